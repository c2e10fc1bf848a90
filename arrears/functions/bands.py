"""Fixed-edge bands: labels, band columns and complete frequency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.semantics import ratio, round_even


def half_open_labels(edges: Sequence[float]) -> list[str]:
    return [f"[{float(low)}, {float(high)})" for low, high in zip(edges, edges[1:])]


def band(col: Column | str, edges: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """Band label; closed on the left by default, on the right with ``right``; outside → null."""
    c = F.col(col) if isinstance(col, str) else col
    expression: Column | None = None
    for low, high, label in zip(edges, edges[1:], labels):
        lower = (c > low) if right else (c >= low)
        inside = lower if high == float("inf") else lower & ((c <= high) if right else (c < high))
        expression = F.when(inside, F.lit(label)) if expression is None else expression.when(inside, F.lit(label))
    return expression


def label_table(spark: SparkSession, labels: Sequence[str], name: str, order: str = "ordem") -> DataFrame:
    """Literal dimension that gives every label its position; its size is the number of labels."""
    rows = [(label, position) for position, label in enumerate(labels)]
    return F.broadcast(spark.createDataFrame(rows, f"{name} string, {order} int"))


def band_frequency(
    df: DataFrame, col: Column | str, edges: Sequence[float], labels: Sequence[str] | None = None,
    digits: int = 4, right: bool = False, name: str = "faixa",
) -> DataFrame:
    """Rows and share per band, empty bands included."""
    labels = list(labels or half_open_labels(edges))
    counted = (
        df.select(band(col, edges, labels, right).alias(name))
        .where(F.col(name).isNotNull())
        .groupBy(name).agg(F.count(F.lit(1)).alias("freq"))
    )
    total = counted.agg(F.sum("freq")).scalar()
    return (
        label_table(df.sparkSession, labels, name)
        .join(counted, name, "left")
        .select(
            name, "ordem",
            F.coalesce("freq", F.lit(0)).alias("freq"),
            total.alias("total"),
        )
        .withColumn("perc", round_even(ratio("freq", "total"), digits))
    )


def band_sums(
    df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str],
    sums: Sequence[str], count: str | None = None, right: bool = False, name: str = "faixa",
) -> DataFrame:
    """Counts and sums per band, 0 for empty bands."""
    measures = [F.sum(s).alias(s) for s in sums]
    if count:
        measures.insert(0, F.count(count).alias("quantidade"))
    grouped = (
        df.withColumn(name, band(col, edges, labels, right))
        .where(F.col(name).isNotNull())
        .groupBy(name).agg(*measures)
    )
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in grouped.columns if c != name]
    return label_table(df.sparkSession, labels, name).join(grouped, name, "left").select(name, "ordem", *filled)


def band_crosstab(
    df: DataFrame, rows: str, columns: str, edges: Sequence[float], labels: Sequence[str] | None = None,
) -> DataFrame:
    """Band of one measure against band of another; every column band is present."""
    labels = list(labels or half_open_labels(edges))
    return (
        df.select(band(rows, edges, labels).alias("faixa_linha"), band(columns, edges, labels).alias("faixa_coluna"))
        .where(F.col("faixa_linha").isNotNull() & F.col("faixa_coluna").isNotNull())
        .groupBy("faixa_linha").pivot("faixa_coluna", labels).agg(F.count(F.lit(1)))
        .fillna(0)
    )
