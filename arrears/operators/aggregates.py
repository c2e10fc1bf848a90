"""Grouped reports: sums, shares, pivots, duplicates and collection sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions.semantics import first_present, percent, present, ratio, round_even, sum0
from arrears.operators.quantiles import exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def group_measures(df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), counts: Sequence[str] = (),
                   distinct: Sequence[str] = (), maxima: Sequence[str] = ()) -> DataFrame:
    """Sums, non-missing counts, exact distinct counts and maxima of one grouping in one pass."""
    measures = (
        [sum0(c).alias(f"sum_{c}") for c in sums]
        + [F.count(c).alias(f"count_{c}") for c in counts]
        + [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct]
        + [F.max(c).alias(f"max_{c}") for c in maxima]
    )
    return present(df, *keys).groupBy(*keys).agg(*measures)


def average_nonzero(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """Average ticket: mean of the non-zero amounts per group, from exact sums."""
    return (
        present(df, key).where(F.col(col) != 0).groupBy(key)
        .agg(F.sum(col).alias("_s"), F.count(col).alias("_n"))
        .select(key, ratio("_s", "_n").alias(name))
    )


def entity_rollup(df: DataFrame, keys: Sequence[str], sums: Sequence[str], attributes: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Money per entity with its first known attributes on a documented order."""
    measures = [sum0(c).alias(c) for c in sums] + [first_present(a, order).alias(a) for a in attributes]
    return present(df, *keys).groupBy(*keys).agg(*measures)


def table_totals(df: DataFrame, col: str) -> DataFrame:
    """Sum, mean, extremes and sample deviation of one column, from exact sums."""
    n, total, squares = F.col("n"), F.col("total").cast("double"), F.col("squares").cast("double")
    return df.agg(
        F.count(col).alias("n"), F.sum(col).alias("total"), F.min(col).alias("minimo"), F.max(col).alias("maximo"),
        F.sum((F.col(col) * F.col(col))).alias("squares"),
    ).select(
        "n", "total", "minimo", "maximo", ratio("total", "n").alias("media"),
        F.sqrt(F.try_divide(squares - total * total / n, n - 1)).alias("desvio"),
    )


def paid_share_and_opportunity(df: DataFrame, key: str) -> DataFrame:
    """Paid percentage of each group and the open money that percentage would recover."""
    return (
        present(df, key).groupBy(key)
        .agg(F.sum("vlr_pago").alias("vlr_pago_total"), F.sum("vlr_aberto").alias("vlr_aberto_total"),
             F.sum("vlr_total_dam").alias("vlr_total_dam"))
        .withColumn("percentual_pago", percent("vlr_pago_total", F.col("vlr_pago_total") + F.col("vlr_aberto_total")))
        .withColumn("oportunidade", F.col("percentual_pago") * F.col("vlr_aberto_total").cast("double") / 100)
    )


def share_of_total(df: DataFrame, key: str, measure: Column, name: str, digits: int = 5) -> DataFrame:
    """Measure per group, the grand total of the groups and the rounded share.

    The total is a scalar over the grouped result, so no window gathers the groups in one task.
    """
    grouped = present(df, key).groupBy(key).agg(measure.alias(name))
    total = grouped.agg(F.sum(name)).scalar()
    return grouped.select(key, name, total.alias(f"total_{name}")).withColumn(
        f"perc_{name}", round_even(ratio(name, f"total_{name}"), digits))


def frequency(df: DataFrame, *cols: str) -> DataFrame:
    """Occurrences of each value or combination, most frequent first."""
    counted = present(df, *cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("num_ocorr"))
    return counted.orderBy(F.col("num_ocorr").desc(), *[F.col(c).asc() for c in cols])


def describe(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, for the table or per group."""
    keys = [by] if by else []
    base = present(df, *keys, col)
    n, total, squares = F.col("count"), F.col("_sum").cast("double"), F.col("_squares").cast("double")
    deviation = F.sqrt(F.greatest(F.try_divide(squares - total * total / n, n - 1), F.lit(0.0)))
    measures = [
        F.count(col).alias("count"), F.sum(col).alias("_sum"), F.sum(F.col(col) * F.col(col)).alias("_squares"),
        F.min(col).alias("min"), F.max(col).alias("max"),
    ]
    shown = [*keys, "count", ratio("_sum", "count").alias("mean"), deviation.alias("std"), "min", "max"]
    summary = (base.groupBy(by) if by else base).agg(*measures).select(*shown)
    quartiles = exact_quantiles(base, col, QUARTILES, by)
    if by:
        return summary.join(quartiles.drop("n"), by)
    return summary.join(quartiles.withColumnRenamed("n", "count"), "count", "left")  # one row on either side


def describe_text(df: DataFrame) -> DataFrame:
    """Per text column: known values, distinct values, the most frequent one and its frequency."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counted = (
        df.select(*texts).unpivot([], texts, "coluna", "valor").where(F.col("valor").isNotNull())
        .groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("coluna").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unicos"),
        F.min_by("valor", F.struct(-F.col("n"), F.col("valor"))).alias("top"), F.max("n").alias("freq"),
    )


def listed(column: str, values: Sequence) -> Column:
    """A pivot column whose values must be in the list: a value that is not fails the job instead of vanishing."""
    unlisted = F.raise_error(F.concat(F.lit(f"{column} has a value without a column: "), F.col(column).cast("string")))
    return F.when(F.col(column).isNull() | F.col(column).isin(list(values)), F.col(column)).otherwise(unlisted)


def pivot_distinct(df: DataFrame, row: str, column: str, entity: str, values: Sequence) -> DataFrame:
    """Distinct entities per row and column value, 0 where there are none, with the row total."""
    counted = present(df, row, column).withColumn(column, listed(column, values)).groupBy(row, column).agg(
        F.count_distinct(entity).alias("_n"))
    wide = counted.groupBy(row).pivot(column, list(values)).agg(F.first("_n")).fillna(0)
    return wide.withColumn("total", sum(F.col(str(v)) for v in values))


def column_totals(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Totals of the value columns of a pivot."""
    return wide.agg(*[F.sum(c).alias(c) for c in columns])


def pivot_sum(df: DataFrame, row: str, column: str, measure: str, values: Sequence, prefix: str = "") -> DataFrame:
    known = present(df, row).withColumn(column, listed(column, values))
    wide = known.groupBy(row).pivot(column, list(values)).agg(F.sum(measure)).fillna(0)
    return wide.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    known = present(df, row, column).withColumn(column, listed(column, values))
    wide = known.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return wide.fillna(0)


def distinct_per_column(df: DataFrame) -> DataFrame:
    """Exact number of distinct known values of every column, one row per column."""
    wide = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "coluna", "distintos")


def top_row(df: DataFrame, key: str, by: Column, pick: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The row with the largest value per group; missing values never win, ties go to the smallest ``tie``."""
    ranked = present(df, key).withColumn("_by", by).where(F.col("_by").isNotNull())
    order = F.struct(-F.col("_by"), *[F.col(t) for t in tie])
    chosen = ranked.groupBy(key).agg(F.min_by(F.struct("_by", *pick), order).alias("_r"))
    return chosen.select(key, F.col("_r._by").alias("maior"), *[F.col(f"_r.{p}").alias(p) for p in pick])


def leading_category(df: DataFrame, group: str, category: str, measure: Column, name: str) -> DataFrame:
    """Category with the largest aggregate per group: an aggregate of an aggregate."""
    per_pair = present(df, group, category).groupBy(group, category).agg(measure.alias(name))
    return top_row(per_pair, group, F.col(name), [category], [category]).withColumnRenamed("maior", name)


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows of a key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum("_n").alias("linhas"), F.count(F.lit(1)).alias("chaves")).withColumn(
        "repetidas", F.col("linhas") - F.col("chaves"))


def duplicate_members(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once: count first, then keep the members."""
    repeated = present(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return df.join(repeated.select(key), key, "left_semi")


def conditional_share(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows that satisfy each condition and their percentage of all rows."""
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])
    long = wide.unpivot(["_total"], list(conditions), "condicao", "quantidade")
    return long.select("condicao", "quantidade", F.col("_total").alias("total"),
                       percent("quantidade", "_total").alias("percentual"))


def conflicting_keys(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Keys for which a column takes more than one value."""
    counted = present(df, *keys).groupBy(*keys).agg(F.count_distinct(col).alias("valores"))
    return counted.where(F.col("valores") > 1)


def collection_sheet(df: DataFrame, key: str) -> DataFrame:
    """Bills, money, presumed debt and percentages per value of any key.

    Bills without the key are grouped too, so that the share of all bills needs no second scan, and then left out.
    """
    grouped = df.groupBy(key).agg(
        F.count("dam").alias("dams"), sum0("vlr_pago").alias("vlr_pago"),
        sum0("vlr_total_dam").alias("vlr_total_dam"), sum0("vlr_aberto").alias("vlr_aberto"),
    )
    bills = grouped.agg(F.sum("dams")).scalar()
    return grouped.where(F.col(key).isNotNull()).select(
        "*", (F.col("vlr_total_dam") - F.col("vlr_pago")).alias("suposto_devido"),
        percent("vlr_pago", "vlr_total_dam").alias("percentual_pago"),
        percent("dams", bills).alias("percentual_dams"),
    )


def ticket_per_entity(df: DataFrame, key: str, entity: str, measure: str) -> DataFrame:
    grouped = present(df, key).groupBy(key).agg(F.sum(measure).alias(measure), F.count_distinct(entity).alias("entidades"))
    return grouped.withColumn("ticket_medio", ratio(measure, "entidades"))
