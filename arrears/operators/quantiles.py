"""Exact order statistics, places and running totals of tables of any size, by one path.

Equal values are counted first, so a value that a third of the rows share is one row. Rows are then dealt into ranges
of the order, as many as the session has shuffle partitions, and written once with the number of their range. Sums per
range give each range its offset, and windows run inside ranges only. What every step keeps per range or group stays in
frames; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arrears.session import cut_lineage


def placed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], measure: str) -> DataFrame:
    """Add ``_before``, the sum of a measure over the earlier rows of the same keys, and ``_total``, that over all.

    Rows with equal order share a range, so orders that hold many equal rows should be counted first. A window without
    keys sees one row per range only.
    """
    ranges = df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_part", F.spark_partition_id())
    dealt = cut_lineage(ranges)
    sums = dealt.groupBy(*keys, "_part").agg(F.sum(measure).alias("_sum"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_skip"),
                         F.sum("_sum").over(whole).alias("_total"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = dealt.join(starts, [*keys, "_part"])
    return found.withColumn(
        "_before", F.col("_skip") + F.coalesce(F.sum(measure).over(inside), F.lit(0))).drop("_part", "_skip")


def order_statistics(df: DataFrame, value: str, ranks: Sequence[tuple[str, Callable[[Column], Column]]],
                     by: str | None = None) -> DataFrame:
    """Values at zero-based ranks of the non-missing rows, per group; ``ranks`` holds names and functions from the
    row count to the rank. A table without rows has no statistics."""
    keys = [by] if by else []
    known = df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if by:
        known = known.where(F.col(by).isNotNull())
    counts = known.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_m"))
    ranked = placed(counts, keys, [F.col("_v").asc()], "_m")
    n = F.col("_total")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_m")), F.col("_v")))

    picked = ranked.groupBy(*keys).agg(F.max(n).alias("n"), *[at(rank(n)).alias(name) for name, rank in ranks])
    return picked.where(F.col("n").isNotNull())


def exact_quantiles(df: DataFrame, value: str, levels: Sequence[float], by: str | None = None) -> DataFrame:
    """Linearly interpolated quantiles ``q0, q1, …`` per group, as double."""
    ranks = []
    for i, level in enumerate(levels):
        ranks.append((f"_lo{i}", lambda n, q=float(level): F.floor((n - 1) * F.lit(q))))
        ranks.append((f"_hi{i}", lambda n, q=float(level): F.ceil((n - 1) * F.lit(q))))
    found = order_statistics(df, value, ranks, by)

    def interpolated(i: int, level: float) -> Column:
        low, high = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        position = (F.col("n") - 1) * F.lit(float(level))
        return (low + (high - low) * (position - F.floor(position))).alias(f"q{i}")

    return found.select(*([by] if by else []), "n", *[interpolated(i, level) for i, level in enumerate(levels)])


def running_total(df: DataFrame, order: Sequence[Column], measure: str, name: str) -> DataFrame:
    """Cumulative sum over a whole table in an order without equal rows."""
    found = placed(df, [], order, measure)
    return found.withColumn(name, F.col("_before") + F.coalesce(measure, F.lit(0))).drop("_before", "_total")
