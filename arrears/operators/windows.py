"""Histories by year, cumulative shares, top groups and hashed samples.

Windows run only over yearly or per-group aggregates, whose partitions have one row per year; anything that grows
with the bills or the groups is summed over ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arrears.functions.semantics import differs, percent, present, ratio
from arrears.operators.quantiles import placed


def history_window(entity: str, year: str, frame: tuple[int, int] | None = None):
    window = Window.partitionBy(entity).orderBy(F.col(year).asc_nulls_last())
    return window.rowsBetween(*frame) if frame else window


def cumulative(df: DataFrame, entity: str, year: str, sums: dict[str, str]) -> DataFrame:
    """Running totals by year; a missing amount stays missing and does not stop the total."""
    window = history_window(entity, year, (Window.unboundedPreceding, Window.currentRow))
    added = {new: F.when(F.col(old).isNotNull(), F.sum(old).over(window)) for old, new in sums.items()}
    return present(df, entity).withColumns(added)


def credit_recurrence(df: DataFrame, entity: str, year: str, amount: str, name: str) -> DataFrame:
    """Years so far whose previous year was not zero (the first counts); 0 in a year without amount."""
    window = history_window(entity, year)
    follows = differs(F.lag(amount).over(window), 0)
    marked = present(df, entity).withColumn("_f", follows.cast("int"))
    counted = F.sum("_f").over(history_window(entity, year, (Window.unboundedPreceding, Window.currentRow)))
    return marked.withColumn(name, F.when(F.col(amount) == 0, F.lit(0)).otherwise(counted)).drop("_f")


def isolated_years(df: DataFrame, entity: str, year: str) -> DataFrame:
    """Entity-years that neither the next nor the previous row of the entity repeats.

    Sorted by year, equal years are neighbours, so these are the years that occur once: an aggregate, no sort.
    """
    counted = present(df, entity, year).groupBy(entity, year).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") == 1).drop("_n")


def moving_average(df: DataFrame, group: str, year: str, value: str, name: str, width: int = 2) -> DataFrame:
    """Mean of the last ``width`` years, missing until there are that many values."""
    window = history_window(group, year, (1 - width, 0))
    return df.withColumn(name, F.when(F.count(value).over(window) == width, F.avg(value).over(window)))


def pareto(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Groups by falling total with the cumulative percentage of the grand total."""
    per_group = present(df, group).groupBy(group).agg(F.sum(measure).alias(measure))
    return with_percentage(per_group, [F.col(measure).desc(), F.col(group).asc()], measure)


def pareto_curve(df: DataFrame, measure: str) -> DataFrame:
    """Cumulative percentage over single rows, per distinct amount from the largest down.

    Rows with the same amount are one point of the curve, so a third of all bills at 0 is one row here; the
    cumulative sum then runs range by range. The points are written once, because cuts, offsets and sums read them.
    """
    per_value = present(df, measure).groupBy(measure).agg(F.count(F.lit(1)).alias("linhas"), F.sum(measure).alias("soma"))
    return with_percentage(per_value, [F.col(measure).desc()], "soma")


def with_percentage(df: DataFrame, order: Sequence[Column], measure: str) -> DataFrame:
    """Cumulative sum in an order, and its percentage of the whole."""
    found = placed(df, [], order, measure)
    summed = found.withColumn("acumulado", F.col("_before") + F.coalesce(measure, F.lit(0)))
    return summed.withColumn("porcentagem_acumulada", percent("acumulado", "_total")).drop("_before", "_total")


def year_over_year(df: DataFrame, group: str, year: str, value: str, name: str = "diferenca") -> DataFrame:
    """Value of the previous year of the group minus this year's."""
    return df.withColumn(name, F.lag(value).over(history_window(group, year)) - F.col(value))


def relative_position(df: DataFrame, group: str, year: str, value: str) -> DataFrame:
    """Distance to the yearly mean of the groups, ratio to the leader, and whether always below either.

    Input has one row per group and year. The leader is the group with the highest mean over its years.
    """
    means = df.groupBy(group).agg(F.avg(value).alias("_mean"))
    leader = means.agg(F.max_by(group, F.struct("_mean", group))).scalar()
    of_leader = df.where(F.col(group) == leader).select(year, F.col(value).alias("_lead"))
    general = df.groupBy(year).agg(F.avg(value).alias("_general"))
    placed = df.join(general, year).join(of_leader, year, "left").select(
        group, year, value, (F.col(value) - F.col("_general")).alias("relativo_geral"),
        ratio(value, "_lead").alias("relativo_lider"),
    )
    always = placed.groupBy(group).agg(
        F.bool_and(F.coalesce(F.col("relativo_geral") < 0, F.lit(False))).cast("int").alias("sempre_abaixo_geral"),
        F.bool_and(F.coalesce(F.col("relativo_lider") < 1, F.lit(False))).cast("int").alias("sempre_abaixo_lider"),
    )
    return placed.join(always, group)


def top_groups(df: DataFrame, group: str, measure: Column, n: int) -> DataFrame:
    """The n groups with the largest aggregate."""
    return present(df, group).groupBy(group).agg(measure.alias("_m")).orderBy(F.col("_m").desc(), F.col(group)).limit(n).select(group)


def restricted_to_top(df: DataFrame, group: str, measure: Column, n: int) -> DataFrame:
    return df.join(top_groups(df, group, measure, n), group, "left_semi")


def head(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of an order; each task keeps only its own n candidates."""
    return df.orderBy(*order).limit(n)


def hashed(key: Sequence[str], seed: int) -> Column:
    """Text hash of a key and a seed, the same in every engine that knows md5."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """n rows picked by the hash of their key and a seed: repeatable under any partitioning.

    Each task keeps its own n candidates only.
    """
    return df.withColumn("_place", hashed(key, seed)).orderBy("_place", *key).limit(n).drop("_place")


def in_training_share(key: Sequence[str], seed: int, share: int = 7, of: int = 10) -> Column:
    """True for a repeatable share of the keys."""
    return F.conv(F.substring(hashed(key, seed), 1, 8), 16, 10).cast("bigint") % of < share
