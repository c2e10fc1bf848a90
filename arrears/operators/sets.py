"""Key differences between years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions.semantics import present


def new_keys(df: DataFrame, key: str, year: str, current: int, previous: int) -> DataFrame:
    """Keys of one year that the other year lacks: one grouped pass over the two years."""
    two = present(df, key).where(F.col(year).isin(current, previous))
    flags = two.groupBy(key).agg(
        F.bool_or(F.col(year) == current).alias("_now"), F.bool_or(F.col(year) == previous).alias("_then"),
    )
    return flags.where(F.col("_now") & ~F.col("_then")).select(key)


def new_against_previous_year(df: DataFrame, key: str, year: str) -> DataFrame:
    """Keys per year that the year before lacks, for every year after the first."""
    years = F.array_sort(F.collect_set(year))  # at most one entry per year of the table
    per_key = present(df, key, year).groupBy(key).agg(years.alias("_years"))
    first = per_key.agg(F.min(F.element_at("_years", 1))).scalar()
    return (
        per_key.select(F.explode("_years").alias("ano"), "_years")
        .where(~F.array_contains("_years", F.col("ano") - 1) & (F.col("ano") > first))
        .groupBy("ano").agg(F.count(F.lit(1)).alias("novos"))
    )


def cumulative_new(df: DataFrame, key: str, year: str) -> DataFrame:
    """Keys per year and how many of them no earlier year had, in one grouped pass."""
    years = present(df, key, year).groupBy(key).agg(
        F.collect_set(year).alias("_years"), F.min(year).alias("_first"),
    )
    return (
        years.select(F.explode("_years").alias("ano"), "_first")
        .groupBy("ano").agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("ano") == F.col("_first")).alias("novos"),
        )
    )
