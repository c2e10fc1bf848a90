"""Exact distinct counts that can be stored and merged: bitmaps of whole-number entities per key.

A distinct count cannot be added up over years or neighbourhoods, a bitmap of the entities can be united. One pass
over the rows stores bitmaps at the finest key; every coarser key is answered from the store alone. A bitmap covers
32,768 neighbouring ids, so its 4 KB are shared by the ids that lie close together; ids spread thinly over a wide range
need up to 4 KB each, where `group_measures` is the better way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions.semantics import present

BUCKET, BITS = "_bloco", "_bits"


def entity_bitmaps(df: DataFrame, keys: Sequence[str], entity: str) -> DataFrame:
    """Rows (keys, block of ids, bitmap). Missing keys are a key of their own, missing entities are left out.

    Pairs of key and entity become distinct first, so that repeated rows never reach the sort under the bitmaps; then
    they are dealt by key and block, at most 32,768 rows each, so that a hot key is spread over its blocks and no task
    sends a 4 KB bitmap for a few of its bits.
    """
    number = F.col(entity).cast("bigint")
    marked = present(df, entity).select(
        *keys, F.bitmap_bucket_number(number).alias(BUCKET), F.bitmap_bit_position(number).alias("_place"))
    dealt = marked.distinct().repartition(*keys, BUCKET)
    return dealt.groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg("_place").alias(BITS))


def united(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of a coarser key: any subset of the stored keys, none for the whole table."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def merged(stored: DataFrame, later: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of two stores of the same keys, such as last year's and this month's."""
    return united(stored.unionByName(later), keys)


def distinct_entities(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Exact number of distinct entities per key of any stored granularity, from bitmaps only."""
    counted = united(bitmaps, keys).select(*keys, F.bitmap_count(BITS).alias("_n"))
    if not keys:
        return counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))
    return counted.groupBy(*keys).agg(F.sum("_n").alias(name))


def cumulative_entities(bitmaps: DataFrame, order: str, name: str) -> DataFrame:
    """Distinct entities up to and including each value of a key with few values, such as years.

    A block's bitmap counts for every later value, so the rows grow with the number of values, not with entities.
    """
    per_value = united(bitmaps, [order]).where(F.col(order).isNotNull())
    later = per_value.select(F.col(order).alias("_ate")).distinct()
    reaching = per_value.join(later, F.col(order) <= F.col("_ate")).select(F.col("_ate").alias(order), BUCKET, BITS)
    return distinct_entities(reaching, [order], name)
