"""Joins with explicit rules for missing keys, row conservation and clashing column names.

Joins are left to the planner: it broadcasts a side only below its size limit, and splits hot keys of inner, left, semi
and anti joins at run time, rows with a missing key among them. Right and full joins are put together from those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from arrears.functions.semantics import present
from arrears.session import cut_lineage


def inner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi-join; missing keys never match, so they are not even shuffled."""
    return present(left, *on).join(present(right, *on), list(on), "inner")


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join; missing keys match nothing, and those of the right side are not even shuffled."""
    return left.join(present(right, *on), list(on), "left")


def left_renamed(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on differently named keys; only the left name survives."""
    return left_join(left, right.withColumnRenamed(right_key, left_key), [left_key])


def full(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join; rows with missing keys stay on their own side.

    In two parts, the left join and the right rows without a match, because a hot key of a full join is never split.
    """
    joined = left_join(left, right, on)
    return joined.unionByName(anti(right, left, on), allowMissingColumns=True)


def full_matching_nulls(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join of two frames with one row per key, in which the missing keys match each other.

    Fails if both sides have several rows with a missing key, which would pair all of them.
    """
    nameless = [side.where(F.col(key).isNull()) for side in (left, right)]
    if all(side.limit(2).count() > 1 for side in nameless):
        raise ValueError(f"both sides have several rows without {key}")
    matched = full(present(left, key), present(right, key), [key])
    pair = [side.withColumn("_nameless", F.lit(1)) for side in (nameless[0], nameless[1].drop(key))]
    unkeyed = pair[0].join(pair[1], "_nameless", "full").drop("_nameless")
    return matched.unionByName(unkeyed.select(matched.columns))


def right(left: DataFrame, right_side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Right join: the matches, and the right rows without any.

    In two parts, because run-time splitting of a hot key on the left works for inner joins, not for right ones.
    """
    keys = list(on)
    matched = inner(left, right_side, keys)
    unmatched = anti(right_side, left, keys)
    return matched.unionByName(unmatched, allowMissingColumns=True)


def anti(left: DataFrame, right_side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left frame whose key the right frame lacks; a missing key counts as lacking."""
    return left.join(present(right_side.select(*on), *on).distinct(), list(on), "left_anti")


def semi(left: DataFrame, right_side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left frame whose key the right frame has."""
    return present(left, *on).join(present(right_side.select(*on), *on).distinct(), list(on), "left_semi")


def suffixed(left: DataFrame, right_side: DataFrame, on: Sequence[str], how: str = "full",
             suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Join in which columns that both sides have get a suffix each."""
    shared = [c for c in left.columns if c in right_side.columns and c not in on]
    first = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    second = right_side.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return full(first, second, on) if how == "full" else first.join(second, list(on), how)


def attach_measures(df: DataFrame, keys: Sequence[str], *measures) -> DataFrame:
    """Group measures next to every row of their group: aggregate first, then join the result back.

    The groups are written first. An aggregate in the stage of the join would keep a hot key from being split; with
    both sides behind exchanges of their own it is.
    """
    grouped = cut_lineage(present(df, *keys).groupBy(*keys).agg(*measures))
    return left_join(df, grouped, keys)


class Conservation:
    """Row count and sums of a frame at two places of one plan, taken by the very pass that writes the result.

    ``enter`` marks the frame before a step, ``leave`` the one behind it; both are observed while the plan runs, so
    nothing is planned or read twice. ``sums`` maps a name to the column before and the column behind. Sums should be
    of whole numbers or decimals, which do not depend on the order of rows. ``check`` is called after the write and
    fails when the two differ.
    """

    def __init__(self, what: str, **sums: tuple[str, str]):
        self.what = what
        self.sums = sums
        self._before, self._behind = Observation(), Observation()

    def _totals(self, side: int) -> list[Column]:
        return [F.count(F.lit(1)).alias("rows"), *[F.sum(pair[side]).alias(name) for name, pair in self.sums.items()]]

    def enter(self, df: DataFrame) -> DataFrame:
        return df.observe(self._before, *self._totals(0))

    def leave(self, df: DataFrame) -> DataFrame:
        return df.observe(self._behind, *self._totals(1))

    def totals(self) -> tuple[dict, dict]:
        """Count and sums before and behind; 0 where there were no rows to observe."""
        found = [side.get for side in (self._before, self._behind)]
        return tuple({name: side.get(name) or 0 for name in ("rows", *self.sums)} for side in found)

    def check(self) -> dict:
        before, behind = self.totals()
        changed = [f"{name} {before[name]} became {behind[name]}" for name in before if before[name] != behind[name]]
        if changed:
            raise ValueError(f"{self.what}: {', '.join(changed)}")
        return before
