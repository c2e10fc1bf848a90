"""Null, ordering, rounding and overwrite rules of data-frame code, written as Spark columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def present(df: DataFrame, *keys: str) -> DataFrame:
    """Grouping and joining drop rows with a missing key; filter before the shuffle."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def sum0(col: Column | str) -> Column:
    """Sum that is 0, not null, when nothing is there to add."""
    return F.coalesce(F.sum(col), F.lit(0))


def total_if(condition: Column, col: Column | str) -> Column:
    """Sum of a column over the rows that satisfy a condition, 0 when there are none."""
    return F.sum(F.when(condition, _c(col)).otherwise(F.lit(0)))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; null when the denominator is 0 or missing."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return ratio(part, whole) * 100


def guarded(denominator: Column | str) -> Column:
    """Missing or zero denominators count as 1."""
    d = _c(denominator)
    return F.when(d.isNull() | (d == 0), F.lit(1)).otherwise(d)


def capped(col: Column | str, top: float = 1.0) -> Column:
    """Values above the cap become the cap; missing values stay missing."""
    c = _c(col)
    return F.when(c > top, F.lit(top)).otherwise(c)


def differs(col: Column | str, value: object) -> Column:
    """Inequality that is true for a missing value."""
    other = value if isinstance(value, Column) else F.lit(value)
    return ~_c(col).eqNullSafe(other)


def holds(condition: Column) -> Column:
    """Comparison that is false, not null, for missing values."""
    return F.coalesce(condition, F.lit(False))


def ascending(col: str) -> Column:
    """Ascending with missing values last."""
    return F.col(col).asc_nulls_last()


def descending(col: str) -> Column:
    return F.col(col).desc_nulls_last()


def round_even(col: Column | str, digits: int) -> Column:
    """Scale, round half to even, scale back: the array-library rounding of doubles."""
    factor = float(10**digits)
    return F.rint(_c(col).cast("double") * factor) / factor


def last_wins(rules: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Compile masked assignments applied in order, where a later one overwrites an earlier one.

    CASE takes the first branch that fits, so the branches run from the last rule to the first.
    """
    def column(value: object) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    expression: Column | None = None
    for condition, value in reversed(rules):
        if expression is None:
            expression = F.when(condition, column(value))
        else:
            expression = expression.when(condition, column(value))
    if expression is None:
        return column(otherwise)
    return expression.otherwise(column(otherwise))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], nearly_unique: bool = False) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    An aggregate instead of a ranked window: map tasks already reduce a hot key to one row each. Rows are sorted for it
    on both sides of the exchange; where keys are ``nearly_unique`` there is nothing to reduce, so rows are exchanged
    first and one sort serves.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = [c for c in order if c not in keys] + rest
    if not payload:
        return df.distinct()
    dealt = df.repartition(*keys) if nearly_unique else df
    picked = dealt.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("_first"))
    columns = [F.col(k) if k in keys else F.col(f"_first.{k}").alias(k) for k in df.columns]
    return picked.select(*columns)


def first_present(col: str, order: Sequence[str]) -> Column:
    """First non-missing value of an attribute within its group, on a documented order."""
    tie_broken = F.struct(*[F.col(o) for o in order], F.col(col))
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), tie_broken))
