"""Ratings: class and recovery index → five levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.semantics import differs, holds, last_wins
from arrears.operators.quantiles import exact_quantiles

RULE_TABLES = {
    "v1": fv.RATING_V1,
    "v15": fv.RATING_V15,
    "k5": fv.RATING_K5,
    "k6": fv.RATING_K6,
}


def rating(variant: str, klass: str = "class_contribuinte", index: str = "igr") -> Column:
    """Rating of one rule table; an index of 0 is always the lowest level."""
    igr = F.col(index)
    rules: list[tuple[Column, object]] = [(holds(igr == 0), fv.RATING_ZERO)]
    for number, low, high, level in RULE_TABLES[variant]:
        fits = (F.col(klass) == number) & (differs(igr, 0.0) if low is None else igr >= low)
        if high is not None:
            fits = fits & (igr < high)
        rules.append((holds(fits), level))
    return last_wins(rules)


def quantile_rating(df: DataFrame, klass: str = "class_contribuinte", index: str = "igr") -> DataFrame:
    """Rating cut at the exact .5 and .75 quantiles of the index within two classes."""
    cuts = exact_quantiles(
        df.where(F.col(klass).isin(list(fv.RATING_QUANTILE_CLASSES))), index, fv.RATING_QUANTILE_LEVELS, by=klass,
    )
    wide = {
        (row[klass], level): row[f"q{position}"]
        for row in cuts.collect()  # one row per class of the fixed rule table
        for position, level in enumerate(fv.RATING_QUANTILE_LEVELS)
    }
    igr, k = F.col(index), F.col(klass)
    low, high = fv.RATING_QUANTILE_LEVELS
    top_class, top = fv.RATING_QUANTILE_CLASS_ALWAYS_TOP
    bad_class, bad = fv.RATING_QUANTILE_CLASS_BAD
    first_class, first = fv.RATING_QUANTILE_CLASS_FIRST
    nonzero = differs(igr, 0.0)
    rules = [(holds(igr == 0), fv.RATING_ZERO), (holds((k == top_class) & nonzero), top)]
    for number, (above, middle, below) in fv.RATING_QUANTILE_CLASSES.items():
        if (number, low) not in wide:
            continue
        median, upper = F.lit(wide[number, low]), F.lit(wide[number, high])
        rules += [
            (holds((k == number) & (igr >= upper)), above),
            (holds((k == number) & (igr < upper) & (igr >= median)), middle),
            (holds((k == number) & (igr < median) & nonzero), below),
        ]
    rules += [(holds((k == bad_class) & nonzero), bad), (holds(k == first_class), first)]
    return df.withColumn("rating_divida", last_wins(rules))


def collection_action(kind: str = "tipo_divida", value: str = "valor_total_da") -> Column:
    """Action for a debt of this type and value; null below the smallest threshold."""
    expression = F.when(F.lit(False), F.lit(None).cast("string"))
    for debt, action, low, high in fv.ACTIONS:
        fits = (F.col(kind) == debt) & (F.col(value) >= low)
        if high is not None:
            fits = fits & (F.col(value) < high)
        expression = expression.when(fits, F.lit(action))
    return expression
