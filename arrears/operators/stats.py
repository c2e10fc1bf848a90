"""Closed-form statistics as aggregates."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.semantics import present
from arrears.operators.joins import left_join
from arrears.operators.quantiles import exact_quantiles, order_statistics, placed
from arrears.session import cut_lineage

HOT_SHARE = 0.01


def elbow(curve: DataFrame, k: str = "k", inertia: str = "inercia") -> DataFrame:
    """Number of clusters farthest from the chord between the ends of the inertia curve (one row per k)."""
    ends = curve.agg(
        F.min(k).alias("x1"), F.max(k).alias("x2"), F.min_by(inertia, k).alias("y1"), F.max_by(inertia, k).alias("y2")
    ).withColumn("e", F.struct("x1", "x2", "y1", "y2")).select("e").scalar()
    x1, x2, y1, y2 = (ends.getField(f).cast("double") for f in ("x1", "x2", "y1", "y2"))
    away = F.abs((y2 - y1) * F.col(k) - (x2 - x1) * F.col(inertia) + x2 * y1 - y2 * x1)
    distance = away / F.sqrt((y2 - y1) * (y2 - y1) + (x2 - x1) * (x2 - x1))
    return curve.withColumn("distancia", distance).agg(
        F.min_by(k, F.struct(-F.col("distancia"), F.col(k))).alias("k_ideal"), F.max("distancia").alias("distancia"))


def davies_bouldin(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance.

    Rows are touched twice, both times by map-side aggregates; the rest is an array with one entry per cluster.
    """
    centres = present(df, label).groupBy(label).agg(*[F.avg(F.col(f).cast("double")).alias(f"_c{i}") for i, f in enumerate(features)])
    offsets = [F.col(f).cast("double") - F.col(f"_c{i}") for i, f in enumerate(features)]
    distance = F.sqrt(sum(o * o for o in offsets))
    spread = df.join(F.broadcast(centres), label).groupBy(label).agg(
        F.avg(distance).alias("s"), F.array(*[F.max(f"_c{i}") for i in range(len(features))]).alias("c"))
    clusters = spread.agg(F.collect_list(F.struct(F.col(label).alias("k"), "s", "c")).alias("all"))

    def apart(a, b):
        squares = F.zip_with(a["c"], b["c"], lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda x, y: x + y))

    def worst(a):
        others = F.filter(F.col("all"), lambda b: b["k"] != a["k"])
        return F.array_max(F.transform(others, lambda b: F.try_divide(a["s"] + b["s"], apart(a, b))))

    scores = F.transform(F.col("all"), worst)
    return clusters.select(
        F.size("all").alias("clusters"),
        (F.aggregate(scores, F.lit(0.0), lambda x, y: x + y) / F.size("all")).alias("davies_bouldin"))


def regression_metrics(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """R², MSE, RMSE and Lin's concordance with population moments."""
    y, p = F.col(truth).cast("double"), F.col(prediction).cast("double")
    moments = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("vy"),
        F.var_pop(p).alias("vp"), F.covar_pop(y, p).alias("c"), F.avg(y).alias("my"), F.avg(p).alias("mp"))
    shift = F.col("my") - F.col("mp")
    return moments.select(
        "n", (1 - F.try_divide("mse", "vy")).alias("r2"), "mse", F.sqrt("mse").alias("rmse"),
        F.try_divide(2 * F.col("c"), F.col("vy") + F.col("vp") + shift * shift).alias("ccc"))


def winsor_limits(df: DataFrame, columns: Sequence[str], low: float = 0.05, high: float = 0.05) -> dict[str, tuple[float, float]]:
    """Values at the cut ranks of every column, all columns in the same passes."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "coluna", "valor")
    found = order_statistics(long, "valor", [
        ("baixo", lambda n: F.floor(n * F.lit(low))), ("alto", lambda n: n - F.floor(n * F.lit(high)) - 1),
    ], by="coluna")
    return {r["coluna"]: (r["baixo"], r["alto"]) for r in found.collect()}  # two numbers per column


def winsorize(df: DataFrame, columns: Sequence[str], low: float = 0.05, high: float = 0.05) -> DataFrame:
    """Replace the lowest and highest shares of each column by the value at the cut."""
    limits = winsor_limits(df, columns, low, high)
    clipped = {}
    for c in columns:
        bottom, top = limits[c]
        value = F.col(c).cast("double")
        clipped[c] = F.when(value < bottom, F.lit(bottom)).when(value > top, F.lit(top)).otherwise(value)
    return df.withColumns(clipped)


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair over the rows where both are known, in one aggregate; long form."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("linha"), F.lit(b).alias("coluna"), F.col(f"_{i}").alias("correlacao"))
        for i, (a, b) in enumerate(pairs)
    ])
    return wide.select(F.inline(rows))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank of each distinct value of each column, ties averaged: rows (coluna, valor, _n, _rank).

    Equal values are one row before anything is ordered, and all columns are ranked in the same passes.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "coluna", "valor")
    counts = present(long, "valor").groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("_n"))
    found = placed(counts, ["coluna"], [F.col("valor").asc()], "_n")
    return found.select("coluna", "valor", "_n", (F.col("_before") + (F.col("_n") + 1) / F.lit(2.0)).alias("_rank"))


def with_ranks(df: DataFrame, ranks: DataFrame, col: str, rows: int, name: str) -> DataFrame:
    """Attach the rank of each value. Values that fill more than 1 % of the rows, at most a hundred, come from a
    broadcast table; the join on the others therefore has no hot key."""
    is_hot = F.col("_n") > HOT_SHARE * rows
    hot = ranks.where(is_hot).select(F.col("valor").alias("_hot"), F.col("_rank").alias("_hot_rank"))
    cold = ranks.where(~is_hot).select(F.col("valor").alias("_cold"), F.col("_rank").alias("_cold_rank"))
    number = F.col(col).cast("double")
    marked = df.join(F.broadcast(hot), number == F.col("_hot"), "left")
    keyed = marked.withColumn("_cold", F.when(F.col("_hot").isNull(), number))
    joined = left_join(keyed, cold, ["_cold"])
    return joined.withColumn(name, F.coalesce("_hot_rank", "_cold_rank")).drop("_hot", "_hot_rank", "_cold", "_cold_rank")


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every pair over rows complete in all columns; long form.

    The complete rows are written once, because every column ranks them again.
    """
    base = cut_lineage(present(df.select(*columns), *columns))
    rows = base.count()
    ranks = cut_lineage(average_ranks(base, columns))
    ranked = base
    for c in columns:
        ranked = with_ranks(ranked, ranks.where(F.col("coluna") == c), c, rows, f"_r_{c}")
    return pearson(ranked.select(*[F.col(f"_r_{c}").alias(c) for c in columns]), columns)


def chi_square_uniform(counts: DataFrame, col: str) -> DataFrame:
    """Goodness of fit of band counts against equal counts, from exact sums."""
    sums = counts.agg(F.count(col).alias("n"), F.sum(col).alias("s"), F.sum(F.col(col) * F.col(col)).alias("q"))
    n, s, q = (F.col(c).cast("double") for c in ("n", "s", "q"))
    return sums.select(((q - s * s / n) * n / s).alias("estatistica"), (F.col("n") - 1).alias("graus"))


def chi_square_p_value(statistic: float, degrees: int) -> float:
    """Upper tail of the chi-square distribution for whole degrees of freedom."""
    half = statistic / 2
    if degrees % 2 == 0:
        term, total, start = math.exp(-half), math.exp(-half), 1
        for i in range(start, degrees // 2):
            term *= half / i
            total += term
        return total
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range((degrees - 1) // 2):
        total += term
        term *= half / (i + 1.5)
    return total


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Association of two categories; the chi-square needs only the cells that occur.

    Tables of two by two get the continuity correction.
    """
    cells = present(df, a, b).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy(a).agg(F.sum("o").alias("r"))
    columns = cells.groupBy(b).agg(F.sum("o").alias("c"))
    share = F.col("o").cast("double") * F.col("o") / (F.col("r").cast("double") * F.col("c"))
    fit = cells.join(rows, a).join(columns, b).agg(
        F.sum("o").alias("n"), F.sum(share).alias("s"), F.count_distinct(a).alias("lines"), F.count_distinct(b).alias("cols"))
    inverse_r = rows.agg(F.sum(1 / F.col("r").cast("double"))).scalar()
    inverse_c = columns.agg(F.sum(1 / F.col("c").cast("double"))).scalar()
    smaller = F.least("lines", "cols") - 1
    raw = fit.withColumn("chi", F.greatest(F.col("n") * (F.col("s") - 1), F.lit(0.0)))
    gap = F.sqrt(F.col("chi") / (F.col("n") * inverse_r * inverse_c))
    corrected = F.col("chi") * F.pow(F.coalesce(F.try_divide(F.greatest(gap - 0.5, F.lit(0.0)), gap), F.lit(0.0)), 2)
    chi = F.when((F.col("lines") == 2) & (F.col("cols") == 2), corrected).otherwise(F.col("chi"))
    return raw.select("n", "lines", "cols", chi.alias("qui_quadrado"),
                      F.sqrt(F.try_divide(chi, F.col("n") * smaller)).alias("v"))


def t_critical(degrees):
    """Two-sided 95 % Student t value of a column of degrees of freedom: a table, then an expansion."""
    z, v = fv.NORMAL_CRITICAL_95, degrees.cast("double")
    far = z + (z**3 + z) / (4 * v) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * v * v)
    table = F.array(*map(F.lit, fv.T_CRITICAL_95))
    return F.when(degrees < 1, None).when(degrees <= len(fv.T_CRITICAL_95), F.try_element_at(table, degrees.cast("int"))).otherwise(far)


def t_interval(df: DataFrame, group: str, value: str) -> DataFrame:
    """95 % interval of each group's mean and whether the mean lies outside the interval of all groups."""
    def interval(frame):
        half = t_critical(F.col("n") - 1) * F.col("desvio") / F.sqrt("n")
        return frame.withColumn("inferior", F.col("media") - half).withColumn("superior", F.col("media") + half)

    measures = [F.count(value).alias("n"), F.avg(value).alias("media"), F.stddev_samp(value).alias("desvio")]
    general = interval(df.agg(*measures)).select(F.struct("inferior", "superior").alias("g")).scalar()
    outside = (F.col("media") < general.getField("inferior")) | (F.col("media") > general.getField("superior"))
    return interval(df.groupBy(group).agg(*measures)).withColumn("fora_do_geral", outside.cast("int"))


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str) -> dict[str, tuple[float, float]]:
    """Centre and scale per column: ``standard`` (population), ``robust`` (median, quartile range) or ``minmax``."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if kind == "robust":
        long = numbers.unpivot([], list(columns), "coluna", "valor")
        found = exact_quantiles(long, "valor", [0.25, 0.5, 0.75], by="coluna").collect()  # one row per column
        fitted = {r["coluna"]: (r["q1"], r["q2"] - r["q0"]) for r in found}
    else:
        if kind == "standard":
            measures = [m for i, c in enumerate(columns) for m in (F.avg(c).alias(f"a{i}"), F.stddev_pop(c).alias(f"b{i}"))]
        elif kind == "minmax":
            measures = [m for i, c in enumerate(columns) for m in (F.min(c).alias(f"a{i}"), (F.max(c) - F.min(c)).alias(f"b{i}"))]
        else:
            raise ValueError(f"unknown scaler {kind}")
        row = numbers.agg(*measures).first()
        fitted = {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}
    return {c: (centre, scale or 1.0) for c, (centre, scale) in fitted.items()}


def scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({
        c + suffix: (F.col(c).cast("double") - F.lit(centre)) / F.lit(width) for c, (centre, width) in fitted.items()
    })
