"""Sliced order statistics, ranks and running totals against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arrears.operators import quantiles as Q
from arrears.operators import stats as S
from arrears.operators import windows as W


def sample(kind, n, seed):
    rng = random.Random(seed)
    if kind == "hot":  # a third of the rows share one value
        return [0.0 if rng.random() < 0.34 else round(rng.random() * 1000, 2) for _ in range(n)]
    if kind == "few":
        return [float(rng.randrange(4)) for _ in range(n)]
    return [round(rng.gauss(0, 50), 3) for _ in range(n)]


@pytest.mark.parametrize("kind", ["hot", "few", "spread"])
def test_quantiles(spark, kind):
    data = {g: sample(kind, n, g) for g, n in ((1, 3001), (2, 7), (3, 1))}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs] + [(1, None), (None, 5.0)], "g int, v double").repartition(5)
    levels = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = {r["g"]: r for r in Q.exact_quantiles(df, "v", levels, by="g").collect()}
    assert set(found) == set(data)
    for g, values in data.items():
        assert found[g]["n"] == len(values)
        assert [found[g][f"q{i}"] for i in range(5)] == pytest.approx(list(np.quantile(values, levels)), abs=1e-9)


def test_whole_table_quantiles(spark):
    values = sample("hot", 5000, 9)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = Q.exact_quantiles(df, "v", [0.1, 0.9]).first()
    assert [row["q0"], row["q1"]] == pytest.approx(list(np.quantile(values, [0.1, 0.9])))


def test_a_group_of_over_a_million_rows(spark):
    rows = 1_200_000
    df = spark.range(rows).select(F.lit("big").alias("g"), (F.col("id") * 7919 % rows).alias("v")).unionAll(
        spark.range(5).select(F.lit("small"), "id"))
    found = {r["g"]: (r["n"], r["q0"], r["q1"]) for r in Q.exact_quantiles(df, "v", [0.25, 0.9], by="g").collect()}
    assert found["big"] == (rows, (rows - 1) * 0.25, pytest.approx((rows - 1) * 0.9))
    assert found["small"] == (5, 1.0, pytest.approx(3.6))


def test_no_rows_have_no_statistics(spark):
    assert Q.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).count() == 0


def test_winsorize(spark):
    df = spark.createDataFrame([(i, float(41 - i)) for i in range(1, 41)], "v int, w double")
    out = sorted(r["v"] for r in S.winsorize(df, ["v", "w"]).collect())
    assert out[:3] == [3, 3, 3] and out[-3:] == [38, 38, 38] and out[3:-3] == list(range(4, 38))


def test_running_total_over_ranges(spark):
    values = sorted(set(sample("spread", 3000, 5)))
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "v double, m int").repartition(6)
    out = Q.running_total(df, [F.col("v").desc()], "m", "t").orderBy(F.col("v").desc()).collect()
    expected = np.cumsum([r["m"] for r in out])
    assert [r["t"] for r in out] == list(expected)


def test_spearman_with_hot_values(spark):
    n = 2000
    frame = pd.DataFrame({"a": sample("hot", n, 1), "b": sample("few", n, 2), "c": sample("spread", n, 3)})
    frame["b"] = frame["b"] + frame["a"].round(-2)
    df = spark.createDataFrame(frame).repartition(5)
    expected = frame.rank().corr()
    for r in S.spearman(df, ["a", "b", "c"]).collect():
        assert r["correlacao"] == pytest.approx(expected.loc[r["linha"], r["coluna"]], abs=1e-9)


def test_pareto_curve_ends_at_all(spark):
    df = spark.createDataFrame([(0,)] * 10 + [(5,), (5,), (30,)], "v int")
    out = {r["v"]: r for r in W.pareto_curve(df, "v").collect()}
    assert out[30]["porcentagem_acumulada"] == 75.0 and out[5]["porcentagem_acumulada"] == 100.0
    assert out[0]["linhas"] == 10 and out[0]["acumulado"] == 40


def test_sample_is_repeatable_and_filtered_alike(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 2)
    first = {r["id"] for r in W.sample_rows(df, ["id"], 300, seed=4).collect()}
    again = {r["id"] for r in W.sample_rows(df.repartition(11), ["id"], 300, seed=4).collect()}
    assert len(first) == 300 and first == again
    assert W.sample_rows(df, ["id"], 9000).count() == 5000
