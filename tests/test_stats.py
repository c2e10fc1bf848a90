"""Closed-form statistics against hand-computed or textbook values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.operators import quality as Q
from arrears.operators import stats as S
from arrears.plans import segments as G


def test_elbow(spark):
    inertia = {2: 100.0, 3: 40.0, 4: 30.0, 5: 25.0, 6: 22.0, 7: 20.0}
    ks = sorted(inertia)
    x1, x2, y1, y2 = ks[0], ks[-1], inertia[ks[0]], inertia[ks[-1]]
    away = {k: abs((y2 - y1) * k - (x2 - x1) * v + x2 * y1 - y2 * x1) / math.hypot(y2 - y1, x2 - x1) for k, v in inertia.items()}
    row = S.elbow(spark.createDataFrame(list(inertia.items()), "k int, inercia double")).first()
    assert row["k_ideal"] == max(away, key=away.get) == 3
    assert row["distancia"] == pytest.approx(away[3])


def test_cramers_v_of_a_diagonal_table(spark):
    df = spark.createDataFrame([(i % 3, i % 3) for i in range(9)], "a int, b int")
    assert S.cramers_v(df, "a", "b").first()["v"] == pytest.approx(1.0)


def test_cramers_v_two_by_two_is_corrected(spark):
    table = np.array([[12, 5], [7, 9]])
    df = spark.createDataFrame([(i, j) for i in (0, 1) for j in (0, 1) for _ in range(table[i, j])], "a int, b int")
    n = table.sum()
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
    chi = ((np.abs(table - expected) - 0.5) ** 2 / expected).sum()
    row = S.cramers_v(df, "a", "b").first()
    assert row["qui_quadrado"] == pytest.approx(chi) and row["v"] == pytest.approx(math.sqrt(chi / n))


def test_chi_square(spark):
    row = S.chi_square_uniform(spark.createDataFrame([(10,), (20,), (30,)], "n int"), "n").first()
    assert row["estatistica"] == pytest.approx(10.0) and row["graus"] == 2
    assert S.chi_square_p_value(10.0, 2) == pytest.approx(math.exp(-5))
    assert S.chi_square_p_value(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert S.chi_square_p_value(7.814728, 3) == pytest.approx(0.05, abs=1e-6)
    assert S.chi_square_p_value(9.487729, 4) == pytest.approx(0.05, abs=1e-6)


def test_t_critical(spark):
    df = spark.createDataFrame([(0,), (1,), (6,), (30,), (31,), (60,)], "d int")
    values = [r[0] for r in df.select(S.t_critical(F.col("d"))).collect()]
    assert values[0] is None
    assert values[1:] == pytest.approx([12.706205, 2.446912, 2.042272, 2.039513, 2.000298], abs=2e-4)


def test_regression_metrics(spark):
    y, p = np.array([0.0, 0.5, 1.0, 0.25]), np.array([0.1, 0.4, 0.9, 0.5])
    row = S.regression_metrics(spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double"), "y", "p").first()
    mse = ((y - p) ** 2).mean()
    assert row["mse"] == pytest.approx(mse) and row["r2"] == pytest.approx(1 - mse / y.var())
    ccc = 2 * np.cov(y, p, bias=True)[0, 1] / (y.var() + p.var() + (y.mean() - p.mean()) ** 2)
    assert row["ccc"] == pytest.approx(ccc)


def test_scalers(spark):
    values = [1.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "a double, b double")
    assert S.fit_scaler(df, ["a"], "standard")["a"] == pytest.approx((np.mean(values), np.std(values)))
    q = np.quantile(values, [0.25, 0.5, 0.75])
    assert S.fit_scaler(df, ["a"], "robust")["a"] == pytest.approx((q[1], q[2] - q[0]))
    assert S.fit_scaler(df, ["a", "b"], "minmax") == {"a": (1.0, 9.0), "b": (5.0, 1.0)}


def test_discriminant_of_two_classes():
    # Two one-hot classes: the within-class covariance of (x, 1 - x) is v·[[1, -1], [-1, 1]], whose pseudo-inverse
    # is that matrix / (4·v), so the coefficients are ±(difference of class shares) / (2·v).
    counts = {("a", 1): 30, ("b", 1): 10, ("a", 0): 20, ("b", 0): 40}
    share_1, share_0 = 30 / 40, 20 / 60
    v = (40 * share_1 * (1 - share_1) + 60 * share_0 * (1 - share_0)) / 98
    w = G.discriminant(counts, ["a", "b"])
    assert w == pytest.approx([(share_1 - share_0) / (2 * v), -(share_1 - share_0) / (2 * v)])


def test_davies_bouldin(spark):
    points = {0: [(0.0, 0.0), (0.0, 2.0)], 1: [(10.0, 0.0), (10.0, 2.0)], 2: [(0.0, 30.0), (0.0, 34.0)]}
    df = spark.createDataFrame([(k, x, y) for k, ps in points.items() for x, y in ps], "k int, x double, y double")
    centres = {k: np.mean(ps, axis=0) for k, ps in points.items()}
    spread = {k: np.mean([np.hypot(*(np.array(p) - centres[k])) for p in ps]) for k, ps in points.items()}
    expected = np.mean([max((spread[i] + spread[j]) / np.hypot(*(centres[i] - centres[j])) for j in points if j != i) for i in points])
    assert S.davies_bouldin(df, "k", ["x", "y"]).first()["davies_bouldin"] == pytest.approx(expected)


def test_silhouette_rows_match_all_pairs(spark):
    rng = np.random.default_rng(1)
    points = [(int(c), *(rng.normal(c * 4, 1, 2).tolist())) for c in (0, 1, 2) for _ in range(12)] + [(3, 50.0, 50.0)]
    df = spark.createDataFrame(points, "label_cluster int, x double, y double")

    def brute(i):
        c, x, y = points[i]
        distance = {}
        for j, (d, u, v) in enumerate(points):
            if j != i:
                distance.setdefault(d, []).append((x - u) ** 2 + (y - v) ** 2)
        if c not in distance:
            return 0.0
        own, other = np.mean(distance[c]), min(np.mean(v) for k, v in distance.items() if k != c)
        return (other - own) / max(own, other)

    found = {(r["label_cluster"], r["x"], r["y"]): r["silhueta"] for r in G.silhouette_rows(df, ["x", "y"]).collect()}
    assert [found[p] for p in points] == pytest.approx([brute(i) for i in range(len(points))])


def test_consistency_rules(spark):
    df = spark.createDataFrame([(0, 10, 0), (4, 10, 0), (0, 10, 10), (4, 10, 6)], "vlr_pago int, vlr_total_dam int, vlr_aberto int")
    found = {r["regra"]: r["linhas"] for r in Q.violations(df, Q.bill_rules()).collect()}
    assert found == {"nao_paga_sem_aberto": 1, "parcial_sem_aberto": 1, "nao_paga_lancado_difere_aberto": 1, "lancado_difere_soma": 2}


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    assert {r["coluna"]: (r["nulos"], r["percentual"]) for r in Q.null_profile(df).collect()} == {"a": (1, 25.0), "b": (2, 50.0)}
