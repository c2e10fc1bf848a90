"""Centroid clustering and hard negatives against brute force in exact integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from tests.llm.helpers import clashing
from pyspark.sql import functions as F

from arrears.llm import centroids, negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def whole(vector, scale, most):
    return [math.floor(max(-most, min(most, np.float32(x).item() * scale))) for x in vector]


def table(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def vectors(width, seed=1, size=150, hot=60):
    """Loose groups, exact copies, ties, one label with a third of all rows, and every kind of odd row."""
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(6)]
    rows = [(i, [m + rng.gauss(0, 0.3) for m in middles[i % 6]], 0 if i < hot else i % 5) for i in range(size)]
    rows += [(1000 + i, rows[i % 7][1], i % 3) for i in range(30)]  # copies under several labels
    rows += [(1100 + 50 * i, [0.0] * width, i % 2) for i in range(4)]  # score 0 with everything
    rows += [(1300 + i, [float(rng.choice([-1, 0, 1])) for _ in range(width)], i % 4) for i in range(40)]  # ties
    rows += [(2000, None, 1), (2050, [None] * width, 1), (2100, [float("nan")] * width, 1),
             (2150, [float("inf")] + [0.0] * (width - 1), 1), (2200, [], 1), (2250, [0.5] * (width - 1), 2),
             (2300, [0.5] * (width + 1), 3), (2350, [0.1] * width, None), (None, [0.2] * width, 1),
             (2400, [1e30] * width, 2), (2450, [-1e30] * width, 3)]
    rows += [rows[10], rows[50], rows[50], (50, [0.3] * width, 4), (50, [0.3] * width, 1)]
    return rows


def brute_clusters(rows, k, rounds, width, scale, seed):
    kept = [(i, whole(v, scale, centroids.MOST)) for i, v, _ in rows if usable(v) and len(v) == width]

    def drawn(row):
        return (row[0] is None, "" if row[0] is None else hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[1])

    middles = [list(v) for _, v in sorted(kept, key=drawn)[:k]]

    def place(vector):
        return min((sum((x - c) ** 2 for x, c in zip(vector, m)), n) for n, m in enumerate(middles))

    for _ in range(rounds):
        groups = {}
        for _, vector in kept:
            groups.setdefault(place(vector)[1], []).append(vector)
        for n, members in groups.items():
            middles[n] = [sum(column) // len(members) for column in zip(*members)]
    return [(i, place(v)[1], place(v)[0]) for i, v in kept], middles


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 1), (5, 0), (60, 2)])
def test_clusters(spark, k, rounds):
    rows = [r for r in vectors(4) if not (usable(r[1]) and len(r[1]) == 4 and abs(r[1][0]) > 1e6)]
    placed, about = centroids.cluster(
        clashing(table(spark, rows), "id", "vector", "cluster", "norm"), clusters=k, rounds=rounds, width=4)
    expected, middles = brute_clusters(rows, k, rounds, 4, centroids.SCALE, centroids.SEED)
    by_id = lambda row: (row[0] is None, row[0] or 0, row[1:])
    assert sorted(map(tuple, placed.select("id", "cluster", "distance").collect()), key=by_id) == sorted(
        expected, key=by_id)
    found = {row["cluster"]: row for row in about.collect()}
    assert [found[n]["centroid"] for n in range(len(middles))] == middles
    for n, row in found.items():
        assert row["cluster_inertia"] == sum(d for _, c, d in expected if c == n)
        assert row["inertia"] == sum(d for *_, d in expected)


def test_clusters_of_huge_components(spark):
    rows = [(1, [1e30] * 64, 0), (2, [-1e30] * 64, 0), (3, [0.0] * 64, 0)]
    placed, _ = centroids.cluster(table(spark, rows), clusters=1, rounds=0)
    assert sorted(d for _, _, d in placed.select("id", "cluster", "distance").collect())[0] == 0


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [0.5], 2)]])
def test_clusters_of_nothing(spark, rows):
    placed, about = centroids.cluster(table(spark, rows, 1))
    assert placed.collect() == [] and about.collect() == []
    assert about.columns == ["cluster", "centroid", "cluster_inertia", "inertia"]


def brute_negatives(rows, positives=5, most=3, lowest=50, highest=95):
    taken = {(i, label, tuple(whole(v, negatives.SCALE, negatives.MOST)))
             for i, v, label in rows if i is not None and label is not None and usable(v)}
    out = []
    for own, label, anchor in taken:
        if own % 50:
            continue
        scored = [(-sum(x * a for x, a in zip(v, anchor)), i, other, v) for i, other, v in taken if i != own]
        near = sorted(s for s in scored if s[2] == label)
        far = sorted(s for s in scored if s[2] != label)
        # Equal ids with equal scores are told apart by a hash; they give the same ids and scores.
        for p, positive, *_ in near[:positives]:
            inside = [s for s in far if lowest * -p <= 100 * -s[0] <= highest * -p][:most]
            out += [(own, positive, rank, s[1], -p, -s[0]) for rank, s in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, block", [(negatives.SHARD_BYTES, negatives.BLOCK_BYTES), (3000, 700)])
@pytest.mark.parametrize("width", [3, 12])
def test_negatives(spark, width, shard, block):
    rows = vectors(width)
    found = negatives.hard_negatives(clashing(table(spark, rows), "id", "print", "anchor", "windows", "score"),
                                     F.col("vec_id") % 50 == 0, shard_bytes=shard, block_bytes=block)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute_negatives(rows)
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 50


@pytest.mark.parametrize("rows", [[], [(50, [1.0, 0.0], 1)], [(50, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)],
                                  [(50, None, 1), (1, [1.0], None)], [(7, [1.0], 1), (8, [1.0], 2)]])
def test_negatives_of_nothing(spark, rows):
    assert negatives.hard_negatives(table(spark, rows, 1), F.col("vec_id") % 50 == 0).collect() == []


def test_search_stops_before_it_has_met_all():
    """On lists with few large components the threshold falls early, and the best rows are still all found."""
    rng = np.random.default_rng(5)
    rows = np.zeros((5000, 6), np.int64)
    rows[np.arange(5000), rng.integers(0, 6, 5000)] = (rng.pareto(1, 5000) * 20).astype(np.int64)
    lists = negatives.Lists(np.arange(5000), np.zeros(5000, np.int64), np.zeros(5000, np.int64), rows.astype(float))
    anchor = np.array([5.0, 0, 3, 1, 0, 2])
    met = []
    everyone = np.ones(5000, bool)
    some, scores = lists.search(anchor, everyone, lambda rows, found: met.append(len(rows)) or negatives.kth(found, 5))
    truth = rows @ anchor.astype(np.int64)
    best = np.lexsort((np.arange(5000), -truth))[:5]
    assert some[:5].tolist() == best.tolist() and scores[:5].tolist() == truth[best].tolist()
    assert met[-1] < 2500


def test_scores_beyond_floats_are_exact():
    rows, anchors = np.full((2, 9), negatives.MOST), np.full((1, 9), negatives.MOST)
    assert negatives.exact_type(rows, anchors) is np.float64
    assert negatives.exact_type(np.full((2, 9000), negatives.MOST), np.full((1, 9000), negatives.MOST)) is np.int64
    assert negatives.exact_type(np.full((2, 64), 256), np.full((1, 64), 256)) is np.float32
