"""Distinct counts from bitmaps against sets."""

import random

from arrears.operators import bitmaps as B


def rows(n=4000, seed=3):
    rng = random.Random(seed)
    ids = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2**40, -(2**40)]
    found = [(rng.choice("aab"), rng.choice([1995, 1996, 1998, None]),
              rng.choice(ids) if rng.random() < 0.2 else rng.randrange(-70_000, 70_000)) for _ in range(n)]
    return found + found[:500] + [("a", 1995, None), ("c", 1995, None)]


def test_every_granularity_from_one_store(spark):
    data = rows()
    store = B.entity_bitmaps(spark.createDataFrame(data, "k string, ano int, e bigint").repartition(5), ["k", "ano"], "e")
    for keys, place in ((["k", "ano"], (0, 1)), (["k"], (0,)), (["ano"], (1,)), ([], ())):
        expected = {}
        for r in data:
            if r[2] is not None:
                expected.setdefault(tuple(r[i] for i in place), set()).add(r[2])
        found = {tuple(r[k] for k in keys): r["n"] for r in B.distinct_entities(store, keys, "n").collect()}
        assert found == {k: len(v) for k, v in expected.items()}


def test_merged_stores_equal_one_store(spark):
    data = rows()
    halves = [spark.createDataFrame(part, "k string, ano int, e bigint") for part in (data[::2], data[1::2])]
    both = B.merged(*[B.entity_bitmaps(h, ["k"], "e") for h in halves], ["k"])
    whole = B.entity_bitmaps(halves[0].unionAll(halves[1]), ["k"], "e")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))


def test_cumulative(spark):
    data = rows()
    store = B.entity_bitmaps(spark.createDataFrame(data, "k string, ano int, e bigint"), ["k", "ano"], "e")
    found = {r["ano"]: r["n"] for r in B.cumulative_entities(store, "ano", "n").collect()}
    assert found == {y: len({e for _, a, e in data if e is not None and a is not None and a <= y}) for y in (1995, 1996, 1998)}


def test_no_rows(spark):
    store = B.entity_bitmaps(spark.createDataFrame([], "k string, e bigint"), ["k"], "e")
    assert B.distinct_entities(store, ["k"], "n").count() == 0
    assert B.distinct_entities(store, [], "n").first()["n"] == 0


def test_hot_key_is_dealt_over_its_blocks(spark):
    """A key that holds all rows is as many groups as its ids have blocks; 0 stands in the block of negative ids."""
    df = spark.range(300_000).selectExpr("'x' AS k", "id % 100000 AS e")
    store = B.entity_bitmaps(df, ["k"], "e")
    assert store.count() == 1 + -(-99_999 // 32_768)
    assert B.distinct_entities(store, ["k"], "n").first()["n"] == 100_000
