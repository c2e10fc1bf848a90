"""Mixing against a plain walk through sources and documents."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from arrears.llm import mixing
from tests.llm.helpers import clashing, corpus, frame


def brute_targets(sizes):
    """Shares by weight; what exceeds three times a source's size is shared again until nothing does."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_names, rest = {}, list(names), sum(sizes.values())
    while open_names:
        level = rest / sum(weight[s] for s in open_names)
        over = [s for s in open_names if weight[s] * level > 3 * sizes[s]]
        if not over:
            target.update({s: weight[s] * level for s in open_names})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= 3 * sizes[s]
            open_names.remove(s)
    return target


def brute_mix(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    per_source = defaultdict(int)
    for r, n in zip(rows, size):
        per_source[r[3]] += n
    target = brute_targets(per_source)
    out = []
    for source, whole in per_source.items():
        mine = [(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), r[0] is not None, r[0] or 0, n, r[0])
                for r, n in zip(rows, size) if r[3] == source]
        before = 0
        for _, _, _, n, doc_id in sorted(mine):
            passes = int(target[source] // whole) if whole else 0
            extra = before + n / 2 < target[source] - passes * whole
            out.append((doc_id, n, whole, round(target[source], 6), n * (passes + extra)))
            before += n
    return sorted(out, key=repr), per_source, target


def test_plan(spark):
    rows = corpus()
    docs = clashing(frame(spark, rows), "id", "key", "size", "hash", "part", "target", "positions")
    expected, per_source, target = brute_mix(rows)
    plan = mixing.plan_mix(docs).collect()
    found = [(r["id"], r["size"], r["source_size"], round(r["target"], 6), r["size"] * r["copies"]) for r in plan]
    assert sorted(found, key=repr) == expected
    assert sum(target.values()) == pytest.approx(sum(per_source.values()))
    taken, longest = defaultdict(int), defaultdict(int)
    for r in plan:
        assert 0 <= r["copies"] <= 3 and len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
        taken[r["key"]] += r["size"] * r["copies"]
        longest[r["key"]] = max(longest[r["key"]], r["size"])
    for source in per_source:
        key = "b" if source is None else "a" + source
        assert abs(taken[key] - target[source]) <= longest[key] / 2 + 1e-6


def test_positions_follow_the_schedules(spark):
    """At any time, a source has given the words that its integrated schedule demands, to within one document."""
    rows = [(i, "w " * (5 + i % 7), "en", f"s{i % 3}", 0) for i in range(900)]
    copies = mixing.mix(frame(spark, rows)).collect()
    plan = mixing.plan_mix(frame(spark, rows)).groupBy("key").agg(F.first("target").alias("t")).collect()
    target = {r["key"][1:]: r["t"] for r in plan}
    positions = [r["position"] for r in copies]
    assert positions == sorted(positions)
    for number, schedule in enumerate(mixing.SCHEDULES):
        (_, first), (_, last) = schedule
        for t in (0.25, 0.5, 0.8):
            due = (first * t + (last - first) * t * t / 2) / mixing.integral(schedule) * target[f"s{number}"]
            given = sum(len(r["text"].split()) for r in copies if r["source"] == f"s{number}" and r["position"] <= t)
            assert abs(given - due) <= 24


def test_schedules_of_several_pieces(spark):
    schedule = ((0.0, 0.0), (0.5, 2.0), (0.75, 2.0), (1.0, 0.0))
    shares = [0.0, 0.1, 0.4, 0.5, 0.9, 1.0]
    times = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double")
             .select(mixing.due(F.col("s"), F.lit(1), (schedule,))).collect()]
    for share, time in zip(shares, times):
        area, steps = 0.0, 20000
        for i in range(int(steps * time)):
            t = (i + 0.5) / steps
            area += (4 * t if t < 0.5 else 2.0 if t < 0.75 else 8 * (1 - t)) / steps
        assert area == pytest.approx(share * mixing.integral(schedule), abs=2e-3)


def test_mix_repeats_documents_as_planned(spark):
    rows = corpus()
    docs = clashing(frame(spark, rows), "POSITION", "mix_id", "mix_places")
    mixed = mixing.mix(docs)
    assert mixed.columns[:-1] == docs.columns
    found = defaultdict(int)
    for r in mixed.collect():
        found[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    expected = defaultdict(int)
    for doc_id, _, _, _, taken in brute_mix(rows)[0]:
        expected[doc_id] += taken
    assert dict(found) == {k: v for k, v in expected.items() if v}
    again = [(r["doc_id"], r[mixed.columns[-1]]) for r in mixing.mix(docs.repartition(9)).collect()]
    assert again == [(r["doc_id"], r[mixed.columns[-1]]) for r in mixed.collect()]


def test_empty_tables(spark):
    assert mixing.plan_mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [(1, None, None, "a", 0), (2, "", None, None, 0)])).count() == 0
