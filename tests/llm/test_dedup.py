"""Line, exact and SimHash deduplication against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from arrears.llm import exact, graph, lines, simhash
from tests.llm.helpers import Components, clashing, corpus, frame

AZ = {i: i + 32 for i in range(65, 91)}
SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(SPACE).translate(AZ)


def brute_lines(rows):
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(doc_id)
    smallest = float("-inf")
    keeper = {k: max(ids, key=lambda i: smallest if i is None else i) for k, ids in holders.items() if len(ids) >= 5}
    out = []
    for doc_id, text, *_ in rows:
        all_lines = (text or "").split("\n")
        kept = [l for l in all_lines if key(l) not in keeper or keeper[key(l)] == doc_id]
        out.append((doc_id, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


def test_lines(spark):
    rows = corpus()
    docs = clashing(frame(spark, rows), "id", "PRINT", "positions", "at", "line", "hash", "key")
    done = lines.dedup_lines(docs)
    assert done.columns == [*docs.columns, "kept_text", "n_lines", "n_dropped"]
    found = [(r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in done.collect()]
    assert sorted(found, key=repr) == brute_lines(rows)
    assert any(r[3] for r in found)


def test_lines_of_an_empty_table(spark):
    assert lines.dedup_lines(frame(spark, [])).count() == 0


def normal(text):
    return re.sub("[ \t-\r]+", " ", text or "")


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[normal(text)]
        known = [i for i in ids if i is not None]
        digest = hashlib.sha256(normal(text).encode()).hexdigest()
        out.append((doc_id, min(known) if known else None, len(ids), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [exact.TRIE_BYTES, 2000])
def test_exact(spark, monkeypatch, limit):
    """The small limit makes every partition give out subtrees many times."""
    monkeypatch.setattr(exact, "TRIE_BYTES", limit)
    rows = corpus()
    docs = clashing(frame(spark, rows), "id", "length", "hash", "keep_id", "copies", "digest")
    found = [tuple(r) for r in exact.exact_duplicates(docs).collect()]
    assert sorted(found, key=repr) == brute_exact(rows)


def test_exact_empty_table(spark):
    assert exact.exact_duplicates(frame(spark, [])).count() == 0


def test_trie_against_a_dictionary():
    import random

    rng = random.Random(3)
    trie, expected = exact.PatriciaTrie(), {}
    for i in range(3000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12)))
        trie.insert(text, i, 1)
        least, count = expected.get(text, (i, 0))
        expected[text] = (min(least, i), count + 1)
    assert {t: (k, c) for t, k, c in exact.terminals(trie.root)} == expected
    given = list(trie.shed(-1))
    assert {t: (k, c) for t, k, c in given} == expected and len(given) == len(expected)
    assert not trie.root.children and trie.bytes == 0


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_simhash(rows, groups=False):
    prints = [brute_fingerprint(r[1]) for r in rows]
    parts = Components()
    distinct = sorted(set(prints))
    for i, a in enumerate(distinct):
        parts.find(a)
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                parts.join(a, b)
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            g = parts.find(p)
            least[g] = min(least.get(g, r[0]), r[0])
    if groups:
        return sorted((least.get(g) for g in {parts.find(p) for p in prints}), key=repr)
    return sorted(((r[0], p, least.get(parts.find(p))) for r, p in zip(rows, prints)), key=repr)


def test_simhash(spark):
    rows = corpus()
    docs = clashing(frame(spark, rows), "id", "bits", "component", "group", "cell")
    found = [(r["id"], r["bits"] % (1 << 64), r["component"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=repr) == brute_simhash(rows)


def test_one_row_of_each_group_stays(spark):
    rows = corpus()
    docs = clashing(frame(spark, rows), "near_id", "near_print")
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=repr) == brute_simhash(rows, groups=True)


def test_grid_finds_every_close_pair(spark):
    """Random fingerprints with neighbours at all distances, the highest and lowest bits among them."""
    import random

    rng = random.Random(11)
    points = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(150):
        p = rng.getrandbits(64)
        points.add(p)
        for distance in range(1, 7):
            points.add(p ^ sum(1 << b for b in rng.sample(range(64), distance)))
    expected = {(simhash.signed(a), simhash.signed(b)) for a in points for b in points
                if simhash.signed(a) < simhash.signed(b) and (a ^ b).bit_count() <= 4}
    df = spark.createDataFrame([(simhash.signed(p),) for p in points], "bits long")
    assert {(r["a"], r["b"]) for r in simhash.grid_links(df).collect()} == expected


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.one_per_group(frame(spark, [])).count() == 0


def test_components(spark):
    import random

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, k) for k in range(201, 260)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5)]
    parts = Components()
    for a, b in edges:
        if a != b:
            parts.join(a, b)
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert found == {n: parts.find(n) for n in parts.parent}
    assert graph.components(df.where(F.lit(False))).count() == 0
