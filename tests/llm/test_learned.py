"""Toxicity, vector search, licences and URL rules: held-out accuracy, brute force, and odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from arrears.llm import hnsw, license, toxicity, urls
from tests.llm.helpers import Components, clashing, corpus, frame, prose

RUDE = ["blockhead", "nitwit", "stinker", "ratface"]


def toxic_corpus(size=900, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(size):
        words = prose(rng, rng.randint(10, 120)).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def brute_marginals(evidence, chain):
    """Sum over all label sequences."""
    n = len(evidence)
    mass = np.zeros(n)
    pairs = np.zeros((2, 2))
    whole = 0.0
    for labels in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(e for e, y in zip(evidence, labels) if y) + sum(chain[a, b] for a, b in zip(labels, labels[1:])))
        whole += w
        mass += w * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += w
    return mass / whole, pairs / whole


def test_marginals_against_all_label_sequences():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 0, 7, 1, 5])
    chain = rng.normal(size=(2, 2))
    evidence = rng.normal(size=sizes.sum()) * 2
    chance, counts = toxicity.Chains(sizes).marginals(evidence, chain, pairs=True)
    expected, pairs = [], np.zeros((2, 2))
    for end, size in zip(np.cumsum(sizes), sizes):
        if size:
            m, p = brute_marginals(evidence[end - size:end], chain)
            expected += list(m)
            pairs += p
    assert chance == pytest.approx(expected) and counts == pytest.approx(pairs)


def test_held_out_documents(spark):
    rows, labels = toxic_corpus()
    docs = frame(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    field = toxicity.train(spark, docs, table)
    judged = docs.withColumn("j", toxicity.judge(spark, F.col("text"), field)).withColumn(
        "held", toxicity.held_out(F.col("doc_id"))).where("held").collect()
    truth = {i: t for i, _, t in labels}
    right = sum((r["j"]["score"] >= toxicity.REJECT) == (truth[r["doc_id"]] == 1) for r in judged)
    assert right / len(judged) > 0.97
    for r in judged:
        words = [r["text"][s["start"]:s["end"]] for s in r["j"]["spans"]]
        found = [w for span in words for w in span.split()]
        if truth[r["doc_id"]]:
            assert len(set(found) & set(RUDE)) == len(set(re.findall(r"\w+", r["text"])) & set(RUDE))


def test_held_out_labels_are_not_learnt(spark):
    rows, labels = toxic_corpus(300)
    docs = frame(spark, rows)
    held = {r["doc_id"] for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()}
    flipped = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (toxicity.train(spark, docs, spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.score_weights, b.score_weights)


def test_odd_texts_and_labels(spark):
    rows, labels = toxic_corpus(300)
    table = spark.createDataFrame(labels + [(0, 1, None), (1, 0, None), (None, 1, 1), (3, 1, 1), (3, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    field = toxicity.train(spark, frame(spark, rows), table)
    docs = clashing(frame(spark, corpus() + [(900, "İİİ blockhead ßΣ nitwit", "en", "s", 0)]), "judged", "score")
    out = docs.withColumn("j", toxicity.judge(spark, F.col("text"), field)).collect()
    assert len(out) == len(corpus()) + 1 and all(0 <= r["j"]["score"] <= 1 for r in out)
    empty = {r["j"]["score"] for r in out if not (r["text"] or "").strip()}
    assert len(empty) == 1
    grown = next(r for r in out if r["doc_id"] == 900)
    assert [grown["text"][s["start"]:s["end"]] for s in grown["j"]["spans"]] == ["blockhead", "nitwit"]


def test_repeated_ids_give_one_row_to_the_fit(spark):
    """A third of all rows share one id: it gives one text, the same in any order and partitioning."""
    rows, labels = toxic_corpus(300)
    hot = next(i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1)
    more = [(hot, f"another text {k} of this id", "en", "s", 0) for k in range(150)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fields = []
    for given, parts in ((rows + more, 1), (more[::-1] + rows[::-1], 7)):
        docs = frame(spark, given).repartition(parts)
        sample = toxicity.labelled_sample(docs, table, "doc_id", "text", "toxic", 4_000, 12_000).collect()
        texts = [text for i, text, *_ in given if i == hot]
        least = min(texts, key=lambda text: hashlib.sha256(text.encode()).hexdigest())
        assert [r["text"] for r in sample if r["id"] == hot] == [least]
        assert len(sample) == len({r["id"] for r in sample}) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _, _ in labels)
        fields.append(toxicity.train(spark, docs, table))
    assert np.array_equal(fields[0].weights, fields[1].weights)
    assert np.array_equal(fields[0].score_weights, fields[1].score_weights)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0), (3, 1, 0)]])
def test_without_labels_of_both_kinds(spark, labels):
    docs = frame(spark, corpus(size=10))
    field = toxicity.train(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scores = docs.select(toxicity.judge(spark, F.col("text"), field)["score"]).distinct().collect()
    assert [r[0] for r in scores] == [0.0]
    assert frame(spark, []).select(toxicity.judge(spark, F.col("text"), field)).count() == 0


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, 2):
        for _ in range(120):
            centre = rng.normal(size=12)
            for _ in range(rng.integers(1, 5)):
                rows.append([len(rows), (centre + rng.normal(size=12) * rng.choice([0.02, 0.25])).astype(np.float32), label])
    big = rng.normal(size=12)
    rows += [[1000 + i, (big + rng.normal(size=12) * 0.05).astype(np.float32), 1] for i in range(150)]
    rows += [[1200 + i, rows[0][1], 0] for i in range(40)] + [[1300, rows[0][1], 2]]
    out = [(int(i), [float(x) for x in v], int(l)) for i, v, l in rows]
    out += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 12, 1), (2003, [float("nan")] * 12, 1), (2004, [float("inf")] + [1.0] * 11, 1),
            (2005, [None] + [1.0] * 11, 1), (2006, out[0][1], None), (None, out[0][1], 0), (2007, [1.0, 2.0], 0), out[5], out[5]]
    return out


def brute_links(rows, limit=0.93):
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i] = (label, np.array(np.float32(v), float))
    parts, links = Components(), {}
    items = sorted(usable.items())
    for i, (label, v) in items:
        parts.find(i)
        links[i] = 0
        for j, (other, w) in items:
            if i != j and label == other and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= limit:
                links[i] += 1
                parts.join(i, j)
    return sorted(((i, links.get(i, 0), parts.find(i) if i in usable else i) for i, *_ in rows), key=repr)


@pytest.mark.parametrize("shard, block", [(hnsw.SHARD_ROWS, hnsw.BLOCK_ROWS), (60, 100)])
def test_vectors(spark, shard, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    found = hnsw.near_vectors(clashing(df, "id", "shard_", "n_links_"), shard_rows=shard, block_rows=block)
    found = sorted((tuple(r) for r in found.collect()), key=repr)
    expected = brute_links(rows)
    total = sum(n for _, n, _ in expected)
    assert [r[0] for r in found] == [r[0] for r in expected]
    assert all(a[1] <= b[1] for a, b in zip(found, expected))
    assert sum(n for _, n, _ in found) >= 0.99 * total
    assert sum(a[2] == b[2] for a, b in zip(found, expected)) >= 0.99 * len(rows)


def test_no_vectors(spark):
    assert hnsw.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_beam_is_widened_until_the_audit_passes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8))
    graph = hnsw.Graph(x / np.linalg.norm(x, axis=1)[:, None], 7)
    width = hnsw.audited_beam(graph, 0.8)
    truth = graph.x @ graph.x.T >= 0.8
    found = sum(truth[i, graph.within(q, 0.8, width)].sum() for i, q in enumerate(graph.x))
    assert found / truth.sum() >= 0.97


def groups(big=300, pairs=60, width=24):
    """One group of near-copies and many far pairs."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=width)
    x = [centre + rng.normal(size=width) * 0.02 for _ in range(big)]
    for _ in range(pairs):
        one = rng.normal(size=width)
        x += [one, one + rng.normal(size=width) * 0.02]
    x = np.stack(x)
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_a_large_group_does_not_hide_that_small_ones_are_missed():
    class Narrow:
        """Finds the large group with any beam, pairs with a beam of at least 32 (with 16, a vector finds itself)."""
        x = np.concatenate([groups(900), groups(0, 200)])

        def within(self, q, limit, width):
            near = np.flatnonzero(self.x @ q >= limit)
            return near if width >= 32 or len(near) > 2 else near[self.x[near] @ q > 1 - 1e-12]

    assert hnsw.audited_beam(Narrow(), hnsw.COSINE) == 32


def test_queries_meet_the_whole_shard_where_no_beam_passes(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(hnsw.Graph, "within", lambda self, q, limit, width: np.flatnonzero(self.x @ q > 1 - 1e-12))
    x = groups()
    ids = np.arange(len(x))
    members = pd.DataFrame({"id": ids, "copies": 1, "vector": list(x)})
    found = hnsw.search((0, len(x[0]), 0, 0), members, pd.DataFrame({"q_id": ids, "q_vector": list(x)}), hnsw.COSINE)
    counts = found[found["kind"] == hnsw.COUNT].set_index("node")["links"].reindex(ids, fill_value=0)
    assert (counts.to_numpy() == (x @ x.T >= hnsw.COSINE).sum(axis=1) - 1).all()


def test_licences(spark):
    rng = random.Random(6)
    apache, gpl = "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("a/LICENSE", apache), ("a/b/c/x.txt", prose(rng, 60)), ("a/b/y.txt", f"{prose(rng, 30)}\n# {gpl}\n{prose(rng, 20)}"),
        ("a/b/LICENSE", gpl), ("a/b/c/d/e.txt", ""), ("q/x.txt", prose(rng, 40)), ("top.txt", prose(rng, 40)), (None, gpl),
        (None, None), ("a/z.txt", None), ("a/z.txt", None), ("q/y.txt", "The licence of this is not known, see the apache museum."),
        ("q/long.txt", prose(rng, 8000) + "\nReleased under the MIT License."),
    ]
    df = clashing(spark.createDataFrame(rows, "path string, text string"), "print", "FOLDER", "below", "part", "own", "held")
    found = sorted(((r["path"], r["license"], r["license_origin"]) for r in license.scan(df).collect()), key=repr)
    assert found == sorted([
        ("a/LICENSE", "Apache-2.0", "own"), ("a/b/c/x.txt", "GPL-3.0", "inherited"), ("a/b/y.txt", "GPL-3.0", "own"),
        ("a/b/LICENSE", "GPL-3.0", "own"), ("a/b/c/d/e.txt", "GPL-3.0", "inherited"), ("q/x.txt", None, None),
        ("top.txt", None, None), (None, "GPL-3.0", "own"), (None, None, None), ("a/z.txt", "Apache-2.0", "inherited"),
        ("a/z.txt", "Apache-2.0", "inherited"), ("q/y.txt", None, None), ("q/long.txt", "MIT", "own")], key=repr)
    assert license.scan(df.limit(0)).count() == 0


def test_full_licence_texts_and_wrapped_headers(spark):
    import textwrap

    texts, headers = dict(license.TEXTS), dict(license.HEADERS)
    rng = random.Random(7)
    rows = [(f"{name}/LICENSE", f"Copyright (c) 2019 A. N. Owner\n\n{text}") for name, text in texts.items()]
    rows += [(f"{name}/src/a.py", prose(rng, 30)) for name in texts]
    rows += [(f"h/{name}.py", "#!/bin/x\n" + textwrap.indent(textwrap.fill(text, 60), "# ") + "\n" + prose(rng, 200))
             for name, text in headers.items()]
    rows.append(("w/x.txt", f"{prose(rng, 40)}\nThis work is licensed under the GNU\nGeneral Public License, version 3\n{prose(rng, 40)}"))
    found = {r["path"]: (r["license"], r["license_origin"]) for r in license.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    for name in texts:
        assert found[f"{name}/LICENSE"] == (name, "own") and found[f"{name}/src/a.py"] == (name, "inherited")
    for name in headers:
        assert found[f"h/{name}.py"] == (name, "own")
    assert found["w/x.txt"] == ("GPL-3.0", "own")


def brute_parts(text):
    """Lines, runs of lines and of paragraphs, comment blocks, and the whole text."""
    parts = [text, *(m.group() for m in regex.finditer(license.COMMENTS, text))]
    for pieces in (text.split("\n"), regex.split(r"\n[^\p{L}\p{N}]*\n", text)):
        parts += ["\n".join(pieces[i:i + n]) for n in range(1, license.RUN + 1) for i in range(len(pieces) - n + 1)]
    return dict.fromkeys(p for p in parts if regex.search(license.TOKEN, p))


SHORT_TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"), ("MIT", "Released under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3, by its owners and by nobody else"))


def test_licence_scores_against_plain_cosines(spark):
    rng = random.Random(9)
    split = lambda text: regex.findall(license.TOKEN, text.lower())
    given = [t for _, t in SHORT_TEMPLATES]
    wrapped = [given[2].replace("GNU ", "GNU\n"), "# " + given[2].replace(", version", "\n# , version"),
               given[2].replace("work is", "work\n\nis").replace("by its", "by\n --\n its")]
    lines = [*given, *wrapped, "Licensed under the MIT License, see file", "GNU public version", "the mit license of apache"]
    rows = [(f"{i}/x", prose(rng, 20) + "\n" + rng.choice(lines) + (" " + prose(rng, 2) if i % 3 == 0 else "") +
             "\n" + prose(rng, 5)) for i in range(70)]
    rows += [("a/LICENSE", given[1]), ("b/x", wrapped[0])]
    holding = Counter(w for _, t in rows for w in set(split(t)))
    known = {w for t in given for w in split(t)}
    rarest = math.log(len(rows) + 1) + 1
    weight = {w: math.log((len(rows) + 1) / (holding[w] + 1)) + 1 for w in known}

    def vector(text):
        return {w: n * weight.get(w, rarest) for w, n in Counter(split(text)).items()}

    def cosine(a, b):
        return sum(a[w] * b.get(w, 0) for w in a) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    vectors = [(name, vector(t)) for name, t in SHORT_TEMPLATES]
    expected = {}
    for path, text in rows:
        best = max((round(cosine(vector(part), v), 9), name) for part in brute_parts(text) for name, v in vectors)
        if best[0] >= license.COSINE:
            expected[path] = best[0]
    found = {r["path"]: round(r["license_score"], 9) for r in license.scan(
        spark.createDataFrame(rows, "path string, text string"), templates=SHORT_TEMPLATES).collect() if r["license"] is not None}
    assert found == pytest.approx(expected) and len(expected) > 30


def test_prose_with_a_notice_licenses_nobody_else(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [("a/essay.txt", f"Blue zebras sing.\n{notice}"), ("a/other.txt", "nothing here"), ("b/NOTICE", f"Blue zebras sing.\n{notice}"),
            ("b/c/other.txt", "nothing here"), ("d/any.txt", notice), ("d/other.txt", "nothing here")]
    rows += [(f"z/{i}", "some words of no interest") for i in range(20)]
    found = {r["path"]: (r["license"], r["license_origin"]) for r in license.scan(
        spark.createDataFrame(rows, "path string, text string"), cosine=0.5).collect()}
    assert found["a/essay.txt"] == ("Apache-2.0", "own") and found["a/other.txt"] == (None, None)
    assert found["b/c/other.txt"] == found["d/other.txt"] == ("Apache-2.0", "inherited")


def test_a_licence_in_the_root_holds_for_all(spark):
    rows = [("LICENSE", "Released under the MIT License"), ("src/a/b.py", "x"), ("c.py", ""), (None, "y"), ("src/LICENSE",
            "Licensed under the Apache License, Version 2.0"), ("/abs/d.py", "z")]
    found = {r["path"]: r["license"] for r in license.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found == {"LICENSE": "MIT", "src/a/b.py": "Apache-2.0", "c.py": "MIT", None: None, "src/LICENSE": "Apache-2.0",
                     "/abs/d.py": "MIT"}


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name)).name if fits else None


def test_urls(spark):
    rng = random.Random(2)
    hosts = ["example.net", "WWW.Example.NET", "a.example.com", "example.com", "org", "x.org", "notnet", "a.fr.org", "É.net", "net"]
    paths = ["", "/", "/en/1", "/de/2.html", "/fr/3?q=1&r=2", "/en", "?x", "#y", "/de/#a", "/DE/1", "/en/page.html?id=7"]
    rows = [(i, f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "no scheme"), (1003, "://"), (None, "http://net/"), rows[0], rows[0]]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string"), "found_rule", "URL_TOKENS", "set", "token", "tokens")
    out = urls.judge(df).collect()
    assert len(out) == len(rows)
    verdicts = {}
    for r in out:
        assert (r["host"], r["path"], r["rule"]) == brute_rule(r["url"])
        verdicts.setdefault(r["url"], set()).add(r["verdict"])
        if r["rule"]:
            assert r["verdict"] == next(x.verdict for x in urls.RULES if x.name == r["rule"])
    assert all(len(v) == 1 for v in verdicts.values()) and verdicts[None] == {"allow"} and verdicts["no scheme"] == {"allow"}
    assert urls.judge(df.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(df.where("url = 'no scheme'")).collect()} == {"allow"}


def test_a_host_blocked_in_all_its_labelled_pages_is_blocked_on_its_others(spark):
    """The host is labelled through one fixed rule only, so its label always goes with that rule's tokens."""
    rows = [(i, f"http://casino-win.example.com/de/{i}") for i in range(20)]
    rows += [(100 + i, f"http://good.example.net/en/{i}") for i in range(80)]  # more support than the host has
    rows += [(200, "http://casino-win.example.com/en/1"), (201, "http://casino-win.example.org/en/x"), (202, "http://good.example.org/en/1")]
    out = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [out[i]["rule"] for i in (200, 201, 202)] == [None] * 3
    assert [out[i]["verdict"] for i in (200, 201, 202)] == ["block", "block", "allow"]


def brute_mined(rows, support, confidence):
    """Rules (tokens, verdict, confidence, support, rarity) over single tokens, none merged: all combinations that pass
    and hold no shorter one of the same verdict and at least their confidence."""
    names = sorted({t for tokens, _ in rows for t in tokens})
    passing = {}
    for size in range(1, max((len(set(t)) for t, _ in rows), default=0) + 1):
        for combination in map(frozenset, itertools.combinations(names, size)):
            holding = [v for t, v in rows if combination <= set(t)]
            for verdict in ("block", "allow"):
                n = holding.count(verdict)
                if n and n >= support * len(rows) and n / len(holding) >= confidence:
                    rarity = min(sum(x in t for t, _ in rows) for x in combination)
                    passing[combination, verdict] = (n / len(holding), n / len(rows), rarity)
    return {key: found for key, found in passing.items() if not any(
        other < key[0] and verdict == key[1] and told[0] >= found[0] for (other, verdict), told in passing.items())}


def test_mined_rules_against_all_combinations(spark):
    """Each mined rule stands for those with any of the tokens that were merged into its items."""
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        tokens = rng.sample("abcdef", rng.randint(1, 4))
        bad = "a" in tokens and "b" in tokens or "c" in tokens and rng.random() < 0.97
        rows.append((sorted(tokens + (["c2", "c3"] if "c" in tokens else []) + (["f2"] if "f" in tokens else [])), "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    items = urls.merged(labelled)
    members = {}
    for r in items.collect():
        members.setdefault(r["item"], []).append(r["token"])
    assert sorted(map(sorted, members.values())) == [["a"], ["b"], ["c", "c2", "c3"], ["d"], ["e"], ["f", "f2"]]
    found = {}
    for r in urls.mine(labelled, items, support=0.02, confidence=0.9).collect():
        for tokens in itertools.product(*(members[i] for i in r["items"])):
            found[frozenset(tokens), r["verdict"]] = (round(r["confidence"], 9), round(r["support"], 9), r["rarity"])
    expected = {k: (round(c, 9), round(s, 9), n) for k, (c, s, n) in brute_mined(rows, 0.02, 0.9).items()}
    assert found == expected and expected


def test_the_verdict_of_every_page_without_a_fixed_rule(spark):
    rng = random.Random(12)
    hosts = ["casino.example.com", "shop.example.com", "news.example.net", "a.org", "b.org", "casino.example.org", "x.net"]
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{rng.choice(['win', 'read', 'buy'])}{rng.choice(['', '?id=1'])}")
            for i in range(260)]
    rows.append((900, "http://casino.example.org/" + "/".join(f"p{'x' * (i % 50)}{'y' * (i // 50)}" for i in range(2000)) + "/win"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    tokens = {r["url"]: frozenset(r["t"]) for r in pages.select("url", urls.tokens_of(
        F.col("url"), urls.host_of(F.col("url")), urls.path_of(F.col("url"))).alias("t")).collect()}
    labelled = [(tokens[u], next(r.verdict for r in urls.RULES if r.name == brute_rule(u)[2])) for _, u in rows if brute_rule(u)[2]]
    mined = brute_mined(labelled, 0.01, 0.9)
    out = {r["page_id"]: r for r in urls.judge(pages, support=0.01, confidence=0.9).collect()}
    verdicts = Counter()
    for page_id, url in rows:
        if brute_rule(url)[2] is None:
            met = [(c, -n, s, verdict) for (held, verdict), (c, s, n) in mined.items() if held <= tokens[url]]
            assert out[page_id]["verdict"] == (max(met)[3] if met else "allow"), url[:80]
            verdicts[out[page_id]["verdict"]] += 1
    assert len(verdicts) == 2


def test_tokens_that_always_come_together_cost_one_item(spark):
    path = "/".join("abcdefghijklmnopqrstuvwxyz"[i] * 3 for i in range(26))
    rows = [(i, f"http://bad.example.net/x/{path}") for i in range(30)] + [(100 + i, f"http://ok.example.net/en/{i}") for i in range(50)]
    rows += [(200, "http://other.example.org/de/zzz"), (201, "http://other.example.org/de/free")]
    out = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert out[200] == "block" and out[201] == "allow"


def test_documents_of_a_source_take_its_licence_file(spark, tmp_path):
    """The query resolves directories: a text that is a licence licenses its source and language, prose and headers do not."""
    from arrears.llm.queries import QUERIES

    rows = [(1, license.TEXTS[0][1], "en", "s", 0), (2, "prose\nReleased under the MIT License\nmore prose", "en", "s", 0),
            (3, "plain prose", "en", "s", 0), (3, "Released under the ISC License", None, None, 0), (None, None, "en", "s", 0),
            (4, "plain prose", "de", "s", 0), (5, "plain prose", None, None, 0), (6, "prose", "en", "t", 0),
            (7, "more words\nReleased under the MIT License\nthan a notice has in all its words", "en", "t", 0),
            (None, license.TEXTS[1][1], "fr", "s", 0), (8, "plain prose", "fr", "s", 0), (9, "plain prose", "it", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op9_license"](spark, str(tmp_path)).select("doc_id", "license", "license_origin").collect()
    first, second = license.TEXTS[0][0], license.TEXTS[1][0]
    assert sorted((tuple(r) for r in found), key=repr) == sorted([
        (1, first, "own"), (2, "MIT", "own"), (3, first, "inherited"), (3, "ISC", "own"), (None, first, "inherited"),
        (4, None, None), (5, None, None), (6, None, None), (7, "MIT", "own"),
        (None, second, "own"), (8, second, "inherited"), (9, None, None)], key=repr)
