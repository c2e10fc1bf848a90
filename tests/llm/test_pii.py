"""Personal data against Python's own patterns, and disclosing terms against plain counts."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from arrears.llm import pii
from tests.llm.helpers import clashing, corpus, frame, prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute_base(text):
    return [(kind, m.start(), m.end()) for kind, pattern in PLAIN.items()
            for m in re.finditer(pattern, text or "") if passes(kind, m.group())]


ODD = [
    "a@b.c_d@e.f x@y.z..q@r.s", "@@a@b.cc@d.ee", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.0003.255", "..1.1.1.1",
    "4539 1488 0343 6467 and 4539148803436467 4539-1488-0343-6468", "+1 (377) 555-0271 +49 (0) 30 12.34.56 +1 +22",
    "é😀 x@mail.example.com ü +49 30 1234567 ß 10.0.0.1", "a" * 30000 + "@", "1" * 30000, "1." * 20000, "a@" + "b." * 20000 + "c",
    "+1" + " (" * 20000, "a@b.c" * 3000, "-@-.-", "%@a.b", "5 5 5 5 5 5 5 5 5 5 5 5 5 5", "",
]


def test_base_spans(spark):
    rng = random.Random(4)
    alphabet = "ab1.@+-_ ()0 9%é\n"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(600)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + corpus()[-20:] + [(None, "c@d.ee", None, None, 0)]
    docs = clashing(frame(spark, rows), "id", "KIND", "spans_", "start", "end", "span_id")
    found = pii.per_document(docs, pii.base_spans(pii.candidates(docs)).select("id", "print", "kind", "start", "end"))
    mine = defaultdict(list)
    for r in found.collect():
        mine[r["doc_id"], r["text"]].append([(pii.KINDS[s["order"] - 1], s["start"], s["end"]) for s in r["spans"]])
    for doc_id, text, *_ in rows:
        for spans in mine[doc_id, text]:
            assert spans == brute_base(text), text[:90]
    assert len(rows) == sum(map(len, mine.values()))


def secret_corpus():
    """One person writes under one address in many wordings; the name stands beside it, common words do too."""
    rng = random.Random(8)
    words = "please write answer today office about the meeting report number again".split()
    rows = []
    for i in range(60):
        filler = " ".join(rng.choice(words) for _ in range(40))
        rows.append((i, filler, "en", "s", 0))
    for i in range(60, 66):
        some = " ".join(rng.choice(words) for _ in range(6))
        rows.append((i, f"{some} Zephyrine Quill zq@mail.example.com {some} office", "en", "s", 0))
    copied = f"the only Coincidence beside other@mail.example.com {' '.join(words)}"
    rows += [(70 + i, copied, "en", "s", 0) for i in range(10)]  # copies are one context
    rows.append((90, "Zephyrine was here", "en", "s", 0))
    return rows


def brute_terms(rows, kinds=("email",)):
    """Terms word by word: frequencies over all documents, entities over distinct texts."""
    texts = sorted({text or "" for _, text, *_ in rows})
    found = {t: [(m.start(), m.end(), m.group(), k) for k in kinds for m in re.finditer(PLAIN[k], t) if passes(k, m.group())]
             for t in texts}
    words = {t: [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W\d_]{3,}", t)] for t in texts}
    frequency, holders = defaultdict(set), defaultdict(set)
    for n, (_, text, *_) in enumerate(rows):
        for *_, w in words[text or ""]:
            frequency[w].add(n)
    for t in texts:
        for *_, value, kind in found[t]:
            holders[kind, value.lower()].add(t)
    outside = {t: [w for w in words[t] if not any(w[0] < e and w[1] > s for s, e, *_ in found[t])] for t in texts}
    told = defaultdict(set)
    for held in holders.values():
        content = math.log(len(rows) / len(held))
        for w in {w for t in held for *_, w in outside[t]}:
            both = sum(any(w == o for *_, o in outside[t]) for t in held)
            usual = len(frequency[w]) / len(rows)
            given = (both + pii.SMOOTHING * usual) / (len(held) + pii.SMOOTHING)
            if content > 0 and math.log(given / usual) / content >= pii.DISCLOSURE:
                for t in held:
                    told[t].add(w)
    return {(doc_id, s, e) for doc_id, text, *_ in rows for s, e, w in outside[text or ""] if w in told[text or ""]}


def test_disclosing_terms(spark):
    rows = secret_corpus()
    spans = pii.find_spans(frame(spark, rows)).where("kind = 'term'").collect()
    found = {(r["id"], r["start"], r["end"]) for r in spans}
    assert found == brute_terms(rows)
    texts = {r[0]: r[1] for r in rows}
    assert {"Zephyrine", "Quill"} <= {texts[i][s:e] for i, s, e in found}
    assert not {texts[i][s:e] for i, s, e in found} & {"office", "meeting", "please"}


def test_disclosing_terms_of_a_corpus(spark):
    """Random prose with addresses; rare words of one document are weaker evidence than those of several."""
    rng = random.Random(3)
    rows = [(i, prose(rng, 40) + (f" owner{i % 7}@mail.example.com {'Ysolde Brandt' if i % 7 == 3 else ''}" if i % 5 == 0 else ""),
             "en", "s", 0) for i in range(300)] + [*corpus(), *secret_corpus()]
    spans = pii.find_spans(frame(spark, rows)).where("kind = 'term'").collect()
    found = {(r["id"], r["start"], r["end"]) for r in spans}
    assert found == brute_terms(rows, ("email", "ip", "card", "phone")) and len(found) > 50


def test_sanitised_text(spark):
    rows = [*secret_corpus(), (99, "é +49 30 1234567 a@b.cc", "de", "s", 0), (None, None, None, None, 0)]
    docs = clashing(frame(spark, rows), "span_list", "print", "from")
    done = {r["doc_id"]: r["clean_text"] for r in pii.sanitise(docs).collect()}
    assert done[99] == "é [PHONE] [EMAIL]" and done[None] == ""
    assert "[TERM] [TERM] [EMAIL]" in done[60] and "Zephyrine" not in done[60]
    assert done[0] == rows[0][1] and done[90] == "Zephyrine was here"


def test_spans_as_text(spark):
    from pyspark.sql import functions as F

    docs = frame(spark, [(1, "a@b.cc 10.0.0.1 c@d.ee", "en", "s", 0), (2, None, "en", "s", 0)])
    rows = pii.per_document(docs, pii.find_spans(docs)).select("doc_id", pii.as_text(F.col("spans")).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in rows} == {1: "email:0:6,email:16:22,ip:7:15", 2: ""}
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_empty_table(spark):
    assert pii.find_spans(frame(spark, [])).count() == 0
    assert pii.sanitise(frame(spark, [])).count() == 0


def test_query_hashes_the_generalised_texts(spark, tmp_path):
    from arrears.llm.queries import QUERIES

    rows = [*secret_corpus(), (99, "é +49 30 1234567 a@b.cc", "de", "s", 0), (None, None, None, None, 0), (7, None, None, None, 0)]
    docs = frame(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = sorted((r["doc_id"] or -1, hashlib.sha256(r["clean_text"].encode()).hexdigest()) for r in pii.sanitise(docs).collect())
    found = QUERIES["op2_pii"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or -1, r["clean_sha256"]) for r in found) == expected


def test_query_counts_the_spans_of_each_kind(spark, tmp_path):
    from arrears.llm.queries import QUERIES

    rows = [(1, "a@b.cc c@d.ee e@f.gg 10.0.0.1", "en", "s", 0), (2, "10.0.0.1 10.0.0.2 4539148803436467", "en", "s", 0),
            (3, "+49 30 1234567 +49 30 1234568 a@b.cc 1.2.3.4", "en", "s", 0), (4, None, "en", "s", 0), (None, "c@d.ee", None, None, 0)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in QUERIES["op2_pii"](spark, str(tmp_path)).collect()}
    for doc_id, text, *_ in rows:
        spans = brute_base(text)
        assert [found[doc_id][f"n_{kind}"] for kind in PLAIN] == [sum(k == kind for k, *_ in spans) for kind in PLAIN], text
        listed = ",".join(f"{k}:{start}:{end}" for k, start, end in spans)
        assert found[doc_id]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
