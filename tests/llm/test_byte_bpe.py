"""Byte-level BPE against the library, its queue against a plain dictionary, and its behaviour on odd rows."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tests.llm.helpers import clashing, corpus, frame
from pyspark.sql import functions as F

from arrears.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.Ranks(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.of, special_tokens={})


def ids_of(encoder, texts):
    return [np.frombuffer(packed, "<u4").tolist() for packed in encoder.texts(texts)]


def odd_texts(rng, count):
    signs = ["a", "  ", "\t", "\n", "'s", "'ll", "1", "é", "ß", "中", "!!", "　", "\x1c", "​", "<|endoftext|>"]
    for k in range(count):
        size = rng.randint(0, 60)
        if k % 3 == 0:
            points = [rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]) for _ in range(size)]
            yield "".join(map(chr, points))
        elif k % 3 == 1:
            yield "".join(rng.choice("abcdeith ") for _ in range(size * 4))
        else:
            yield "".join(rng.choice(signs) for _ in range(size))


@pytest.mark.parametrize("at_once", [1, byte_bpe.AT_ONCE, 10**9])
def test_odd_texts(ranks, library, monkeypatch, at_once):
    monkeypatch.setattr(byte_bpe, "AT_ONCE", at_once)
    texts = list(odd_texts(random.Random(1), 900))
    assert ids_of(byte_bpe.Encoder(ranks), texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point(ranks, library):
    texts = [chr(c) + "x" + chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 11 == 0)]
    texts += [f"a{chr(c)}1 {chr(c)}" for c in sorted(ranks.odd)[::7]]
    assert ids_of(byte_bpe.Encoder(ranks), texts) == [library.encode_ordinary(t) for t in texts]


def test_small_chunks_and_tables_change_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK_CHARS", 50)
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 10)
    monkeypatch.setattr(byte_bpe, "SHORT", 5)
    texts = [t or "" for _, t, *_ in corpus(size=20)][:20]
    assert ids_of(byte_bpe.Encoder(ranks), texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("word", [
    "a" * 20_000, "ab" * 20_000, " " * 20_000, "=" * 30_000, "é" * 20_000,
    "".join(random.Random(2).choice("acgt") for _ in range(40_000))])
def test_long_pre_tokens(ranks, library, word):
    assert ids_of(byte_bpe.Encoder(ranks), [word]) == [library.encode_ordinary(word)]


def test_a_million_letters_in_linear_time(ranks):
    letters = "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    encoder = byte_bpe.Encoder(ranks)
    start = time.time()
    ids, = ids_of(encoder, [letters])
    assert time.time() - start < 40
    assert byte_bpe.decoded(np.array(ids), ranks.names) == letters.encode()


def test_queue_gives_lowest_rank_and_smallest_position():
    rng = random.Random(4)
    for size in (1, 64, 65, 70_000):
        queue, plain = byte_bpe.RankQueue(size), {}
        for _ in range(3000):
            if rng.random() < 0.55 or not plain:
                some = [(rng.randrange(size), rng.randrange(10**6)) for _ in range(rng.choice([1, 1, 5]))]
                if len(some) == 1:
                    queue.push(*some[0])
                else:
                    queue.push_all(*np.array(some).T)
                for rank, place in some:
                    plain.setdefault(rank, []).append(place)
            rank = queue.first()
            assert rank == min(plain)
            bucket = queue.open(rank)
            assert bucket[0] == min(plain[rank])
            if rng.random() < 0.5:
                assert sorted(bucket) == sorted(plain.pop(rank))
                queue.close(rank)
        for rank in sorted(plain):
            assert queue.first() == rank
            queue.close(rank)
        assert queue.first() == byte_bpe.NEVER


def test_documents(spark, library):
    rows = corpus()
    docs = clashing(frame(spark, rows), "ids", "decoded", "made", "tokens")
    made = docs.select("*", byte_bpe.round_trip(spark, F.col("text"), PATH, PATTERN).alias("out")).collect()
    assert len(made) == len(rows) and {row["ids"] for row in made} == {"ids"}
    for row in made:
        assert row["out"]["ids"] == library.encode_ordinary(row["text"] or "")
        assert row["out"]["decoded"] == (row["text"] or "").encode()


def test_encode_and_decode_apart(spark, library):
    docs = frame(spark, corpus(size=10)).select("doc_id", "text", byte_bpe.encode(
        spark, F.col("text"), PATH, PATTERN).alias("ids"))
    for row in docs.select("*", byte_bpe.decode(spark, F.col("ids"), PATH, PATTERN).alias("back")).collect():
        assert row["ids"] == library.encode_ordinary(row["text"] or "") and row["back"] == (row["text"] or "").encode()
    gaps = spark.createDataFrame([(None,), ([],), ([None, 72],)], "ids array<int>")
    back = gaps.select(byte_bpe.decode(spark, F.col("ids"), PATH, PATTERN)).collect()
    assert [row[0] for row in back] == [b"", b"", bytes(byte_bpe.Ranks(PATH, PATTERN).names[72])]


def test_empty_table(spark):
    docs = frame(spark, [])
    assert docs.select(byte_bpe.round_trip(spark, F.col("text"), PATH, PATTERN)).collect() == []
