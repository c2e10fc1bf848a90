"""Encoding and decoding against the tokenizers library."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arrears.llm import bpe
from arrears.llm.queries import tokenizer_path
from tests.llm.helpers import clashing, corpus, frame


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return bpe.TextEncoder(bpe.Vocabulary(tokenizer_path()))


def unpack(ids):
    return [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)]


def test_odd_texts(library, encoder):
    rng = random.Random(5)
    alphabet = "abcdefgh ABΣΆßİéàÉ́ \x1c\x85​　漢字かな한글 '’s't 12३ \n\t\x00!?.,<|endoftext|>😀ﬁǅ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 3000, "<|endoftext|>" * 3, "the<|startoftext|>The", "", "don't ''' we've I'm 'sss 'rexx", "é" * 500]
    for text, ids in zip(texts, encoder.encode(iter(texts))):
        assert unpack(ids) == library.encode(text, add_special_tokens=False).ids, text[:80]


def test_small_tables_of_known_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 5)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 100)
    encoder = bpe.TextEncoder(bpe.Vocabulary(tokenizer_path()))
    texts = [r[1] or "" for r in corpus(size=20) if len(r[1] or "") < 5000]
    for text, ids in zip(texts, encoder.encode(iter(texts))):
        assert unpack(ids) == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, library):
    docs = clashing(frame(spark, corpus()), "IDS_", "decoded_")
    path = tokenizer_path()
    coded = docs.withColumn("ids", bpe.encode(spark, F.col("text"), path))
    rows = coded.withColumn("back", bpe.decode(spark, F.col("ids"), path)).withColumn(
        "both", bpe.round_trip(spark, F.col("text"), path)).collect()
    assert len(rows) == len(corpus())
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert unpack(r["ids"]) == ids
        assert r["back"] == library.decode(ids, skip_special_tokens=False)
        assert (r["both"]["ids"], r["both"]["decoded"]) == (r["ids"], r["back"])


def test_empty_table(spark):
    docs = frame(spark, [])
    assert docs.withColumn("ids", bpe.encode(spark, F.col("text"), tokenizer_path())).count() == 0


def test_letters_of_one_unicode_table_only(library, encoder):
    strange = [*encoder.lower, *map(chr, sorted(encoder.odd)[::9])]
    texts = [f"a{c}b {c} 1{c}{c}" for c in strange]
    rng = random.Random(11)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    texts += ["".join(chr(rng.choice(points)) for _ in range(30)) for _ in range(1500)]
    assert [unpack(i) for i in encoder.encode(iter(texts))] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("letters", ["acgt", "abcdefghijklmnopqrstuvwxyz", "a"])
def test_long_words(library, encoder, letters):
    rng = random.Random(12)
    word = "".join(rng.choice(letters) for _ in range(30_000))
    ids, = encoder.encode(iter([word]))
    assert unpack(ids) == library.encode(word, add_special_tokens=False).ids


def test_long_words_take_linear_memory(encoder):
    """Some hundred bytes a letter: a word of a million letters stays below 500 MB."""
    rng = random.Random(13)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60_000))
    tracemalloc.start()
    ids, = encoder.encode(iter([word]))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 400 * len(word)
    spelled = "".join(encoder.words.v.names[i] for i in unpack(ids))
    assert spelled.removesuffix(encoder.words.suffix) == word


def test_batches_are_cut_by_bytes(spark, library, monkeypatch):
    """No more text is worked on at once than the limit, or one text; order, nulls and longer texts stay."""
    monkeypatch.setattr(bpe, "BATCH_BYTES", 10)
    rows = ["ab", None, "", "ééé", "x" * 25, "c", "d" * 10, None]
    cut = [part.to_pylist() for part in bpe.portions(iter([pa.array(["zz", *rows], pa.string()).slice(1), pa.array([], pa.string())]))]
    assert cut == [["ab", None, "", "ééé"], ["x" * 25], ["c"], ["d" * 10, None]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)
    made = docs.withColumn("made", bpe.round_trip(spark, F.col("text"), tokenizer_path())).collect()
    for r in made:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (unpack(r["made"]["ids"]), r["made"]["decoded"]) == (ids, library.decode(ids, skip_special_tokens=False))
