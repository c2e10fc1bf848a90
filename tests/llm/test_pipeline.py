"""The stages of the corpus pipeline, each on its own input, and the whole run."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from arrears.llm import common, toxicity
from arrears.llm.queries import ORACLES, QUERIES, tokenizer_path
from tests.conftest import SMALL
from tests.llm.helpers import corpus, frame
from tests.llm.test_dedup import brute_lines, brute_simhash
from tests.llm.test_mixing import brute_mix

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_the_dealt_ones():
    assert list(STAGES) == ["toxicity", "line dedup", "simhash near-dedup", "mixing", "bpe"]


def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = STAGES["toxicity"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    field = toxicity.train(spark, docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = docs.select("doc_id", toxicity.judge(spark, F.col("text"), field)["score"].alias("s")).collect()
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scores if r["s"] < toxicity.REJECT}


def test_line_stage(spark):
    out = STAGES["line dedup"](spark, frame(spark, corpus()), SMALL)
    assert out.columns == COLUMNS
    found = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(found, key=repr) == sorted(((i, t) for i, t, _, _ in brute_lines(corpus())), key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_near_duplicate_stage(spark):
    out = STAGES["simhash near-dedup"](spark, frame(spark, corpus()), SMALL)
    assert out.columns == COLUMNS
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == brute_simhash(corpus(), groups=True)


def test_mixing_stage(spark):
    out = STAGES["mixing"](spark, frame(spark, corpus()), SMALL)
    assert out.columns == COLUMNS
    words = sum(len((r["text"] or "").split()) for r in out.collect())
    assert words == sum(row[-1] for row in brute_mix(corpus())[0])


def test_encoding_stage(spark):
    library = Tokenizer.from_file(tokenizer_path())
    texts = {r[0]: r[1] for r in corpus() if r[0] is not None and r[0] != 7}
    for r in STAGES["bpe"](spark, frame(spark, corpus()), SMALL).collect():
        if r["doc_id"] in texts:
            ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
            assert r["ids"] == b"".join(i.to_bytes(4, "little") for i in ids) and r["n_tokens"] == len(ids)
            assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_whole_run_equals_its_stages(spark):
    docs = common.table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.settle(stage(spark, docs, SMALL))
    assert [r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()] == [r["doc_id"] for r in docs.collect()]


@pytest.mark.parametrize("stage", list(STAGES))
def test_empty_documents(spark, stage):
    assert STAGES[stage](spark, frame(spark, []), SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "labels", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    names = sorted(df.columns)
    theirs = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]}) q").fetchall()
    assert sorted(map(repr, theirs)) == sorted(repr(tuple(r)) for r in df.select(names).collect())


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - {"op13_hard_negatives"}))  # its rows are pairs of an anchor, by rank
def test_queries_have_one_row_per_input_row(spark, name):
    table = {"op7_embeddings": "embeddings", "op12_centroids": "embeddings", "op10_url_filter": "pages"}.get(name, "documents")
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
