"""The corpus pipeline: toxic documents go, shared lines go, near-copies go, sources are mixed, texts become tokens.

Each stage takes (spark, docs, folder) and returns a frame; all but the last return the columns of ``documents``. The
stages read ``docs`` more than once, so ``run`` writes each result to the shared checkpoint folder before the next one
starts; a job that loses executors goes on from there.

Rules of all stages: null texts are empty texts; null ids, labels and sources, empty and very long texts, ties and
repeated rows are treated as the operator of the stage states; an empty table passes through as an empty one; columns
beyond those of ``documents`` pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import bpe, lines, mixing, simhash, toxicity
from arrears.llm.common import fresh, settle, table, tune
from arrears.llm.queries import tokenizer_path

# Trained models and fingerprints have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose score reaches the rejection limit go; the field is fitted on the labelled ones among ``docs``."""
    field = toxicity.train(spark, docs, table(spark, folder, "labels"))
    judged, = fresh(docs, "judged")
    scored = docs.withColumn(judged, toxicity.judge(tune(spark), F.col("text"), field))
    return scored.where(F.col(judged)["score"] < toxicity.REJECT).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    kept, count, dropped = fresh(docs, "kept_text", "line_count", "dropped_count")
    done = lines.dedup_lines(docs, kept=kept, lines=count, dropped=dropped)
    new = {"text": F.col(kept), "n_chars": F.length(kept).cast("long")}
    return done.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    tune(spark)
    return simhash.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    made = docs.select("doc_id", "source", "lang", bpe.round_trip(
        tune(spark), F.col("text"), tokenizer_path()).alias("made"))
    return made.select("doc_id", "source", "lang", (F.octet_length("made.ids") / 4).cast("long").alias("n_tokens"),
                       "made.ids", F.sha2("made.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(tune(spark), folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
