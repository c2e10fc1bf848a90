"""Line deduplication: lines that many documents share leave all documents but one.

A line's key is the line without ASCII white space at its ends, A to Z lower-cased. Keys of at least ``min_chars`` code
points are hashed, the documents of each hash are counted, and where there are ``min_docs`` or more, the lines go from
every document except the one with the largest id. What stays is put together again by position.

Only hashes and positions are shuffled until the last join; texts move once. A line that a third of all documents hold
is counted by document first and by hash afterwards, both combined on the map side, and the join that brings the count
back is an inner equi-join, which Spark splits at run time.

Rules: a null or empty text is one empty line; a null id counts as one document, smaller than all others; rows that
repeat an id are one document for the count, and each keeps or loses lines by its own text; a document that loses all
its lines keeps the empty text; very long texts are split once and put together in one pass; an empty table gives an empty
result. A column of the table that has the name of an output column gives way to it; all others pass through. Lines are
compared by 128-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import SPACE, ascii_lower, fresh, others, settle

MIN_CHARS, MIN_DOCS = 40, 5


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def without(pieces: Column, positions: Column) -> Column:
    """The pieces whose positions are not listed, joined by line ends.

    The pieces are bound to a name, so that the text is split once and not once per line that stays.
    """
    def joined(bound: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(bound) - 1), positions)
        return F.array_join(F.transform(stay, lambda at: F.get(bound, at)), "\n")

    return F.get(F.transform(F.array(pieces), joined), F.lit(0))


def dropped_positions(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (id, print, positions): the lines to drop of each row, told by its id and the hash of its text."""
    # The hash goes into a step of its own: beside the generator it would be taken anew for every line of a text.
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("print"))
    lines = texts.select("id", "print", F.posexplode(lines_of(F.col("text"))).alias("at", "line")).where(
        F.length("line") >= min_chars).select("id", "print", "at", key_of(F.col("line")).alias("key"))
    lines = lines.where(F.length("key") >= min_chars).select(
        "id", "print", "at", F.unhex(F.md5("key")).alias("hash"))
    holders = lines.select("hash", "id").distinct()
    # Written, so that the join reads both sides from exchanges of its own and a hot line can be split.
    shared = settle(holders.groupBy("hash").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
                    .where(F.col("docs") >= min_docs).select("hash", "keeper"))
    return (lines.join(shared, "hash").where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy("id", "print").agg(F.collect_set("at").alias("positions")))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, kept: str = "kept_text",
                lines: str = "n_lines", dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the text that stays, its number of lines before, and the number of dropped lines."""
    key, hashed, gone = fresh(docs, "id", "print", "positions")
    drop = dropped_positions(docs, id_column, text_column, min_chars, min_docs).select(
        F.col("id").alias(key), F.col("print").alias(hashed), F.col("positions").alias(gone))
    text = F.coalesce(docs[text_column], F.lit(""))
    joined = docs.join(drop, docs[id_column].eqNullSafe(drop[key]) & (F.xxhash64(text) == drop[hashed]), "left")
    pieces, positions = lines_of(text), drop[gone]
    return joined.select(
        *others(docs, kept, lines, dropped),
        F.when(positions.isNull(), text).otherwise(without(pieces, positions)).alias(kept),
        F.size(pieces).cast("long").alias(lines),
        F.coalesce(F.size(positions), F.lit(0)).cast("long").alias(dropped),
    )
