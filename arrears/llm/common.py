"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII white space of every word and line rule here: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Rows of a text table are kilobytes each: batches for Python workers hold fewer rows than the default 10,000.
OPTIONS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files.

    Used where several later steps read one costly result; a lost executor then costs a read, not the work behind it.
    The folder is the session's ``spark.checkpoint.dir``; there is no local substitute.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else; the built-in lower() serves texts without other letters."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null: the pieces between white-space runs of the trimmed text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that clash with no column of ``df`` (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def others(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` without those called as an output column (names compare without case)."""
    made = {name.lower() for name in names}
    return [df[c] for c in df.columns if c.lower() not in made]


def text_print(text: Column) -> Column:
    """With the id, tells rows apart that repeat an id with another text; null reads as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def row_key(row_id: Column, names: list[str]) -> list[Column]:
    """An id as two columns without nulls, so that plain equi-joins and groupings on them share one exchange."""
    return [F.coalesce(row_id, F.lit(0)).alias(names[0]), row_id.isNull().alias(names[1])]
