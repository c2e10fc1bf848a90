"""CSV members inside zip archives.

``read_members`` opens archives in place: one job lists their directories, then every member is a task of its own that
seeks to it, so neither the size of an archive nor the number of its members is limited by one value or one task. A
single member is one compressed stream and cannot be split. ``read_archived_csv`` takes each archive as one binary value
(at most 2 GB); it is for stores that only Spark can open.

Missing values and empty texts are both written as nothing and read as missing.
"""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from fnmatch import fnmatchcase
from itertools import islice
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 10_000
LONGEST_FIELD = 2**31 - 1
MEMBERS = "path string, member string, bytes bigint"
WRITTEN = "path string, member string, linhas bigint"


def read_archived_csv(spark: SparkSession, path: str, member: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Rows of one named CSV member of every archive under a path.

    Members are streamed out in batches of text columns; Spark then casts them, so a bad value fails the job there.
    """
    names = schema.fieldNames()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    if member in archive.namelist():
                        yield from member_rows(archive, member, names, separator)

    archives = spark.read.format("binaryFile").load(path).select("content")
    return typed(archives.mapInPandas(rows, text_schema(names)), schema)


def list_members(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, name and uncompressed bytes of the members whose whole name fits the pattern; only directories are read."""
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place in batch["path"]:
                with opened(place) as archive:
                    found = [(place, m.filename, m.file_size) for m in archive.infolist()
                             if not m.is_dir() and fnmatchcase(m.filename, pattern)]
                yield pd.DataFrame(found, columns=["path", "member", "bytes"])

    return spark.read.format("binaryFile").load(path).select("path").mapInPandas(listed, MEMBERS)


def read_members(spark: SparkSession, path: str, pattern: str, schema: T.StructType | str, separator: str = ",") -> DataFrame:
    """Rows of every CSV member that fits the pattern, in all archives under a path, several members at a time.

    A member without one of the columns, or with a value that does not cast, fails the job; further columns are passed over.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = schema.fieldNames()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, member in zip(batch["path"], batch["member"]):
                with opened(place) as archive:
                    yield from member_rows(archive, member, names, separator)

    # A stated number of partitions is not merged again: rows of the list are small, what they stand for is not.
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = list_members(spark, path, pattern).repartition(parts, "path", "member")
    return typed(dealt.mapInPandas(rows, text_schema(names)), schema)


def write_members(df: DataFrame, folder: str, member: str, separator: str = ",") -> DataFrame:
    """Write one archive per task under a folder, with a CSV member for every value of the column ``member``.

    The folder should be a new one: archives of an earlier run that have no successor of their name stay. Rows of one
    member go to one task; a row without a member fails the job. An archive gets its name once it is complete; a task
    that runs again writes the same name anew. Returns path, member and rows of what was written; the archives are
    there when it has been read.
    """
    names = [c for c in df.columns if c != member]

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        store, base = located(folder)
        store.create_dir(base, recursive=True)
        hidden = f"{base}/_{task.partitionId():05d}-{task.taskAttemptId()}"
        final = f"{base}/part-{task.partitionId():05d}.zip"
        counts: dict[str, int] = {}
        with store.open_output_stream(hidden) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
            name, stream = None, None
            for batch in batches:
                for value, part in batch.groupby(member, sort=False):  # rows come sorted by member
                    if value != name:
                        if stream is not None:
                            stream.close()
                        name, counts[value] = value, 0
                        stream = io.TextIOWrapper(archive.open(value, "w", force_zip64=True), encoding="utf-8", newline="")
                        csv.writer(stream, delimiter=separator).writerow(names)
                    csv.writer(stream, delimiter=separator).writerows(
                        ["" if x is None else x for x in row] for row in part[names].itertuples(index=False, name=None))
                    counts[value] += len(part)
            if stream is not None:
                stream.close()
        if counts:
            store.move(hidden, final)
        else:
            store.delete_file(hidden)
        yield pd.DataFrame([(final, m, n) for m, n in counts.items()], columns=["path", "member", "linhas"])

    given = F.coalesce(F.col(member).cast("string"), F.raise_error(F.lit(f"a row has no {member}")).cast("string"))
    text = df.select(given.alias(member), *[F.col(c).cast("string").alias(c) for c in names])
    parts = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return text.repartition(parts, member).sortWithinPartitions(member).mapInPandas(written, WRITTEN)


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it; Spark names local files ``file:/...`` and leaves blanks as they are."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe="/:@?&=%+"))


@contextmanager
def opened(path: str) -> Iterator[zipfile.ZipFile]:
    store, inside = located(path)
    with store.open_input_file(inside) as file, zipfile.ZipFile(file) as archive:
        yield archive


def member_rows(archive: zipfile.ZipFile, member: str, names: list[str], separator: str) -> Iterator[pd.DataFrame]:
    """Batches of text columns of one member, streamed."""
    csv.field_size_limit(LONGEST_FIELD)
    with archive.open(member) as raw:
        reader = csv.DictReader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline=""), delimiter=separator)
        if missing := [n for n in names if n not in (reader.fieldnames or [])]:
            raise ValueError(f"{member} lacks columns {missing}")
        while batch := [[record[n] or None for n in names] for record in islice(reader, ROWS_PER_BATCH)]:
            yield pd.DataFrame(batch, columns=names, dtype=object)


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
