"""Database scans and table sinks over JDBC; connection settings come from configuration, never from code."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Connection:
    """JDBC address and properties. ``source`` is the format, so tests can read the same tables from files."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    source: str = "jdbc"

    @classmethod
    def from_conf(cls, spark: SparkSession, prefix: str = "spark.arrears.database") -> Connection:
        """Settings ``<prefix>.url``, ``.user``, ``.password`` and ``.driver`` of the session."""
        url = spark.conf.get(f"{prefix}.url")
        found = {k: spark.conf.get(f"{prefix}.{k}", None) for k in ("user", "password", "driver")}
        return cls(url, {k: v for k, v in found.items() if v})


@dataclass(frozen=True)
class Slices:
    """Numeric column whose ranges are read by separate tasks."""

    column: str
    low: int
    high: int
    count: int


def _reader(spark: SparkSession, connection: Connection, extra: Mapping[str, object]):
    options = {"url": connection.url, "fetchsize": FETCH_ROWS, **connection.properties, **extra}
    return spark.read.format(connection.source).options(**{k: str(v) for k, v in options.items()})


def scan_table(spark: SparkSession, connection: Connection, table: str, slices: Slices | None = None) -> DataFrame:
    """Whole table or view; with slices, one range per task, so no single connection carries a large table."""
    extra: dict[str, object] = {"dbtable": table}
    if slices:
        extra |= {"partitionColumn": slices.column, "lowerBound": slices.low, "upperBound": slices.high, "numPartitions": slices.count}
    return _reader(spark, connection, extra).load()


def scan_query(spark: SparkSession, connection: Connection, sql: str, slices: Slices | None = None) -> DataFrame:
    """Query run by the database; sliced queries go in as a derived table."""
    if slices:
        return scan_table(spark, connection, f"({sql}) AS consulta", slices)
    return _reader(spark, connection, {"query": sql}).load()


def replace_table(df: DataFrame, connection: Connection, table: str, writers: int = 16, batch: int = 10_000) -> None:
    """Replace a table's rows, keeping its definition; few writers, so the database is not flooded.

    The rows are dealt to the writers by a shuffle, so what computes them keeps its own parallelism.
    """
    (
        df.repartition(writers).write.format(connection.source).mode("overwrite")
        .options(url=connection.url, dbtable=table, truncate="true", batchsize=str(batch), **connection.properties).save()
    )
