"""CSV and Parquet tables: fixed schemas in, feature stores and lists out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions.scalars import decimal_comma as comma
from arrears.operators.joins import Conservation
from arrears.session import checkpoint_folder

COMMITTED, LAYOUT = "_COMMITTED", "_layout.json"  # readers of data pass over names that begin with an underscore


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, reachable from every executor."""
    return f"{checkpoint_folder(spark).rstrip('/')}/arrears-{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, separator: str = ",",
             strict: bool = True) -> DataFrame:
    """CSV with header and a fixed schema; a malformed row or a header that does not match fails the job."""
    return spark.read.csv(
        path if isinstance(path, str) else list(path), schema=schema, sep=separator, header=True, enforceSchema=not strict,
        mode="FAILFAST" if strict else "PERMISSIVE", escape='"', multiLine=False,
    )


def write_csv(df: DataFrame, path: str, separator: str = ",", decimal_comma: bool = False, mode: str = "overwrite",
              compression: str | None = None) -> None:
    """CSV with header; numbers with fractions can be written with a decimal comma."""
    if decimal_comma:
        fractional = (T.DecimalType, T.DoubleType, T.FloatType)
        df = df.select(*[
            comma(f.name).alias(f.name) if isinstance(f.dataType, fractional) else F.col(f.name) for f in df.schema.fields
        ])
    df.write.mode(mode).csv(path, sep=separator, header=True, escape='"', compression=compression)


def roundtrip_csv(df: DataFrame, path: str, schema: str, separator: str = ";") -> DataFrame:
    write_csv(df, path, separator)
    return read_csv(df.sparkSession, path, schema, separator)


def load_tables(spark: SparkSession, folder: str, schemas: Mapping[str, str | T.StructType], separator: str = ",",
                kind: str = "csv") -> dict[str, DataFrame]:
    """The source tables of a run, by name."""
    if kind == "parquet":
        return {name: spark.read.schema(schema).parquet(f"{folder}/{name}.parquet") for name, schema in schemas.items()}
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema, separator) for name, schema in schemas.items()}


class FeatureStore:
    """Snapshots of feature tables as Parquet, published whole or not at all.

    Every publication goes to a version folder of its own, and a commit marker, an empty file, is the last thing
    written to it. Readers take the highest version that has the marker, so they never see half a publication, and one
    that fails leaves the version before it readable. Old versions stay until ``prune`` takes them.

    A table published with keys is bucketed by them: rows are hashed into ``buckets`` files, sorted by partition and
    key. Two tables with the same keys and number of buckets join without an exchange. Other tables are split by
    ``da_aberto`` where they have it.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets = buckets

    def path(self, table: str, snapshot: str) -> str:
        return f"{self.folder}/{table}/snapshot={snapshot}"

    def publish(self, df: DataFrame, table: str, snapshot: str, keys: Sequence[str] = (),
                watch: Conservation | None = None) -> str:
        """Write a version and commit it; with ``watch``, only if rows and sums were conserved on the way."""
        number = 1 + max((int(name.split("-")[0]) for name in self._versions(table, snapshot)), default=0)
        path = f"{self.path(table, snapshot)}/{number:08d}-{uuid.uuid4().hex}"
        if keys:
            layout = {"keys": list(keys), "buckets": self.buckets, "schema": df.schema.json()}
            name = self._declare(path, layout)
            # As many hash partitions as buckets: one task writes one file.
            df.repartition(self.buckets, *keys).write.insertInto(name)
            self._write(f"{path}/{LAYOUT}", json.dumps(layout))
        else:
            writer = df.write.partitionBy("da_aberto") if "da_aberto" in df.columns else df.write
            writer.parquet(path)
        if watch is not None:
            watch.check()
        self._write(f"{path}/{COMMITTED}", "")
        return path

    def read(self, table: str, snapshot: str) -> DataFrame:
        path = self.current(table, snapshot)
        layout = self._read(f"{path}/{LAYOUT}")
        return self.spark.read.parquet(path) if layout is None else self.spark.table(self._declare(path, json.loads(layout)))

    def current(self, table: str, snapshot: str) -> str:
        """The folder of the last committed version."""
        committed = self._committed(table, snapshot)
        if not committed:
            raise FileNotFoundError(f"{self.path(table, snapshot)} has no committed version")
        return committed[-1]

    def prune(self, table: str, snapshot: str, keep: int = 2) -> None:
        """Delete committed versions but the last ``keep``, for when no reader is left on them."""
        for path in self._committed(table, snapshot)[:-keep]:
            self._files(path)[0].delete(self._files(path)[1], True)

    def _declare(self, path: str, layout: Mapping) -> str:
        """The name under which the session's catalog knows a bucketed version."""
        schema = T.StructType.fromJson(json.loads(layout["schema"]))
        name = "store_" + path.rsplit("-", 1)[1]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{k}`" for k in layout["keys"])
        order = f"`da_aberto`, {keys}" if "da_aberto" in schema.names and "da_aberto" not in layout["keys"] else keys
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                       f"SORTED BY ({order}) INTO {int(layout['buckets'])} BUCKETS LOCATION '{path}'")
        return name

    def _committed(self, table: str, snapshot: str) -> list[str]:
        base = self.path(table, snapshot)
        return [f"{base}/{name}" for name in self._versions(table, snapshot) if self._exists(f"{base}/{name}/{COMMITTED}")]

    def _versions(self, table: str, snapshot: str) -> list[str]:
        """Version folders by number, committed or not."""
        base = self.path(table, snapshot)
        files, place = self._files(base)
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def _files(self, path: str):
        """The shared file system of a path, as the cluster is configured, and the path in its terms."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _exists(self, path: str) -> bool:
        files, place = self._files(path)
        return files.exists(place)

    def _write(self, path: str, text: str) -> None:
        files, place = self._files(path)
        stream = files.create(place, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    def _read(self, path: str) -> str | None:
        files, place = self._files(path)
        if not files.exists(place):
            return None
        stream = files.open(place)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text
