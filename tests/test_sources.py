"""Readers and writers."""

import subprocess
import sys
import zipfile
from decimal import Decimal

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.operators.joins import Conservation, left_join
from arrears.sources import archives, database, files

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("nome", T.StringType()), T.StructField("valor", T.DecimalType(18, 2))])


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,outro,valor\n1,x,2.50\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect()


def test_csv_bad_number_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,nome,valor\n1,x,abc\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect()


def test_csv_quotes_and_missing_values(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a;"b"', Decimal("2.50")), (2, None, None)], SCHEMA)
    back = files.roundtrip_csv(df, str(tmp_path / "out"), SCHEMA.simpleString()[7:-1].replace(":", " "))
    assert sorted(map(tuple, back.collect())) == [(1, 'a;"b"', Decimal("2.50")), (2, None, None)]


def test_decimal_comma(spark, tmp_path):
    df = spark.createDataFrame([(1, "a.b", Decimal("1234.50"))], SCHEMA)
    files.write_csv(df.coalesce(1), str(tmp_path / "out"), separator=";", decimal_comma=True)
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text.splitlines() == ["id;nome;valor", "1;a.b;1234,50"]


def test_members_of_many_archives(spark, tmp_path):
    for i in range(3):
        with zipfile.ZipFile(tmp_path / f"lote{i}.zip", "w") as z:
            z.writestr("imovel.csv", f"id,nome,valor\n{i},n{i},{i}.25\n{i + 10},,\n")
            z.writestr("outro.csv", "x\n1\n")
    df = archives.read_archived_csv(spark, str(tmp_path), "imovel.csv", SCHEMA)
    assert df.schema == SCHEMA or [f.dataType for f in df.schema] == [f.dataType for f in SCHEMA]
    assert sorted(map(tuple, df.collect()), key=lambda r: r[0])[:2] == [(0, "n0", Decimal("0.25")), (1, "n1", Decimal("1.25"))]
    assert df.count() == 6


def test_archive_without_a_column_fails(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "lote.zip", "w") as z:
        z.writestr("imovel.csv", "id,nome\n1,a\n")
    with pytest.raises(Exception, match="lacks columns"):
        archives.read_archived_csv(spark, str(tmp_path), "imovel.csv", SCHEMA).collect()


def test_members_are_listed_and_read_in_place(spark, tmp_path):
    folder = tmp_path / "dois lotes"
    folder.mkdir()
    for i in range(2):
        with zipfile.ZipFile(folder / f"lote {i}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("2019/imovel.csv", f"\ufeffvalor,extra,nome,id\r\n{i}.25,x,\"a\r\nb, \"\"c\"\"\",{i}\r\n,,,{i + 10}\r\n")
            z.writestr("2020/imovel.csv", f"id,nome,valor\n{i + 20},{'n' * 200_000},1\n")
            z.writestr("2020/empty.csv", "id,nome,valor\n")
            z.writestr("outro.csv", "x\n1\n")
    listed = archives.list_members(spark, str(folder), "*/imovel.csv")
    assert sorted((r["path"][-10:], r["member"]) for r in listed.collect()) == [
        (f"lote {i}.zip", f"{year}/imovel.csv") for i in range(2) for year in (2019, 2020)]
    rows = sorted(map(tuple, archives.read_members(spark, str(folder), "2*", SCHEMA).collect()))
    assert rows[:3] == [(0, 'a\r\nb, "c"', Decimal("0.25")), (1, 'a\r\nb, "c"', Decimal("1.25")), (10, None, None)]
    assert [(r[0], len(r[1])) for r in rows[4:]] == [(20, 200_000), (21, 200_000)]
    assert archives.read_members(spark, str(folder), "none*", SCHEMA).collect() == []
    with pytest.raises(Exception, match="lacks columns"):
        archives.read_members(spark, str(folder), "*", SCHEMA).collect()


def test_members_of_one_archive_are_many_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "lote.zip", "w") as z:
        for i in range(40):
            z.writestr(f"{i}.csv", f"id,nome,valor\n{i},a,1\n")
    read = archives.read_members(spark, str(tmp_path), "*.csv", SCHEMA)
    assert read.select(F.spark_partition_id()).distinct().count() > 4 and read.count() == 40


def test_archives_written_by_tasks(spark, tmp_path):
    rows = [(i, None if i % 3 == 0 else f"n;{i}\n", Decimal(i)) for i in range(30_000)]
    named = spark.createDataFrame(rows, SCHEMA).withColumn("member", F.format_string("%d/lote.csv", F.col("id") % 5))
    folder = str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the archives
        told = archives.write_members(named, folder, "member", ";").collect()
        assert sorted((r["member"], r["linhas"]) for r in told) == [(f"{k}/lote.csv", 6_000) for k in range(5)]
    assert sorted(map(tuple, archives.read_members(spark, folder, "*", SCHEMA, ";").collect())) == rows
    assert archives.read_members(spark, folder, "3/*", SCHEMA, ";").count() == 6_000
    assert archives.write_members(named.where("id < 0"), str(tmp_path / "none"), "member").collect() == []
    with pytest.raises(Exception, match="a row has no member"):
        archives.write_members(named.withColumn("member", F.lit(None).cast("string")), str(tmp_path / "no"), "member").collect()


class RecordingReader:
    """Stands in for ``spark.read``: keeps the options and reads a file instead of a database."""

    def __init__(self, spark, path):
        self.spark, self.path, self.seen = spark, path, {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.spark.read.parquet(self.path)


def test_database_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    reader = RecordingReader(spark, path)
    connection = database.Connection("jdbc:any:", {"user": "u"})
    assert database.scan_table(reader, connection, "vw", database.Slices("id", 0, 100, 8)).count() == 5
    assert reader.seen["dbtable"] == "vw" and reader.seen["numPartitions"] == "8" and reader.seen["partitionColumn"] == "id"
    database.scan_query(reader, connection, "select 1")
    assert reader.seen["query"] == "select 1" and reader.seen["format"] == "jdbc"
    database.scan_query(reader, connection, "select 1", database.Slices("id", 0, 9, 2))
    assert reader.seen["dbtable"] == "(select 1) AS consulta"


def test_connection_comes_from_configuration(spark):
    spark.conf.set("spark.arrears.database.url", "jdbc:any:x")
    try:
        assert database.Connection.from_conf(spark).url == "jdbc:any:x"
    finally:
        spark.conf.unset("spark.arrears.database.url")


def test_feature_store_snapshots(spark, tmp_path):
    store = files.FeatureStore(spark, str(tmp_path))
    store.publish(spark.createDataFrame([(1, 0), (2, 1)], "id int, da_aberto int"), "fs", "2020-01-01")
    store.publish(spark.createDataFrame([(3, 1)], "id int, da_aberto int"), "fs", "2020-02-01")
    assert sorted(r["id"] for r in store.read("fs", "2020-01-01").collect()) == [1, 2]
    assert [r["id"] for r in store.read("fs", "2020-02-01").where("da_aberto = 1").collect()] == [3]


def test_load_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    (tmp_path / "b.csv").write_text("id\n2\n")
    tables = files.load_tables(spark, str(tmp_path), {"a": "id int", "b": "id int"})
    assert tables["b"].first()["id"] == 2


def rows_of(store, table="fs"):
    return sorted(map(tuple, store.read(table, "2020").select("id", "da_aberto", "valor").collect()))


def small(spark, *rows):
    return spark.createDataFrame(rows, "id int, da_aberto int, valor bigint")


@pytest.mark.parametrize("keys", [(), ("id",)])
def test_a_failed_publication_leaves_the_one_before(spark, tmp_path, keys):
    store = files.FeatureStore(spark, str(tmp_path), buckets=3)
    with pytest.raises(FileNotFoundError):
        store.read("fs", "2020")
    store.publish(small(spark, (1, 0, 5), (2, 1, 6)), "fs", "2020", keys)
    first = store.current("fs", "2020")
    broken = small(spark, (3, 0, 7)).withColumn("valor", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        store.publish(broken, "fs", "2020", keys)
    watch = Conservation("repeated", value=("valor", "valor"))
    repeated = watch.leave(watch.enter(small(spark, (3, 0, 7))).crossJoin(spark.range(2).drop("id")))
    with pytest.raises(ValueError, match="repeated: rows 1 became 2, value 7 became 14"):
        store.publish(repeated, "fs", "2020", keys, watch)
    assert store.current("fs", "2020") == first and rows_of(store) == [(1, 0, 5), (2, 1, 6)]
    store.publish(small(spark, (4, 0, 8)), "fs", "2020", keys)
    again = files.FeatureStore(spark, str(tmp_path))
    assert rows_of(again) == [(4, 0, 8)] and again.current("fs", "2020") > first
    store.prune("fs", "2020", keep=1)
    assert rows_of(store) == [(4, 0, 8)] and len(list((tmp_path / "fs" / "snapshot=2020").glob("0000000[1]-*"))) == 0


def test_readers_keep_the_version_they_opened(spark, tmp_path):
    store = files.FeatureStore(spark, str(tmp_path), buckets=2)
    store.publish(small(spark, (1, 0, 5)), "fs", "2020", ["id"])
    opened = store.read("fs", "2020")
    store.publish(small(spark, (2, 0, 6)), "fs", "2020", ["id"])
    assert opened.collect()[0]["id"] == 1 and rows_of(store) == [(2, 0, 6)]


def test_bucketed_stores_join_without_an_exchange(spark, tmp_path):
    store = files.FeatureStore(spark, str(tmp_path), buckets=4)
    left = spark.range(200).selectExpr("CAST(id % 50 AS int) AS id", "'a' AS tipo", "CAST(id % 2 AS int) AS da_aberto")
    store.publish(left, "dividas", "2020", ["id", "tipo"])
    store.publish(left.distinct().withColumn("peso", F.lit(1)), "pessoas", "2020", ["id", "tipo"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        people = store.read("pessoas", "2020").where("da_aberto = 0").drop("da_aberto")
        joined = left_join(store.read("dividas", "2020"), people, ["id", "tipo"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_row_conservation(spark):
    watch = Conservation("same", total=("id", "number"))
    kept = watch.leave(watch.enter(spark.range(5)).withColumnRenamed("id", "number"))
    kept.write.format("noop").mode("overwrite").save()
    assert watch.check() == {"rows": 5, "total": 10}
    watch = Conservation("fewer")
    watch.leave(watch.enter(spark.range(3)).where("id > 0")).collect()
    with pytest.raises(ValueError, match="fewer: rows 3 became 2"):
        watch.check()
    watch = Conservation("nothing")
    watch.leave(watch.enter(spark.range(0))).collect()
    assert watch.check() == {"rows": 0}


def test_workers_need_no_copy_of_the_package(tmp_path):
    sent = tmp_path / "sent"
    sent.write_bytes(cloudpickle.dumps((archives.opened, archives.member_rows, archives.located)))
    read = "import pickle, sys; print([f.__name__ for f in pickle.load(open(sys.argv[1], 'rb'))])"
    told = subprocess.run([sys.executable, "-I", "-c", read, str(sent)], cwd=tmp_path, capture_output=True, text=True)
    assert told.stdout.strip() == "['opened', 'member_rows', 'located']", told.stderr
