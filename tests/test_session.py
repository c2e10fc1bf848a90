"""Checkpoint folder: the session's own, and never a local one on a cluster."""

from types import SimpleNamespace

import pytest

from arrears.session import RUNTIME_OPTIONS, checkpoint_folder, cut_lineage, tune


def fake(folder, master, current=None):
    chosen = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current or (chosen[-1] if chosen else None), setCheckpointDir=chosen.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=context), chosen


def test_folder_of_the_session_is_used():
    spark, chosen = fake("hdfs:/shared", "spark://host:7077")
    assert checkpoint_folder(spark) == "hdfs:/shared" and not chosen


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError):
        checkpoint_folder(fake(None, "spark://host:7077")[0])


def test_local_session_without_a_folder_is_refused():
    with pytest.raises(ValueError):
        checkpoint_folder(fake(None, "local[2]")[0])


def test_checkpoint_keeps_rows_and_cuts_the_plan(spark):
    df = cut_lineage(spark.range(10).withColumnRenamed("id", "x"))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_options_are_applied(spark):
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_OPTIONS.items())


def test_a_task_takes_no_more_of_a_larger_input(spark, source):
    """The partitions of an exchange follow the bytes read, and are merged again where they turn out small."""
    from arrears.session import BYTES_A_PARTITION, FIRST_PARTITIONS, spread_exchanges

    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert spread_exchanges(spark, 0) == before and spread_exchanges(spark, 100 * BYTES_A_PARTITION + 1) == 101
        plan = spark.range(0, 1000, 1, 4).selectExpr("id % 7 AS x").distinct()
        assert ", 101)" in plan._jdf.queryExecution().executedPlan().toString()
        assert plan.rdd.getNumPartitions() < 101 and plan.count() == 7
        assert source.size() > 0
    finally:
        spark.conf.unset(FIRST_PARTITIONS)
