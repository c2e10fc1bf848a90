"""Model invariants; numbers differ between libraries, properties do not."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from arrears.operators.stats import fit_scaler
from arrears.plans import features as P
from arrears.plans import recovery as R
from arrears.plans import segments as S
from arrears.session import cut_lineage, neighbouring_rows


@pytest.fixture(scope="module")
def people(spark, source):
    return cut_lineage(P.accessibility(P.taxpayer_profile(source.divida, source.notas)))


@pytest.fixture(scope="module")
def segmented(people):
    return S.segment_taxpayers(people, P.training_slice(people), P.CLUSTER_FEATURES, ["id_pessoa", "tipo_divida"], k=5, trees=5, depth=5)


@pytest.fixture(scope="module")
def frame(spark, source, segmented):
    return cut_lineage(P.training_frame(P.debt_store(source.divida), P.first_debt_floor(segmented[0])))


@pytest.fixture(scope="module")
def trained(frame):
    return R.train_index(frame, P.FEATURES_V2, P.TARGET, ["cda", "tipo_divida", "id_pessoa"], R.forest(10, 6))


def test_inertia_falls_with_k(spark, people):
    prepared = cut_lineage(S.assembled(P.training_slice(people), P.CLUSTER_FEATURES))
    curve = S.sweep(prepared, [2, 4, 8])
    inertia = [r["inercia"] for r in curve.orderBy("k").collect()]
    assert inertia[0] >= inertia[1] * 0.99 and inertia[1] >= inertia[2] * 0.99
    assert S.best_k(curve) in (2, 4, 8)


def test_segments(people, segmented):
    classified, learned = segmented
    assert classified.count() == people.count()
    assert 0.5 < learned["accuracy"] <= 1.0
    assert classified.where("num_dist_cda = 1 AND class_contribuinte_nome <> 'PRIMEIRA DIVIDA'").count() == 0
    assert classified.where("class_contribuinte_peso IS NULL").count() == 0
    order = S.cluster_order(learned["model"], P.CLUSTER_FEATURES, ["historico_pagamento_em_valor"])
    centres = [c["historico_pagamento_em_valor"] for c in (learned["centroids"][i] for i in order)]
    assert centres == sorted(centres)
    assert learned["names"][order[0]] == "DEVEDOR PESSIMO" and learned["names"][order[-1]] == "DEVEDOR EXCEL"


def test_silhouette_rows_average_to_the_overall_value(segmented):
    labelled = segmented[1]["labelled"]
    mean = S.silhouette_rows(labelled, P.CLUSTER_FEATURES).agg(F.avg("silhueta")).first()[0]
    assert mean == pytest.approx(S.silhouette(labelled), abs=1e-6)


def test_weights_rise_with_rank(segmented):
    rows = {r["class_contribuinte_nome"]: r["class_contribuinte_peso"] for r in segmented[1]["weights"].collect()}
    assert rows["DEVEDOR PESSIMO"] == min(rows.values()) and rows["DEVEDOR EXCEL"] == max(rows.values())


def test_split_is_stable(spark):
    df = spark.range(2000)
    train = {r["id"] for r in R.split(df, ["id"])[0].collect()}
    again = {r["id"] for r in R.split(df.repartition(13), ["id"])[0].collect()}
    assert train == again and 1300 < len(train) < 1500


def test_forest_beats_the_mean(frame, trained):
    train, test = R.split(frame, ["cda", "tipo_divida", "id_pessoa"])
    from arrears.operators.stats import regression_metrics

    base = regression_metrics(R.mean_baseline(train, test, P.TARGET), P.TARGET, "igr").first()
    assert trained[1]["r2"] > base["r2"] and base["r2"] <= 0.01
    assert sum(v for _, v in trained[2]) == pytest.approx(1.0)


def test_boosting_stops_by_itself(spark):
    """A slope is learned in many small steps: every round kept helps, the one after the last would not have."""
    rows = cut_lineage(spark.range(2000).select("id", (F.col("id") / 100).alias("x"), (F.col("id") / 100).alias("y")))
    options = {"rate": 0.5, "share": 1.0, "depth": 2}
    stopping = R.boosted(trees=60, tolerance=0.05, **options)
    model, found, _ = R.train_index(rows, ["x"], "y", ["id"], stopping, scaler=None)
    train, _ = R.split(rows, ["id"])
    marked = R.set_aside(train, stopping, ["id"], R.fv.SEED)
    assert 0.15 < marked.where(R.STOP_MARK).count() / train.count() < 0.25
    assert R.set_aside(train, R.boosted(trees=5), ["id"], 1) is train and R.set_aside(train, R.forest(1), ["id"], 1) is train
    errors = R.round_errors(model, marked.where(R.STOP_MARK))
    assert 3 < R.rounds(model) == len(errors) < 60
    assert all(later < earlier for earlier, later in zip(errors, errors[1:]))
    assert found["r2"] > 0.9
    longer = R.fit(marked.where(~F.col(R.STOP_MARK)), ["x"], "y", R.boosted(trees=len(errors) + 1, **options), None)
    beyond = R.round_errors(longer, marked.where(R.STOP_MARK))
    assert beyond[-2] - beyond[-1] < 0.05 * max(beyond[-1], 0.01)


def test_gate():
    assert R.accept_regressor({"r2": 0.83, "mse": 0.0189}) and not R.accept_regressor({"r2": 0.82, "mse": 0.0189})
    assert not R.accept_regressor({"r2": 0.83, "mse": 0.019})
    assert R.accept_segments(5) and not R.accept_segments(4)


def test_models_are_saved_with_their_scaler(frame, trained, tmp_path):
    assert R.save_if_accepted(trained[0], False, str(tmp_path), "igr") is None
    path = R.save_if_accepted(trained[0], True, str(tmp_path), "igr", datetime(2020, 1, 2))
    loaded = R.open_model(path)
    key = ["cda", "tipo_divida", "id_pessoa"]
    mine = {tuple(r[k] for k in key): r["igr"] for r in R.prediction(trained[0], frame).collect()}
    theirs = {tuple(r[k] for k in key): r["igr"] for r in R.prediction(loaded, frame).collect()}
    assert mine == theirs


def test_scaler_is_learned_on_the_training_rows(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "a double")
    stages, inputs = R.scaler_stage(train, ["a"], "standard")
    scored = stages[0].transform(spark.createDataFrame([(100.0,)], "a double")).first()
    assert inputs == ["a_escala"] and scored["a_escala"] == pytest.approx(19.0)
    assert fit_scaler(train, ["a"], "standard")["a"] == (5.0, 5.0)


def test_stock_is_scored_and_rated(source, segmented, trained):
    open_people = segmented[0].where("da_aberto = 1").select(
        "id_pessoa", "tipo_divida", "num_dist_cda", "quantidade_reparcelamento", "historico_pagamento_em_valor",
        "situacao_cobranca", "class_contribuinte_nome", "class_contribuinte_peso")
    stock = P.debt_store(source.divida).where("da_aberto = 1").drop("quantidade_reparcelamento").join(open_people, ["id_pessoa", "tipo_divida"], "left")
    scored = R.score_stock(stock, trained[0])
    assert scored.where("situacao_cobranca = 0 AND rating_divida <> 'BAIXISSIMA'").count() == 0
    assert scored.where("rating_divida IS NULL").count() == 0
    assert scored.count() == source.divida.where("da_aberto = 1").count()


def test_residuals_leave_out_the_ends(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.5, 1.0), (0.9, 0.5), (0.1, 0.5)], "y double, igr double")
    out = R.residuals(df, "y").collect()
    assert [round(r["residuos"], 6) for r in out] == [0.4, -0.4]


def test_a_forest_is_grown_in_parts(spark):
    """All trees are there, the prediction is their mean, and passes take few tasks however the rows were dealt."""
    rows = cut_lineage(spark.range(400).select("id", F.rand(1).alias("x"), F.rand(2).alias("y")).repartition(30))
    model = R.fit(rows, ["x"], "y", R.forest(10, 4), None)
    parts = [stage for stage in model.stages if hasattr(stage, "trees")]
    assert [part.getNumTrees for part in parts] == [2, 3, 2, 3]
    assert len({part.trees[0].toDebugString.split("\n", 1)[1] for part in parts}) > 1
    scored = R.prediction(model, rows)
    assert scored.columns == ["id", "x", "y", R.PREDICTION]
    trees = [tree for part in parts for tree in part.trees]
    vector = R.VectorAssembler(inputCols=["x"], outputCol="v")
    for row in vector.transform(scored).limit(5).collect():
        assert row[R.PREDICTION] == pytest.approx(sum(t.predict(row["v"]) for t in trees) / 10)
    assert R.importances(model, ["x"]) == [("x", pytest.approx(1.0))]
    assert R.tasks_of_a_part(400, 8, 4) == 2 and R.tasks_of_a_part(5_000_001, 8, 4) == 6
    assert len(R.fit(rows, ["x"], "y", R.forest(1, 2), None).stages) == 3


def test_a_forest_reads_neighbours_side_by_side(spark):
    """No row is lost; features with few values come first in the order; rows that are alike are dealt over the tasks."""
    rows = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("many"), (F.col("id") % 3).alias("few"), F.lit(1.0).alias("y"))
    near, count = neighbouring_rows(rows.repartition(30), ["many", "few"], ["few", "many", "y"])
    found = [(r["few"], r["many"]) for r in near.collect()]
    assert count == 3000 and found == sorted((r["few"], r["many"]) for r in rows.collect())
    alike, _ = neighbouring_rows(rows.withColumn("many", F.lit(1)), ["many"], ["y"])
    sizes = [r["count"] for r in alike.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 8 and max(sizes) < 1000
    empty, none = neighbouring_rows(rows.where("few > 5"), ["many"], ["y"])
    assert (empty.count(), none) == (0, 0)


def test_parts_and_tasks_follow_cores_and_rows():
    assert [R.parts_of_a_forest(trees, 8) for trees in (1, 3, 10, 40, 100)] == [1, 1, 4, 5, 8]
    assert R.parts_of_a_forest(100, 200) == 12
    assert R.tasks_for(10, 8) == 8 and R.tasks_for(20_000_001, 8) == 21


def test_keys_are_hashed_once(spark):
    rows = spark.range(200).select("id", F.col("id").alias("x"), (F.col("id") % 5).alias("y"))
    train, test = R.split_rows(rows, ["x"], "y", ["id"], R.fv.SEED)
    for part, plain in zip((train, test), R.split(rows, ["id"])):
        assert part.columns == ["id", "x", "y"] and sorted(part.collect()) == sorted(plain.collect())
        assert "md5" not in part._jdf.queryExecution().optimizedPlan().toString()
