"""Whole runs over the smallest tables."""

from pyspark.sql import functions as F

from arrears.plans import features, pipelines, recovery
from arrears.session import cut_lineage
from arrears.sources.files import FeatureStore
from catalogue.stores import REFERENCE_YEAR, certificates, debts_v1, parcels, stock


def test_second_generation_run(spark, source, tmp_path):
    store, models = FeatureStore(spark, str(tmp_path / "store")), str(tmp_path / "models")
    base = cut_lineage(source.divida)
    built = pipelines.build_taxpayers(store, "2002-01", base, source.notas, models, trees=5, depth=5)
    assert built["aceito"] and built["modelo"] and len(built["centroides"]) == 5
    pipelines.build_debts(store, "2002-01", base)
    assert pipelines.train(store, "2002-01", models, trees=3, depth=3, r2=2.0)["modelo"] is None
    trained = pipelines.train(store, "2002-01", models, trees=5, depth=5, r2=-1.0, mse=9.0)
    assert trained["modelo"] and trained["n"] > 0
    summary = pipelines.score(store, "2002-01", trained["modelo"])
    open_debts = base.where("da_aberto = 1")
    assert summary.agg(F.sum("cda")).first()[0] == open_debts.count()
    assert summary.agg(F.sum("valor_total_da")).first()[0] == open_debts.agg(F.sum("valor_tot")).first()[0]
    pipelines.publish_lists(store, "2002-01", base, str(tmp_path / "listas"))
    lists = spark.read.parquet(str(tmp_path / "listas"))
    assert lists.where("valor_total_da < 1000 OR idade_divida > 3").count() == 0
    assert set(r[0] for r in lists.select("rating_divida").distinct().collect()) <= {"MEDIA", "ALTA", "ALTISSIMA"}


def test_first_generation_run(spark, source, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    _, numbers = pipelines.build_taxpayers_v1(store, "2002-01", *certificates(source), source.notas, trees=5, depth=5)
    people = store.read(pipelines.TAXPAYERS, "2002-01")
    assert set(numbers.values()) == {0, 1, 2, 3}
    assert people.where("class_contribuinte_peso IS NULL OR class_contribuinte_nome IS NULL").count() == 0
    assert people.where("frequencia_da_pessoa = 1 AND class_contribuinte <> 4").count() == 0
    frame = cut_lineage(features.training_frame_v1(debts_v1(source), people))
    model, _, _ = recovery.train_index(frame, features.FEATURES_V1, features.TARGET, ["cda"], recovery.forest(5, 5))
    path = recovery.save_if_accepted(model, True, str(tmp_path / "models"), "igr")
    scored = pipelines.score_v1(stock(source), parcels(source), people, path, REFERENCE_YEAR)
    assert scored.count() == stock(source).count()
    assert scored.where("rating_divida IS NULL").count() == 0
    assert scored.where("status_situacao = 0 AND igr <> 0").count() == 0


def test_schemas_describe_the_tables(spark, tmp_path):
    from arrears.sources import files, schemas

    for name, schema in schemas.FIRST_GENERATION.items():
        columns = spark.createDataFrame([], schema).columns
        (tmp_path / f"{name}.csv").write_text(",".join(columns) + "\n")
    tables = files.load_tables(spark, str(tmp_path), schemas.FIRST_GENERATION)
    assert all(t.count() == 0 for t in tables.values())
    for schema in (*schemas.SECOND_GENERATION.values(), schemas.BILLS, schemas.HISTORY):
        assert spark.createDataFrame([], schema).columns
