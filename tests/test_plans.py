"""Conservation, skew and independence of partitioning of the domain plans."""

import pytest
from pyspark.sql import functions as F

from arrears.operators import joins as J
from arrears.operators import sets
from arrears.plans import collection as K
from arrears.plans import features as P
from arrears.plans import reports as R


def test_left_joins_conserve_rows_and_money(spark, source):
    profile = P.taxpayer_profile(source.divida, source.notas)
    keys = source.divida.select(*P.TAXPAYER).distinct().count()
    assert profile.count() == keys
    assert profile.agg(F.sum("valor_tot")).first()[0] == source.divida.agg(F.sum("valor_tot")).first()[0]
    assert P.certificate_detail(source.divida).count() == source.divida.count()


def test_invoice_duplicates_do_not_multiply_taxpayers(spark, source):
    twice = source.notas.unionByName(source.notas)
    assert P.taxpayer_profile(source.divida, twice).count() == P.taxpayer_profile(source.divida, source.notas).count()


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_results_do_not_depend_on_partitions(spark, source, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        digest = P.accessibility(P.taxpayer_profile(source.divida, source.notas)).agg(
            F.count(F.lit(1)), F.sum(F.hash("id_pessoa", "tipo_divida", "da_aberto", "situacao_cobranca", "valor_pago").cast("bigint"))).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = P.accessibility(P.taxpayer_profile(source.divida, source.notas)).agg(
        F.count(F.lit(1)), F.sum(F.hash("id_pessoa", "tipo_divida", "da_aberto", "situacao_cobranca", "valor_pago").cast("bigint"))).first()
    assert digest == expected


def test_left_joins_read_the_columns_they_need(spark, source):
    joined = J.left_renamed(source.dam, source.notas, "id_contribuinte", "id_pessoa").select("dam", "qtd_notas_2anos")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in plan and "l_discount" not in plan and "p_brand" not in plan


def test_attributes_in_conflict_give_one_taxpayer_row(spark):
    base = spark.createDataFrame(
        [(1, "imovel", 7, 0, 10, 5, 1, 0, "INAPTO", 1, 0), (2, "imovel", 7, 0, 20, 5, 2, 1, "ATIVO", 0, 1)],
        "cda int, tipo_divida string, id_pessoa int, da_aberto int, valor_tot int, valor_pago int, quantidade_reparcelamento int, "
        "edificacao int, situacao string, cpf_cnpj_existe int, endereco_existe int")
    rows = P.taxpayer_profile(base, spark.createDataFrame([], "id_pessoa int, qtd_notas_2anos int")).collect()
    assert len(rows) == 1
    assert (rows[0]["edificacao"], rows[0]["situacao"], rows[0]["cpf_cnpj_existe"], rows[0]["num_dist_cda"]) == (1, "ATIVO", 1, 2)


def test_zero_totals_count_as_one(spark):
    base = spark.createDataFrame([(1, "imovel", 7, 0, 0, 3), (2, "imovel", 7, 1, None, 0)],
                                 "cda int, tipo_divida string, id_pessoa int, da_aberto int, valor_tot int, valor_pago int")
    store = {r["cda"]: r["percentual_pago_cda"] for r in P.debt_store(base).collect()}
    assert store == {1: 1.0, 2: 0.0}


def test_weight_defaults_and_legacy(spark):
    stock = spark.createDataFrame([("a", 1, "BOM PAGADOR", 9.0), ("b", 3, "BOM PAGADOR", 9.0), ("c", None, None, None)],
                                  "cda string, frequencia_da_pessoa int, class_contribuinte_nome string, class_contribuinte_peso double")
    intended = {r["cda"]: (r["class_contribuinte_nome"], r["class_contribuinte_peso"]) for r in P.scoring_frame(stock).collect()}
    assert intended == {"a": ("PRIMEIRA DIVIDA", 3.79174), "b": ("BOM PAGADOR", 9.0), "c": ("PIOR PAGADOR", -1.37166)}
    legacy = {r["cda"]: r["class_contribuinte_peso"] for r in P.scoring_frame(stock, legacy=True).collect()}
    assert legacy == {"a": 9.0, "b": 9.0, "c": 0.0}


def test_overrides(spark):
    df = spark.createDataFrame([(0, 1, 0.5), (1, 15, 0.5), (1, 14, 0.5), (None, None, 0.5)], "status_situacao int, anos_idade_da int, igr double")
    assert [r["igr"] for r in P.score_overrides(df).collect()] == [0.0, 0.0, 0.5, 0.5]


def test_credit_recurrence_is_counted_before_years_are_cut(spark):
    history = spark.createDataFrame([(2015 + i, "t", 0, v, v, 1, 1, 2) for i, v in enumerate([5, 0, 7, 3])],
                                    "ano int, id_contribuinte string, pgt_cota_unica int, hist_valor_pago int, hist_valor_total int, num_imoveis int, reco_inscricao int, reco_debito int")
    out = {r["ano"]: (r["reco_credito"], r["hist_lancado"], r["reco_debito"]) for r in P.credit_history(history).collect()}
    assert out == {2017: (2, 12, 3), 2018: (3, 15, 3)}


def test_novelty(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("a", 4), ("b", 4), ("c", 4), (None, 4)], "k string, ano int")
    assert {r["ano"]: (r["total"], r["novos"]) for r in sets.cumulative_new(df, "k", "ano").collect()} == {1: (1, 1), 2: (2, 1), 4: (3, 1)}
    assert {r["ano"]: r["novos"] for r in sets.new_against_previous_year(df, "k", "ano").collect()} == {2: 1, 4: 3}
    assert [r["k"] for r in sets.new_keys(df, "k", "ano", 4, 2).collect()] == ["c"]


def test_lists_are_written_sorted_per_type_and_action(spark, source, tmp_path):
    from catalogue.scoring import open_rated
    from catalogue.stores import taxpayers

    lists = K.collection_lists(open_rated(source), source.divida, taxpayers(source))
    K.write_collection_lists(lists, str(tmp_path / "listas"))
    back = spark.read.parquet(str(tmp_path / "listas"))
    assert back.count() == lists.count()
    file = back.select(F.input_file_name()).first()[0]
    igr = [r["igr"] for r in spark.read.parquet(file).collect()]
    assert igr == sorted(igr, reverse=True)


def test_returning_and_new_bills_partition_the_year(spark, source):
    bills = R.sized(source.dam)
    new = R.new_property_bills(bills, 2001, 2000, one_per_property=False)
    assert new.count() + R.returning_property_bills(bills, 2001, 2000).count() == bills.where("ano_fato_gerador = 2001").count()


def test_column_types_follow_the_schema(source):
    from arrears.operators import quality

    found = [tuple(r) for r in quality.column_types(source.dam).orderBy("posicao").collect()]
    assert [(f[1], f[2]) for f in found] == [(f.name, f.dataType.simpleString()) for f in source.dam.schema]


def test_measures_of_a_hot_key_are_attached_by_a_split_join(spark):
    """A third of the rows under one key: the join that brings the group's measure back is cut into several tasks."""
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
               "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name, None) for name in options}
    try:
        for name, value in options.items():
            spark.conf.set(name, value)
        rows = spark.range(0, 60000, 1, 6).selectExpr("IF(id % 3 = 0, 7, id % 500) AS k", "id AS v", "uuid() AS text")
        found = J.attach_measures(rows, ["k"], F.sum("v").alias("total"))
        assert found.where("k = 7").agg(F.count_distinct("total")).first()[0] == 1
        found.write.format("noop").mode("overwrite").save()
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
