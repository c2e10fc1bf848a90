"""Rated stock, collection lists and class reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.bands import band_frequency, label_table
from arrears.functions.ratings import collection_action
from arrears.functions.semantics import capped, differs, present, ratio, round_even
from arrears.operators.joins import left_join
from arrears.operators.aggregates import crosstab, share_of_total

FULL_KEY = ["cda", "tipo_divida", "id_pessoa", "da_aberto"]


def rating_summary(rated: DataFrame) -> DataFrame:
    """Certificates and money per rating with their shares, in rating order."""
    grouped = present(rated, "rating_divida").groupBy("rating_divida").agg(
        F.count_distinct("cda").alias("cda"), F.sum("valor_total_da").alias("valor_total_da"))
    totals = grouped.agg(F.struct(F.sum("cda").alias("c"), F.sum("valor_total_da").alias("v")).alias("t")).scalar()
    return (
        grouped.withColumn("total_cda", totals.getField("c")).withColumn("total_vlr_tot_da", totals.getField("v"))
        .withColumn("perc_cda", round_even(ratio("cda", "total_cda"), 4))
        .withColumn("perc_vlr_tot_da", round_even(ratio("valor_total_da", "total_vlr_tot_da"), 4))
        .join(label_table(rated.sparkSession, fv.RATING_ORDER, "rating_divida", "ordem_rating"), "rating_divida")
        .orderBy("ordem_rating")
    )


def compare_ratings(df: DataFrame, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """Certificates rated differently by two columns, and the contingency table of both."""
    different = df.where(differs(first, F.col(second)))
    return different, crosstab(df, first, second, fv.RATING_ORDER)


def collection_lists(rated: DataFrame, base: DataFrame, taxpayers: DataFrame) -> DataFrame:
    """Debts to act on, with the action: open, neither sued nor protested, young and well rated.

    All filters sit on the inputs, so only candidates are shuffled. Written partitioned by debt type and action,
    sorted by falling index inside each.
    """
    candidates = rated.where(
        (F.col("da_aberto") == 1) & F.col("idade_divida").between(0, fv.COLLECTION_MAX_AGE)
        & F.col("rating_divida").isin(fv.COLLECTION_RATINGS)
    ).withColumn("acao", collection_action()).where(F.col("acao").isNotNull())
    clear = base.where((F.col("ajuizamento") == 0) & (F.col("protesto") == 0) & (F.col("da_aberto") == 1))
    attributes = [c for c in ["atividade_principal", "situacao", "vlr_tributo", "vlr_taxa", "edificacao",
                              "cpf_cnpj_existe", "endereco_existe"] if c in base.columns]
    joined = present(candidates, *FULL_KEY).join(clear.select(*FULL_KEY, *attributes), FULL_KEY)
    invoices = taxpayers.where(F.col("da_aberto") == 1).select("id_pessoa", "tipo_divida", "qtd_notas_2anos")
    complete = left_join(joined, invoices, ["id_pessoa", "tipo_divida"])
    listed = [c for c in fv.COLLECTION_COLUMNS if c in complete.columns]
    return complete.select("tipo_divida", "acao", *listed)


def write_collection_lists(lists: DataFrame, folder: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per debt type and action, each file sorted by falling index.

    Ranges over type, action, index and key cut a large list into several ordered files, also where many debts
    share one index.
    """
    order = ["tipo_divida", "acao", F.desc("igr"), "cda", "id_pessoa"]
    (
        lists.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        .partitionBy("tipo_divida", "acao").parquet(folder)
    )


def class_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fv.CLASSES_V2, "class_contribuinte int, class_contribuinte_nome string, class_contribuinte_perfil string")


def class_distribution(taxpayers: DataFrame) -> DataFrame:
    """Taxpayers per class overall, closed and open, with their shares; one grouping feeds all three."""
    name = "class_contribuinte_nome"
    per = present(taxpayers, name).groupBy("da_aberto", name).agg(F.count("id_pessoa").alias("_n"))
    own = F.when(F.col("da_aberto") == 0, F.lit("fechada")).when(F.col("da_aberto") == 1, F.lit("aberta"))
    parts = per.select(F.explode(F.array(F.lit("todas"), own)).alias("parte"), name, "_n").where(F.col("parte").isNotNull())
    counted = parts.groupBy("parte", name).agg(F.sum("_n").alias("pessoas"))
    totals = counted.groupBy("parte").agg(F.sum("pessoas").alias("total_pessoas"))
    return counted.join(totals, "parte").withColumn("perc_pessoas", round_even(ratio("pessoas", "total_pessoas"), 5))


def first_debtors(taxpayers: DataFrame) -> DataFrame:
    """Closed-partition taxpayers with one certificate, history capped at 1."""
    single = taxpayers.where((F.col("da_aberto") == 0) & (F.col("num_dist_cda") == 1))
    return single.withColumn("historico_pagamento_em_valor", capped("historico_pagamento_em_valor"))


def first_debt_accessibility(taxpayers: DataFrame) -> DataFrame:
    return share_of_total(first_debtors(taxpayers), "situacao_cobranca", F.count_distinct("id_pessoa"), "pessoas")


def first_debt_bands(taxpayers: DataFrame) -> DataFrame:
    return band_frequency(first_debtors(taxpayers), "historico_pagamento_em_valor", fv.PAID_RATIO_EDGES)


def first_debt_means(taxpayers: DataFrame) -> DataFrame:
    means = ["situacao_cobranca", "num_dist_cda", "quantidade_reparcelamento", "historico_pagamento_em_valor"]
    return first_debtors(taxpayers).agg(*[F.avg(c).alias(c) for c in means])


def dual_type_taxpayers(base: DataFrame) -> DataFrame:
    """Certificates and money per type of the taxpayers that owe both types."""
    closed = present(base.where(F.col("da_aberto") == 0), "id_pessoa", "tipo_divida")
    per_type = closed.groupBy("id_pessoa", "tipo_divida").agg(
        F.count_distinct("cda").alias("cda"), F.sum("valor_tot").alias("valor_tot"))
    people = closed.groupBy("id_pessoa").agg(
        F.count_distinct("tipo_divida").alias("_types"), F.count_distinct("cda").alias("num_dist_cda"))
    return per_type.join(people.where(F.col("_types") > 1).drop("_types"), "id_pessoa")


def dual_type_classes(taxpayers: DataFrame, names: list[str]) -> DataFrame:
    """Class as property owner against class as business, for taxpayers that have both."""
    closed = present(taxpayers.where(F.col("da_aberto") == 0), "id_pessoa")
    def klass(kind):
        return F.max(F.when(F.col("tipo_divida") == kind, F.col("class_contribuinte_nome")))

    both = closed.groupBy("id_pessoa").agg(klass("imovel").alias("imovel"), klass("mercantil").alias("mercantil"))
    return crosstab(both, "imovel", "mercantil", names)
