"""Extraction of certificates, debits, invoices and installments from the source star schema.

Every extraction is one join per dimension that contributes columns and one grouped aggregate. Dimensions that
contribute nothing are not joined: their keys are unique, so they cannot change a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.scalars import compose_key
from arrears.functions.semantics import present, total_if

LAUNCHED = ["vlr_lan_correcao", "vlr_lan_juros", "vlr_lan_multa", "vlr_lan_principal"]
# The published extraction adds launched interest twice.
LAUNCHED_AS_PUBLISHED = ["vlr_lan_correcao", "vlr_lan_juros", "vlr_lan_juros", "vlr_lan_multa", "vlr_lan_principal"]
COLLECTED = ["vlr_arr_correcao", "vlr_arr_juros", "vlr_arr_multa", "vlr_arr_principal", "vlr_arr_tsd"]


def _certificates(fact: DataFrame, kind: str, paid: Sequence[int], tributes: Sequence[int], person: list) -> DataFrame:
    settled = F.col("chave_dim_situacao_processo").isin(list(paid))
    tribute = F.col("chave_dim_tributo").isin(list(tributes))
    value = F.col("valor_total")
    return (
        fact.groupBy("termo_da_unico", "serie_da_cda")
        .agg(
            F.count("termo_da_unico").alias("deb_totais"),
            total_if(settled, F.lit(1)).alias("deb_pagos"),
            F.sum(value).alias("valor_tot"),
            total_if(tribute, value).alias("vlr_tributo"),
            total_if(~tribute, value).alias("vlr_taxa"),
            total_if(settled, value).alias("valor_pago"),
            F.max("chave_tempo_inscricao").alias("inscricao_divida"),
            *person,
            F.max(F.when(F.col("protestada") == "N", 0).otherwise(1)).alias("divida_protestada"),
            F.max(F.col("chave_tempo_ajuizamento").isNotNull().cast("int")).alias("divida_ajuizada"),
        )
        .withColumn("cda", compose_key(kind, "termo_da_unico", "serie_da_cda"))
        .withColumn("tipo_divida", F.lit(kind))
        .drop("termo_da_unico", "serie_da_cda")
    )


def property_certificates(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Certificates on real estate with the owner's status, building and id flags."""
    owner = dim.select(F.col("chave_dim_imovel").alias("_key"), "situacao_imovel", "natureza_imovel", "cpf_unico")
    joined = fact.join(owner, fact["chave_dim_imovel"] == F.col("_key"), "left")
    person = [
        F.max("_key").alias("id_pessoa"),
        F.max("situacao_imovel").alias("situacao"),
        F.max(F.when(F.col("natureza_imovel") == "T", 0).otherwise(1)).alias("edificacao"),
        F.max(F.col("cpf_unico").isNotNull().cast("int")).alias("cpf_existe"),
    ]
    return _certificates(joined, "imovel", fv.PROPERTY_PAID_STATUS, fv.PROPERTY_TRIBUTES, person)


def business_certificates(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Certificates on businesses; there is no building attribute."""
    owner = dim.select(F.col("chave_dim_merct").alias("_key"), "a04_situacao_mercantil", "cpf_unico")
    joined = fact.join(owner, fact["chave_dim_mercantil"] == F.col("_key"), "left")
    person = [
        F.max("_key").alias("id_pessoa"),
        F.max("a04_situacao_mercantil").alias("situacao"),
        F.max(F.col("cpf_unico").isNotNull().cast("int")).alias("cpf_existe"),
    ]
    return _certificates(joined, "mercantil", fv.BUSINESS_PAID_STATUS, fv.BUSINESS_TRIBUTES, person)


def _sum_of(columns: Sequence[str]):
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total


def _debits(debits: DataFrame, id_column: str, other_id: str, dim: DataFrame, dim_id: str, dim_key: str,
            cut: str, first_year: int, launched: Sequence[str], collected: Sequence[str]) -> DataFrame:
    overdue = F.col("dt_vencimento") < F.lit(cut).cast("timestamp_ntz")
    mine = debits.where(
        (F.year("dt_fat_gerador") >= first_year) & F.col(other_id).isNull() & F.col(id_column).isNotNull()
    )
    # Reduce to one row per unit before the dimension is looked up.
    per_unit = mine.groupBy(F.col(id_column).alias("_unit")).agg(
        F.count(F.lit(1)).alias("a"),
        F.sum(_sum_of(launched)).alias("b"),
        total_if(overdue, F.lit(1)).alias("c"),
        total_if(overdue, _sum_of(launched)).alias("d"),
        total_if(overdue, _sum_of(collected)).alias("e"),
    )
    units = dim.select(F.col(dim_id).alias("_unit"), F.col(dim_key).alias("id_pessoa"))
    return per_unit.join(units, "_unit").groupBy("id_pessoa").agg(
        F.sum("a").alias("total_creditos_lancados"),
        F.sum("b").alias("valor_lancado_creditos"),
        F.sum("c").alias("quantidade_debitos_adm"),
        F.sum("d").alias("valor_lancado_debitos"),
        F.sum("e").alias("valor_arrecadado_debitos"),
    )


def property_debits(debits: DataFrame, dim: DataFrame, cut: str = fv.DEBIT_CUT, first_year: int = fv.DEBIT_FIRST_YEAR,
                    launched: Sequence[str] = LAUNCHED, collected: Sequence[str] = COLLECTED) -> DataFrame:
    """Administrative credits and overdue debits of properties (rows without a business id)."""
    return _debits(debits, "seq_imovel_unico", "inscr_mercantil_unico", dim, "seq_imovel_unico", "chave_dim_imovel",
                   cut, first_year, launched, collected)


def business_debits(debits: DataFrame, dim: DataFrame, cut: str = fv.DEBIT_CUT, first_year: int = fv.DEBIT_FIRST_YEAR,
                    launched: Sequence[str] = LAUNCHED, collected: Sequence[str] = COLLECTED) -> DataFrame:
    """The same for businesses (rows without a property id)."""
    return _debits(debits, "inscr_mercantil_unico", "seq_imovel_unico", dim, "insc_merct_unico", "chave_dim_merct",
                   cut, first_year, launched, collected)


def invoices_per_taxpayer(invoices: DataFrame, dim: DataFrame, after_year: int = fv.INVOICE_AFTER_YEAR) -> DataFrame:
    counted = (
        present(invoices.where(F.col("ano") > after_year), "inscr_merc_pres_uni")
        .groupBy(F.col("inscr_merc_pres_uni").alias("insc_merct_unico")).agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counted.join(dim.select("insc_merct_unico", "chave_dim_merct"), "insc_merct_unico")
        .groupBy(F.col("chave_dim_merct").alias("id_pessoa")).agg(F.sum("n").alias("qtd_notas_2anos"))
    )


def installments(plan: DataFrame) -> DataFrame:
    """Installment plans per certificate; the protest and lawsuit flags are part of the grain."""
    business = F.col("adimovsequ").isNull()
    grouped = (
        present(plan, "termo_da_unico")
        .withColumn("divida_protestada", F.when(F.col("fpropaprot") == "NAO", 0).otherwise(1))
        .withColumn("divida_ajuizada", F.col("dt_ajuizamento").isNotNull().cast("int"))
        .groupBy("termo_da_unico", "cterdiseri", "adimovsequ", "divida_protestada", "divida_ajuizada")
        .agg(
            F.max("admercsequ").alias("_business"),
            F.sum("vl_lanc_principal").alias("valor_tot"),
            F.sum("vl_arr_principal").alias("valor_pago"),
            F.max(F.year("dt_parcelamento")).alias("ano_inscricao_da"),
            F.max("qtd_reparcelamentos").alias("quantidade_reparcelamentos"),
        )
    )
    return grouped.select(
        F.when(business, compose_key("mercantil", "termo_da_unico", "cterdiseri"))
        .otherwise(compose_key("imovel", "termo_da_unico", "cterdiseri")).alias("cda"),
        F.when(business, F.col("_business")).otherwise(F.col("adimovsequ")).alias("id_pessoa"),
        F.when(business, F.lit("mercantil")).otherwise(F.lit("imovel")).alias("tipo_divida"),
        "valor_tot", "valor_pago", "divida_protestada", "divida_ajuizada", "ano_inscricao_da",
        "quantidade_reparcelamentos",
    )


def time_dictionary(dim_time: DataFrame) -> DataFrame:
    return dim_time.select("chave_tempo", F.to_date("data").alias("date"))


def with_date(df: DataFrame, dates: DataFrame, key: str, name: str) -> DataFrame:
    """Date of a time key; unknown keys stay without a date.

    A calendar has one row per day, so the planner's own size check turns this into a broadcast.
    """
    lookup = dates.select(F.col("chave_tempo").alias("_key"), F.col("date").alias(name))
    return df.join(lookup, df[key] == F.col("_key"), "left").drop("_key")


def certificate_owners(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct certificate × property × kind of owner."""
    owners = dim.where(F.col("tipo_propriedade_resp").isNotNull()).select("chave_dim_imovel", "tipo_propriedade_resp")
    pairs = fact.select("termo_da_unico", "chave_dim_imovel").distinct()
    return pairs.join(owners, "chave_dim_imovel").distinct()
