"""Data-quality profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.semantics import percent, present


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column with their percentage: one aggregate over the table."""
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot(["_total"], df.columns, "coluna", "nulos")
    return long.select("coluna", "nulos", F.col("_total").alias("total"), percent("nulos", "_total").alias("percentual"))


def null_subset(df: DataFrame, missing: str, by: str, entity: str) -> DataFrame:
    """Entities of the rows in which a column is missing, per group, with their share of all such entities."""
    subset = df.where(F.col(missing).isNull())
    total = subset.agg(F.count_distinct(entity)).scalar()
    grouped = present(subset, by).groupBy(by).agg(F.count_distinct(entity).alias("entidades"))
    return grouped.withColumn("percentual", percent("entidades", total))


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each consistency rule."""
    wide = df.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    return wide.unpivot([], list(rules), "regra", "linhas")


def bill_rules() -> dict[str, Column]:
    paid, billed, still_open = F.col("vlr_pago"), F.col("vlr_total_dam"), F.col("vlr_aberto")
    partial = (paid > 0) & (paid < billed)
    return {
        "nao_paga_sem_aberto": (paid == 0) & (billed > 0) & (still_open == 0),
        "parcial_sem_aberto": partial & (billed > 0) & (still_open == 0),
        "nao_paga_lancado_difere_aberto": (paid == 0) & (billed != still_open),
        "lancado_difere_soma": billed != paid + still_open,
    }


def history_rules() -> dict[str, Column]:
    return {"divida_maior_que_debito": F.col("reco_inscricao") > F.col("reco_debito")}


def partition_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("linhas"))


def column_types(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "posicao int, coluna string, tipo string, nulavel boolean")
