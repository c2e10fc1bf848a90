"""Property-tax reports: cohorts, behaviour by size, neighbourhoods and years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import scalars as S
from arrears.functions.semantics import keep_first, percent, present, ratio, sum0
from arrears.operators.aggregates import entity_rollup, paid_share_and_opportunity
from arrears.operators.joins import anti

ROLLUP = ["idade_imovel", "tamanho_imovel", "natureza_imovel", "bairro", "tipo_propriedade", "tipo_contribuinte"]


def sized(bills: DataFrame) -> DataFrame:
    return bills.withColumn("tamanho_imovel", S.size_class())


def new_property_bills(bills: DataFrame, current: int, previous: int, one_per_property: bool = True,
                       order: Sequence[str] = ("dam", "id_contribuinte")) -> DataFrame:
    """Bills of properties that the previous year did not bill; by default one bill each."""
    year = F.col("ano_fato_gerador")
    now = present(bills.where(year == current), "id_imovel")
    if one_per_property:
        now = keep_first(now, ["id_imovel"], list(order))
    return anti(now, bills.where(year == previous), ["id_imovel"])


def returning_property_bills(bills: DataFrame, current: int, previous: int) -> DataFrame:
    """Bills of the current year whose property was billed the year before."""
    year = F.col("ano_fato_gerador")
    return anti(bills.where(year == current), new_property_bills(bills, current, previous), ["id_imovel"])


def cohort(bills: DataFrame) -> DataFrame:
    """Property × taxpayer with money, first attributes, amount due and paid percentage."""
    rolled = entity_rollup(bills, ["id_imovel", "id_contribuinte"], ["vlr_aberto", "vlr_pago"],
                           [c for c in ROLLUP if c in bills.columns], ["ano_fato_gerador", "dam"])
    due = F.col("vlr_aberto") + F.col("vlr_pago")
    return rolled.withColumn("valor_total_devido", due).withColumn("percentual_pago", percent("vlr_pago", due))


def paying_universe(rolled: DataFrame) -> DataFrame:
    """Entities without an open balance, per property type."""
    paid = rolled.where(F.col("vlr_aberto") == 0)
    return present(paid, "tipo_propriedade").groupBy("tipo_propriedade").agg(
        F.count(F.lit(1)).alias("quantidade"), sum0("vlr_pago").alias("vlr_pago"))


def behaviour_by_size(bills: DataFrame, by: Sequence[str] = ("tipo_contribuinte", "tamanho_imovel")) -> DataFrame:
    """Open, paid, properties, average open ticket and paid percentage per kind of owner and size."""
    grouped = present(bills, *by).groupBy(*by).agg(
        sum0("vlr_aberto").alias("vlr_aberto"), sum0("vlr_pago").alias("vlr_pago"),
        F.count_distinct("id_imovel").alias("imoveis"))
    return grouped.withColumn("ticket_medio", ratio("vlr_aberto", "imoveis")).withColumn(
        "percentual_pago", percent("vlr_pago", F.col("vlr_pago") + F.col("vlr_aberto")))


def returning_by_type(bills: DataFrame, current: int, previous: int) -> DataFrame:
    return paid_share_and_opportunity(returning_property_bills(bills, current, previous), "tipo_propriedade")


def neighbourhood_ranking(bills: DataFrame, factor: float, by: str = "bairro") -> DataFrame:
    """Properties with an open balance, the balance and the part of it expected back, largest first."""
    grouped = present(bills.where(F.col("vlr_aberto") > 0), by).groupBy(by).agg(
        F.count_distinct("id_imovel").alias("quantidade_id_imovel"), F.sum("vlr_aberto").alias("soma_vlr_aberto"))
    expected = F.col("soma_vlr_aberto").cast("double") * F.lit(factor)
    return grouped.withColumn("pode_ser_pago", expected).orderBy(F.col("soma_vlr_aberto").desc(), by)


def below_average(bills: DataFrame, by: str = "bairro") -> DataFrame:
    """Neighbourhoods whose paid percentage is below that of all bills."""
    sums = [F.sum("vlr_aberto").alias("vlr_aberto"), F.sum("vlr_pago").alias("vlr_pago")]
    share = percent("vlr_pago", F.col("vlr_aberto") + F.col("vlr_pago"))
    grouped = present(bills, by).groupBy(by).agg(*sums)
    overall = grouped.agg(F.sum("vlr_aberto").alias("vlr_aberto"), F.sum("vlr_pago").alias("vlr_pago")).select(share.alias("s")).scalar()
    rated = grouped.withColumn("percentual_pago", share).withColumn("media_geral", overall)
    return rated.where(F.col("percentual_pago") < F.col("media_geral"))


def year_totals(bills: DataFrame, by: str = "ano_fato_gerador") -> DataFrame:
    grouped = present(bills, by).groupBy(by).agg(sum0("vlr_aberto").alias("vlr_aberto"), sum0("vlr_pago").alias("vlr_pago"))
    due = F.col("vlr_aberto") + F.col("vlr_pago")
    return grouped.withColumn("valor_devido", due).withColumn("percentual_pago", percent("vlr_pago", due))
