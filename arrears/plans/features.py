"""Taxpayer, debt and credit feature stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arrears.functions import fixed_values as fv
from arrears.functions import scalars as S
from arrears.functions.semantics import (
    capped, guarded, keep_first, last_wins, present, ratio, round_even, sum0,
)
from arrears.operators.cleaning import fill_everything, fill_nulls, typed_key, union_all
from arrears.operators.extract import with_date
from arrears.operators.joins import Conservation, left_join, left_renamed
from arrears.operators.quantiles import exact_quantiles
from arrears.operators.windows import credit_recurrence, cumulative

CERTIFICATE = ["cda", "tipo_divida", "id_pessoa"]
PARTITIONED = [*CERTIFICATE, "da_aberto"]
TAXPAYER = ["id_pessoa", "tipo_divida", "da_aberto"]
CLUSTER_FEATURES = ["situacao_cobranca", "num_dist_cda", "quantidade_reparcelamento", "historico_pagamento_em_valor"]


def certificate_totals(base: DataFrame, keys: list[str] = CERTIFICATE) -> DataFrame:
    """Billed, paid, still open, expected minus paid, and the loss, per certificate in one grouping."""
    is_open = F.col("da_aberto") == 1
    balance = F.coalesce(F.col("valor_tot"), F.lit(0)) - F.coalesce(F.col("valor_pago"), F.lit(0))
    return (
        present(base, *keys).groupBy(*keys)
        .agg(sum0("valor_tot").alias("valor_tot"), sum0("valor_pago").alias("valor_pago"),
             F.sum(F.when(is_open, balance)).alias("valor_aberto"))
        .withColumn("dif_tot_pago", F.col("valor_tot") - F.col("valor_pago"))
        .withColumn("dif_tot_pago_aberto", round_even(F.col("dif_tot_pago") - F.col("valor_aberto"), 5))
    )


def certificate_detail(base: DataFrame) -> DataFrame:
    """Certificate attributes with the totals of their own partition and the paid ratio, from one exchange.

    A certificate has few rows in a partition, so its totals are window sums.
    """
    own = Window.partitionBy(*PARTITIONED)
    billed, paid = (F.coalesce(F.sum(c).over(own), F.lit(0)) for c in ("valor_tot", "valor_pago"))
    balance = F.coalesce(F.col("valor_tot"), F.lit(0)) - F.coalesce(F.col("valor_pago"), F.lit(0))
    still_open = F.sum(F.when(F.col("da_aberto") == 1, balance)).over(own)
    return present(base, *PARTITIONED).withColumns(
        {"valor_tot": guarded(billed), "valor_pago": paid, "valor_aberto": still_open}
    ).withColumn("perc_pago", round_even(ratio("valor_pago", "valor_tot"), 5))


def debt_store(base: DataFrame) -> DataFrame:
    """Debt features, second generation: totals per partition and the capped paid ratio as target."""
    detail = certificate_detail(base).drop("perc_pago").withColumnRenamed("valor_tot", "valor_total_da")
    return detail.withColumn("percentual_pago_cda", capped(ratio("valor_pago", "valor_total_da")))


def taxpayer_profile(base: DataFrame, invoices: DataFrame) -> DataFrame:
    """One row per taxpayer, debt type and partition.

    Conflicting attributes resolve to one value (largest flag, smallest status), so the join to invoices and every
    later join on this key keeps one row.
    """
    grouped = present(base, *TAXPAYER).groupBy(*TAXPAYER).agg(
        F.count_distinct("cda").alias("num_dist_cda"),
        sum0("quantidade_reparcelamento").alias("quantidade_reparcelamento"),
        sum0("valor_tot").alias("valor_tot"), sum0("valor_pago").alias("valor_pago"),
        F.max("edificacao").alias("edificacao"), F.min("situacao").alias("situacao"),
        F.max("cpf_cnpj_existe").alias("cpf_cnpj_existe"), F.max("endereco_existe").alias("endereco_existe"),
    )
    return grouped.join(_one_invoice_row(invoices), "id_pessoa", "left")


def _one_invoice_row(invoices: DataFrame) -> DataFrame:
    return present(invoices, "id_pessoa").groupBy("id_pessoa").agg(F.max("qtd_notas_2anos").alias("qtd_notas_2anos"))


def accessibility(profile: DataFrame) -> DataFrame:
    """Accessibility profile, score and label, and the payment history by value."""
    filled = fill_nulls(profile, {"qtd_notas_2anos": 0, "edificacao": 0, "cpf_cnpj_existe": 0})
    return (
        filled.withColumn("perfil_acessivel", S.accessibility_profile())
        .withColumn("situacao_cobranca", S.accessibility_score())
        .withColumn("class_situacao_cobranca", S.accessibility_label())
        .withColumn("valor_tot", guarded("valor_tot"))
        .withColumn("historico_pagamento_em_valor", ratio("valor_pago", "valor_tot"))
    )


def training_slice(taxpayers: DataFrame) -> DataFrame:
    """Cluster features of closed-partition taxpayers with more than one certificate."""
    chosen = taxpayers.where((F.col("da_aberto") == 0) & (F.col("num_dist_cda") > 1))
    return chosen.select("id_pessoa", "tipo_divida", *CLUSTER_FEATURES)


def scoring_slice(taxpayers: DataFrame) -> DataFrame:
    """Cluster features of all open-partition taxpayers; single-certificate ones are relabelled later."""
    return taxpayers.where(F.col("da_aberto") == 1).select("id_pessoa", "tipo_divida", *CLUSTER_FEATURES)


def active_status(invoices: str = "qtd_notas_2anos"):
    """1 when the register says active or invoices prove activity."""
    active = F.col("situacao").eqNullSafe("ATIVO")
    return last_wins([(active, 1), ((F.col(invoices) > 0) & ~active, 1)], otherwise=0)


def weighted_status():
    total = F.col("situacao_ativa") + F.col("cpf_existe") + F.col("edificacao")
    return last_wins([(F.col("situacao_ativa") == 0, 0)], otherwise=total)


def taxpayer_store_v1(properties: DataFrame, businesses: DataFrame, invoices: DataFrame) -> DataFrame:
    """Taxpayer features, first generation: totals and histories per person over both debt types.

    The certificate-level columns are those of the person's first certificate by key.
    """
    base = typed_key(union_all(properties, businesses), "id_pessoa")
    own = ["situacao", "cpf_existe", "edificacao", "deb_totais", "deb_pagos", "valor_tot", "valor_pago"]
    people = base.groupBy("id_pessoa").agg(
        F.min_by(F.struct(*own), F.struct("cda", *own)).alias("_own"),
        F.count("cda").alias("frequencia_da_pessoa"),
        sum0("deb_totais").alias("total_debitos_pessoa"), sum0("deb_pagos").alias("debitos_pagos_pessoa"),
        sum0("valor_tot").alias("valor_total_pessoa"), sum0("valor_pago").alias("valor_pago_pessoa"),
    )
    joined = people.join(_one_invoice_row(invoices), "id_pessoa", "left")
    flat = joined.select("*", "_own.*").drop("_own")
    return (
        fill_nulls(flat, {"edificacao": 1, "qtd_notas_2anos": 0})
        .withColumn("situacao_ativa", active_status())
        .withColumn("status_situacao", weighted_status())
        .withColumn("historico_pagamento_em_qtd", ratio("debitos_pagos_pessoa", "total_debitos_pessoa") + 1)
        .withColumn("historico_pagamento_em_valor", ratio("valor_pago_pessoa", "valor_total_pessoa") + 1)
    )


def with_class_labels_v1(df: DataFrame) -> DataFrame:
    """First-debt class, class name and weight; ``class_contribuinte`` holds the classifier's answer."""
    klass = last_wins([(F.col("frequencia_da_pessoa") == 1, fv.FIRST_DEBT_CLASS_V1)],
                      otherwise=F.col("class_contribuinte").cast("int"))
    names = {number: name for number, name, _ in fv.CLASSES_V1}
    weights = {number: weight for number, _, weight in fv.CLASSES_V1}
    return (
        df.withColumn("class_contribuinte", klass)
        .withColumn("class_contribuinte_nome", S.code_map("class_contribuinte", names))
        .withColumn("class_contribuinte_peso", S.code_map("class_contribuinte", weights))
    )


def installment_rates(parcels: DataFrame) -> DataFrame:
    """One row per certificate: re-instalments and the paid rate of its installments."""
    kind = F.when(F.col("id_imovel").isNull(), F.lit("mercantil")).otherwise(F.lit("imovel"))
    rated = present(parcels, "cda").select(
        S.compose_key_strict(kind, "cda").alias("cda"), "quantidade_reparcelamentos",
        ratio("total_valor_pago", "valor_lancado_total").alias("parcela_taxa_pagamento_valor"),
    )
    return keep_first(rated, ["cda"], ["quantidade_reparcelamentos", "parcela_taxa_pagamento_valor"], nearly_unique=True)


def debt_store_v1(properties: DataFrame, businesses: DataFrame, dates: DataFrame, parcels: DataFrame, reference_year: int) -> DataFrame:
    """Debt features, first generation: one row per certificate with age, target and installments."""
    optional = [c for c in ["tipo_tributo"] if c in properties.columns]
    columns = ["cda", "id_pessoa", "tipo_divida", "valor_tot", "valor_pago", *optional,
               "divida_protestada", "divida_ajuizada", "inscricao_divida"]
    base = union_all(properties, businesses).select(*columns)
    single = typed_key(keep_first(base, ["cda"], ["tipo_divida", "id_pessoa", "inscricao_divida"], nearly_unique=True), "id_pessoa")
    dated = with_date(single, dates, "inscricao_divida", "data_inscricao_da")
    debts = (
        dated.withColumn("ano_inscricao_da", F.year("data_inscricao_da"))
        .withColumn("anos_idade_da", S.age_in_years(F.col("ano_inscricao_da"), reference_year))
        .withColumnsRenamed({"valor_tot": "valor_total_da", "tipo_tributo": "tipo_tributo_da"})
        .withColumn("percentual_pago_cda", ratio("valor_pago", "valor_total_da"))
        .drop("inscricao_divida", "data_inscricao_da")
    )
    return debts.join(installment_rates(parcels), "cda", "left")


def debt_store_v15(base: DataFrame, reference_year: int) -> DataFrame:
    """Debt features, intermediate generation: sums, largest flags and age per certificate, one grouping."""
    single = keep_first(
        base.select("cda", "id_pessoa", "tipo_divida", "valor_tot", "valor_pago", "protesto", "divida_ajuizada",
                    S.parsed_year("inscricao_divida").alias("ano_inscricao_da")),
        ["cda"], ["tipo_divida", "id_pessoa", "ano_inscricao_da"], nearly_unique=True)
    return (
        present(single, "id_pessoa").withColumn("id_pessoa", F.col("id_pessoa").cast("string"))
        .groupBy("cda", "id_pessoa", "tipo_divida")
        .agg(sum0("valor_tot").alias("valor_total_da"), sum0("valor_pago").alias("valor_pago"),
             F.max("protesto").alias("protesto"), F.max("divida_ajuizada").alias("divida_ajuizada"),
             F.max("ano_inscricao_da").alias("ano_inscricao_da"))
        .withColumn("anos_idade_da", S.age_in_years(F.col("ano_inscricao_da"), reference_year))
        .withColumn("percentual_pago_cda", ratio("valor_pago", "valor_total_da"))
    )


TAXPAYER_FEATURES_V1 = ["frequencia_da_pessoa", "historico_pagamento_em_qtd", "status_situacao",
                        "historico_pagamento_em_valor", "class_contribuinte_peso"]
FEATURES_V1 = ["valor_total_da", "anos_idade_da", "quantidade_reparcelamentos", "frequencia_da_pessoa",
               "historico_pagamento_em_qtd", "status_situacao", "historico_pagamento_em_valor", "class_contribuinte_peso"]
FEATURES_V2 = ["valor_total_da", "idade_divida", "quantidade_reparcelamento", "num_dist_cda", "situacao_cobranca",
               "historico_pagamento_em_valor", "class_contribuinte_peso"]
TARGET = "percentual_pago_cda"


def training_frame_v1(debts: DataFrame, taxpayers: DataFrame, age_limit: int = fv.TRAINING_AGE_LIMIT) -> DataFrame:
    """Recent debts with their taxpayer's features; keys stay for the split and are not features."""
    recent = debts.where(F.col("anos_idade_da") < age_limit).select(
        "cda", "id_pessoa", TARGET, "valor_total_da", "anos_idade_da", "quantidade_reparcelamentos")
    people = taxpayers.select("id_pessoa", *TAXPAYER_FEATURES_V1)
    return fill_nulls(recent.join(people, "id_pessoa"), {"quantidade_reparcelamentos": 0})


def training_frame(debts: DataFrame, taxpayers: DataFrame, age_limit: int = fv.TRAINING_AGE_LIMIT,
                   watch: Conservation | None = None) -> DataFrame:
    """Closed recent debts, second generation, with closed-partition taxpayer features.

    ``watch`` observes the debts before and behind the join, which must neither lose nor repeat any.
    """
    recent = debts.where((F.col("da_aberto") == 0) & (F.col("idade_divida") < age_limit)).select(
        *PARTITIONED, TARGET, "valor_total_da", "idade_divida")
    people = fill_nulls(taxpayers.where(F.col("da_aberto") == 0).select(
        "id_pessoa", "tipo_divida", "num_dist_cda", "quantidade_reparcelamento", "historico_pagamento_em_valor",
        "situacao_cobranca", "class_contribuinte_peso"), {"quantidade_reparcelamento": 0})
    if watch is None:
        return left_join(recent, people, ["id_pessoa", "tipo_divida"])
    return watch.leave(left_join(watch.enter(recent), people, ["id_pessoa", "tipo_divida"]))


def first_debt_floor(taxpayers: DataFrame, good: str = "DEVEDOR BOM", level: float = 0.75) -> DataFrame:
    """First debtors get at least the history that three quarters of the good payers stay below."""
    reference = exact_quantiles(taxpayers.where(F.col("class_contribuinte_nome") == good), "historico_pagamento_em_valor", [level])
    row = reference.first()  # one number
    floor = F.lit(row["q0"] if row else None).cast("double")
    history = F.col("historico_pagamento_em_valor")
    raised = F.when((F.col("num_dist_cda") == 1) & (history < floor), floor).otherwise(history)
    return taxpayers.withColumn("historico_pagamento_em_valor", raised)


def stock_frame(stock: DataFrame, parcels: DataFrame, taxpayers: DataFrame, reference_year: int) -> DataFrame:
    """Open certificates with age, re-instalments and first-generation taxpayer features."""
    dated = typed_key(stock, "id_contribuinte").withColumn("ano_inscricao_da", S.parsed_year("inscricao_divida"))
    debts = dated.withColumn("anos_idade_da", S.age_in_years(F.col("ano_inscricao_da"), reference_year)).withColumnsRenamed(
        {"valor_tot": "valor_total_da", "tipo_tributo": "tipo_tributo_da"})
    rates = installment_rates(parcels).select("cda", "quantidade_reparcelamentos")
    with_parcels = debts.join(rates, "cda", "left")
    return left_renamed(with_parcels, taxpayers, "id_contribuinte", "id_pessoa")


def scoring_frame(stock: DataFrame, legacy: bool = False, worst: float = fv.WORST_WEIGHT_V1, first: float = fv.FIRST_DEBT_WEIGHT_V1) -> DataFrame:
    """Defaults for unknown taxpayers, then zero for everything still missing.

    ``legacy`` reproduces runs in which the weight defaults never took effect and missing weights became 0.
    """
    name, weight = F.col("class_contribuinte_nome"), F.col("class_contribuinte_peso")
    if legacy:
        named = stock.withColumn("class_contribuinte_nome", F.coalesce(name, F.lit(fv.WORST_CLASS_V1)))
        return fill_everything(named)
    named = stock.withColumn("class_contribuinte_nome", F.coalesce(
        last_wins([(F.col("frequencia_da_pessoa") <= 1, fv.FIRST_DEBT_NAME)], otherwise=name), F.lit(fv.WORST_CLASS_V1)))
    weighted = named.withColumn("class_contribuinte_peso", last_wins(
        [(F.col("class_contribuinte_nome") == fv.FIRST_DEBT_NAME, first),
         (F.col("class_contribuinte_nome") == fv.WORST_CLASS_V1, worst)], otherwise=weight))
    return fill_everything(weighted)


def score_overrides(df: DataFrame, status: str = "status_situacao", age: str = "anos_idade_da", index: str = "igr") -> DataFrame:
    """No recovery from unreachable debtors or old debts."""
    return df.withColumn(index, last_wins(
        [(F.col(status) == 0, 0.0), (F.col(age) >= fv.AGE_WITHOUT_RECOVERY, 0.0)], otherwise=F.col(index)))


def credit_history(history: DataFrame, first_year: int = fv.CREDIT_FIRST_YEAR) -> DataFrame:
    """Taxpayer-year features: running totals and recurrences, computed before early years are cut."""
    summed = cumulative(history, "id_contribuinte", "ano", {
        "pgt_cota_unica": "hist_cota_unica", "hist_valor_pago": "hist_pagamento", "hist_valor_total": "hist_lancado"})
    marked = credit_recurrence(summed, "id_contribuinte", "ano", "hist_valor_total", "reco_credito")
    return marked.withColumn("reco_debito", F.col("reco_debito") + F.col("reco_inscricao")).where(F.col("ano") >= first_year)


def credit_store(bills: DataFrame, history: DataFrame, first_year: int = fv.CREDIT_FIRST_YEAR) -> DataFrame:
    """Bills of known taxpayers with the taxpayer's history of the same year and the paid ratio as target."""
    known = present(bills, "id_contribuinte").select(
        "dam", "id_imovel", "id_contribuinte", F.col("ano_fato_gerador").alias("ano"), "idade_imovel", "area_construida",
        "tipo_propriedade", "bairro", "vlr_aberto", "vlr_pago", (F.col("vlr_aberto") + F.col("vlr_pago")).alias("vlr_lancado"),
    ).where(F.col("ano") >= first_year)
    filled = fill_nulls(known, {"area_construida": 0, "idade_imovel": 0, "tipo_propriedade": fv.LAND_TYPE,
                                "bairro": fv.UNKNOWN_NEIGHBOURHOOD})
    features = credit_history(history, first_year).drop("hist_valor_pago", "hist_valor_total")
    return (
        filled.withColumn("aberto", S.open_flag("vlr_lancado", "vlr_pago"))
        .join(features, ["id_contribuinte", "ano"])
        .withColumn("percentual_pago", F.coalesce(ratio("vlr_pago", "vlr_lancado"), F.lit(0.0)))
    )


def taxpayer_years(history: DataFrame, first_year: int = fv.CREDIT_FIRST_YEAR) -> DataFrame:
    """Totals per taxpayer over the years and the paid percentage."""
    sums = ["hist_valor_pago", "pgt_cota_unica", "hist_valor_total", "num_imoveis", "reco_credito", "reco_debito", "reco_inscricao"]
    grouped = credit_history(history, first_year).groupBy("id_contribuinte").agg(*[sum0(c).alias(c) for c in sums])
    return grouped.withColumn("percentual_pago", F.coalesce(ratio("hist_valor_pago", "hist_valor_total") * 100, F.lit(0.0)))


def year_slices(store: DataFrame, training_before: int) -> dict[str, DataFrame]:
    """Training years, the last training year, the scoring year, and the last two together."""
    year = F.col("ano")
    return {
        "treino": store.where(year < training_before),
        "ultimo": store.where(year == training_before - 1),
        "escore": store.where(year == training_before),
        "recentes": store.where(year > training_before - 2),
    }
