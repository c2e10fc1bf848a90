"""Extraction queries."""

from arrears.operators import extract as X
from catalogue.registry import query


def _certificate_sql(kind: str, fact: str, dim: str, key: str, dim_key: str, paid: str, tributes: str, person: str) -> str:
    return f"""
WITH marked AS (
  SELECT termo_da_unico AS term, serie_da_cda AS series, {key} AS owner, valor_total AS amount,
    list_contains([{paid}], chave_dim_situacao_processo) AS settled,
    list_contains([{tributes}], chave_dim_tributo) AS taxed,
    chave_tempo_inscricao AS entered, protestada IS DISTINCT FROM 'N' AS protested,
    chave_tempo_ajuizamento IS NOT NULL AS sued
  FROM {fact}
), by_owner AS (
  SELECT term, series, owner, count(term) AS lines, count(*) FILTER (settled) AS settled_lines, sum(amount) AS billed,
    sum(amount) FILTER (taxed) AS tax, sum(amount) FILTER (NOT taxed) AS fee, sum(amount) FILTER (settled) AS received,
    max(entered) AS entered, bool_or(protested) AS protested, bool_or(sued) AS sued
  FROM marked GROUP BY ALL
), people AS (
  SELECT {dim_key} AS owner, {person}, cpf_unico IS NOT NULL AS identified FROM {dim}
)
SELECT '{kind}-' || term || series AS cda, '{kind}' AS tipo_divida, sum(lines) AS deb_totais,
  sum(settled_lines) AS deb_pagos, sum(billed) AS valor_tot, coalesce(sum(tax), 0) AS vlr_tributo,
  coalesce(sum(fee), 0) AS vlr_taxa, coalesce(sum(received), 0) AS valor_pago, max(entered) AS inscricao_divida,
  max(people.owner) AS id_pessoa, {{person_columns}}, CAST(coalesce(bool_or(identified), false) AS INT) AS cpf_existe,
  CAST(bool_or(protested) AS INT) AS divida_protestada, CAST(bool_or(sued) AS INT) AS divida_ajuizada
FROM by_owner LEFT JOIN people USING (owner)
GROUP BY term, series"""


PROPERTY_SQL = _certificate_sql(
    "imovel", "v_fato_imovel", "v_dim_imovel", "chave_dim_imovel", "chave_dim_imovel", "2, 103, 105", "5, 8, 19",
    "situacao_imovel AS status, natureza_imovel <> 'T' AS built",
).format(person_columns="max(status) AS situacao, CAST(coalesce(bool_or(built IS DISTINCT FROM false), true) AS INT) AS edificacao")
BUSINESS_SQL = _certificate_sql(
    "mercantil", "v_fato_mercantil", "v_dim_mercantil", "chave_dim_mercantil", "chave_dim_merct", "2, 103",
    "1, 2, 7, 11, 12", "a04_situacao_mercantil AS status",
).format(person_columns="max(status) AS situacao")
CERTIFICATE_SHAPE = (
    "cda:string tipo_divida:string deb_totais:long deb_pagos:long valor_tot:double vlr_tributo:double "
    "vlr_taxa:double valor_pago:double inscricao_divida:long id_pessoa:long situacao:string {}cpf_existe:long "
    "divida_protestada:long divida_ajuizada:long"
)


@query("extract_property", CERTIFICATE_SHAPE.format("edificacao:long "), PROPERTY_SQL)
def extract_property(src):
    return X.property_certificates(src.fato_imovel, src.dim_imovel)


@query("extract_business", CERTIFICATE_SHAPE.format(""), BUSINESS_SQL)
def extract_business(src):
    return X.business_certificates(src.fato_mercantil, src.dim_mercantil)


def _debit_sql(unit: str, other: str, dim: str, dim_id: str, dim_key: str, interest: int) -> str:
    """``interest`` is how often launched interest counts."""
    return f"""
WITH credit AS (
  SELECT {unit} AS unit, dt_vencimento < TIMESTAMP '2000-06-29 00:00:00' AS overdue,
    vlr_lan_principal + vlr_lan_correcao + vlr_lan_multa + {interest} * vlr_lan_juros AS launched,
    vlr_arr_principal + vlr_arr_tsd + vlr_arr_correcao + vlr_arr_multa + vlr_arr_juros AS collected
  FROM v_debito_adm WHERE {other} IS NULL AND dt_fat_gerador >= TIMESTAMP '1997-01-01 00:00:00'
), per_unit AS (
  SELECT unit, count(unit) AS credits, sum(launched) AS launched, count(*) FILTER (overdue) AS late,
    coalesce(sum(launched) FILTER (overdue), 0) AS late_launched,
    coalesce(sum(collected) FILTER (overdue), 0) AS late_collected
  FROM credit GROUP BY unit
)
SELECT {dim_key} AS id_pessoa, sum(credits) AS total_creditos_lancados, sum(launched) AS valor_lancado_creditos,
  sum(late) AS quantidade_debitos_adm, sum(late_launched) AS valor_lancado_debitos,
  sum(late_collected) AS valor_arrecadado_debitos
FROM per_unit JOIN {dim} AS unit_owner ON unit_owner.{dim_id} = per_unit.unit
GROUP BY {dim_key}"""


DEBIT_SHAPE = (
    "id_pessoa:long total_creditos_lancados:long valor_lancado_creditos:double quantidade_debitos_adm:long "
    "valor_lancado_debitos:double valor_arrecadado_debitos:double"
)
TEST_CUT = {"cut": "2000-06-29 00:00:00", "first_year": 1997}


@query("extract_debits_property", DEBIT_SHAPE, _debit_sql(
    "seq_imovel_unico", "inscr_mercantil_unico", "v_dim_imovel", "seq_imovel_unico", "chave_dim_imovel", 2))
def extract_debits_property(src):
    return X.property_debits(src.debito_adm, src.dim_imovel, launched=X.LAUNCHED_AS_PUBLISHED, **TEST_CUT)


@query("extract_debits_business", DEBIT_SHAPE, _debit_sql(
    "inscr_mercantil_unico", "seq_imovel_unico", "v_dim_mercantil", "insc_merct_unico", "chave_dim_merct", 1))
def extract_debits_business(src):
    return X.business_debits(src.debito_adm, src.dim_mercantil, **TEST_CUT)


@query("extract_invoices", "id_pessoa:long qtd_notas_2anos:long", """
WITH issued AS (
  SELECT inscr_merc_pres_uni AS business, count(*) AS invoices FROM v_nfse WHERE ano >= 2021 GROUP BY business
)
SELECT chave_dim_merct AS id_pessoa, sum(invoices) AS qtd_notas_2anos
FROM v_dim_mercantil JOIN issued ON issued.business = v_dim_mercantil.insc_merct_unico GROUP BY id_pessoa""")
def extract_invoices(src):
    return X.invoices_per_taxpayer(src.nfse, src.dim_mercantil)


INSTALLMENT_SQL = """
WITH plan AS (
  SELECT termo_da_unico, cterdiseri, adimovsequ AS property, admercsequ AS business,
    if(adimovsequ IS NULL, 'mercantil', 'imovel') AS kind, CAST(fpropaprot IS DISTINCT FROM 'NAO' AS INT) AS protested,
    CAST(dt_ajuizamento IS NOT NULL AS INT) AS sued, vl_lanc_principal AS launched, vl_arr_principal AS collected,
    year(dt_parcelamento) AS agreed, qtd_reparcelamentos AS renewals
  FROM v_parcelamento WHERE termo_da_unico IS NOT NULL
)
SELECT kind || '-' || termo_da_unico || cterdiseri AS cda, coalesce(property, max(business)) AS id_pessoa,
  kind AS tipo_divida, sum(launched) AS valor_tot, sum(collected) AS valor_pago, protested AS divida_protestada,
  sued AS divida_ajuizada, max(agreed) AS ano_inscricao_da, max(renewals) AS quantidade_reparcelamentos
FROM plan GROUP BY termo_da_unico, cterdiseri, property, kind, protested, sued"""


@query("extract_installments",
       "cda:string id_pessoa:long tipo_divida:string valor_tot:double valor_pago:double divida_protestada:long "
       "divida_ajuizada:long ano_inscricao_da:long quantidade_reparcelamentos:long", INSTALLMENT_SQL)
def extract_installments(src):
    return X.installments(src.parcelamento)


@query("date_lookup", "cda:string inscricao_divida:long data_inscricao_da:string ano_inscricao_da:long", f"""
WITH base AS ({PROPERTY_SQL})
SELECT b.cda, b.inscricao_divida, CAST(t.data AS VARCHAR) AS data_inscricao_da, extract(year FROM t.data) AS ano_inscricao_da
FROM base b LEFT JOIN v_dim_tempo t ON t.chave_tempo = b.inscricao_divida""")
def date_lookup(src):
    from pyspark.sql import functions as F

    certificates = X.property_certificates(src.fato_imovel, src.dim_imovel)
    dated = X.with_date(certificates, X.time_dictionary(src.dim_tempo), "inscricao_divida", "data_inscricao_da")
    return dated.withColumn("ano_inscricao_da", F.year("data_inscricao_da"))


@query("owner_distinct", "termo_da_unico:long chave_dim_imovel:long tipo_propriedade_resp:string", """
WITH named AS (SELECT chave_dim_imovel, tipo_propriedade_resp FROM v_dim_imovel WHERE tipo_propriedade_resp IS NOT NULL),
billed AS (SELECT DISTINCT termo_da_unico, chave_dim_imovel FROM v_fato_imovel)
SELECT termo_da_unico, chave_dim_imovel, tipo_propriedade_resp FROM billed JOIN named USING (chave_dim_imovel)""")
def owner_distinct(src):
    return X.certificate_owners(src.fato_imovel, src.dim_imovel)
