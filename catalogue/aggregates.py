"""Aggregation and band queries."""

from pyspark.sql import functions as F

from arrears.functions import bands as B
from arrears.functions import fixed_values as fv
from arrears.functions import scalars as S
from arrears.functions.semantics import ratio, round_even
from arrears.operators import aggregates as A
from arrears.operators import bitmaps as M
from arrears.operators.quantiles import exact_quantiles
from arrears.session import cut_lineage
from catalogue.cleaning import SIZE_SQL
from catalogue.registry import query

BILL_COLUMNS = [
    "dam", "id_imovel", "id_contribuinte", "ano_fato_gerador", "vlr_total_dam", "vlr_pago", "vlr_aberto",
    "tipo_propriedade", "natureza_imovel", "area_construida", "idade_imovel", "qtd_pavimentos", "bairro", "regiao", "rpa",
    "tipo_contribuinte", "data_ultimo_pagamento", "atualizacao_cadastro",
]
BILL_TEXTS = ["tipo_propriedade", "natureza_imovel", "bairro", "regiao", "tipo_contribuinte", "atualizacao_cadastro"]
KINDS = ["APARTAMENTO", "CASA", "LOJA", "SALA", "GALPAO"]
YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


def trunc6(col):
    """Statistics are compared on their first six decimals."""
    return F.floor(F.col(col) * 1e6) / 1e6


@query("group_multi", "bairro:string sum_vlr_pago:double sum_vlr_aberto:double count_id_contribuinte:long distinct_id_imovel:long max_qtd_pavimentos:long", """
SELECT bairro, sum(vlr_pago) AS sum_vlr_pago, sum(vlr_aberto) AS sum_vlr_aberto, count(id_contribuinte) AS count_id_contribuinte,
  count(DISTINCT id_imovel) AS distinct_id_imovel, max(qtd_pavimentos) AS max_qtd_pavimentos FROM v_dam GROUP BY bairro""")
def group_multi(src):
    return A.group_measures(src.dam, ["bairro"], ["vlr_pago", "vlr_aberto"], ["id_contribuinte"], ["id_imovel"], ["qtd_pavimentos"])


@query("avg_ticket_nonzero", "ano_fato_gerador:long ticket_medio_pago:double", """
SELECT ano_fato_gerador, CAST(sum(vlr_pago) AS DOUBLE)/count(vlr_pago) AS ticket_medio_pago FROM v_dam WHERE vlr_pago <> 0 GROUP BY 1""")
def avg_ticket_nonzero(src):
    return A.average_nonzero(src.dam, "ano_fato_gerador", "vlr_pago", "ticket_medio_pago")


@query("entity_rollup", "id_imovel:long id_contribuinte:long vlr_aberto:double vlr_pago:double idade_imovel:long bairro:string tipo_propriedade:string", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY id_imovel, id_contribuinte ORDER BY ano_fato_gerador, dam, bairro) AS rn
  FROM v_dam WHERE id_contribuinte IS NOT NULL)
SELECT id_imovel, id_contribuinte, sum(vlr_aberto) AS vlr_aberto, sum(vlr_pago) AS vlr_pago,
  max(CASE WHEN rn = 1 THEN idade_imovel END) AS idade_imovel, max(CASE WHEN rn = 1 THEN bairro END) AS bairro,
  max(CASE WHEN rn = 1 THEN tipo_propriedade END) AS tipo_propriedade FROM r GROUP BY 1, 2""")
def entity_rollup(src):
    return A.entity_rollup(src.dam, ["id_imovel", "id_contribuinte"], ["vlr_aberto", "vlr_pago"],
                           ["idade_imovel", "bairro", "tipo_propriedade"], ["ano_fato_gerador", "dam"])


@query("table_totals", "n:long total:double minimo:double maximo:double media:double desvio:double", """
SELECT n, total, minimo, maximo, CAST(total AS DOUBLE)/n AS media, floor(desvio*1e6)/1e6 AS desvio FROM (
  SELECT count(vlr_total_dam) AS n, sum(vlr_total_dam) AS total, min(vlr_total_dam) AS minimo, max(vlr_total_dam) AS maximo,
    stddev_samp(CAST(vlr_total_dam AS DOUBLE)) AS desvio FROM v_dam) t""")
def table_totals(src):
    return A.table_totals(src.dam, "vlr_total_dam").withColumn("desvio", trunc6("desvio"))


OPPORTUNITY_SHAPE = ("ano_fato_gerador:long vlr_pago_total:double vlr_aberto_total:double vlr_total_dam:double "
                     "percentual_pago:double oportunidade:double")
OPPORTUNITY_SQL = """
SELECT *, percentual_pago*CAST(vlr_aberto_total AS DOUBLE)/100 AS oportunidade FROM (
  SELECT ano_fato_gerador, sum(vlr_pago) AS vlr_pago_total, sum(vlr_aberto) AS vlr_aberto_total, sum(vlr_total_dam) AS vlr_total_dam,
    CAST(sum(vlr_pago) AS DOUBLE)/CAST(sum(vlr_pago) + sum(vlr_aberto) AS DOUBLE)*100 AS percentual_pago
  FROM v_dam WHERE {} GROUP BY 1) t"""


@query("pct_opportunity", OPPORTUNITY_SHAPE, OPPORTUNITY_SQL.format("true"))
def pct_opportunity(src):
    return A.paid_share_and_opportunity(src.dam, "ano_fato_gerador")


@query("pct_opportunity_neighbourhood", OPPORTUNITY_SHAPE, OPPORTUNITY_SQL.format("trim(bairro) = 'NATION_7'"))
def pct_opportunity_neighbourhood(src):
    return A.paid_share_and_opportunity(src.dam.where(S.trimmed_equals("bairro", "NATION_7")), "ano_fato_gerador")


@query("share_of_total", "tipo_propriedade:string imoveis:long total_imoveis:long perc_imoveis:double", """
WITH g AS (SELECT tipo_propriedade, count(DISTINCT id_imovel) AS imoveis FROM v_dam WHERE tipo_propriedade IS NOT NULL GROUP BY 1)
SELECT tipo_propriedade, imoveis, (SELECT sum(imoveis) FROM g) AS total_imoveis,
  round_even(CAST(imoveis AS DOUBLE)/CAST((SELECT sum(imoveis) FROM g) AS DOUBLE)*100000e0, 0)/100000e0 AS perc_imoveis FROM g""")
def share_of_total(src):
    return A.share_of_total(src.dam, "tipo_propriedade", F.count_distinct("id_imovel"), "imoveis")


@query("frequency", "id_contribuinte:long num_ocorr:long",
       "SELECT id_contribuinte, count(*) AS num_ocorr FROM v_dam WHERE id_contribuinte IS NOT NULL GROUP BY 1")
def frequency(src):
    return A.frequency(src.dam, "id_contribuinte")


@query("frequency_pairs", "bairro:string tipo_propriedade:string num_ocorr:long", """
SELECT bairro, tipo_propriedade, count(*) AS num_ocorr FROM v_dam WHERE tipo_propriedade IS NOT NULL GROUP BY 1, 2""")
def frequency_pairs(src):
    return A.frequency(src.dam, "bairro", "tipo_propriedade")


@query("group_quantile", "tipo_divida:string n:long q0:double q1:double", """
SELECT tipo_divida, count(*) AS n, round_even(quantile_cont(CAST(valor_tot AS DOUBLE), 0.5)*1e4, 0)/1e4 AS q0,
  round_even(quantile_cont(CAST(valor_tot AS DOUBLE), 0.75)*1e4, 0)/1e4 AS q1 FROM v_divida GROUP BY 1""")
def group_quantile(src):
    found = exact_quantiles(src.divida, "valor_tot", [0.5, 0.75], by="tipo_divida")
    return found.withColumn("q0", round_even("q0", 4)).withColumn("q1", round_even("q1", 4))


DESCRIBE_SQL = """count({0}) AS count, CAST(sum({0}) AS DOUBLE)/count({0}) AS mean, floor(stddev_samp(CAST({0} AS DOUBLE))*1e6)/1e6 AS std,
  min({0}) AS min, max({0}) AS max, round_even(quantile_cont(CAST({0} AS DOUBLE), 0.25)*1e4, 0)/1e4 AS q0,
  round_even(quantile_cont(CAST({0} AS DOUBLE), 0.5)*1e4, 0)/1e4 AS q1, round_even(quantile_cont(CAST({0} AS DOUBLE), 0.75)*1e4, 0)/1e4 AS q2"""
DESCRIBE_SHAPE = "count:long mean:double std:double min:double max:double q0:double q1:double q2:double"


def _truncated(df):
    for c in ("q0", "q1", "q2"):
        df = df.withColumn(c, round_even(c, 4))
    return df.withColumn("std", trunc6("std"))


@query("describe", DESCRIBE_SHAPE, f"SELECT {DESCRIBE_SQL.format('vlr_aberto')} FROM v_dam")
def describe(src):
    return _truncated(A.describe(src.dam, "vlr_aberto"))


@query("describe_by_group", "idade_imovel:long " + DESCRIBE_SHAPE,
       f"SELECT idade_imovel, {DESCRIBE_SQL.format('vlr_aberto')} FROM v_dam GROUP BY 1")
def describe_by_group(src):
    return _truncated(A.describe(src.dam, "vlr_aberto", by="idade_imovel"))


@query("describe_text", "coluna:string count:long unicos:long top:string freq:long", " UNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS coluna, (SELECT count({c}) FROM v_dam) AS count, (SELECT count(DISTINCT {c}) FROM v_dam) AS unicos,
  {c} AS top, count(*) AS freq FROM v_dam WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY freq DESC, top LIMIT 1)"""
    for c in BILL_TEXTS))
def describe_text(src):
    return A.describe_text(src.dam)


SIZE_PIVOT_SQL = f"""
SELECT tipo_propriedade, {', '.join(f"count(DISTINCT CASE WHEN t = '{v}' THEN id_imovel END) AS {v}" for v in fv.SIZE_ORDER)}
FROM (SELECT tipo_propriedade, id_imovel, {SIZE_SQL} AS t FROM v_dam WHERE idade_imovel <= 20 AND tipo_propriedade IS NOT NULL) s
GROUP BY 1"""
SIZE_PIVOT_SHAPE = " ".join(f"{v}:long" for v in fv.SIZE_ORDER)


def _size_pivot(src):
    recent = src.dam.where("idade_imovel <= 20").withColumn("tamanho_imovel", S.size_class())
    return A.pivot_distinct(recent, "tipo_propriedade", "tamanho_imovel", "id_imovel", fv.SIZE_ORDER)


@query("pivot_distinct", f"tipo_propriedade:string {SIZE_PIVOT_SHAPE} total:long",
       f"SELECT *, PEQUENO + MEDIO + GRANDE + INDEFINIDO AS total FROM ({SIZE_PIVOT_SQL}) p")
def pivot_distinct(src):
    return _size_pivot(src)


@query("pivot_column_totals", SIZE_PIVOT_SHAPE,
       f"SELECT {', '.join(f'sum({v}) AS {v}' for v in fv.SIZE_ORDER)} FROM ({SIZE_PIVOT_SQL}) p")
def pivot_column_totals(src):
    return A.column_totals(_size_pivot(src), fv.SIZE_ORDER)


YEAR_SHAPE = " ".join(f"ano_{y}:double" for y in YEARS)


@query("pivot_sum_year", f"tipo_propriedade:string {YEAR_SHAPE}", f"""
SELECT tipo_propriedade, {', '.join(f'sum(CASE WHEN ano_fato_gerador = {y} THEN vlr_aberto ELSE 0 END) AS ano_{y}' for y in YEARS)}
FROM v_dam WHERE tipo_propriedade IS NOT NULL GROUP BY 1""")
def pivot_sum_year(src):
    return A.pivot_sum(src.dam, "tipo_propriedade", "ano_fato_gerador", "vlr_aberto", YEARS, "ano_")


@query("pivot_entities_year", "tipo_propriedade:string " + " ".join(f"ano_{y}:long" for y in YEARS), f"""
SELECT tipo_propriedade, {', '.join(f'count(DISTINCT CASE WHEN ano_fato_gerador = {y} THEN id_imovel END) AS ano_{y}' for y in YEARS)}
FROM v_dam WHERE tipo_propriedade IS NOT NULL GROUP BY 1""")
def pivot_entities_year(src):
    wide = A.pivot_distinct(src.dam, "tipo_propriedade", "ano_fato_gerador", "id_imovel", YEARS)
    return wide.withColumnsRenamed({str(y): f"ano_{y}" for y in YEARS})


@query("crosstab", "regiao:string " + " ".join(f"{k}:long" for k in KINDS), f"""
SELECT regiao, {', '.join(f"sum(CASE WHEN tipo_propriedade = '{k}' THEN 1 ELSE 0 END) AS {k}" for k in KINDS)}
FROM v_dam WHERE tipo_propriedade IS NOT NULL GROUP BY 1""")
def crosstab(src):
    return A.crosstab(src.dam, "regiao", "tipo_propriedade", KINDS)


@query("distinct_per_column", "coluna:string distintos:long",
       " UNION ALL ".join(f"SELECT '{c}' AS coluna, count(DISTINCT {c}) AS distintos FROM v_dam" for c in BILL_COLUMNS))
def distinct_per_column(src):
    return A.distinct_per_column(src.dam)


@query("distinct_from_store", "chave:string valor:string imoveis:long", """
SELECT 'bairro' AS chave, bairro AS valor, count(DISTINCT id_imovel) AS imoveis FROM v_dam GROUP BY bairro
UNION ALL SELECT 'tipo_propriedade', tipo_propriedade, count(DISTINCT id_imovel) FROM v_dam GROUP BY tipo_propriedade
UNION ALL SELECT 'ano_fato_gerador', CAST(ano_fato_gerador AS VARCHAR), count(DISTINCT id_imovel) FROM v_dam GROUP BY ano_fato_gerador
UNION ALL SELECT 'tudo', NULL, count(DISTINCT id_imovel) FROM v_dam""")
def distinct_from_store(src):
    """Distinct properties at four granularities from bitmaps that one pass stored at the finest."""
    keys = ["bairro", "tipo_propriedade", "ano_fato_gerador"]
    store = cut_lineage(M.entity_bitmaps(src.dam, keys, "id_imovel"))
    found = M.distinct_entities(store, [], "imoveis").select(
        F.lit("tudo").alias("chave"), F.lit(None).cast("string").alias("valor"), "imoveis")
    for key in keys:
        per_key = M.distinct_entities(store, [key], "imoveis")
        found = found.unionByName(per_key.select(F.lit(key).alias("chave"), F.col(key).cast("string").alias("valor"), "imoveis"))
    return found


@query("cumulative_distinct", "ano_fato_gerador:long contribuintes:long", """
SELECT a.ano_fato_gerador, count(DISTINCT b.id_contribuinte) AS contribuintes
FROM (SELECT DISTINCT ano_fato_gerador FROM v_dam WHERE ano_fato_gerador IS NOT NULL) a
JOIN v_dam b ON b.ano_fato_gerador <= a.ano_fato_gerador GROUP BY 1""")
def cumulative_distinct(src):
    """Taxpayers seen up to each year, from one bitmap store per year."""
    store = cut_lineage(M.entity_bitmaps(src.dam, ["ano_fato_gerador"], "id_contribuinte"))
    return M.cumulative_entities(store, "ano_fato_gerador", "contribuintes")


@query("argmax_row", "bairro:string maior:double tipo_propriedade:string dam:long", """
SELECT bairro, maior, tipo_propriedade, dam FROM (SELECT bairro, r AS maior, tipo_propriedade, dam,
  row_number() OVER (PARTITION BY bairro ORDER BY r DESC, dam, tipo_propriedade NULLS FIRST) AS rn
  FROM (SELECT *, CAST(vlr_pago AS DOUBLE)/CAST(vlr_total_dam AS DOUBLE)*100 AS r FROM v_dam) a) b WHERE rn = 1""")
def argmax_row(src):
    share = ratio("vlr_pago", "vlr_total_dam") * 100
    return A.top_row(src.dam, "bairro", share, ["tipo_propriedade", "dam"], ["dam", "tipo_propriedade"])


@query("argmax_type", "bairro:string tipo_propriedade:string devido:double", """
SELECT bairro, tipo_propriedade, devido FROM (SELECT *, row_number() OVER (PARTITION BY bairro ORDER BY devido DESC, tipo_propriedade) AS rn
  FROM (SELECT bairro, tipo_propriedade, sum(vlr_aberto) AS devido FROM v_dam WHERE vlr_aberto > 0 AND tipo_propriedade IS NOT NULL GROUP BY 1, 2) a) b WHERE rn = 1""")
def argmax_type(src):
    return A.leading_category(src.dam.where("vlr_aberto > 0"), "bairro", "tipo_propriedade", F.sum("vlr_aberto"), "devido")


@query("two_level", "bairro:string tipo_propriedade:string imoveis:long", """
SELECT bairro, tipo_propriedade, imoveis FROM (SELECT *, row_number() OVER (PARTITION BY bairro ORDER BY imoveis DESC, tipo_propriedade) AS rn
  FROM (SELECT bairro, tipo_propriedade, count(DISTINCT id_imovel) AS imoveis FROM v_dam WHERE tipo_propriedade IS NOT NULL GROUP BY 1, 2) a) b WHERE rn = 1""")
def two_level(src):
    return A.leading_category(src.dam, "bairro", "tipo_propriedade", F.count_distinct("id_imovel"), "imoveis")


@query("duplicates", "linhas:long chaves:long repetidas:long",
       "SELECT count(*) AS linhas, count(DISTINCT dam) AS chaves, count(*) - count(DISTINCT dam) AS repetidas FROM v_dam")
def duplicates(src):
    return A.duplicate_summary(src.dam, ["dam"])


@query("duplicate_members", "dam:long id_imovel:long vlr_total_dam:double", """
SELECT dam, id_imovel, vlr_total_dam FROM v_dam WHERE dam IN (SELECT dam FROM v_dam GROUP BY dam HAVING count(*) > 1)""")
def duplicate_members(src):
    return A.duplicate_members(src.dam, "dam")


@query("conditional_share", "condicao:string quantidade:long total:long percentual:double", " UNION ALL ".join(f"""
SELECT '{n}' AS condicao, sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS quantidade, count(*) AS total,
  CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS DOUBLE)/CAST(count(*) AS DOUBLE)*100 AS percentual FROM v_dam""" for n, c in [
    ("paga", "vlr_pago = vlr_total_dam"), ("nao_paga", "vlr_pago = 0"), ("parcial", "vlr_pago <> 0 AND vlr_pago < vlr_total_dam")]))
def conditional_share(src):
    paid, billed = F.col("vlr_pago"), F.col("vlr_total_dam")
    return A.conditional_share(src.dam, {"paga": paid == billed, "nao_paga": paid == 0, "parcial": (paid != 0) & (paid < billed)})


@query("conflicting_keys", "cda:long valores:long",
       "SELECT cda, count(DISTINCT da_aberto) AS valores FROM v_divida GROUP BY cda HAVING count(DISTINCT da_aberto) > 1")
def conflicting_keys(src):
    return A.conflicting_keys(src.divida, ["cda"], "da_aberto")


SHEET_SHAPE = ("dams:long vlr_pago:double vlr_total_dam:double vlr_aberto:double suposto_devido:double "
               "percentual_pago:double percentual_dams:double")


def _register_sheet(name: str, key: str, kind: str):
    @query(f"collection_sheet_{name}", f"{key}:{kind} {SHEET_SHAPE}", f"""
SELECT {key}, count(dam) AS dams, sum(vlr_pago) AS vlr_pago, sum(vlr_total_dam) AS vlr_total_dam, sum(vlr_aberto) AS vlr_aberto,
  sum(vlr_total_dam) - sum(vlr_pago) AS suposto_devido,
  CAST(sum(vlr_pago) AS DOUBLE)/CAST(sum(vlr_total_dam) AS DOUBLE)*100 AS percentual_pago,
  CAST(count(dam) AS DOUBLE)/CAST((SELECT count(dam) FROM v_dam) AS DOUBLE)*100 AS percentual_dams
FROM v_dam WHERE {key} IS NOT NULL GROUP BY {key}""")
    def sheet(src):
        return A.collection_sheet(src.dam, key)


for _name, _key, _kind in [
    ("year", "ano_fato_gerador", "long"), ("rpa", "rpa", "long"), ("region", "regiao", "string"),
    ("type", "tipo_propriedade", "string"), ("neighbourhood", "bairro", "string"),
    ("nature", "natureza_imovel", "string"), ("floors", "qtd_pavimentos", "long"),
]:
    _register_sheet(_name, _key, _kind)


@query("ticket_per_entity", "tipo_propriedade:string vlr_total_dam:double entidades:long ticket_medio:double", """
SELECT tipo_propriedade, sum(vlr_total_dam) AS vlr_total_dam, count(DISTINCT id_imovel) AS entidades,
  CAST(sum(vlr_total_dam) AS DOUBLE)/CAST(count(DISTINCT id_imovel) AS DOUBLE) AS ticket_medio
FROM v_dam WHERE tipo_propriedade IS NOT NULL GROUP BY 1""")
def ticket_per_entity(src):
    return A.ticket_per_entity(src.dam, "tipo_propriedade", "id_imovel", "vlr_total_dam")


@query("age_band_sums", "faixa:string vlr_aberto:double valor_devido:double", """
SELECT f.faixa, coalesce(sum(vlr_aberto), 0) AS vlr_aberto, coalesce(sum(vlr_aberto + vlr_pago), 0) AS valor_devido
FROM (VALUES ('(0, 20]', 0, 20), ('(20, 50]', 20, 50), ('(50, inf]', 50, 1000000)) f(faixa, inf, sup)
LEFT JOIN v_dam d ON d.idade_imovel > f.inf AND d.idade_imovel <= f.sup GROUP BY 1""")
def age_band_sums(src):
    due = src.dam.withColumn("valor_devido", F.col("vlr_aberto") + F.col("vlr_pago"))
    return B.band_sums(due, "idade_imovel", fv.PROPERTY_AGE_EDGES, fv.PROPERTY_AGE_LABELS, ["vlr_aberto", "valor_devido"], right=True)


@query("value_bands", "faixa:string ordem:long quantidade:long vlr_total_dam:double vlr_pago:double vlr_aberto:double", """
SELECT f.faixa, f.ordem, count(d.dam) AS quantidade, coalesce(sum(vlr_total_dam), 0) AS vlr_total_dam,
  coalesce(sum(vlr_pago), 0) AS vlr_pago, coalesce(sum(vlr_aberto), 0) AS vlr_aberto
FROM (VALUES ('>=0 <3000', 0, 0, 3000), ('>=3000 <5000', 1, 3000, 5000), ('>=5000 <8000', 2, 5000, 8000), ('>=8000', 3, 8000, 1000000000)) f(faixa, ordem, inf, sup)
LEFT JOIN v_dam d ON d.vlr_total_dam >= f.inf AND d.vlr_total_dam < f.sup GROUP BY 1, 2""")
def value_bands(src):
    return B.band_sums(src.dam, "vlr_total_dam", fv.BILL_VALUE_EDGES, fv.BILL_VALUE_LABELS,
                       ["vlr_total_dam", "vlr_pago", "vlr_aberto"], count="dam")


def bands_sql(edges):
    rows = ", ".join(f"('[{float(a)}, {float(b)})', {i}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
                     for i, (a, b) in enumerate(zip(edges, edges[1:])))
    return f"(VALUES {rows}) f(faixa, ordem, inf, sup)"


FREQUENCY_SHAPE = "faixa:string ordem:long freq:long total:long perc:double"


def band_frequency_sql(edges, value, table, digits):
    factor = f"{10**digits}e0"
    return f"""
WITH x AS (SELECT {value} AS v FROM {table}),
g AS (SELECT f.faixa, f.ordem, count(x.v) AS freq FROM {bands_sql(edges)} LEFT JOIN x ON x.v >= f.inf AND x.v < f.sup GROUP BY 1, 2)
SELECT faixa, ordem, freq, (SELECT sum(freq) FROM g) AS total,
  round_even(CAST(freq AS DOUBLE)/CAST((SELECT sum(freq) FROM g) AS DOUBLE)*{factor}, 0)/{factor} AS perc FROM g"""


@query("paid_bands", FREQUENCY_SHAPE, band_frequency_sql(
    fv.PAID_RATIO_EDGES, "CAST(valor_pago AS DOUBLE)/CAST(valor_tot AS DOUBLE)", "v_divida", 4))
def paid_bands(src):
    return B.band_frequency(src.divida, ratio("valor_pago", "valor_tot"), fv.PAID_RATIO_EDGES)


@query("residual_bands", FREQUENCY_SHAPE, band_frequency_sql(fv.RESIDUAL_EDGES, "y - y_predict", "v_resid", 5))
def residual_bands(src):
    return B.band_frequency(src.resid, F.col("y") - F.col("y_predict"), fv.RESIDUAL_EDGES, digits=5)


PAID_LABELS = B.half_open_labels(fv.PAID_RATIO_EDGES)


@query("band_crosstab", "faixa_linha:string " + " ".join(f"c{i}:long" for i in range(len(PAID_LABELS))), f"""
SELECT a.faixa AS faixa_linha, {', '.join(f'sum(CASE WHEN b.ordem = {i} THEN 1 ELSE 0 END) AS c{i}' for i in range(len(PAID_LABELS)))}
FROM v_resid r JOIN {bands_sql(fv.PAID_RATIO_EDGES).replace(' f(', ' a(')} ON r.y >= a.inf AND r.y < a.sup
JOIN {bands_sql(fv.PAID_RATIO_EDGES).replace(' f(', ' b(')} ON r.y_predict >= b.inf AND r.y_predict < b.sup GROUP BY 1""")
def band_crosstab(src):
    wide = B.band_crosstab(src.resid, "y", "y_predict", fv.PAID_RATIO_EDGES)
    return wide.withColumnsRenamed({label: f"c{i}" for i, label in enumerate(PAID_LABELS)})
