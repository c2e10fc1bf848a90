"""Window, order and sampling queries."""

from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.bands import label_table
from arrears.functions.semantics import ascending, descending, keep_first, round_even
from arrears.operators import aggregates as A
from arrears.operators import windows as W
from arrears.operators.aggregates import listed
from catalogue.registry import query

YEAR_SHARE_SQL = """y AS (SELECT bairro, ano_fato_gerador AS ano,
  CAST(sum(vlr_pago) AS DOUBLE)/CAST(sum(vlr_pago) + sum(vlr_aberto) AS DOUBLE)*100 AS pct FROM v_dam GROUP BY 1, 2)"""


def neighbourhood_years(src):
    """Paid percentage per neighbourhood and year: one row each."""
    grouped = src.dam.groupBy("bairro", F.col("ano_fato_gerador").alias("ano")).agg(
        F.sum("vlr_pago").alias("p"), F.sum("vlr_aberto").alias("a"))
    return grouped.select("bairro", "ano", A.percent("p", F.col("p") + F.col("a")).alias("pct"))


@query("running_totals", "id_contribuinte:long ano:long hist_cota_unica:long hist_pagamento:double hist_lancado:double", """
SELECT id_contribuinte, ano, sum(pgt_cota_unica) OVER w AS hist_cota_unica, sum(hist_valor_pago) OVER w AS hist_pagamento,
  sum(hist_valor_total) OVER w AS hist_lancado FROM v_hist
WINDOW w AS (PARTITION BY id_contribuinte ORDER BY ano ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_totals(src):
    return W.cumulative(src.hist, "id_contribuinte", "ano", {
        "pgt_cota_unica": "hist_cota_unica", "hist_valor_pago": "hist_pagamento", "hist_valor_total": "hist_lancado"})


@query("credit_recurrence", "id_contribuinte:long ano:long reco_credito:long", """
SELECT id_contribuinte, ano, CASE WHEN hist_valor_pago = 0 THEN 0 ELSE sum(f) OVER (PARTITION BY id_contribuinte ORDER BY ano
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS reco_credito
FROM (SELECT *, CASE WHEN lag(hist_valor_pago) OVER (PARTITION BY id_contribuinte ORDER BY ano) = 0 THEN 0 ELSE 1 END AS f FROM v_hist) t""")
def credit_recurrence(src):
    return W.credit_recurrence(src.hist, "id_contribuinte", "ano", "hist_valor_pago", "reco_credito")


@query("isolated_years", "id_imovel:long ano_fato_gerador:long", """
SELECT id_imovel, ano_fato_gerador FROM (SELECT id_imovel, ano_fato_gerador,
  lead(ano_fato_gerador) OVER w AS n, lag(ano_fato_gerador) OVER w AS p FROM v_dam
  WINDOW w AS (PARTITION BY id_imovel ORDER BY ano_fato_gerador)) t
WHERE ano_fato_gerador IS DISTINCT FROM n AND ano_fato_gerador IS DISTINCT FROM p""")
def isolated_years(src):
    return W.isolated_years(src.dam, "id_imovel", "ano_fato_gerador")


@query("moving_average", "bairro:string ano:long media_movel:double", f"""
WITH {YEAR_SHARE_SQL} SELECT bairro, ano, CASE WHEN p IS NULL THEN NULL ELSE round_even((p + pct)/2*1e6, 0)/1e6 END AS media_movel
FROM (SELECT *, lag(pct) OVER (PARTITION BY bairro ORDER BY ano) AS p FROM y) t""")
def moving_average(src):
    moved = W.moving_average(neighbourhood_years(src), "bairro", "ano", "pct", "media_movel")
    return moved.withColumn("media_movel", round_even("media_movel", 6))


@query("pareto", "bairro:string vlr_aberto:double acumulado:double porcentagem_acumulada:double", """
WITH g AS (SELECT bairro, sum(vlr_aberto) AS vlr_aberto FROM v_dam GROUP BY 1),
c AS (SELECT *, sum(vlr_aberto) OVER (ORDER BY vlr_aberto DESC, bairro ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acumulado FROM g)
SELECT *, CAST(acumulado AS DOUBLE)/CAST((SELECT sum(vlr_aberto) FROM g) AS DOUBLE)*100 AS porcentagem_acumulada FROM c""")
def pareto(src):
    return W.pareto(src.dam, "bairro", "vlr_aberto")


@query("pareto_curve", "vlr_aberto:double linhas:long acumulado:double porcentagem_acumulada:double", """
WITH g AS (SELECT vlr_aberto, count(*) AS linhas, sum(vlr_aberto) AS soma FROM v_dam GROUP BY 1),
c AS (SELECT *, sum(soma) OVER (ORDER BY vlr_aberto DESC) AS acumulado FROM g)
SELECT vlr_aberto, linhas, acumulado, CAST(acumulado AS DOUBLE)/CAST((SELECT sum(soma) FROM g) AS DOUBLE)*100 AS porcentagem_acumulada FROM c""")
def pareto_curve(src):
    return W.pareto_curve(src.dam, "vlr_aberto")


@query("dedupe_first", "dam:long id_imovel:long ano_fato_gerador:long vlr_total_dam:double vlr_pago:double bairro:string", """
SELECT dam, id_imovel, ano_fato_gerador, vlr_total_dam, vlr_pago, bairro FROM (SELECT *, row_number() OVER (
  PARTITION BY dam ORDER BY id_imovel, ano_fato_gerador, vlr_total_dam, vlr_pago, bairro) AS rn FROM v_dam) t WHERE rn = 1""")
def dedupe_first(src):
    columns = ["dam", "id_imovel", "ano_fato_gerador", "vlr_total_dam", "vlr_pago", "bairro"]
    return keep_first(src.dam.select(*columns), ["dam"], columns[1:])


@query("yoy_difference", "bairro:string ano:long diferenca:double media:double", f"""
WITH {YEAR_SHARE_SQL}, d AS (SELECT bairro, ano, lag(pct) OVER (PARTITION BY bairro ORDER BY ano) - pct AS diferenca FROM y)
SELECT bairro, ano, diferenca, (SELECT floor(avg(diferenca)*1e6)/1e6 FROM d) AS media FROM d""")
def yoy_difference(src):
    changes = W.year_over_year(neighbourhood_years(src), "bairro", "ano", "pct")
    mean = changes.agg((F.floor(F.avg("diferenca") * 1e6) / 1e6).alias("m")).scalar()
    return changes.withColumn("media", mean)


@query("relative_to_leader", "bairro:string ano:long relativo_geral:double relativo_lider:double sempre_abaixo_geral:long sempre_abaixo_lider:long", f"""
WITH {YEAR_SHARE_SQL}, g AS (SELECT ano, avg(pct) AS media FROM y GROUP BY 1),
m AS (SELECT bairro FROM y GROUP BY 1 ORDER BY avg(pct) DESC, bairro DESC LIMIT 1),
l AS (SELECT ano, pct AS lead FROM y WHERE bairro = (SELECT bairro FROM m)),
p AS (SELECT y.bairro, y.ano, y.pct - g.media AS rg, y.pct/l.lead AS rl FROM y JOIN g ON g.ano = y.ano LEFT JOIN l ON l.ano = y.ano),
a AS (SELECT bairro, min(CASE WHEN rg < 0 THEN 1 ELSE 0 END) AS ag, min(CASE WHEN rl < 1 THEN 1 ELSE 0 END) AS al FROM p GROUP BY 1)
SELECT p.bairro, p.ano, round_even(rg*1e6, 0)/1e6 AS relativo_geral, rl AS relativo_lider, ag AS sempre_abaixo_geral, al AS sempre_abaixo_lider
FROM p JOIN a ON a.bairro = p.bairro""")
def relative_to_leader(src):
    placed = W.relative_position(neighbourhood_years(src), "bairro", "ano", "pct")
    return placed.withColumn("relativo_geral", round_even("relativo_geral", 6))


@query("sort_head", "bairro:string vlr_aberto:double imoveis:long", """
SELECT bairro, sum(vlr_aberto) AS vlr_aberto, count(DISTINCT id_imovel) AS imoveis FROM v_dam GROUP BY 1 ORDER BY vlr_aberto DESC, bairro LIMIT 10""")
def sort_head(src):
    grouped = src.dam.groupBy("bairro").agg(F.sum("vlr_aberto").alias("vlr_aberto"), F.count_distinct("id_imovel").alias("imoveis"))
    return W.head(grouped, [descending("vlr_aberto"), ascending("bairro")], 10)


TOP_YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


@query("top20_matrix", "bairro:string " + " ".join(f"ano_{y}:double" for y in TOP_YEARS), f"""
WITH t AS (SELECT bairro FROM v_dam GROUP BY 1 ORDER BY sum(vlr_aberto) DESC, bairro LIMIT 20), {YEAR_SHARE_SQL}
SELECT y.bairro, {', '.join(f'max(CASE WHEN ano = {y} THEN pct END) AS ano_{y}' for y in TOP_YEARS)}
FROM y JOIN t ON t.bairro = y.bairro GROUP BY 1""")
def top20_matrix(src):
    top = W.top_groups(src.dam, "bairro", F.sum("vlr_aberto"), 20)
    years = neighbourhood_years(src).join(top, "bairro", "left_semi")
    wide = years.withColumn("ano", listed("ano", TOP_YEARS)).groupBy("bairro").pivot("ano", TOP_YEARS).agg(F.first("pct"))
    return wide.withColumnsRenamed({str(y): f"ano_{y}" for y in TOP_YEARS})


@query("top_groups_detail", "dam:long bairro:string vlr_aberto:double", """
SELECT dam, bairro, vlr_aberto FROM v_dam WHERE bairro IN (SELECT bairro FROM v_dam GROUP BY 1 ORDER BY sum(vlr_aberto) DESC, bairro LIMIT 5)""")
def top_groups_detail(src):
    return W.restricted_to_top(src.dam, "bairro", F.sum("vlr_aberto"), 5)


@query("domain_sort", "tamanho_imovel:string ordem:long dams:long", """
SELECT t.tamanho_imovel, o.ordem, count(*) AS dams FROM (SELECT CASE WHEN area_construida <= 100 THEN 'PEQUENO'
  WHEN area_construida <= 300 THEN 'MEDIO' ELSE 'GRANDE' END AS tamanho_imovel FROM v_dam) t
JOIN (VALUES ('PEQUENO', 0), ('MEDIO', 1), ('GRANDE', 2)) o(tamanho_imovel, ordem) ON o.tamanho_imovel = t.tamanho_imovel
GROUP BY 1, 2 ORDER BY 2""")
def domain_sort(src):
    area = F.col("area_construida")
    sized = src.dam.select(F.when(area <= 100, "PEQUENO").when(area <= 300, "MEDIO").otherwise("GRANDE").alias("tamanho_imovel"))
    counted = sized.groupBy("tamanho_imovel").agg(F.count(F.lit(1)).alias("dams"))
    return counted.join(label_table(src.spark, fv.SIZE_ORDER[:3], "tamanho_imovel"), "tamanho_imovel").orderBy("ordem")


def hash_sql(*columns: str) -> str:
    """The text hash of a key and the seed."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"md5(concat_ws('|', '{fv.SEED}', {parts}))"


def training_sql(*columns: str) -> str:
    """Whether a key belongs to the training share."""
    return f"(CAST('0x' || substr({hash_sql(*columns)}, 1, 8) AS BIGINT) % 10 < 7)"


@query("sample_n", "dam:long id_imovel:long vlr_aberto:double", f"""
SELECT dam, id_imovel, vlr_aberto FROM v_dam ORDER BY {hash_sql('dam', 'id_imovel')}, dam, id_imovel LIMIT 1400""")
def sample_n(src):
    return W.sample_rows(src.dam.select("dam", "id_imovel", "vlr_aberto"), ["dam", "id_imovel"], 1400, seed=fv.SEED)


@query("hash_split", "parte:string linhas:long certificados:long", f"""
SELECT CASE WHEN {training_sql('cda')} THEN 'treino' ELSE 'teste' END AS parte, count(*) AS linhas, count(DISTINCT cda) AS certificados
FROM v_divida GROUP BY 1""")
def hash_split(src):
    part = F.when(W.in_training_share(["cda"], fv.SEED), "treino").otherwise("teste")
    return src.divida.groupBy(part.alias("parte")).agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("cda").alias("certificados"))
