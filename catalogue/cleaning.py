"""Projection, filter, null-policy, scalar and set queries."""

from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions import scalars as S
from arrears.functions.semantics import capped, differs, guarded, last_wins, present, ratio, round_even
from arrears.operators import cleaning as C
from arrears.operators import sets
from catalogue.registry import query


@query("project_rename_drop", "chave:long situacao:string tipo_divida:string",
       "SELECT cda AS chave, tipo_divida, situacao FROM v_divida")
def project_rename_drop(src):
    shaped = C.reshape(src.divida, ["cda", "tipo_divida", "situacao", "valor_tot"], {"cda": "chave"}, ["valor_tot"])
    texts = C.columns_of_type(shaped)
    return shaped.select("chave", *texts.columns)


@query("filter_forms", "dam:long idade_imovel:long tipo_propriedade:string vlr_aberto:double", """
SELECT dam, idade_imovel, tipo_propriedade, vlr_aberto FROM v_dam
WHERE (vlr_aberto > 0 AND vlr_total_dam >= 3000) AND (idade_imovel > 20 AND idade_imovel <= 50)
  AND tipo_propriedade IN ('CASA', 'LOJA')""")
def filter_forms(src):
    masked = src.dam.where((F.col("vlr_aberto") > 0) & (F.col("vlr_total_dam") >= 3000))
    return masked.where("idade_imovel > 20 AND idade_imovel <= 50").where(F.col("tipo_propriedade").isin("CASA", "LOJA"))


@query("null_policy", "dam:long id_contribuinte:long tipo_propriedade:string atualizacao_cadastro:string sem_pagamento:long", """
SELECT dam, id_contribuinte, coalesce(tipo_propriedade, 'TERRENO') AS tipo_propriedade,
  coalesce(atualizacao_cadastro, '0') AS atualizacao_cadastro,
  CASE WHEN data_ultimo_pagamento IS NULL THEN 1 ELSE 0 END AS sem_pagamento
FROM v_dam WHERE id_contribuinte IS NOT NULL""")
def null_policy(src):
    known = present(src.dam, "id_contribuinte").withColumn(
        "sem_pagamento", F.col("data_ultimo_pagamento").isNull().cast("int"))
    return C.fill_everything(C.fill_nulls(known, {"tipo_propriedade": "TERRENO"}))


@query("case_last_wins", "cda:long faixa:string", """
SELECT cda, CASE WHEN ajuizamento = 1 THEN 'ajuizada' WHEN protesto = 1 THEN 'protestada'
  WHEN valor_tot >= 100000 THEN 'grande' WHEN valor_tot >= 0 THEN 'comum' END AS faixa FROM v_divida""")
def case_last_wins(src):
    value = last_wins([
        (F.col("valor_tot") >= 0, "comum"),
        (F.col("valor_tot") >= 100000, "grande"),
        (F.col("protesto") == 1, "protestada"),
        (F.col("ajuizamento") == 1, "ajuizada"),
    ])
    return src.divida.withColumn("faixa", value)


@query("ratio_guard", "cda:long da_aberto:long percentual:double", """
SELECT cda, da_aberto, CASE WHEN r > 1 THEN 1 ELSE r END AS percentual FROM (
  SELECT cda, da_aberto, CAST(valor_tot AS DOUBLE) /
    CAST(CASE WHEN valor_pago IS NULL OR valor_pago = 0 THEN 1 ELSE valor_pago END AS DOUBLE) / 4 AS r FROM v_divida) t""")
def ratio_guard(src):
    return src.divida.withColumn("percentual", capped(ratio("valor_tot", guarded("valor_pago")) / 4))


@query("replace_values", "dam:long bairro:string tipo_propriedade:string", """
SELECT dam, nullif(trim(bairro), 'NATION_3') AS bairro,
  CASE WHEN trim(tipo_propriedade) = 'GALPAO' THEN 'OUTROS' ELSE trim(tipo_propriedade) END AS tipo_propriedade FROM v_dam""")
def replace_values(src):
    replaced = C.replace_values(src.dam, "bairro", to_null=["NATION_3"])
    return C.replace_values(replaced, "tipo_propriedade", to_value={"GALPAO": "OUTROS"})


@query("exclude_ids", "dam:long id_contribuinte:long", """
SELECT dam, id_contribuinte FROM v_dam WHERE id_contribuinte IS NULL OR id_contribuinte NOT IN (3, 8, 15)""")
def exclude_ids(src):
    return C.exclude(src.dam, "id_contribuinte", [3, 8, 15])


@query("casts", "dam_texto:string ano:long id_contribuinte:long", """
SELECT CAST(dam AS VARCHAR) AS dam_texto, ano_fato_gerador AS ano, id_contribuinte FROM v_dam
WHERE id_contribuinte IS NOT NULL""")
def casts(src):
    keyed = C.typed_key(src.dam.withColumn("id_contribuinte", F.col("id_contribuinte").cast("string")), "id_contribuinte")
    return keyed.select(F.col("dam").cast("string").alias("dam_texto"),
                        F.col("ano_fato_gerador").try_cast("int").alias("ano"), "id_contribuinte")


@query("partition_split", "parte:string linhas:long valor:double", """
SELECT CASE da_aberto WHEN 0 THEN 'fechada' ELSE 'aberta' END AS parte, count(*) AS linhas, sum(valor_tot) AS valor
FROM v_divida GROUP BY 1""")
def partition_split(src):
    closed, open_ = C.partitions(src.divida)
    summary = [F.count(F.lit(1)).alias("linhas"), F.sum("valor_tot").alias("valor")]
    return C.union_all(closed.agg(F.lit("fechada").alias("parte"), *summary), open_.agg(F.lit("aberta").alias("parte"), *summary))


@query("trim_compare", "bairro:string vlr_aberto:double dams:long", """
SELECT bairro, sum(vlr_aberto) AS vlr_aberto, count(*) AS dams FROM v_dam WHERE trim(bairro) = 'NATION_7' GROUP BY bairro""")
def trim_compare(src):
    return src.dam.where(S.trimmed_equals("bairro", "NATION_7")).groupBy("bairro").agg(
        F.sum("vlr_aberto").alias("vlr_aberto"), F.count(F.lit(1)).alias("dams"))


@query("compose_key", "chave:string chave_estrita:string n:long", """
SELECT concat('imovel-', termo_da_unico, cterdiseri) AS chave, 'imovel' || '-' || CAST(termo_da_unico AS VARCHAR) AS chave_estrita,
  count(*) AS n FROM v_parcelamento GROUP BY 1, 2""")
def compose_key(src):
    return src.parcelamento.select(
        S.compose_key("imovel", "termo_da_unico", "cterdiseri").alias("chave"),
        S.compose_key_strict(F.lit("imovel"), "termo_da_unico").alias("chave_estrita"),
    ).groupBy("chave", "chave_estrita").agg(F.count(F.lit(1)).alias("n"))


@query("digits_only", "bairro:string numero:long sem_numero:long", """
SELECT bairro, TRY_CAST(nullif(regexp_replace(bairro, '\\D', '', 'g'), '') AS BIGINT) AS numero,
  TRY_CAST(nullif(regexp_replace(regiao, '\\D', '', 'g'), '') AS BIGINT) AS sem_numero
FROM v_dam GROUP BY bairro, regiao""")
def digits_only(src):
    return src.dam.select("bairro", "regiao").distinct().select(
        "bairro", S.digits_only("bairro").alias("numero"), S.digits_only("regiao").alias("sem_numero"))


@query("interval_labels", "rotulo:string n:long", """
SELECT concat('[', CAST(rpa AS VARCHAR), ', ', CAST(rpa + 1 AS VARCHAR), ')') AS rotulo, count(*) AS n FROM v_dam GROUP BY 1""")
def interval_labels(src):
    limits = src.dam.select(F.col("rpa").alias("inf"), (F.col("rpa") + 1).alias("sup"))
    return limits.groupBy(S.interval_label("inf", "sup").alias("rotulo")).agg(F.count(F.lit(1)).alias("n"))


@query("ratios_rounded", "cda:long da_aberto:long soma:double diferenca:double pct:double pct2:double", """
SELECT cda, da_aberto, valor_tot + valor_pago AS soma, valor_tot - valor_pago AS diferenca,
  round_even(CAST(valor_pago AS DOUBLE)/CAST(valor_tot AS DOUBLE)*100000e0, 0)/100000e0 AS pct,
  round_even(CAST(valor_pago AS DOUBLE)/CAST(valor_tot AS DOUBLE)*100*100e0, 0)/100e0 AS pct2 FROM v_divida""")
def ratios_rounded(src):
    share = ratio("valor_pago", "valor_tot")
    return src.divida.select(
        "cda", "da_aberto", (F.col("valor_tot") + F.col("valor_pago")).alias("soma"),
        (F.col("valor_tot") - F.col("valor_pago")).alias("diferenca"),
        round_even(share, 5).alias("pct"), round_even(share * 100, 2).alias("pct2"))


@query("code_map", "dam:long porte:string porte_numero:long", """
SELECT dam, porte, CASE porte WHEN 'PEQUENO' THEN 2 WHEN 'MEDIO' THEN 3 WHEN 'GRANDE' THEN 4 WHEN 'INDEFINIDO' THEN 1 END AS porte_numero
FROM (SELECT dam, CASE WHEN area_construida <= 60 THEN 'PEQUENO' WHEN area_construida <= 100 THEN 'MEDIO'
  WHEN area_construida <= 400 THEN 'GRANDE' ELSE 'OUTRO' END AS porte FROM v_dam) t""")
def code_map(src):
    area = F.col("area_construida")
    sized = src.dam.withColumn("porte", F.when(area <= 60, "PEQUENO").when(area <= 100, "MEDIO")
                               .when(area <= 400, "GRANDE").otherwise("OUTRO"))
    return sized.withColumn("porte_numero", S.code_map("porte", fv.SIZE_NUMBERS))


def _brazilian(number: str) -> str:
    """Two decimals, thousands apart by points, as text."""
    return f"translate(format('{{:,.2f}}', CAST({number} AS DOUBLE)), ',.', '.,')"


@query("money_text", "bairro:string aberto:string pago:string", f"""
WITH b AS (SELECT bairro, sum(vlr_aberto) AS a, sum(vlr_pago) AS p FROM v_dam GROUP BY bairro)
SELECT bairro, 'R$ ' || {_brazilian('a')} AS aberto,
  {_brazilian('CAST(p AS DOUBLE) / CAST(a + p AS DOUBLE) * 100')} || '%' AS pago FROM b""")
def money_text(src):
    return src.dam.groupBy("bairro").agg(F.sum("vlr_aberto").alias("a"), F.sum("vlr_pago").alias("p")).select(
        "bairro", S.money_text("a").alias("aberto"), S.percent_text(ratio("p", F.col("a") + F.col("p")) * 100).alias("pago"))


@query("date_parts", "cda:long ano:long mes:long idade:long", """
SELECT l_orderkey AS cda, extract(year FROM l_shipdate) AS ano, extract(month FROM l_shipdate) AS mes,
  2002 - extract(year FROM l_shipdate) AS idade FROM v_item""")
def date_parts(src):
    parsed = F.try_to_timestamp(F.col("l_shipdate").cast("string"))
    return src.item.select(F.col("l_orderkey").alias("cda"), F.year(parsed).alias("ano"), F.month(parsed).alias("mes"),
                           S.age_in_years(S.parsed_year("l_shipdate"), 2002).alias("idade"))


SIZE_SQL = """CASE tipo_propriedade
  WHEN 'APARTAMENTO' THEN CASE WHEN area_construida <= 60 THEN 'PEQUENO' WHEN area_construida <= 100 THEN 'MEDIO' ELSE 'GRANDE' END
  WHEN 'CASA' THEN CASE WHEN area_construida <= 100 THEN 'PEQUENO' WHEN area_construida <= 200 THEN 'MEDIO' ELSE 'GRANDE' END
  WHEN 'LOJA' THEN CASE WHEN area_construida <= 50 THEN 'PEQUENO' WHEN area_construida <= 200 THEN 'MEDIO' ELSE 'GRANDE' END
  WHEN 'GALPAO' THEN CASE WHEN area_construida > 200 AND area_construida <= 500 THEN 'PEQUENO'
    WHEN area_construida > 500 AND area_construida <= 2000 THEN 'MEDIO' ELSE 'GRANDE' END
  WHEN 'SALA' THEN CASE WHEN area_construida >= 20 AND area_construida <= 50 THEN 'PEQUENO'
    WHEN area_construida > 50 AND area_construida <= 150 THEN 'MEDIO' ELSE 'GRANDE' END
  ELSE 'INDEFINIDO' END"""


@query("size_class", "dam:long tamanho_imovel:string", f"SELECT dam, {SIZE_SQL} AS tamanho_imovel FROM v_dam")
def size_class(src):
    return src.dam.withColumn("tamanho_imovel", S.size_class())


@query("single_quota", "dam:long cota_unica:long", """
SELECT dam, CASE WHEN extract(month FROM data_ultimo_pagamento) = 1 AND vlr_pago = vlr_total_dam
  AND ano_fato_gerador = extract(year FROM data_ultimo_pagamento) THEN 1 ELSE 0 END AS cota_unica FROM v_dam""")
def single_quota(src):
    return src.dam.withColumn(
        "cota_unica", S.single_quota("data_ultimo_pagamento", "vlr_pago", "vlr_total_dam", "ano_fato_gerador"))


@query("payment_status", "situacao_pagamento:string aberto:long dams:long pago:double", """
SELECT CASE WHEN vlr_pago = vlr_total_dam THEN 'paga' WHEN vlr_pago = 0 THEN 'nao_paga'
  WHEN vlr_pago > 0 AND vlr_pago < vlr_total_dam THEN 'parcial' WHEN vlr_pago > vlr_total_dam THEN 'paga_a_maior' END AS situacao_pagamento,
  CASE WHEN vlr_total_dam <> vlr_pago THEN 1 ELSE 0 END AS aberto, count(*) AS dams, sum(vlr_pago) AS pago
FROM v_dam GROUP BY 1, 2""")
def payment_status(src):
    return src.dam.groupBy(S.payment_status().alias("situacao_pagamento"),
                           S.open_flag("vlr_total_dam", "vlr_pago").alias("aberto")).agg(
        F.count(F.lit(1)).alias("dams"), F.sum("vlr_pago").alias("pago"))


@query("land_rule", "tamanho:string dams:long", """
SELECT CASE WHEN tipo_propriedade IS NULL THEN 'TERRENO' ELSE 'PREDIO' END AS tamanho, count(*) AS dams FROM v_dam GROUP BY 1""")
def land_rule(src):
    sized = src.dam.withColumn("porte", F.lit("PREDIO"))
    return sized.groupBy(S.land_size("tipo_propriedade", "porte").alias("tamanho")).agg(F.count(F.lit(1)).alias("dams"))


HISTORY_COLUMNS = ["ano", "id_contribuinte", "hist_valor_total", "hist_valor_pago", "num_imoveis", "pgt_cota_unica",
                   "reco_inscricao", "reco_debito"]
HISTORY_JSON = " || ',' || ".join(f"""'"{c}":' || CAST({c} AS VARCHAR)""" for c in HISTORY_COLUMNS)


@query("json_records", "ano:long id_contribuinte:long json:string",
       f"SELECT ano, id_contribuinte, '{{' || {HISTORY_JSON} || '}}' AS json FROM v_hist")
def json_records(src):
    return C.json_records(src.hist, ["ano", "id_contribuinte"])


@query("unpivot", "ano:long medida:string valor:double", """
WITH y AS (SELECT ano_fato_gerador AS ano, sum(vlr_pago) AS vlr_pago, sum(vlr_aberto) AS vlr_aberto FROM v_dam GROUP BY 1)
SELECT ano, 'vlr_pago' AS medida, vlr_pago AS valor FROM y UNION ALL SELECT ano, 'vlr_aberto', vlr_aberto FROM y""")
def unpivot(src):
    years = src.dam.groupBy(F.col("ano_fato_gerador").alias("ano")).agg(
        F.sum("vlr_pago").alias("vlr_pago"), F.sum("vlr_aberto").alias("vlr_aberto"))
    return C.to_long(years, ["ano"], ["vlr_pago", "vlr_aberto"], "medida", "valor")


@query("add_dummies", "dam:long tipo_contribuinte:string tipo_contribuinte_PF:long tipo_contribuinte_PJ:long", """
SELECT dam, tipo_contribuinte, CASE WHEN tipo_contribuinte = 'PF' THEN 1 ELSE 0 END AS tipo_contribuinte_PF,
  CASE WHEN tipo_contribuinte = 'PJ' THEN 1 ELSE 0 END AS tipo_contribuinte_PJ FROM v_dam""")
def add_dummies(src):
    return C.one_hot(src.dam, "tipo_contribuinte", ["PF", "PJ"])


@query("union_all", "cda:string tipo_divida:string edificacao:long", """
SELECT concat('imovel-', termo_da_unico, serie_da_cda) AS cda, 'imovel' AS tipo_divida, 1 AS edificacao FROM v_fato_imovel
UNION ALL SELECT concat('mercantil-', termo_da_unico, serie_da_cda), 'mercantil', NULL FROM v_fato_mercantil""")
def union_all(src):
    def labelled(fact, kind):
        return fact.select(S.compose_key(kind, "termo_da_unico", "serie_da_cda").alias("cda"), F.lit(kind).alias("tipo_divida"))

    return C.union_all(labelled(src.fato_imovel, "imovel").withColumn("edificacao", F.lit(1)),
                       labelled(src.fato_mercantil, "mercantil"))


@query("new_entities", "id_contribuinte:long", """
SELECT DISTINCT id_contribuinte FROM v_dam WHERE ano_fato_gerador = 2001 AND id_contribuinte IS NOT NULL
EXCEPT SELECT id_contribuinte FROM v_dam WHERE ano_fato_gerador = 2000""")
def new_entities(src):
    return sets.new_keys(src.dam, "id_contribuinte", "ano_fato_gerador", 2001, 2000)


@query("new_entities_by_year", "ano:long novos:long", """
WITH k AS (SELECT DISTINCT id_contribuinte AS id, ano_fato_gerador AS ano FROM v_dam WHERE id_contribuinte IS NOT NULL)
SELECT a.ano, count(*) AS novos FROM k a WHERE a.ano > (SELECT min(ano) FROM k)
  AND NOT EXISTS (SELECT 1 FROM k b WHERE b.id = a.id AND b.ano = a.ano - 1) GROUP BY a.ano""")
def new_entities_by_year(src):
    return sets.new_against_previous_year(src.dam, "id_contribuinte", "ano_fato_gerador")


@query("cumulative_new", "ano:long total:long novos:long", """
WITH k AS (SELECT DISTINCT id_contribuinte AS id, ano_fato_gerador AS ano FROM v_dam WHERE id_contribuinte IS NOT NULL),
f AS (SELECT id, min(ano) AS first FROM k GROUP BY id)
SELECT k.ano, count(*) AS total, sum(CASE WHEN k.ano = f.first THEN 1 ELSE 0 END) AS novos
FROM k JOIN f ON f.id = k.id GROUP BY k.ano""")
def cumulative_new(src):
    return sets.cumulative_new(src.dam, "id_contribuinte", "ano_fato_gerador")


@query("distinct_rows", "bairro:string tipo_propriedade:string",
       "SELECT DISTINCT bairro, tipo_propriedade FROM v_dam")
def distinct_rows(src):
    return src.dam.select("bairro", "tipo_propriedade").distinct()


@query("not_equal_keeps_missing", "dam:long", "SELECT dam FROM v_dam WHERE tipo_propriedade IS DISTINCT FROM 'CASA'")
def not_equal_keeps_missing(src):
    return src.dam.where(differs("tipo_propriedade", "CASA"))
