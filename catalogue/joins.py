"""Join queries."""

from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.operators import joins as J
from arrears.operators import cleaning as C
from catalogue.registry import query


@query("join_inner", "cda:long da_aberto:long id_pessoa:long qtd_notas_2anos:long", """
SELECT d.cda, d.da_aberto, d.id_pessoa, n.qtd_notas_2anos FROM v_divida d JOIN v_notas n ON n.id_pessoa = d.id_pessoa""")
def join_inner(src):
    return J.inner(src.divida, src.notas, ["id_pessoa"])


@query("join_left", "dam:long id_contribuinte:long ano_fato_gerador:long hist_valor_total:double reco_debito:long vlr_pago:double", """
SELECT d.dam, d.id_contribuinte, d.ano_fato_gerador, h.hist_valor_total, h.reco_debito, d.vlr_pago
FROM v_dam d LEFT JOIN v_hist h ON h.id_contribuinte = d.id_contribuinte AND h.ano = d.ano_fato_gerador""")
def join_left(src):
    history = src.hist.withColumnRenamed("ano", "ano_fato_gerador")
    return J.left_join(src.dam, history, ["id_contribuinte", "ano_fato_gerador"])


@query("join_left_renamed", "dam:long id_contribuinte:long qtd_notas_2anos:long", """
SELECT d.dam, d.id_contribuinte, n.qtd_notas_2anos FROM v_dam d LEFT JOIN v_notas n ON n.id_pessoa = d.id_contribuinte""")
def join_left_renamed(src):
    return J.left_renamed(src.dam, src.notas, "id_contribuinte", "id_pessoa")


@query("join_full", "id_pessoa:long qtd_notas_2anos:long dividas:long", """
WITH d AS (SELECT id_pessoa, count(*) AS dividas FROM v_divida WHERE da_aberto = 1 GROUP BY 1)
SELECT coalesce(d.id_pessoa, n.id_pessoa) AS id_pessoa, n.qtd_notas_2anos, d.dividas
FROM d FULL JOIN v_notas n ON n.id_pessoa = d.id_pessoa""")
def join_full(src):
    """Open debts and invoices: some taxpayers have only the one, some only the other."""
    debts = src.divida.where(F.col("da_aberto") == 1).groupBy("id_pessoa").agg(F.count(F.lit(1)).alias("dividas"))
    return J.full(debts, src.notas, ["id_pessoa"])


@query("join_full_null_keys", "tipo_propriedade:string pf:long pj:long", """
WITH a AS (SELECT tipo_propriedade, count(*) AS pf FROM v_dam WHERE tipo_contribuinte = 'PF' GROUP BY 1),
b AS (SELECT tipo_propriedade, count(*) AS pj FROM v_dam WHERE tipo_contribuinte = 'PJ' GROUP BY 1)
SELECT coalesce(a.tipo_propriedade, b.tipo_propriedade) AS tipo_propriedade, a.pf, b.pj
FROM a FULL JOIN b ON a.tipo_propriedade IS NOT DISTINCT FROM b.tipo_propriedade""")
def join_full_null_keys(src):
    def of(kind, name):
        return src.dam.where(F.col("tipo_contribuinte") == kind).groupBy("tipo_propriedade").agg(F.count(F.lit(1)).alias(name))

    return J.full_matching_nulls(of("PF", "pf"), of("PJ", "pj"), "tipo_propriedade")


@query("join_right", "id_pessoa:long tipos:long cda:long valor_tot:double", """
WITH k AS (SELECT id_pessoa, count(DISTINCT tipo_divida) AS tipos FROM v_divida GROUP BY 1)
SELECT k.id_pessoa, k.tipos, d.cda, d.valor_tot FROM v_divida d RIGHT JOIN k ON k.id_pessoa = d.id_pessoa AND d.da_aberto = 0""")
def join_right(src):
    kinds = src.divida.groupBy("id_pessoa").agg(F.count_distinct("tipo_divida").alias("tipos"))
    closed, _ = C.partitions(src.divida)
    return J.right(closed.select("id_pessoa", "cda", "valor_tot"), kinds, ["id_pessoa"])


@query("anti_join", "dam:long id_imovel:long", """
SELECT dam, id_imovel FROM v_dam d WHERE ano_fato_gerador = 2001 AND NOT EXISTS (
  SELECT 1 FROM v_dam p WHERE p.ano_fato_gerador = 2000 AND p.id_imovel = d.id_imovel)""")
def anti_join(src):
    year = F.col("ano_fato_gerador")
    return J.anti(src.dam.where(year == 2001), src.dam.where(year == 2000), ["id_imovel"])


@query("semi_join", "dam:long id_imovel:long", """
SELECT dam, id_imovel FROM v_dam d WHERE id_imovel IN (SELECT id_imovel FROM v_dam WHERE vlr_total_dam < 2000)""")
def semi_join(src):
    return J.semi(src.dam, src.dam.where(F.col("vlr_total_dam") < 2000), ["id_imovel"])


@query("lookup_join", "cda:long da_aberto:long situacao_cobranca:long class_situacao_cobranca:string", """
SELECT cda, da_aberto, s AS situacao_cobranca, CASE s WHEN 0 THEN 'INACESSÍVEL' WHEN 1 THEN 'POUQUISSIMO ACESSÍVEL'
  WHEN 2 THEN 'POUCO ACESSÍVEL' WHEN 3 THEN 'BEM ACESSÍVEL' WHEN 4 THEN 'MUITO ACESSÍVEL' END AS class_situacao_cobranca
FROM (SELECT cda, da_aberto, idade_divida % 6 AS s FROM v_divida) t""")
def lookup_join(src):
    scored = src.divida.withColumn("situacao_cobranca", F.col("idade_divida") % 6)
    labels = src.spark.createDataFrame(list(fv.ACCESSIBILITY_LABELS.items()), "situacao_cobranca int, class_situacao_cobranca string")
    return scored.join(F.broadcast(labels), "situacao_cobranca", "left")


@query("suffix_join", "id_imovel:long vlr_aberto_x:double vlr_aberto_y:double vlr_pago_x:double vlr_pago_y:double", """
WITH a AS (SELECT id_imovel, sum(vlr_aberto) AS vlr_aberto, sum(vlr_pago) AS vlr_pago FROM v_dam WHERE ano_fato_gerador = 2000 GROUP BY 1),
b AS (SELECT id_imovel, sum(vlr_aberto) AS vlr_aberto, sum(vlr_pago) AS vlr_pago FROM v_dam WHERE ano_fato_gerador = 2001 GROUP BY 1)
SELECT coalesce(a.id_imovel, b.id_imovel) AS id_imovel, a.vlr_aberto AS vlr_aberto_x, b.vlr_aberto AS vlr_aberto_y,
  a.vlr_pago AS vlr_pago_x, b.vlr_pago AS vlr_pago_y FROM a FULL JOIN b ON a.id_imovel = b.id_imovel""")
def suffix_join(src):
    def of(year):
        return src.dam.where(F.col("ano_fato_gerador") == year).groupBy("id_imovel").agg(
            F.sum("vlr_aberto").alias("vlr_aberto"), F.sum("vlr_pago").alias("vlr_pago"))

    return J.suffixed(of(2000), of(2001), ["id_imovel"])


@query("attach_measures", "dam:long id_contribuinte:long vlr_aberto:double total_contribuinte:double bills:long", """
SELECT dam, d.id_contribuinte, vlr_aberto, g.total_contribuinte, g.bills FROM v_dam d LEFT JOIN (
  SELECT id_contribuinte, sum(vlr_aberto) AS total_contribuinte, count(*) AS bills FROM v_dam
  WHERE id_contribuinte IS NOT NULL GROUP BY 1) g ON g.id_contribuinte = d.id_contribuinte""")
def attach_measures(src):
    return J.attach_measures(src.dam, ["id_contribuinte"], F.sum("vlr_aberto").alias("total_contribuinte"),
                             F.count(F.lit(1)).alias("bills"))
