"""Property-tax report queries."""

from pyspark.sql import functions as F

from arrears.plans import reports as R
from catalogue.cleaning import SIZE_SQL
from catalogue.registry import query

NOW, BEFORE = 2001, 2000
COHORT_CTE = f"""z AS (SELECT *, {SIZE_SQL} AS tamanho_imovel FROM v_dam),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_imovel ORDER BY dam, id_contribuinte NULLS FIRST, ano_fato_gerador, vlr_total_dam, vlr_pago) AS rn
  FROM z WHERE ano_fato_gerador = {NOW}) t WHERE rn = 1),
n AS (SELECT * FROM one WHERE id_imovel NOT IN (SELECT id_imovel FROM z WHERE ano_fato_gerador = {BEFORE})),
c AS (SELECT id_imovel, id_contribuinte, tipo_propriedade, tipo_contribuinte, tamanho_imovel, vlr_aberto, vlr_pago, vlr_aberto + vlr_pago AS valor_total_devido,
  CAST(vlr_pago AS DOUBLE)/CAST(vlr_aberto + vlr_pago AS DOUBLE)*100 AS percentual_pago FROM n WHERE id_contribuinte IS NOT NULL),
back AS (SELECT * FROM z WHERE ano_fato_gerador = {NOW} AND id_imovel NOT IN (SELECT id_imovel FROM n))"""


@query("cohort_new", "id_imovel:long id_contribuinte:long tipo_propriedade:string tipo_contribuinte:string tamanho_imovel:string vlr_aberto:double vlr_pago:double "
       "valor_total_devido:double percentual_pago:double", f"WITH {COHORT_CTE} SELECT * FROM c")
def cohort_new(src):
    return R.cohort(R.new_property_bills(R.sized(src.dam), NOW, BEFORE))


@query("cohort_paying", "tipo_propriedade:string quantidade:long vlr_pago:double", f"""
WITH {COHORT_CTE} SELECT tipo_propriedade, count(*) AS quantidade, sum(vlr_pago) AS vlr_pago FROM c WHERE vlr_aberto = 0 AND tipo_propriedade IS NOT NULL GROUP BY 1""")
def cohort_paying(src):
    return R.paying_universe(R.cohort(R.new_property_bills(R.sized(src.dam), NOW, BEFORE)))


BEHAVIOUR = """sum(vlr_aberto) AS vlr_aberto, sum(vlr_pago) AS vlr_pago, count(DISTINCT id_imovel) AS imoveis,
  CAST(sum(vlr_aberto) AS DOUBLE)/CAST(count(DISTINCT id_imovel) AS DOUBLE) AS ticket_medio,
  CAST(sum(vlr_pago) AS DOUBLE)/CAST(sum(vlr_pago) + sum(vlr_aberto) AS DOUBLE)*100 AS percentual_pago"""
BEHAVIOUR_SHAPE = "tamanho_imovel:string vlr_aberto:double vlr_pago:double imoveis:long ticket_medio:double percentual_pago:double"


@query("behaviour_by_size", f"tipo_contribuinte:string {BEHAVIOUR_SHAPE}",
       f"SELECT tipo_contribuinte, tamanho_imovel, {BEHAVIOUR} FROM (SELECT *, {SIZE_SQL} AS tamanho_imovel FROM v_dam) z GROUP BY 1, 2")
def behaviour_by_size(src):
    return R.behaviour_by_size(R.sized(src.dam))


@query("cohort_by_size", f"tipo_contribuinte:string {BEHAVIOUR_SHAPE}", f"WITH {COHORT_CTE} SELECT tipo_contribuinte, tamanho_imovel, {BEHAVIOUR} FROM n GROUP BY 1, 2")
def cohort_by_size(src):
    return R.behaviour_by_size(R.new_property_bills(R.sized(src.dam), NOW, BEFORE))


@query("cohort_returning", BEHAVIOUR_SHAPE, f"WITH {COHORT_CTE} SELECT tamanho_imovel, {BEHAVIOUR} FROM back GROUP BY 1")
def cohort_returning(src):
    return R.behaviour_by_size(R.returning_property_bills(R.sized(src.dam), NOW, BEFORE), ["tamanho_imovel"])


@query("cohort_returning_type", "tipo_propriedade:string vlr_pago_total:double vlr_aberto_total:double vlr_total_dam:double percentual_pago:double oportunidade:double", f"""
WITH {COHORT_CTE} SELECT *, percentual_pago*CAST(vlr_aberto_total AS DOUBLE)/100 AS oportunidade FROM (SELECT tipo_propriedade, sum(vlr_pago) AS vlr_pago_total, sum(vlr_aberto) AS vlr_aberto_total,
  sum(vlr_total_dam) AS vlr_total_dam, CAST(sum(vlr_pago) AS DOUBLE)/CAST(sum(vlr_pago) + sum(vlr_aberto) AS DOUBLE)*100 AS percentual_pago
  FROM back WHERE tipo_propriedade IS NOT NULL GROUP BY 1) t""")
def cohort_returning_type(src):
    return R.returning_by_type(R.sized(src.dam), NOW, BEFORE)


@query("neighbourhood_ranking", "bairro:string quantidade_id_imovel:long soma_vlr_aberto:double pode_ser_pago:double", f"""
SELECT bairro, count(DISTINCT id_imovel) AS quantidade_id_imovel, sum(vlr_aberto) AS soma_vlr_aberto, CAST(sum(vlr_aberto) AS DOUBLE)*0.87e0 AS pode_ser_pago
FROM (SELECT *, {SIZE_SQL} AS t FROM v_dam WHERE idade_imovel <= 20) z WHERE t = 'PEQUENO' AND vlr_aberto > 0 GROUP BY 1""")
def neighbourhood_ranking(src):
    small = R.sized(src.dam.where("idade_imovel <= 20")).where(F.col("tamanho_imovel") == "PEQUENO")
    return R.neighbourhood_ranking(small, 0.87)


@query("below_average", "bairro:string vlr_aberto:double vlr_pago:double percentual_pago:double media_geral:double", f"""
WITH g AS (SELECT bairro, sum(vlr_aberto) AS vlr_aberto, sum(vlr_pago) AS vlr_pago FROM v_dam WHERE ano_fato_gerador = {NOW} GROUP BY 1),
o AS (SELECT CAST(sum(vlr_pago) AS DOUBLE)/CAST(sum(vlr_aberto) + sum(vlr_pago) AS DOUBLE)*100 AS m FROM g)
SELECT * FROM (SELECT *, CAST(vlr_pago AS DOUBLE)/CAST(vlr_aberto + vlr_pago AS DOUBLE)*100 AS percentual_pago, (SELECT m FROM o) AS media_geral FROM g) t WHERE percentual_pago < media_geral""")
def below_average(src):
    return R.below_average(src.dam.where(F.col("ano_fato_gerador") == NOW))


YEAR_TOTAL_SQL = """SELECT {0}, sum(vlr_aberto) AS vlr_aberto, sum(vlr_pago) AS vlr_pago, sum(vlr_aberto) + sum(vlr_pago) AS valor_devido,
  CAST(sum(vlr_pago) AS DOUBLE)/CAST(sum(vlr_aberto) + sum(vlr_pago) AS DOUBLE)*100 AS percentual_pago FROM v_dam GROUP BY 1"""
YEAR_TOTAL_SHAPE = "{0}:long vlr_aberto:double vlr_pago:double valor_devido:double percentual_pago:double"


@query("year_totals", YEAR_TOTAL_SHAPE.format("ano_fato_gerador"), YEAR_TOTAL_SQL.format("ano_fato_gerador"))
def year_totals(src):
    return R.year_totals(src.dam)


@query("age_totals", YEAR_TOTAL_SHAPE.format("idade_imovel"), YEAR_TOTAL_SQL.format("idade_imovel"))
def age_totals(src):
    return R.year_totals(src.dam, "idade_imovel")
