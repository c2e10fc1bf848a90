"""Rating, collection-list and class queries."""

from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.ratings import quantile_rating, rating
from arrears.functions.semantics import round_even
from arrears.plans import collection as K
from catalogue.aggregates import FREQUENCY_SHAPE, band_frequency_sql
from catalogue.registry import query
from catalogue.stores import ACCESS_CTE, taxpayers

V1_SQL = """CASE WHEN igr = 0 THEN 'BAIXISSIMA' WHEN classe = 3 THEN 'ALTISSIMA' WHEN classe = 1 THEN 'BAIXA'
  WHEN classe = 2 THEN CASE WHEN igr >= 0.5 THEN 'ALTISSIMA' WHEN igr >= 0.1 THEN 'ALTA' ELSE 'MEDIA' END
  WHEN classe = 0 THEN CASE WHEN igr >= 0.5 THEN 'ALTA' WHEN igr >= 0.05 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 4 THEN CASE WHEN igr >= 0.3 THEN 'ALTA' WHEN igr >= 0.1 THEN 'MEDIA' ELSE 'BAIXA' END END"""
V15_SQL = """CASE WHEN igr = 0 THEN 'BAIXISSIMA' WHEN classe = 2 THEN 'ALTISSIMA' WHEN classe = 0 THEN 'BAIXA'
  WHEN classe = 1 THEN CASE WHEN igr >= 0.5 THEN 'ALTA' WHEN igr >= 0.1 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 3 THEN CASE WHEN igr >= 0.5 THEN 'ALTISSIMA' WHEN igr >= 0.05 THEN 'ALTA' ELSE 'MEDIA' END
  WHEN classe = 4 THEN CASE WHEN igr >= 0.3 THEN 'ALTA' WHEN igr >= 0.1 THEN 'MEDIA' ELSE 'BAIXA' END END"""
K5_SQL = """CASE WHEN igr = 0 THEN 'BAIXISSIMA' WHEN classe = 2 THEN 'BAIXA'
  WHEN classe = 3 THEN CASE WHEN igr >= 0.9 THEN 'ALTA' WHEN igr >= 0.6 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 1 THEN CASE WHEN igr >= 0.9 THEN 'ALTISSIMA' WHEN igr >= 0.6 THEN 'ALTA' WHEN igr >= 0.2 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 4 THEN CASE WHEN igr >= 0.7 THEN 'ALTISSIMA' WHEN igr >= 0.3 THEN 'ALTA' ELSE 'MEDIA' END
  WHEN classe = 0 THEN CASE WHEN igr >= 0.4 THEN 'ALTISSIMA' WHEN igr >= 0.1 THEN 'ALTA' ELSE 'MEDIA' END
  WHEN classe = 5 THEN CASE WHEN igr >= 0.3 THEN 'ALTISSIMA' WHEN igr >= 0.1 THEN 'ALTA' ELSE 'MEDIA' END END"""
K6_SQL = """CASE WHEN igr = 0 THEN 'BAIXISSIMA' WHEN classe = 0 THEN 'BAIXA'
  WHEN classe = 5 THEN CASE WHEN igr >= 0.9 THEN 'ALTA' WHEN igr >= 0.6 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 1 THEN CASE WHEN igr >= 0.6 THEN 'ALTA' WHEN igr >= 0.3 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 2 THEN CASE WHEN igr >= 0.8 THEN 'ALTISSIMA' WHEN igr >= 0.6 THEN 'ALTA' WHEN igr >= 0.2 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 3 THEN CASE WHEN igr >= 0.9 THEN 'ALTISSIMA' WHEN igr >= 0.6 THEN 'ALTA' WHEN igr >= 0.2 THEN 'MEDIA' ELSE 'BAIXA' END
  WHEN classe = 4 THEN CASE WHEN igr >= 0.3 THEN 'ALTISSIMA' WHEN igr >= 0.1 THEN 'ALTA' ELSE 'MEDIA' END
  WHEN classe = 6 THEN CASE WHEN igr >= 0.3 THEN 'ALTISSIMA' WHEN igr >= 0.1 THEN 'ALTA' ELSE 'MEDIA' END END"""
RATED_SHAPE = "cda:long tipo_divida:string id_pessoa:long da_aberto:long igr:double rating_divida:string"


def _rated_sql(case, column):
    return f"SELECT cda, tipo_divida, id_pessoa, da_aberto, valor_total_da, idade_divida, igr, {case} AS rating_divida FROM (SELECT *, {column} AS classe FROM v_score) s"


def _register_rating(variant, case, column):
    @query(f"rating_{variant}", RATED_SHAPE, _rated_sql(case, column))
    def rated(src):
        return src.score.withColumn("rating_divida", rating(variant, column))


for _variant, _case, _column in [("v1", V1_SQL, "classe_5"), ("v15", V15_SQL, "classe_5"), ("k5", K5_SQL, "classe_6"), ("k6", K6_SQL, "classe_7")]:
    _register_rating(_variant, _case, _column)

QUANTILE_CTE = """qq AS (SELECT classe_5 AS classe, quantile_cont(igr, 0.5) AS q50, quantile_cont(igr, 0.75) AS q75 FROM v_score GROUP BY 1),
qr AS (SELECT s.*, CASE WHEN s.classe_5 = 4 THEN 'ALTA' WHEN igr = 0 AND NOT (s.classe_5 IN (1, 3) AND igr >= q50) THEN 'BAIXISSIMA'
  WHEN s.classe_5 = 2 THEN 'ALTISSIMA' WHEN s.classe_5 = 0 THEN 'BAIXA'
  WHEN s.classe_5 = 1 THEN CASE WHEN igr >= q75 THEN 'ALTISSIMA' WHEN igr >= q50 THEN 'ALTA' ELSE 'MEDIA' END
  WHEN s.classe_5 = 3 THEN CASE WHEN igr >= q75 THEN 'ALTA' WHEN igr >= q50 THEN 'MEDIA' ELSE 'BAIXA' END END AS rating_divida
FROM v_score s JOIN qq ON qq.classe = s.classe_5)"""


@query("rating_quantile", RATED_SHAPE, f"WITH {QUANTILE_CTE} SELECT * FROM qr")
def rating_quantile(src):
    return quantile_rating(src.score, "classe_5")


def _both(src):
    rated = src.score.withColumn("rating_orig", rating("k5", "classe_5"))
    return quantile_rating(rated, "classe_5")


BOTH_CTE = f"{QUANTILE_CTE}, bo AS (SELECT *, {K5_SQL.replace('classe ', 'classe_5 ')} AS rating_orig FROM qr)"


@query("rating_compare", "cda:long tipo_divida:string id_pessoa:long da_aberto:long rating_orig:string rating_divida:string", f"""
WITH {BOTH_CTE} SELECT * FROM bo WHERE rating_orig IS DISTINCT FROM rating_divida""")
def rating_compare(src):
    return K.compare_ratings(_both(src), "rating_orig", "rating_divida")[0]


@query("rating_crosstab", "rating_orig:string " + " ".join(f"{r}:long" for r in fv.RATING_ORDER), f"""
WITH {BOTH_CTE} SELECT rating_orig, {', '.join(f"sum(CASE WHEN rating_divida = '{r}' THEN 1 ELSE 0 END) AS {r}" for r in fv.RATING_ORDER)} FROM bo GROUP BY 1""")
def rating_crosstab(src):
    return K.compare_ratings(_both(src), "rating_orig", "rating_divida")[1]


def open_rated(src):
    return src.score.where(F.col("da_aberto") == 1).withColumn("rating_divida", rating("k5", "classe_6"))


@query("rating_summary", "rating_divida:string ordem_rating:long cda:long valor_total_da:double total_cda:long total_vlr_tot_da:double perc_cda:double perc_vlr_tot_da:double", f"""
WITH r AS ({_rated_sql(K5_SQL, 'classe_6')}), g AS (SELECT rating_divida, count(DISTINCT cda) AS cda, sum(valor_total_da) AS v FROM r WHERE da_aberto = 1 GROUP BY 1)
SELECT g.rating_divida, o.ordem AS ordem_rating, cda, v AS valor_total_da, (SELECT sum(cda) FROM g) AS total_cda, (SELECT sum(v) FROM g) AS total_vlr_tot_da,
  round_even(CAST(cda AS DOUBLE)/CAST((SELECT sum(cda) FROM g) AS DOUBLE)*10000e0, 0)/10000e0 AS perc_cda,
  round_even(CAST(v AS DOUBLE)/CAST((SELECT sum(v) FROM g) AS DOUBLE)*10000e0, 0)/10000e0 AS perc_vlr_tot_da
FROM g JOIN (VALUES ('ALTISSIMA', 0), ('ALTA', 1), ('MEDIA', 2), ('BAIXA', 3), ('BAIXISSIMA', 4)) o(rating, ordem) ON o.rating = g.rating_divida""")
def rating_summary(src):
    return K.rating_summary(open_rated(src))


@query("collection_lists", "tipo_divida:string acao:string cda:long id_pessoa:long idade_divida:long valor_total_da:double qtd_notas_2anos:long edificacao:long "
       "situacao:string endereco_existe:long cpf_cnpj_existe:long igr:double rating_divida:string", f"""
WITH {ACCESS_CTE}, r AS ({_rated_sql(K5_SQL, 'classe_6')})
SELECT r.tipo_divida, CASE WHEN r.valor_total_da < 3000 THEN 'negativar' WHEN r.valor_total_da < CASE r.tipo_divida WHEN 'imovel' THEN 50000 ELSE 200000 END THEN 'protesto'
    ELSE 'ajuizamento' END AS acao, r.cda, r.id_pessoa, r.idade_divida, r.valor_total_da, a.qtd_notas_2anos, d.edificacao, d.situacao, d.endereco_existe,
  d.cpf_cnpj_existe, r.igr, r.rating_divida
FROM r LEFT JOIN v_divida d ON d.cda = r.cda AND d.tipo_divida = r.tipo_divida AND d.id_pessoa = r.id_pessoa AND d.da_aberto = r.da_aberto
LEFT JOIN a ON a.id_pessoa = r.id_pessoa AND a.tipo_divida = r.tipo_divida AND a.da_aberto = r.da_aberto
WHERE r.da_aberto = 1 AND d.ajuizamento = 0 AND d.protesto = 0 AND r.idade_divida >= 0 AND r.idade_divida <= 3
  AND r.rating_divida IN ('MEDIA', 'ALTA', 'ALTISSIMA') AND r.valor_total_da >= 1000""")
def collection_lists(src):
    return K.collection_lists(open_rated(src), src.divida, taxpayers(src))


@query("class_dimension", "class_contribuinte:long class_contribuinte_nome:string class_contribuinte_perfil:string pessoas:long", f"""
WITH {ACCESS_CTE} SELECT c.*, count(DISTINCT a.id_pessoa) AS pessoas FROM (VALUES (0, 'DEVEDOR PESSIMO', 'NAO PAGA INACESSIVEL'), (3, 'DEVEDOR RUIM', 'NAO PAGA ACESSIVEL'),
  (1, 'DEVEDOR CONTUMAZ', 'NEGOCIADOR MTS PARC'), (4, 'DEVEDOR BOM', 'PAGADOR NEGOCIADOR'), (2, 'DEVEDOR EXCEL', 'PAGADOR ORGANICO'), (5, 'PRIMEIRA DIVIDA', 'NOVO EM DIVIDA'))
  c(class_contribuinte, class_contribuinte_nome, class_contribuinte_perfil) LEFT JOIN a ON a.class_contribuinte = c.class_contribuinte GROUP BY 1, 2, 3""")
def class_dimension(src):
    counted = taxpayers(src).groupBy("class_contribuinte").agg(F.count_distinct("id_pessoa").alias("pessoas"))
    return F.broadcast(K.class_dimension(src.spark)).join(counted, "class_contribuinte", "left").fillna(0, ["pessoas"])


FIRST_CTE = ACCESS_CTE + ", fd AS (SELECT *, least(historico_pagamento_em_valor, 1e0) AS h FROM a WHERE da_aberto = 0 AND num_dist_cda = 1)"


@query("first_debt_accessibility", "situacao_cobranca:long pessoas:long total_pessoas:long perc_pessoas:double", f"""
WITH {FIRST_CTE}, g AS (SELECT situacao_cobranca, count(DISTINCT id_pessoa) AS pessoas FROM fd GROUP BY 1)
SELECT *, (SELECT sum(pessoas) FROM g) AS total_pessoas, round_even(CAST(pessoas AS DOUBLE)/CAST((SELECT sum(pessoas) FROM g) AS DOUBLE)*100000e0, 0)/100000e0 AS perc_pessoas FROM g""")
def first_debt_accessibility(src):
    return K.first_debt_accessibility(taxpayers(src))


@query("first_debt_profile", FREQUENCY_SHAPE, f"WITH {FIRST_CTE}, " + band_frequency_sql(fv.PAID_RATIO_EDGES, "h", "fd", 4).strip()[5:])
def first_debt_profile(src):
    return K.first_debt_bands(taxpayers(src))


@query("first_debt_means", "situacao_cobranca:double num_dist_cda:double quantidade_reparcelamento:double historico_pagamento_em_valor:double", f"""
WITH {FIRST_CTE} SELECT avg(situacao_cobranca) AS situacao_cobranca, avg(num_dist_cda) AS num_dist_cda, avg(quantidade_reparcelamento) AS quantidade_reparcelamento,
  round_even(avg(h)*1e9, 0)/1e9 AS historico_pagamento_em_valor FROM fd""")
def first_debt_means(src):
    return K.first_debt_means(taxpayers(src)).withColumn("historico_pagamento_em_valor", round_even("historico_pagamento_em_valor", 9))


@query("dual_type_taxpayers", "id_pessoa:long tipo_divida:string cda:long valor_tot:double num_dist_cda:long", """
WITH t AS (SELECT id_pessoa, count(DISTINCT cda) AS num_dist_cda FROM v_divida WHERE da_aberto = 0 GROUP BY 1 HAVING count(DISTINCT tipo_divida) > 1)
SELECT d.id_pessoa, d.tipo_divida, count(DISTINCT d.cda) AS cda, sum(d.valor_tot) AS valor_tot, t.num_dist_cda
FROM v_divida d JOIN t ON t.id_pessoa = d.id_pessoa WHERE d.da_aberto = 0 GROUP BY 1, 2, t.num_dist_cda""")
def dual_type_taxpayers(src):
    return K.dual_type_taxpayers(src.divida)


CLASS_NAMES = [name for _, name, _ in fv.CLASSES_V2]
CLASS_COLUMNS = {name: name.replace(" ", "_") for name in CLASS_NAMES}


@query("dual_type_classes", "imovel:string " + " ".join(f"{c}:long" for c in CLASS_COLUMNS.values()), f"""
WITH {ACCESS_CTE}, i AS (SELECT * FROM a WHERE da_aberto = 0 AND tipo_divida = 'imovel'), m AS (SELECT * FROM a WHERE da_aberto = 0 AND tipo_divida = 'mercantil')
SELECT i.class_contribuinte_nome AS imovel, {', '.join(f"sum(CASE WHEN m.class_contribuinte_nome = '{n}' THEN 1 ELSE 0 END) AS {c}" for n, c in CLASS_COLUMNS.items())}
FROM i JOIN m ON m.id_pessoa = i.id_pessoa GROUP BY 1""")
def dual_type_classes(src):
    return K.dual_type_classes(taxpayers(src), CLASS_NAMES).withColumnsRenamed(CLASS_COLUMNS)


@query("class_distribution", "parte:string class_contribuinte_nome:string pessoas:long total_pessoas:long perc_pessoas:double", f"""
WITH {ACCESS_CTE}, x AS (SELECT 'todas' AS parte, * FROM a UNION ALL SELECT CASE da_aberto WHEN 0 THEN 'fechada' ELSE 'aberta' END, * FROM a),
g AS (SELECT parte, class_contribuinte_nome, count(id_pessoa) AS pessoas FROM x GROUP BY 1, 2)
SELECT *, sum(pessoas) OVER (PARTITION BY parte) AS total_pessoas,
  round_even(CAST(pessoas AS DOUBLE)/CAST(sum(pessoas) OVER (PARTITION BY parte) AS DOUBLE)*100000e0, 0)/100000e0 AS perc_pessoas FROM g""")
def class_distribution(src):
    return K.class_distribution(taxpayers(src))
