"""Feature-store queries."""

from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions import scalars as S
from arrears.functions.semantics import round_even
from arrears.operators import extract as X
from arrears.plans import features as P
from catalogue.extraction import BUSINESS_SQL, PROPERTY_SQL
from catalogue.registry import query

REFERENCE_YEAR = 2002


@query("certificate_totals", "cda:long tipo_divida:string id_pessoa:long valor_tot:double valor_pago:double valor_aberto:double "
       "dif_tot_pago:double dif_tot_pago_aberto:double", """
SELECT *, round_even(CAST(dif_tot_pago - valor_aberto AS DOUBLE)*100000e0, 0)/100000e0 AS dif_tot_pago_aberto FROM (
  SELECT cda, tipo_divida, id_pessoa, sum(valor_tot) AS valor_tot, sum(valor_pago) AS valor_pago,
    sum(CASE WHEN da_aberto = 1 THEN valor_tot - valor_pago END) AS valor_aberto, sum(valor_tot) - sum(valor_pago) AS dif_tot_pago
  FROM v_divida GROUP BY 1, 2, 3) t""")
def certificate_totals(src):
    return P.certificate_totals(src.divida)


DETAIL_SQL = """SELECT b.*, t.vt AS valor_tot_p, t.vp AS valor_pago_p FROM v_divida b JOIN (
  SELECT cda, tipo_divida, id_pessoa, da_aberto, CASE WHEN sum(valor_tot) = 0 THEN 1 ELSE sum(valor_tot) END AS vt, sum(valor_pago) AS vp
  FROM v_divida GROUP BY 1, 2, 3, 4) t ON t.cda = b.cda AND t.tipo_divida = b.tipo_divida AND t.id_pessoa = b.id_pessoa AND t.da_aberto = b.da_aberto"""


@query("certificate_detail", "cda:long tipo_divida:string id_pessoa:long da_aberto:long situacao:string idade_divida:long valor_tot:double "
       "valor_pago:double valor_aberto:double perc_pago:double", f"""
SELECT cda, tipo_divida, id_pessoa, da_aberto, situacao, idade_divida, valor_tot_p AS valor_tot, valor_pago_p AS valor_pago,
  CASE WHEN da_aberto = 1 THEN valor_tot - valor_pago END AS valor_aberto,
  round_even(CAST(valor_pago_p AS DOUBLE)/CAST(valor_tot_p AS DOUBLE)*100000e0, 0)/100000e0 AS perc_pago FROM ({DETAIL_SQL}) d""")
def certificate_detail(src):
    return P.certificate_detail(src.divida)


@query("debt_store", "cda:long tipo_divida:string id_pessoa:long da_aberto:long valor_total_da:double valor_pago:double percentual_pago_cda:double", f"""
SELECT cda, tipo_divida, id_pessoa, da_aberto, valor_tot_p AS valor_total_da, valor_pago_p AS valor_pago,
  least(CAST(valor_pago_p AS DOUBLE)/CAST(valor_tot_p AS DOUBLE), 1e0) AS percentual_pago_cda FROM ({DETAIL_SQL}) d""")
def debt_store(src):
    return P.debt_store(src.divida)


PROFILE_CTE = """p AS (SELECT d.*, n.qtd_notas_2anos FROM (SELECT id_pessoa, tipo_divida, da_aberto, count(DISTINCT cda) AS num_dist_cda,
    sum(quantidade_reparcelamento) AS quantidade_reparcelamento, sum(valor_tot) AS valor_tot, sum(valor_pago) AS valor_pago,
    max(edificacao) AS edificacao, min(situacao) AS situacao, max(cpf_cnpj_existe) AS cpf_cnpj_existe, max(endereco_existe) AS endereco_existe
  FROM v_divida GROUP BY 1, 2, 3) d LEFT JOIN v_notas n ON n.id_pessoa = d.id_pessoa)"""
ACCESS_CTE = PROFILE_CTE + """,
a0 AS (SELECT *, CASE WHEN tipo_divida = 'imovel' THEN CASE WHEN edificacao = 1 THEN 2 ELSE 0 END
    WHEN coalesce(qtd_notas_2anos, 0) > 0 AND situacao = 'ATIVO' THEN 2
    WHEN coalesce(qtd_notas_2anos, 0) > 0 OR situacao = 'ATIVO' THEN 1 ELSE 0 END AS perfil_acessivel FROM p),
a AS (SELECT id_pessoa, tipo_divida, da_aberto, num_dist_cda, quantidade_reparcelamento, valor_tot, valor_pago, edificacao, situacao,
    coalesce(qtd_notas_2anos, 0) AS qtd_notas_2anos, perfil_acessivel,
    CASE WHEN tipo_divida = 'imovel' AND perfil_acessivel = 0 THEN 1 WHEN perfil_acessivel = 0 OR cpf_cnpj_existe = 0 THEN 0
      ELSE perfil_acessivel + cpf_cnpj_existe + endereco_existe END AS situacao_cobranca,
    CAST(valor_pago AS DOUBLE)/CAST(CASE WHEN valor_tot = 0 THEN 1 ELSE valor_tot END AS DOUBLE) AS historico_pagamento_em_valor,
    id_pessoa % 6 AS class_contribuinte, CASE id_pessoa % 6 WHEN 0 THEN 'DEVEDOR PESSIMO' WHEN 1 THEN 'DEVEDOR CONTUMAZ'
      WHEN 2 THEN 'DEVEDOR EXCEL' WHEN 3 THEN 'DEVEDOR RUIM' WHEN 4 THEN 'DEVEDOR BOM' ELSE 'PRIMEIRA DIVIDA' END AS class_contribuinte_nome,
    CAST(id_pessoa % 6 AS DOUBLE)/2 - 1 AS class_contribuinte_peso FROM a0)"""


def taxpayers(src):
    """Accessibility frame with a class derived from the key, as the trained classifier would add it."""
    names = {number: name for number, name, _ in fv.CLASSES_V2}
    scored = P.accessibility(P.taxpayer_profile(src.divida, src.notas))
    return (
        scored.withColumn("class_contribuinte", (F.col("id_pessoa") % 6).cast("int"))
        .withColumn("class_contribuinte_nome", S.code_map("class_contribuinte", names))
        .withColumn("class_contribuinte_peso", F.col("class_contribuinte").cast("double") / 2 - 1)
    )


@query("taxpayer_profile", "id_pessoa:long tipo_divida:string da_aberto:long num_dist_cda:long quantidade_reparcelamento:long valor_tot:double "
       "valor_pago:double edificacao:long situacao:string cpf_cnpj_existe:long endereco_existe:long qtd_notas_2anos:long",
       f"WITH {PROFILE_CTE} SELECT * FROM p")
def taxpayer_profile(src):
    return P.taxpayer_profile(src.divida, src.notas)


@query("accessibility", "id_pessoa:long tipo_divida:string da_aberto:long perfil_acessivel:long situacao_cobranca:long "
       "class_situacao_cobranca:string historico_pagamento_em_valor:double", f"""
WITH {ACCESS_CTE} SELECT id_pessoa, tipo_divida, da_aberto, perfil_acessivel, situacao_cobranca, CASE situacao_cobranca WHEN 0 THEN 'INACESSÍVEL'
  WHEN 1 THEN 'POUQUISSIMO ACESSÍVEL' WHEN 2 THEN 'POUCO ACESSÍVEL' WHEN 3 THEN 'BEM ACESSÍVEL' WHEN 4 THEN 'MUITO ACESSÍVEL' END AS class_situacao_cobranca,
  historico_pagamento_em_valor FROM a""")
def accessibility(src):
    return P.accessibility(P.taxpayer_profile(src.divida, src.notas))


SLICE_SHAPE = ("id_pessoa:long tipo_divida:string situacao_cobranca:long num_dist_cda:long quantidade_reparcelamento:long "
               "historico_pagamento_em_valor:double")


@query("training_slice", SLICE_SHAPE, f"WITH {ACCESS_CTE} SELECT * FROM a WHERE da_aberto = 0 AND num_dist_cda > 1")
def training_slice(src):
    return P.training_slice(taxpayers(src))


@query("scoring_slice", SLICE_SHAPE, f"WITH {ACCESS_CTE} SELECT * FROM a WHERE da_aberto = 1")
def scoring_slice(src):
    return P.scoring_slice(taxpayers(src))


STORE_V1_CTE = f"""im AS ({PROPERTY_SQL}), me AS ({BUSINESS_SQL}),
u AS (SELECT cda, id_pessoa, situacao, cpf_existe, edificacao, deb_totais, deb_pagos, valor_tot, valor_pago FROM im WHERE id_pessoa IS NOT NULL
  UNION ALL SELECT cda, id_pessoa, situacao, cpf_existe, NULL, deb_totais, deb_pagos, valor_tot, valor_pago FROM me WHERE id_pessoa IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY id_pessoa ORDER BY cda) AS rn FROM u),
g AS (SELECT id_pessoa, count(cda) AS frequencia_da_pessoa, sum(deb_totais) AS total_debitos_pessoa, sum(deb_pagos) AS debitos_pagos_pessoa,
  sum(valor_tot) AS valor_total_pessoa, sum(valor_pago) AS valor_pago_pessoa FROM u GROUP BY 1),
s0 AS (SELECT g.*, f.situacao, f.cpf_existe, coalesce(f.edificacao, 1) AS edificacao, f.deb_totais, f.deb_pagos, f.valor_tot, f.valor_pago,
  coalesce(n.qtd_notas_2anos, 0) AS qtd_notas_2anos, CASE WHEN f.situacao = 'ATIVO' OR coalesce(n.qtd_notas_2anos, 0) > 0 THEN 1 ELSE 0 END AS situacao_ativa
  FROM g JOIN f ON f.id_pessoa = g.id_pessoa AND f.rn = 1 LEFT JOIN v_notas n ON n.id_pessoa = g.id_pessoa),
s1 AS (SELECT *, CASE WHEN situacao_ativa = 0 THEN 0 ELSE situacao_ativa + cpf_existe + edificacao END AS status_situacao,
  CAST(debitos_pagos_pessoa AS DOUBLE)/CAST(total_debitos_pessoa AS DOUBLE) + 1 AS historico_pagamento_em_qtd,
  CAST(valor_pago_pessoa AS DOUBLE)/CAST(valor_total_pessoa AS DOUBLE) + 1 AS historico_pagamento_em_valor,
  CASE WHEN frequencia_da_pessoa = 1 THEN 4 ELSE id_pessoa % 4 END AS class_contribuinte FROM s0),
st AS (SELECT *, CASE class_contribuinte WHEN 0 THEN 'PAGADOR INTERMEDIARIO' WHEN 1 THEN 'PIOR PAGADOR' WHEN 2 THEN 'BOM PAGADOR'
    WHEN 3 THEN 'MELHOR PAGADOR' ELSE 'PRIMEIRA DIVIDA' END AS class_contribuinte_nome,
  CASE class_contribuinte WHEN 0 THEN 1e0 WHEN 1 THEN -1.37166e0 WHEN 2 THEN 3.79174e0 WHEN 3 THEN 11.19087e0 ELSE 1e0 END AS class_contribuinte_peso FROM s1)"""
STORE_V1_SHAPE = ("id_pessoa:long situacao:string cpf_existe:long edificacao:long qtd_notas_2anos:long situacao_ativa:long status_situacao:long "
                  "deb_totais:long deb_pagos:long valor_tot:double valor_pago:double frequencia_da_pessoa:long total_debitos_pessoa:long "
                  "debitos_pagos_pessoa:long valor_total_pessoa:double valor_pago_pessoa:double historico_pagamento_em_qtd:double "
                  "historico_pagamento_em_valor:double class_contribuinte:long class_contribuinte_nome:string class_contribuinte_peso:double")


def certificates(src):
    return (X.property_certificates(src.fato_imovel, src.dim_imovel), X.business_certificates(src.fato_mercantil, src.dim_mercantil))


def store_v1(src):
    store = P.taxpayer_store_v1(*certificates(src), src.notas)
    return P.with_class_labels_v1(store.withColumn("class_contribuinte", F.col("id_pessoa") % 4))


@query("taxpayer_store_v1", STORE_V1_SHAPE, f"WITH {STORE_V1_CTE} SELECT * FROM st")
def taxpayer_store_v1(src):
    return store_v1(src)


PARCEL_CTE = """pc AS (SELECT concat(CAST(termo_da_unico AS VARCHAR), cterdiseri) AS cda, adimovsequ AS id_imovel,
  vl_arr_principal AS total_valor_pago, vl_lanc_principal AS valor_lancado_total, qtd_reparcelamentos AS quantidade_reparcelamentos
  FROM v_parcelamento WHERE termo_da_unico IS NOT NULL),
pr AS (SELECT cda, quantidade_reparcelamentos, taxa AS parcela_taxa_pagamento_valor FROM (SELECT *, row_number() OVER (PARTITION BY cda
    ORDER BY quantidade_reparcelamentos, taxa) AS rn FROM (SELECT (CASE WHEN id_imovel IS NULL THEN 'mercantil' ELSE 'imovel' END) || '-' || cda AS cda,
    quantidade_reparcelamentos, CAST(total_valor_pago AS DOUBLE)/CAST(valor_lancado_total AS DOUBLE) AS taxa FROM pc) q) r WHERE rn = 1)"""


def parcels(src):
    return src.parcelamento.where(F.col("termo_da_unico").isNotNull()).select(
        F.concat(F.col("termo_da_unico").cast("string"), "cterdiseri").alias("cda"), F.col("adimovsequ").alias("id_imovel"),
        F.col("vl_arr_principal").alias("total_valor_pago"), F.col("vl_lanc_principal").alias("valor_lancado_total"),
        F.col("qtd_reparcelamentos").alias("quantidade_reparcelamentos"))


DEBT_V1_CTE = f"""{PARCEL_CTE}, dv AS (SELECT u.cda, u.id_pessoa, u.tipo_divida, u.valor_tot AS valor_total_da, u.valor_pago, divida_protestada, divida_ajuizada,
  extract(year FROM t.data) AS ano_inscricao_da, {REFERENCE_YEAR} - extract(year FROM t.data) AS anos_idade_da,
  CAST(u.valor_pago AS DOUBLE)/CAST(u.valor_tot AS DOUBLE) AS percentual_pago_cda, pr.quantidade_reparcelamentos, pr.parcela_taxa_pagamento_valor
FROM (SELECT cda, id_pessoa, tipo_divida, valor_tot, valor_pago, divida_protestada, divida_ajuizada, inscricao_divida FROM im
  UNION ALL SELECT cda, id_pessoa, tipo_divida, valor_tot, valor_pago, divida_protestada, divida_ajuizada, inscricao_divida FROM me) u
LEFT JOIN v_dim_tempo t ON t.chave_tempo = u.inscricao_divida LEFT JOIN pr ON pr.cda = u.cda WHERE u.id_pessoa IS NOT NULL)"""


def debts_v1(src):
    return P.debt_store_v1(*certificates(src), X.time_dictionary(src.dim_tempo), parcels(src), REFERENCE_YEAR)


@query("debt_store_v1", "cda:string id_pessoa:long tipo_divida:string valor_total_da:double valor_pago:double divida_protestada:long divida_ajuizada:long "
       "ano_inscricao_da:long anos_idade_da:long percentual_pago_cda:double quantidade_reparcelamentos:long parcela_taxa_pagamento_valor:double",
       f"WITH im AS ({PROPERTY_SQL}), me AS ({BUSINESS_SQL}), {DEBT_V1_CTE} SELECT * FROM dv")
def debt_store_v1(src):
    return debts_v1(src)


@query("debt_store_v15", "cda:long id_pessoa:string tipo_divida:string valor_total_da:double valor_pago:double protesto:long divida_ajuizada:long "
       "ano_inscricao_da:long anos_idade_da:long percentual_pago_cda:double", f"""
SELECT cda, CAST(id_pessoa AS VARCHAR) AS id_pessoa, tipo_divida, valor_tot AS valor_total_da, valor_pago, protesto, ajuizamento AS divida_ajuizada,
  2002 - idade_divida AS ano_inscricao_da, {REFERENCE_YEAR} - (2002 - idade_divida) AS anos_idade_da,
  CAST(valor_pago AS DOUBLE)/CAST(valor_tot AS DOUBLE) AS percentual_pago_cda
FROM (SELECT *, row_number() OVER (PARTITION BY cda ORDER BY tipo_divida, id_pessoa, 2002 - idade_divida, valor_tot, valor_pago) AS rn FROM v_divida) t WHERE rn = 1""")
def debt_store_v15(src):
    dated = src.divida.withColumn("inscricao_divida", F.concat((2002 - F.col("idade_divida")).cast("string"), F.lit("-03-15")))
    return P.debt_store_v15(dated.withColumnRenamed("ajuizamento", "divida_ajuizada"), REFERENCE_YEAR)


@query("training_frame", "cda:string id_pessoa:long percentual_pago_cda:double valor_total_da:double anos_idade_da:long quantidade_reparcelamentos:long "
       "frequencia_da_pessoa:long historico_pagamento_em_qtd:double status_situacao:long class_contribuinte_peso:double", f"""
WITH {STORE_V1_CTE}, {DEBT_V1_CTE}
SELECT dv.cda, dv.id_pessoa, dv.percentual_pago_cda, dv.valor_total_da, dv.anos_idade_da, coalesce(dv.quantidade_reparcelamentos, 0) AS quantidade_reparcelamentos,
  st.frequencia_da_pessoa, st.historico_pagamento_em_qtd, st.status_situacao, st.class_contribuinte_peso
FROM dv JOIN st ON st.id_pessoa = dv.id_pessoa WHERE dv.anos_idade_da < 5""")
def training_frame(src):
    return P.training_frame_v1(debts_v1(src), store_v1(src), age_limit=5)


@query("training_frame_v2", "cda:long tipo_divida:string id_pessoa:long percentual_pago_cda:double valor_total_da:double idade_divida:long num_dist_cda:long "
       "quantidade_reparcelamento:long situacao_cobranca:long historico_pagamento_em_valor:double class_contribuinte_peso:double", f"""
WITH {ACCESS_CTE} SELECT d.cda, d.tipo_divida, d.id_pessoa, least(CAST(d.valor_pago AS DOUBLE)/CAST(d.valor_tot AS DOUBLE), 1e0) AS percentual_pago_cda,
  d.valor_tot AS valor_total_da, d.idade_divida, a.num_dist_cda, a.quantidade_reparcelamento, a.situacao_cobranca, a.historico_pagamento_em_valor, a.class_contribuinte_peso
FROM v_divida d LEFT JOIN a ON a.id_pessoa = d.id_pessoa AND a.tipo_divida = d.tipo_divida AND a.da_aberto = 0 WHERE d.da_aberto = 0 AND d.idade_divida < 5""")
def training_frame_v2(src):
    return P.training_frame(P.debt_store(src.divida), taxpayers(src), age_limit=5)


@query("first_debt_floor", "id_pessoa:long tipo_divida:string da_aberto:long historico_pagamento_em_valor:double", f"""
WITH {ACCESS_CTE}, q AS (SELECT quantile_cont(historico_pagamento_em_valor, 0.75) AS q FROM a WHERE class_contribuinte_nome = 'DEVEDOR BOM')
SELECT id_pessoa, tipo_divida, da_aberto, round_even(CASE WHEN num_dist_cda = 1 AND historico_pagamento_em_valor < q THEN q
  ELSE historico_pagamento_em_valor END*1e9, 0)/1e9 AS historico_pagamento_em_valor FROM a CROSS JOIN q""")
def first_debt_floor(src):
    return P.first_debt_floor(taxpayers(src)).withColumn("historico_pagamento_em_valor", round_even("historico_pagamento_em_valor", 9))


def stock(src):
    open_debts = src.divida.where(F.col("da_aberto") == 1)
    return open_debts.select(
        F.concat(F.col("tipo_divida"), F.lit("-"), F.col("cda").cast("string"), F.lit("O")).alias("cda"),
        F.when(F.col("id_pessoa") % 9 == 0, F.col("id_pessoa") + 5000000).otherwise(F.col("id_pessoa")).alias("id_contribuinte"),
        "tipo_divida", "valor_tot", "protesto", "ajuizamento",
        F.concat((2002 - F.col("idade_divida")).cast("string"), F.lit("-03-15")).alias("inscricao_divida"))


STOCK_CTE = f"""sk AS (SELECT d.tipo_divida || '-' || CAST(d.cda AS VARCHAR) || 'O' AS cda, CASE WHEN d.id_pessoa % 9 = 0 THEN d.id_pessoa + 5000000 ELSE d.id_pessoa END AS id_contribuinte,
  d.valor_tot AS valor_total_da, d.idade_divida AS anos_idade_da FROM v_divida d WHERE d.da_aberto = 1),
sf AS (SELECT sk.*, pr.quantidade_reparcelamentos, st.frequencia_da_pessoa, st.historico_pagamento_em_qtd, st.status_situacao, st.historico_pagamento_em_valor,
  CASE WHEN st.frequencia_da_pessoa <= 1 THEN 'PRIMEIRA DIVIDA' ELSE coalesce(st.class_contribuinte_nome, 'PIOR PAGADOR') END AS class_contribuinte_nome, st.class_contribuinte_peso AS peso
  FROM sk LEFT JOIN pr ON pr.cda = sk.cda LEFT JOIN st ON st.id_pessoa = sk.id_contribuinte)"""
STOCK_SHAPE = ("cda:string id_contribuinte:long valor_total_da:double anos_idade_da:long quantidade_reparcelamentos:long frequencia_da_pessoa:long "
               "historico_pagamento_em_qtd:double status_situacao:long historico_pagamento_em_valor:double class_contribuinte_nome:string class_contribuinte_peso:double")


def _stock_sql(weight):
    return f"""WITH {STORE_V1_CTE}, {PARCEL_CTE}, {STOCK_CTE} SELECT cda, id_contribuinte, valor_total_da, anos_idade_da, coalesce(quantidade_reparcelamentos, 0) AS quantidade_reparcelamentos,
  coalesce(frequencia_da_pessoa, 0) AS frequencia_da_pessoa, coalesce(historico_pagamento_em_qtd, 0) AS historico_pagamento_em_qtd, coalesce(status_situacao, 0) AS status_situacao,
  coalesce(historico_pagamento_em_valor, 0) AS historico_pagamento_em_valor, class_contribuinte_nome, {weight} AS class_contribuinte_peso FROM sf"""


def stock_with_features(src):
    return P.stock_frame(stock(src), parcels(src), store_v1(src), REFERENCE_YEAR)


@query("stock_frame", STOCK_SHAPE, _stock_sql("""CASE class_contribuinte_nome WHEN 'PRIMEIRA DIVIDA' THEN 3.79174e0
  WHEN 'PIOR PAGADOR' THEN -1.37166e0 ELSE coalesce(peso, 0) END"""))
def stock_frame(src):
    return P.scoring_frame(stock_with_features(src))


@query("stock_frame_legacy", STOCK_SHAPE, _stock_sql("coalesce(peso, 0)"))
def stock_frame_legacy(src):
    return P.scoring_frame(stock_with_features(src), legacy=True)


@query("score_overrides", "cda:long da_aberto:long igr:double", """
SELECT cda, da_aberto, CASE WHEN id_pessoa % 4 = 0 OR idade_divida + id_pessoa % 12 >= 15 THEN 0 ELSE igr END AS igr FROM v_score""")
def score_overrides(src):
    framed = src.score.withColumn("status_situacao", F.col("id_pessoa") % 4).withColumn("anos_idade_da", F.col("idade_divida") + F.col("id_pessoa") % 12)
    return P.score_overrides(framed)


HISTORY_CTE = """hx AS (SELECT ano, id_contribuinte, num_imoveis, pgt_cota_unica, reco_inscricao, reco_debito + reco_inscricao AS reco_debito, hist_valor_pago, hist_valor_total,
  sum(pgt_cota_unica) OVER w AS hist_cota_unica, sum(hist_valor_pago) OVER w AS hist_pagamento, sum(hist_valor_total) OVER w AS hist_lancado,
  CASE WHEN hist_valor_total = 0 THEN 0 ELSE sum(f) OVER w END AS reco_credito
  FROM (SELECT *, CASE WHEN lag(hist_valor_total) OVER (PARTITION BY id_contribuinte ORDER BY ano) = 0 THEN 0 ELSE 1 END AS f FROM v_hist) z
  WINDOW w AS (PARTITION BY id_contribuinte ORDER BY ano ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
h AS (SELECT * FROM hx WHERE ano >= 1997)"""
CREDIT_CTE = HISTORY_CTE + """, cs AS (SELECT d.dam, d.id_imovel, d.id_contribuinte, d.ano_fato_gerador AS ano, coalesce(d.tipo_propriedade, 'TERRENO') AS tipo_propriedade,
  d.vlr_aberto + d.vlr_pago AS vlr_lancado, CASE WHEN d.vlr_aberto + d.vlr_pago <> d.vlr_pago THEN 1 ELSE 0 END AS aberto, h.hist_cota_unica, h.hist_pagamento, h.hist_lancado,
  h.reco_debito, h.reco_credito, h.num_imoveis, coalesce(CAST(d.vlr_pago AS DOUBLE)/nullif(CAST(d.vlr_aberto + d.vlr_pago AS DOUBLE), 0), 0) AS percentual_pago
FROM v_dam d JOIN h ON h.id_contribuinte = d.id_contribuinte AND h.ano = d.ano_fato_gerador)"""


def credit(src):
    return P.credit_store(src.dam, src.hist, first_year=1997)


@query("credit_store", "dam:long id_imovel:long id_contribuinte:long ano:long tipo_propriedade:string vlr_lancado:double aberto:long hist_cota_unica:long "
       "hist_pagamento:double hist_lancado:double reco_debito:long reco_credito:long num_imoveis:long percentual_pago:double", f"WITH {CREDIT_CTE} SELECT * FROM cs")
def credit_store(src):
    return credit(src)


@query("taxpayer_years", "id_contribuinte:long hist_valor_pago:double pgt_cota_unica:long hist_valor_total:double num_imoveis:long reco_credito:long "
       "reco_debito:long reco_inscricao:long percentual_pago:double", f"""
WITH {HISTORY_CTE} SELECT *, coalesce(CAST(hist_valor_pago AS DOUBLE)/nullif(CAST(hist_valor_total AS DOUBLE), 0)*100, 0) AS percentual_pago FROM (
  SELECT id_contribuinte, sum(hist_valor_pago) AS hist_valor_pago, sum(pgt_cota_unica) AS pgt_cota_unica, sum(hist_valor_total) AS hist_valor_total,
    sum(num_imoveis) AS num_imoveis, sum(reco_credito) AS reco_credito, sum(reco_debito) AS reco_debito, sum(reco_inscricao) AS reco_inscricao FROM h GROUP BY 1) t""")
def taxpayer_years(src):
    return P.taxpayer_years(src.hist, first_year=1997)


@query("year_slices", "recorte:string linhas:long pago:double", f"""
WITH {CREDIT_CTE} SELECT 'treino' AS recorte, count(*) AS linhas, sum(vlr_lancado) AS pago FROM cs WHERE ano < 2001
UNION ALL SELECT 'ultimo', count(*), sum(vlr_lancado) FROM cs WHERE ano = 2000 UNION ALL SELECT 'escore', count(*), sum(vlr_lancado) FROM cs WHERE ano = 2001
UNION ALL SELECT 'recentes', count(*), sum(vlr_lancado) FROM cs WHERE ano > 1999""")
def year_slices(src):
    slices = P.year_slices(credit(src), 2001)
    frames = [df.agg(F.lit(name).alias("recorte"), F.count(F.lit(1)).alias("linhas"), F.sum("vlr_lancado").alias("pago")) for name, df in slices.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
