"""Statistics and data-quality queries."""

from pyspark.sql import functions as F

from arrears.functions import bands as B
from arrears.functions import fixed_values as fv
from arrears.functions.semantics import round_even
from arrears.operators import aggregates as A
from arrears.operators import quality as Q
from arrears.operators import stats as S
from catalogue.aggregates import band_frequency_sql
from catalogue.aggregates import BILL_COLUMNS
from catalogue.registry import query
from catalogue.windows import YEAR_SHARE_SQL, neighbourhood_years


def r6(df, *cols):
    """Floating sums depend on their order: compare six decimals."""
    for c in cols:
        df = df.withColumn(c, round_even(c, 6))
    return df


def sql6(expression: str, name: str) -> str:
    return f"round_even(({expression})*1e6, 0)/1e6 AS {name}"


@query("null_profile", "coluna:string nulos:long total:long percentual:double", " UNION ALL ".join(f"""
SELECT '{c}' AS coluna, sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS nulos, count(*) AS total,
  CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE)/CAST(count(*) AS DOUBLE)*100 AS percentual FROM v_dam"""
    for c in BILL_COLUMNS))
def null_profile(src):
    return Q.null_profile(src.dam)


def _register_null_subset(name: str, by: str, kind: str):
    @query(f"null_subset_{name}", f"{by}:{kind} entidades:long percentual:double", f"""
SELECT {by}, count(DISTINCT id_imovel) AS entidades, CAST(count(DISTINCT id_imovel) AS DOUBLE)/CAST((
  SELECT count(DISTINCT id_imovel) FROM v_dam WHERE atualizacao_cadastro IS NULL) AS DOUBLE)*100 AS percentual
FROM v_dam WHERE atualizacao_cadastro IS NULL AND {by} IS NOT NULL GROUP BY 1""")
    def subset(src):
        return Q.null_subset(src.dam, "atualizacao_cadastro", by, "id_imovel")


for _name, _by, _kind in [("type", "tipo_propriedade", "string"), ("year", "ano_fato_gerador", "long"), ("nature", "natureza_imovel", "string")]:
    _register_null_subset(_name, _by, _kind)


@query("missing_taxpayer", "condicao:string quantidade:long total:long percentual:double", " UNION ALL ".join(f"""
SELECT '{n}' AS condicao, sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS quantidade, count(*) AS total,
  CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS DOUBLE)/CAST(count(*) AS DOUBLE)*100 AS percentual FROM v_dam WHERE id_contribuinte IS NULL"""
    for n, c in [("paga", "vlr_pago = vlr_total_dam"), ("nao_paga", "vlr_pago = 0"), ("parcial", "vlr_pago <> 0 AND vlr_pago < vlr_total_dam")]))
def missing_taxpayer(src):
    paid, billed = F.col("vlr_pago"), F.col("vlr_total_dam")
    unknown = src.dam.where(F.col("id_contribuinte").isNull())
    return A.conditional_share(unknown, {"paga": paid == billed, "nao_paga": paid == 0, "parcial": (paid != 0) & (paid < billed)})


@query("partition_counts", "tipo_divida:string da_aberto:long linhas:long",
       "SELECT tipo_divida, da_aberto, count(*) AS linhas FROM v_divida GROUP BY 1, 2")
def partition_counts(src):
    return Q.partition_counts(src.divida, ["tipo_divida", "da_aberto"])


@query("consistency", "regra:string linhas:long", " UNION ALL ".join(
    f"SELECT '{n}' AS regra, sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS linhas FROM {t}" for n, c, t in [
        ("nao_paga_sem_aberto", "vlr_pago = 0 AND vlr_total_dam > 0 AND vlr_aberto = 0", "v_dam"),
        ("parcial_sem_aberto", "vlr_pago > 0 AND vlr_pago < vlr_total_dam AND vlr_aberto = 0", "v_dam"),
        ("nao_paga_lancado_difere_aberto", "vlr_pago = 0 AND vlr_total_dam <> vlr_aberto", "v_dam"),
        ("lancado_difere_soma", "vlr_total_dam <> vlr_pago + vlr_aberto", "v_dam"),
        ("divida_maior_que_debito", "reco_inscricao > reco_debito", "v_hist")]))
def consistency(src):
    return Q.violations(src.dam, Q.bill_rules()).unionByName(Q.violations(src.hist, Q.history_rules()))


CURVE_SQL = """curve AS (SELECT k.k, CAST(sum(i.vlr_total) AS DOUBLE) AS inercia
  FROM (SELECT DISTINCT l_linenumber AS k FROM v_item) k JOIN v_item i ON i.l_linenumber >= k.k GROUP BY 1)"""


@query("elbow", "k_ideal:long distancia:double", f"""
WITH {CURVE_SQL}, e AS (SELECT min(k) AS x1, max(k) AS x2, arg_min(inercia, k) AS y1, arg_max(inercia, k) AS y2 FROM curve)
SELECT k AS k_ideal, round_even(d*1e2, 0)/1e2 AS distancia FROM (SELECT k, abs((y2-y1)*k - (x2-x1)*inercia + x2*y1 - y2*x1)
  / sqrt((y2-y1)*(y2-y1) + CAST((x2-x1)*(x2-x1) AS DOUBLE)) AS d FROM curve CROSS JOIN e) t ORDER BY d DESC, k LIMIT 1""")
def elbow(src):
    per_line = src.item.groupBy(F.col("l_linenumber").alias("k")).agg(F.sum("vlr_total").alias("v"))
    # One row per line number: the falling curve is a running sum over those few rows.
    from pyspark.sql.window import Window
    curve = per_line.select("k", F.sum("v").over(Window.orderBy(F.col("k").desc())).cast("double").alias("inercia"))
    return S.elbow(curve).withColumn("distancia", round_even("distancia", 2))


@query("davies_bouldin", "clusters:long davies_bouldin:double", """
WITH f AS (SELECT tipo_divida AS l1, da_aberto, concat(tipo_divida, CAST(da_aberto AS VARCHAR)) AS k,
  CAST(valor_tot AS DOUBLE)/1000 AS x, CAST(valor_pago AS DOUBLE)/1000 AS y FROM v_divida),
c AS (SELECT k, avg(x) AS cx, avg(y) AS cy FROM f GROUP BY k),
s AS (SELECT f.k, cx, cy, avg(sqrt((x-cx)*(x-cx) + (y-cy)*(y-cy))) AS s FROM f JOIN c ON c.k = f.k GROUP BY 1, 2, 3),
w AS (SELECT a.k, max((a.s + b.s)/sqrt((a.cx-b.cx)*(a.cx-b.cx) + (a.cy-b.cy)*(a.cy-b.cy))) AS w FROM s a JOIN s b ON a.k <> b.k GROUP BY 1)
SELECT count(*) AS clusters, round_even(avg(w)*1e6, 0)/1e6 AS davies_bouldin FROM w""")
def davies_bouldin(src):
    labelled = src.divida.select(
        F.concat("tipo_divida", F.col("da_aberto").cast("string")).alias("k"),
        (F.col("valor_tot").cast("double") / 1000).alias("x"), (F.col("valor_pago").cast("double") / 1000).alias("y"))
    return r6(S.davies_bouldin(labelled, "k", ["x", "y"]), "davies_bouldin")


@query("regression_metrics", "n:long r2:double mse:double rmse:double ccc:double", f"""
SELECT n, {sql6('1 - mse/vy', 'r2')}, {sql6('mse', 'mse')}, {sql6('sqrt(mse)', 'rmse')},
  {sql6('2*c/(vy + vp + (my - mp)*(my - mp))', 'ccc')} FROM (SELECT count(*) AS n, avg((y - y_predict)*(y - y_predict)) AS mse,
  var_pop(y) AS vy, var_pop(y_predict) AS vp, covar_pop(y, y_predict) AS c, avg(y) AS my, avg(y_predict) AS mp FROM v_resid) t""")
def regression_metrics(src):
    return r6(S.regression_metrics(src.resid, "y", "y_predict"), "r2", "mse", "rmse", "ccc")


WINSOR = ["vlr_pago", "vlr_aberto", "vlr_total_dam", "area_construida", "idade_imovel"]


@query("winsorize", "dam:long " + " ".join(f"{c}:double" for c in WINSOR), f"""
WITH n AS (SELECT count(*) AS n FROM v_dam),
{', '.join(f'''b_{c} AS (SELECT max(CASE WHEN rn = CAST(floor(0.05e0*n) AS BIGINT) + 1 THEN v END) AS lo, max(CASE WHEN rn = n - CAST(floor(0.05e0*n) AS BIGINT) THEN v END) AS hi
  FROM (SELECT CAST({c} AS DOUBLE) AS v, row_number() OVER (ORDER BY {c}) AS rn FROM v_dam) o CROSS JOIN n)''' for c in WINSOR)}
SELECT dam, {', '.join(f'greatest(least(CAST({c} AS DOUBLE), (SELECT hi FROM b_{c})), (SELECT lo FROM b_{c})) AS {c}' for c in WINSOR)} FROM v_dam""")
def winsorize(src):
    return S.winsorize(src.dam.select("dam", *WINSOR), WINSOR)


CORRELATED = ["vlr_pago", "vlr_aberto", "area_construida", "idade_imovel", "ano_fato_gerador"]
CORR_SHAPE = "linha:string coluna:string correlacao:double"


def _pairs(table, names, prefix=""):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS linha, '{b}' AS coluna, {sql6(f'corr(CAST({prefix}{a} AS DOUBLE), CAST({prefix}{b} AS DOUBLE))', 'correlacao')} FROM {table}"
        for i, a in enumerate(names) for b in names[i + 1:])


@query("pearson", CORR_SHAPE, _pairs("v_dam", CORRELATED))
def pearson(src):
    return r6(S.pearson(src.dam, CORRELATED), "correlacao")


RANKED = ["reco_debito", "reco_inscricao", "num_imoveis", "pgt_cota_unica", "hist_valor_pago"]


@query("spearman", CORR_SHAPE, f"""
WITH k AS (SELECT {', '.join(f'rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1)/2.0e0 AS r_{c}' for c in RANKED)} FROM v_hist)
{_pairs('k', RANKED, 'r_')}""")
def spearman(src):
    return r6(S.spearman(src.hist, RANKED), "correlacao")


@query("chi_square", "estatistica:double graus:long", f"""
WITH c AS ({band_frequency_sql(fv.RESIDUAL_EDGES, 'y - y_predict', 'v_resid', 5).replace('WITH x AS (', 'SELECT freq FROM (WITH x AS (', 1)}) z)
SELECT round_even(sum((freq - m)*(freq - m)/m)*1e6, 0)/1e6 AS estatistica, count(*) - 1 AS graus
FROM c CROSS JOIN (SELECT CAST(avg(freq) AS DOUBLE) AS m FROM c) a""")
def chi_square(src):
    counts = B.band_frequency(src.resid, F.col("y") - F.col("y_predict"), fv.RESIDUAL_EDGES, digits=5)
    return r6(S.chi_square_uniform(counts, "freq"), "estatistica")


def _cramer_sql(a, b):
    return f"""
WITH o AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM v_dam WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
r AS (SELECT a, sum(o) AS r FROM o GROUP BY 1), c AS (SELECT b, sum(o) AS c FROM o GROUP BY 1), t AS (SELECT sum(o) AS n FROM o),
e AS (SELECT CAST(coalesce(o.o, 0) AS DOUBLE) AS o, CAST(r.r AS DOUBLE)*CAST(c.c AS DOUBLE)/CAST(t.n AS DOUBLE) AS e FROM r CROSS JOIN c CROSS JOIN t
  LEFT JOIN o ON o.a = r.a AND o.b = c.b),
x AS (SELECT CAST((SELECT n FROM t) AS DOUBLE) AS n, (SELECT count(*) FROM r) AS lines, (SELECT count(*) FROM c) AS cols,
  sum((o-e)*(o-e)/e) AS chi, sum(greatest(abs(o-e) - 0.5, 0)*greatest(abs(o-e) - 0.5, 0)/e) AS yates FROM e)
SELECT n, lines, cols, round_even(CASE WHEN lines = 2 AND cols = 2 THEN yates ELSE chi END*1e4, 0)/1e4 AS qui_quadrado,
  {sql6('sqrt(CASE WHEN lines = 2 AND cols = 2 THEN yates ELSE chi END/(n*(least(lines, cols) - 1)))', 'v')} FROM x"""


CRAMER_SHAPE = "n:long lines:long cols:long qui_quadrado:double v:double"


@query("cramers_v", CRAMER_SHAPE, _cramer_sql("tipo_propriedade", "regiao"))
def cramers_v(src):
    return r6(S.cramers_v(src.dam, "tipo_propriedade", "regiao"), "v").withColumn("qui_quadrado", round_even("qui_quadrado", 4))


@query("cramers_v_two_by_two", CRAMER_SHAPE, _cramer_sql("tipo_contribuinte", "natureza_imovel"))
def cramers_v_two_by_two(src):
    return r6(S.cramers_v(src.dam, "tipo_contribuinte", "natureza_imovel"), "v").withColumn("qui_quadrado", round_even("qui_quadrado", 4))


@query("t_interval", "bairro:string n:long media:double inferior:double superior:double fora_do_geral:long", f"""
WITH {YEAR_SHARE_SQL}, z AS (SELECT count(pct) AS n, avg(pct) AS m, stddev_samp(pct) AS s FROM y),
tt AS (SELECT m - c*s/sqrt(n) AS lo, m + c*s/sqrt(n) AS hi FROM (SELECT *, 1.959964e0 + (pow(1.959964e0,3) + 1.959964e0)/(4*(n-1))
  + (5*pow(1.959964e0,5) + 16*pow(1.959964e0,3) + 3*1.959964e0)/(96*CAST((n-1)*(n-1) AS DOUBLE)) AS c FROM z) q),
b AS (SELECT *, CASE n - 1 {' '.join(f'WHEN {i + 1} THEN {t}e0' for i, t in enumerate(fv.T_CRITICAL_95))} END AS c
  FROM (SELECT bairro, count(pct) AS n, avg(pct) AS m, stddev_samp(pct) AS s FROM y GROUP BY 1) q)
SELECT bairro, n, {sql6('m', 'media')}, {sql6('m - c*s/sqrt(n)', 'inferior')}, {sql6('m + c*s/sqrt(n)', 'superior')},
  CASE WHEN m < (SELECT lo FROM tt) OR m > (SELECT hi FROM tt) THEN 1 ELSE 0 END AS fora_do_geral FROM b""")
def t_interval(src):
    return r6(S.t_interval(neighbourhood_years(src), "bairro", "pct"), "media", "inferior", "superior")


@query("standard_scale", "dam:long vlr_pago:double area_construida:double", f"""
SELECT dam, {', '.join(sql6(f'(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ())/stddev_pop(CAST({c} AS DOUBLE)) OVER ()', c) for c in ['vlr_pago', 'area_construida'])} FROM v_dam""")
def standard_scale(src):
    columns = ["vlr_pago", "area_construida"]
    return r6(S.scale(src.dam, S.fit_scaler(src.dam, columns, "standard")), *columns)


@query("robust_minmax", "dam:long vlr_total_dam_r:double area_construida_m:double", f"""
SELECT dam, {sql6('(CAST(vlr_total_dam AS DOUBLE) - q1)/(q2 - q0)', 'vlr_total_dam_r')},
  {sql6('(CAST(area_construida AS DOUBLE) - lo)/(hi - lo)', 'area_construida_m')}
FROM v_dam CROSS JOIN (SELECT quantile_cont(CAST(vlr_total_dam AS DOUBLE), 0.25) AS q0, quantile_cont(CAST(vlr_total_dam AS DOUBLE), 0.5) AS q1,
  quantile_cont(CAST(vlr_total_dam AS DOUBLE), 0.75) AS q2, CAST(min(area_construida) AS DOUBLE) AS lo, CAST(max(area_construida) AS DOUBLE) AS hi FROM v_dam) s""")
def robust_minmax(src):
    scaled = S.scale(src.dam, S.fit_scaler(src.dam, ["vlr_total_dam"], "robust"), "_r")
    scaled = S.scale(scaled, S.fit_scaler(src.dam, ["area_construida"], "minmax"), "_m")
    return r6(scaled, "vlr_total_dam_r", "area_construida_m")
