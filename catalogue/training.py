"""Model and store queries.

A trained model differs between libraries, so its query returns facts with a known answer: how many rows were held out,
that every certificate is scored once, that the model beats the mean. What has a closed form is compared as it is.
"""

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.bands import band_crosstab, half_open_labels
from arrears.functions.semantics import capped, guarded, ratio, round_even
from arrears.operators import cleaning as C
from arrears.operators.joins import Conservation, left_join
from arrears.operators.stats import regression_metrics
from arrears.plans import features as P
from arrears.plans import pipelines
from arrears.plans import recovery as R
from arrears.plans import segments as S
from arrears.session import cut_lineage, training_rows
from arrears.sources import archives, files
from catalogue.registry import query
from catalogue.statistics import r6, sql6
from catalogue.stores import (
    ACCESS_CTE, CREDIT_CTE, PARCEL_CTE, STOCK_CTE, STORE_V1_CTE, credit, debts_v1, stock_with_features, store_v1, taxpayers,
)
from catalogue.windows import training_sql

TREES = 100  # as many as the surveyed models have
STOP_TOLERANCE = 1e-3  # a round must lower the error of the rows set aside by a thousandth of it
BOOSTING_ROUNDS = 30  # see README: every round of the full 2,000 is a chain of jobs
V1_CLUSTER_FEATURES = ["status_situacao", "historico_pagamento_em_qtd", "historico_pagamento_em_valor"]
INDEX_KEY = ["cda", "tipo_divida", "id_pessoa"]
AGE = fv.TRAINING_AGE_LIMIT
HELD_OUT_SQL = f"da_aberto = 0 AND idade_divida < {AGE} AND NOT {training_sql(*INDEX_KEY)}"


def accessible(src):
    return P.accessibility(P.taxpayer_profile(src.divida, src.notas))


def segmented(src, **sizes):
    people = cut_lineage(accessible(src))
    return S.segment_taxpayers(people, P.training_slice(people), P.CLUSTER_FEATURES, ["id_pessoa", "tipo_divida"],
                               **{"k": 5, "trees": TREES, **sizes})


def index_frame(src):
    """Training frame with closed-form classes, so that regressors are looked at apart from the segmentation."""
    return P.training_frame(P.debt_store(src.divida), P.first_debt_floor(taxpayers(src)))


def facts(src, rows, schema):
    return src.spark.createDataFrame(rows, schema)


def beats_mean(metrics) -> int:
    """The mean of the training target has a coefficient of determination of about 0."""
    return int(metrics["r2"] > 0.01)


def valid_error(mse) -> int:
    """Shares lie between 0 and 1, so a squared error does too."""
    return int(0 < mse < 1)


@query("kmeans_sweep", "k:long pessoas:long nao_pior_que_k2:long cotovelo_no_intervalo:long", """
SELECT k, (SELECT count(*) FROM (SELECT id_pessoa, tipo_divida FROM v_divida WHERE da_aberto = 0 GROUP BY 1, 2 HAVING count(DISTINCT cda) > 1) t)
  AS pessoas, 1 AS nao_pior_que_k2, 1 AS cotovelo_no_intervalo FROM range(2, 16) AS sizes(k)""")
def kmeans_sweep(src):
    """Inertia of 2 to 15 clusters; more clusters never fit worse than two."""
    prepared = training_rows(S.assembled(P.training_slice(accessible(src)), P.CLUSTER_FEATURES), ["id_pessoa", "tipo_divida"])
    curve = S.sweep(prepared, range(2, 16))
    inertia = {r["k"]: r["inercia"] for r in curve.collect()}  # one row per k
    people, inside = prepared.count(), int(S.best_k(curve) in inertia)
    return facts(src, [(k, people, int(v <= inertia[2]), inside) for k, v in inertia.items()],
                 "k int, pessoas bigint, nao_pior_que_k2 int, cotovelo_no_intervalo int")


SILHOUETTE_SQL = """
WITH p AS (SELECT cda, id_pessoa % 3 AS g, idade_divida::DOUBLE AS x, quantidade_reparcelamento::DOUBLE AS y FROM v_divida
  WHERE da_aberto = 1),
d AS (SELECT a.cda, a.g, b.g AS h, sum((a.x - b.x)**2 + (a.y - b.y)**2) AS total, count(*) AS n FROM p a CROSS JOIN p b GROUP BY 1, 2, 3),
m AS (SELECT cda, g, max(CASE WHEN g = h AND n > 1 THEN total / (n - 1) END) AS own, min(CASE WHEN g <> h THEN total / n END) AS other
  FROM d GROUP BY 1, 2),
s AS (SELECT g, coalesce((other - own) / nullif(greatest(own, other), 0), 0) AS v FROM m)
SELECT g AS label_cluster, count(*) AS pessoas, round_even(avg(v)*1e6, 0)/1e6 AS silhueta,
  (SELECT round_even(avg(v)*1e6, 0)/1e6 FROM s) AS geral FROM s GROUP BY g"""


@query("silhouette", "label_cluster:long pessoas:long silhueta:double geral:double", SILHOUETTE_SQL)
def silhouette(src):
    """Silhouettes of closed-form labels, per row from cluster moments and over all rows from the evaluator."""
    columns = ["idade_divida", "quantidade_reparcelamento"]
    labelled = src.divida.where("da_aberto = 1").withColumn(S.CLUSTER, (F.col("id_pessoa") % 3).cast("int"))
    labelled = cut_lineage(S.assembled(labelled.select(S.CLUSTER, *[F.col(c).cast("double").alias(c) for c in columns]), columns))
    rows = S.silhouette_rows(labelled, columns).groupBy(S.CLUSTER).agg(
        F.count(F.lit(1)).alias("pessoas"), round_even(F.avg("silhueta"), 6).alias("silhueta"))
    return rows.withColumn("geral", round_even(F.lit(S.silhouette(labelled)), 6))


@query("segment_classifier", "da_aberto:long pessoas:long classes_conhecidas:long pesos_por_classe:long acerta_mais_que_a_maioria:long", """
SELECT da_aberto, count(*) AS pessoas, 1 AS classes_conhecidas, 1 AS pesos_por_classe, 1 AS acerta_mais_que_a_maioria
FROM (SELECT DISTINCT id_pessoa, tipo_divida, da_aberto FROM v_divida) t GROUP BY 1""")
def segment_classifier(src):
    """Everyone is classified once, into the named classes, and the forest repeats the clusters."""
    people, learned = segmented(src)
    largest = learned["labelled"].groupBy(S.CLUSTER).count().agg(F.max("count") / F.sum("count")).first()[0]
    known = F.col("class_contribuinte_nome").isin(list(learned["names"].values()))
    return people.groupBy("da_aberto").agg(
        F.count(F.lit(1)).alias("pessoas"), F.bool_and(known).cast("int").alias("classes_conhecidas"),
        F.bool_and(F.col("class_contribuinte_peso").isNotNull()).cast("int").alias("pesos_por_classe"),
    ).withColumn("acerta_mais_que_a_maioria", F.lit(int(learned["accuracy"] > largest)))


@query("class_weights", "class_contribuinte_nome:string lugar:long", " UNION ALL ".join(
    f"SELECT '{name}' AS class_contribuinte_nome, {place} AS lugar" for place, name in enumerate(fv.WEIGHT_ORDER_V2, 1)))
def class_weights(src):
    """Weights are handed out by rank in a fixed order of classes, the smallest first."""
    weights = S.class_weights(taxpayers(src))
    return weights.select("class_contribuinte_nome", F.row_number().over(  # one row per class
        Window.partitionBy().orderBy("class_contribuinte_peso")).alias("lugar"))


@query("discriminant_weights", "lugar:long posicao:double", f"""
WITH {ACCESS_CTE}, paid AS (SELECT class_contribuinte_nome, avg(CASE WHEN valor_pago >= coalesce(nullif(valor_tot, 0), 1) THEN 1e0 ELSE 0e0 END) AS p
  FROM a WHERE class_contribuinte_nome IS NOT NULL GROUP BY 1),
ends AS (SELECT min(p) AS low, max(p) AS high FROM paid)
SELECT row_number() OVER (ORDER BY p) AS lugar, {sql6('(p - low)/(high - low)', 'posicao')} FROM paid CROSS JOIN ends""")
def discriminant_weights(src):
    """Coefficients of the discriminant from the lowest, 0, to the highest, 1.

    For classes as 0/1 columns they are the classes' shares of full payment, up to shift and scale.
    """
    paid = F.coalesce(capped(ratio("valor_pago", guarded("valor_tot"))).cast("int") == 1, F.lit(False)).cast("int")
    rows = taxpayers(src).groupBy("class_contribuinte_nome", paid.alias("pago")).count().collect()  # two rows per class
    names = sorted({r["class_contribuinte_nome"] for r in rows})
    found = sorted(S.discriminant({(r["class_contribuinte_nome"], r["pago"]): r["count"] for r in rows}, names))
    placed = [(i, float((w - found[0]) / (found[-1] - found[0]))) for i, w in enumerate(found, 1)]
    return r6(facts(src, placed, "lugar int, posicao double"), "posicao")


STEP_AGE, STEP_LOW, STEP_HIGH = 2, 0.25, 0.75


@query("step_forest", "idade_divida:long n:long igr:double importancia_idade:double", f"""
SELECT idade_divida, count(*) AS n, CASE WHEN idade_divida >= {STEP_AGE} THEN {STEP_HIGH}e0 ELSE {STEP_LOW}e0 END AS igr, 1e0 AS importancia_idade
FROM v_divida WHERE {HELD_OUT_SQL} GROUP BY 1""")
def step_forest(src):
    """A target that steps at one age is learned exactly, and all importance goes to the age."""
    step = F.when(F.col("idade_divida") >= STEP_AGE, STEP_HIGH).otherwise(STEP_LOW)
    frame = cut_lineage(index_frame(src).withColumn(P.TARGET, step))
    regressor = R.forest(TREES).setFeatureSubsetStrategy("all")
    model, _, weights = R.train_index(frame, P.FEATURES_V2, P.TARGET, INDEX_KEY, regressor)
    _, test = R.split(frame, INDEX_KEY, fv.SEED)
    by_age = R.prediction(model, test).groupBy("idade_divida", F.col(R.PREDICTION).alias("igr")).agg(F.count(F.lit(1)).alias("n"))
    shown = by_age.groupBy("idade_divida", round_even("igr", 6).alias("igr")).agg(F.sum("n").alias("n"))
    return shown.withColumn("importancia_idade", round_even(F.lit(dict(weights)["idade_divida"]), 6))


@query("step_boosting", "idade_divida:long n:long igr:double arvores:long", f"""
SELECT idade_divida, count(*) AS n, CASE WHEN idade_divida >= {STEP_AGE} THEN {STEP_HIGH}e0 ELSE {STEP_LOW}e0 END AS igr, 1 AS arvores
FROM v_divida WHERE {HELD_OUT_SQL} GROUP BY 1""")
def step_boosting(src):
    """The first tree learns the step exactly, so of 2,000 rounds the second is the last, and one tree stays."""
    step = F.when(F.col("idade_divida") >= STEP_AGE, STEP_HIGH).otherwise(STEP_LOW)
    frame = cut_lineage(index_frame(src).withColumn(P.TARGET, step))
    model, _, _ = R.train_index(frame, P.FEATURES_V2, P.TARGET, INDEX_KEY, R.boosted(tolerance=STOP_TOLERANCE))
    _, test = R.split(frame, INDEX_KEY, fv.SEED)
    by_age = R.prediction(model, test).groupBy("idade_divida", round_even(R.PREDICTION, 6).alias("igr")).agg(F.count(F.lit(1)).alias("n"))
    return by_age.withColumn("arvores", F.lit(R.rounds(model)))


@query("boosted_until_still", "n:long erro_valido:long parou_antes:long melhora_ate_parar:long", f"""
SELECT count(*) AS n, 1 AS erro_valido, 1 AS parou_antes, 1 AS melhora_ate_parar FROM v_divida WHERE {HELD_OUT_SQL}""")
def boosted_until_still(src):
    """All 2,000 rounds are allowed; training ends by itself, and on the rows set aside no earlier round is better."""
    frame = cut_lineage(index_frame(src))
    regressor = R.boosted(tolerance=STOP_TOLERANCE)
    model, found, _ = R.train_index(frame, P.FEATURES_V2, P.TARGET, INDEX_KEY, regressor)
    watched = R.set_aside(R.split(frame, INDEX_KEY, fv.SEED)[0], regressor, INDEX_KEY, fv.SEED).where(R.STOP_MARK)
    errors = R.round_errors(model, watched)
    return facts(src, [(found["n"], valid_error(found["mse"]), int(R.rounds(model) < regressor.getMaxIter()),
                        int(errors[-1] <= min(errors) + 1e-9))],
                 "n bigint, erro_valido int, parou_antes int, melhora_ate_parar int")


@query("mean_baseline", "n:long media:double r2:double mse:double", f"""
WITH f AS (SELECT least(CAST(valor_pago AS DOUBLE)/CAST(valor_tot AS DOUBLE), 1e0) AS y, {training_sql(*INDEX_KEY)} AS known
  FROM v_divida WHERE da_aberto = 0 AND idade_divida < {AGE}),
m AS (SELECT avg(y) AS media FROM f WHERE known)
SELECT count(*) AS n, {sql6('media', 'media')}, {sql6('1 - avg((y - media)*(y - media))/var_pop(y)', 'r2')}, {sql6('avg((y - media)*(y - media))', 'mse')}
FROM f CROSS JOIN m WHERE NOT known GROUP BY media""")
def mean_baseline(src):
    """What every model must beat: the training rows' mean, measured on the rows held out."""
    train, test = R.split(training_rows(R.matrix(index_frame(src), P.FEATURES_V2, P.TARGET, INDEX_KEY), INDEX_KEY), INDEX_KEY, fv.SEED)
    guessed = R.mean_baseline(train, test, P.TARGET)
    mean = guessed.agg(F.max(R.PREDICTION)).scalar()
    return r6(regression_metrics(guessed, P.TARGET, R.PREDICTION).select("n", mean.alias("media"), "r2", "mse"), "media", "r2", "mse")


GATE_SCALES = [0, 1, 2, 4]


@query("gate_cases", "escala:long n:long r2:double mse:double aceito:long salvo:long", f"""
SELECT escala, n, {sql6('1 - mse/vy', 'r2')}, {sql6('mse', 'mse')},
  CASE WHEN 1 - mse/vy > {fv.GATE_R2} AND mse < {fv.GATE_MSE} THEN 1 ELSE 0 END AS aceito,
  CASE WHEN 1 - mse/vy > {fv.GATE_R2} AND mse < {fv.GATE_MSE} THEN 1 ELSE 0 END AS salvo
FROM (SELECT escala, count(*) AS n, var_pop(y) AS vy, avg(((y_predict - y)*escala)*((y_predict - y)*escala)) AS mse
  FROM v_resid CROSS JOIN (VALUES {', '.join(f'({k})' for k in GATE_SCALES)}) AS e(escala) GROUP BY 1) t""")
def gate_cases(src):
    """The gate at its published limits, for closed-form predictions with their errors scaled: an accepted model can be
    opened again, a rejected one leaves no file."""
    closed = cut_lineage(closed_form_predictions(src))
    model = Pipeline(stages=[VectorAssembler(inputCols=[P.TARGET], outputCol=R.VECTOR)]).fit(closed)
    rows = []
    for k in GATE_SCALES:
        guess = F.col(P.TARGET) + (F.col(R.PREDICTION) - F.col(P.TARGET)) * k
        m = regression_metrics(closed.withColumn(R.PREDICTION, guess), P.TARGET, R.PREDICTION).first()
        accepted = R.accept_regressor(m.asDict())
        path = R.save_if_accepted(model, accepted, files.scratch_folder(src.spark, "gate"), f"igr-{k}")
        saved = path is not None and len(R.open_model(path).stages) == 1
        rows.append((k, m["n"], m["r2"], m["mse"], int(accepted), int(saved)))
    return r6(facts(src, rows, "escala int, n bigint, r2 double, mse double, aceito int, salvo int"), "r2", "mse")


@query("igr_regressor", "n:long melhor_que_media:long erros_coerentes:long", f"""
SELECT count(*) AS n, 1 AS melhor_que_media, 1 AS erros_coerentes FROM v_divida WHERE {HELD_OUT_SQL}""")
def igr_regressor(src):
    _, m, _ = R.train_index(index_frame(src), P.FEATURES_V2, P.TARGET, INDEX_KEY, R.forest(TREES))
    coherent = int(abs(m["rmse"] ** 2 - m["mse"]) < 1e-9 and -1 <= m["ccc"] <= 1)
    return facts(src, [(m["n"], beats_mean(m), coherent)], "n bigint, melhor_que_media int, erros_coerentes int")


CREDIT_FEATURES = ["area_construida", "reco_debito", "reco_credito", "num_imoveis", "hist_pagamento", "hist_lancado", "idade_imovel", "hist_cota_unica"]


def credit_frame(src):
    return P.year_slices(credit(src), 2001)["treino"].select("dam", "id_imovel", "percentual_pago", *[F.col(c).cast("double").alias(c) for c in CREDIT_FEATURES])


@query("boosted_regressor", "n:long erro_valido:long", f"""
WITH {CREDIT_CTE} SELECT count(*) AS n, 1 AS erro_valido FROM cs
WHERE ano < 2001 AND NOT {training_sql('dam', 'id_imovel')}""")
def boosted_regressor(src):
    _, m, _ = R.train_index(credit_frame(src), CREDIT_FEATURES, "percentual_pago", ["dam", "id_imovel"], R.boosted(trees=BOOSTING_ROUNDS))
    return facts(src, [(m["n"], valid_error(m["mse"]))], "n bigint, erro_valido int")


@query("model_comparison", "escala:string modelo:string n:long erro_valido:long melhor_que_media:long", f"""
SELECT escala, modelo, (SELECT count(*) FROM v_divida WHERE {HELD_OUT_SQL}) AS n, 1 AS erro_valido,
  CASE modelo WHEN 'media' THEN 0 WHEN 'floresta' THEN 1 END AS melhor_que_media
FROM (VALUES ('standard'), ('robust'), ('minmax')) AS e(escala) CROSS JOIN (VALUES ('media'), ('floresta'), ('reforco')) AS m(modelo)""")
def model_comparison(src):
    models = {"media": None, "floresta": R.forest(TREES), "reforco": R.boosted(trees=BOOSTING_ROUNDS)}
    found = R.compare_models(index_frame(src), P.FEATURES_V2, P.TARGET, INDEX_KEY, models)
    better = F.when(F.col("modelo") != "reforco", (F.col("r2") > 0.01).cast("int"))  # few rounds at a low rate promise nothing
    return found.select("escala", "modelo", "n", F.col("mse").between(0, 1).cast("int").alias("erro_valido"), better.alias("melhor_que_media"))


@query("importances", "variavel:string entre_zero_e_um:long somam_um:long", " UNION ALL ".join(
    f"SELECT '{c}' AS variavel, 1 AS entre_zero_e_um, 1 AS somam_um" for c in P.FEATURES_V2))
def importances(src):
    _, _, found = R.train_index(index_frame(src), P.FEATURES_V2, P.TARGET, INDEX_KEY, R.forest(TREES))
    whole = int(abs(sum(v for _, v in found) - 1) < 1e-6)
    return facts(src, [(name, int(0 <= v <= 1), whole) for name, v in found], "variavel string, entre_zero_e_um int, somam_um int")


def closed_form_predictions(src):
    return src.resid.withColumnsRenamed({"y": P.TARGET, "y_predict": R.PREDICTION})


@query("residuals", "cda:long da_aberto:long percentual_pago_cda:double igr:double residuos:double", """
SELECT cda, da_aberto, y AS percentual_pago_cda, y_predict AS igr, y - y_predict AS residuos FROM v_resid
WHERE y_predict <> 0 AND y_predict <> 1""")
def residuals(src):
    return R.residuals(closed_form_predictions(src), P.TARGET, ["cda", "da_aberto"])


PREDICTION_EDGES = fv.PAID_RATIO_EDGES
PREDICTION_LABELS = half_open_labels(PREDICTION_EDGES)
PREDICTION_SQL = f"""
WITH edge AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{label}', {low}::DOUBLE, {high}::DOUBLE)" for i, (label, low, high) in enumerate(
    zip(PREDICTION_LABELS, PREDICTION_EDGES, PREDICTION_EDGES[1:])))}) AS e(place, label, low, high)),
pair AS (SELECT a.label AS truth, b.place AS guess FROM v_resid JOIN edge a ON y >= a.low AND y < a.high JOIN edge b ON y_predict >= b.low AND y_predict < b.high
  WHERE da_aberto = 0)
SELECT truth AS faixa_linha, {', '.join(f'count(*) FILTER (guess = {i}) AS c{i}' for i in range(len(PREDICTION_LABELS)))}
FROM pair GROUP BY truth"""


@query("prediction_bands", "faixa_linha:string " + " ".join(f"c{i}:long" for i in range(len(PREDICTION_LABELS))), PREDICTION_SQL)
def prediction_bands(src):
    closed = closed_form_predictions(src).where("da_aberto = 0")
    wide = band_crosstab(closed, P.TARGET, R.PREDICTION, PREDICTION_EDGES)
    return wide.withColumnsRenamed({label: f"c{i}" for i, label in enumerate(PREDICTION_LABELS)})


def scored(src):
    """Segment, weigh, train and score the open stock: the whole second-generation chain."""
    people, learned = segmented(src)
    people = cut_lineage(people)
    debts = P.debt_store(src.divida)
    frame = P.training_frame(debts, P.first_debt_floor(people))
    model, _, _ = R.train_index(frame, P.FEATURES_V2, P.TARGET, INDEX_KEY, R.forest(TREES))
    open_people = people.where(F.col("da_aberto") == 1).select(
        "id_pessoa", "tipo_divida", "num_dist_cda", "quantidade_reparcelamento", "historico_pagamento_em_valor",
        "situacao_cobranca", "class_contribuinte_nome", "class_contribuinte_peso")
    stock = debts.where(F.col("da_aberto") == 1).drop("quantidade_reparcelamento").join(open_people, ["id_pessoa", "tipo_divida"], "left")
    return people, learned, R.score_stock(stock, model)


KNOWN_RATING_SQL = ", ".join(f"'{r}'" for r in fv.RATING_ORDER)


@query("scored_stock", "tipo_divida:string certificados:long valor:double indices_validos:long ratings_conhecidos:long", """
SELECT tipo_divida, count(*) AS certificados, sum(valor_tot) AS valor, count(*) AS indices_validos, count(*) AS ratings_conhecidos
FROM v_divida WHERE da_aberto = 1 GROUP BY 1""")
def scored_stock(src):
    """Every open certificate is scored once and rated, and no money is lost on the way."""
    _, _, rated = scored(src)
    return rated.groupBy("tipo_divida").agg(
        F.count(F.lit(1)).alias("certificados"), F.sum("valor_total_da").alias("valor"),
        F.count_if(F.col("igr").between(0, 1)).alias("indices_validos"),
        F.count_if(F.col("rating_divida").isin(fv.RATING_ORDER)).alias("ratings_conhecidos"))


@query("solo_scores", "cda:string valor_total_da:double anos_idade_da:long indice_valido:long rating_conhecido:long", f"""
WITH {STORE_V1_CTE}, {PARCEL_CTE}, {STOCK_CTE} SELECT cda, valor_total_da, anos_idade_da, 1 AS indice_valido, 1 AS rating_conhecido FROM sf""")
def solo_scores(src):
    store = cut_lineage(store_v1(src))

    def learn_classes():
        frequent = store.where(F.col("frequencia_da_pessoa") > 1).select("id_pessoa", *V1_CLUSTER_FEATURES)
        prepared = training_rows(S.assembled(frequent, V1_CLUSTER_FEATURES), ["id_pessoa"])
        clusters = S.cluster(prepared, 4)
        classifier, _ = S.train_classifier(clusters.transform(prepared), V1_CLUSTER_FEATURES, ["id_pessoa"], trees=TREES)
        order = S.cluster_order(clusters, V1_CLUSTER_FEATURES, ["historico_pagamento_em_valor"])
        return classifier, dict(zip(order, fv.CLUSTER_CLASSES_V1))

    def learn_index():
        return R.train_index(P.training_frame_v1(debts_v1(src), store), P.FEATURES_V1, P.TARGET, ["cda"], R.forest(TREES))[0]

    (classifier, classes), model = R.side_by_side(src.spark, [(learn_classes,), (learn_index,)])  # neither reads the other
    requests = P.scoring_frame(stock_with_features(src)).select(
        "cda", "valor_total_da", "anos_idade_da", "quantidade_reparcelamentos", "situacao_ativa", "edificacao",
        F.col("cpf_existe").alias("tem_cpf"), "frequencia_da_pessoa",
        (F.col("historico_pagamento_em_qtd") - 1).alias("historico_pagamento_em_qtd"),
        (F.col("historico_pagamento_em_valor") - 1).alias("historico_pagamento_em_valor"))
    answers = R.score_requests(requests, classifier, classes, model)
    return answers.select("cda", "valor_total_da", "anos_idade_da", F.col("igr").between(0, 1).cast("int").alias("indice_valido"),
                          F.col("rating_divida").isin(fv.RATING_ORDER).cast("int").alias("rating_conhecido"))


TAXPAYER_TEXT = "id_pessoa:long tipo_divida:string da_aberto:long num_dist_cda:long valor_tot:double qtd_notas_2anos:long"
TAXPAYER_SCHEMA = "id_pessoa bigint, tipo_divida string, da_aberto int, num_dist_cda bigint, valor_tot decimal(18,2), qtd_notas_2anos bigint"


def _profile(src):
    return P.taxpayer_profile(src.divida, src.notas).select("id_pessoa", "tipo_divida", "da_aberto", "num_dist_cda", "valor_tot", "qtd_notas_2anos")


PROFILE_SQL = """SELECT d.*, n.qtd_notas_2anos FROM (SELECT id_pessoa, tipo_divida, da_aberto, count(DISTINCT cda) AS num_dist_cda, sum(valor_tot) AS valor_tot
  FROM v_divida GROUP BY 1, 2, 3) d LEFT JOIN v_notas n ON n.id_pessoa = d.id_pessoa"""


@query("csv_roundtrip", TAXPAYER_TEXT, PROFILE_SQL)
def csv_roundtrip(src):
    return files.roundtrip_csv(_profile(src), files.scratch_folder(src.spark, "csv"), TAXPAYER_SCHEMA)


@query("csv_decimal_comma", "id_pessoa:long tipo_divida:string da_aberto:long valor_tot:string", """
SELECT id_pessoa, tipo_divida, da_aberto, replace(CAST(CAST(valor_tot AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS valor_tot
FROM (SELECT id_pessoa, tipo_divida, da_aberto, sum(valor_tot) AS valor_tot FROM v_divida GROUP BY 1, 2, 3) t""")
def csv_decimal_comma(src):
    folder = files.scratch_folder(src.spark, "decimal-comma")
    files.write_csv(_profile(src).drop("num_dist_cda", "qtd_notas_2anos"), folder, separator=";", decimal_comma=True)
    return files.read_csv(src.spark, folder, "id_pessoa bigint, tipo_divida string, da_aberto int, valor_tot string", separator=";")


@query("archived_csv", TAXPAYER_TEXT, PROFILE_SQL + " WHERE d.da_aberto = 1")
def archived_csv(src):
    """Profiles in archives, a member for every partition and range of taxpayers; the members of open ones are read."""
    folder = files.scratch_folder(src.spark, "archives")
    member = F.format_string("%s/%d.csv", F.when(F.col("da_aberto") == 1, "aberto").otherwise("fechado"), F.col("id_pessoa") % 16)
    archives.write_members(_profile(src).withColumn("membro", member), folder, "membro").agg(F.sum("linhas")).collect()
    return archives.read_members(src.spark, folder, "aberto/*", TAXPAYER_SCHEMA)


@query("store_roundtrip", TAXPAYER_TEXT, PROFILE_SQL)
def store_roundtrip(src):
    folder = files.scratch_folder(src.spark, "store")
    store = files.FeatureStore(src.spark, folder)
    store.publish(_profile(src), "fs_contribuinte", "2002-01-01")
    return store.read("fs_contribuinte", "2002-01-01")


@query("conserved_joins", "etapa:string linhas_antes:long linhas_depois:long valor_antes:double valor_depois:double trocas:long", f"""
SELECT 'treino' AS etapa, count(*) AS linhas_antes, count(*) AS linhas_depois, sum(valor_tot) AS valor_antes, sum(valor_tot) AS valor_depois,
  0 AS trocas FROM v_divida WHERE da_aberto = 0 AND idade_divida < {AGE}
UNION ALL SELECT 'estoque', count(*), count(*), sum(valor_tot), sum(valor_tot), 0 FROM v_divida WHERE da_aberto = 1""")
def conserved_joins(src):
    """Debts and money before and behind the joins with the taxpayers, observed while the joined rows are written, and
    the exchanges that the joins of the bucketed stores plan."""
    store = files.FeatureStore(src.spark, files.scratch_folder(src.spark, "conserved"), buckets=8)
    base = cut_lineage(src.divida)
    store.publish(P.debt_store(base), pipelines.DEBTS, "2002-01", pipelines.TAXPAYER_KEY)
    people = taxpayers(src).withColumn("class_contribuinte", F.lit(0))
    store.publish(people, pipelines.TAXPAYERS, "2002-01", pipelines.TAXPAYER_KEY)
    rows = []
    for stage in ("treino", "estoque"):
        watch = Conservation(stage, value=("valor_total_da", "valor_total_da"))
        joined = pipelines.stock(store, "2002-01", watch) if stage == "estoque" else P.training_frame(
            store.read(pipelines.DEBTS, "2002-01"), store.read(pipelines.TAXPAYERS, "2002-01"), watch=watch)
        exchanges = exchanges_of(joined)
        store.publish(joined, stage, "2002-01", watch=watch)
        before, behind = watch.totals()
        rows.append((stage, before["rows"], behind["rows"], float(before["value"]), float(behind["value"]), exchanges))
    return facts(src, rows, "etapa string, linhas_antes bigint, linhas_depois bigint, valor_antes double, valor_depois double, trocas int")


def exchanges_of(df) -> int:
    """How many exchanges by hash or range a plan holds before it runs; broadcasts of small sides are none."""
    return df._jdf.queryExecution().executedPlan().toString().count(" Exchange ")


LEARNED_BEFORE = 2000


@query("one_hot_learned", "ano:long tipo_propriedade:string lugar:long linhas:long", f"""
WITH seen AS (SELECT tipo_propriedade, row_number() OVER (ORDER BY count(*) DESC, tipo_propriedade) - 1 AS place
  FROM v_dam WHERE ano_fato_gerador < {LEARNED_BEFORE} AND tipo_propriedade IS NOT NULL GROUP BY 1)
SELECT ano_fato_gerador AS ano, d.tipo_propriedade, coalesce(place, (SELECT count(*) FROM seen)) AS lugar, count(*) AS linhas
FROM v_dam d LEFT JOIN seen ON seen.tipo_propriedade = d.tipo_propriedade GROUP BY 1, 2, 3""")
def one_hot_learned(src):
    """Place of the 1 in each row's vector, with categories learned from the earlier years."""
    model = C.learn_one_hot(src.dam.where(F.col("ano_fato_gerador") < LEARNED_BEFORE), "tipo_propriedade")
    vector = vector_to_array("tipo_propriedade_vetor")
    return model.transform(src.dam).groupBy(
        F.col("ano_fato_gerador").alias("ano"), "tipo_propriedade", (F.array_position(vector, 1.0) - 1).alias("lugar")
    ).agg(F.count(F.lit(1)).alias("linhas"))


@query("csv_source_tables", TAXPAYER_TEXT, PROFILE_SQL)
def csv_source_tables(src):
    """Two source tables written as plain comma CSV and loaded by name with their fixed schemas."""
    folder = files.scratch_folder(src.spark, "tables")
    profile = _profile(src).drop("qtd_notas_2anos")
    files.write_csv(profile, f"{folder}/contribuintes.csv")
    files.write_csv(src.notas.select("id_pessoa", "qtd_notas_2anos"), f"{folder}/notas.csv")
    tables = files.load_tables(src.spark, folder, {
        "contribuintes": TAXPAYER_SCHEMA.removesuffix(", qtd_notas_2anos bigint"), "notas": "id_pessoa bigint, qtd_notas_2anos bigint"})
    return left_join(tables["contribuintes"], tables["notas"], ["id_pessoa"])


@query("whole_run", "etapa:string linhas:long valor:double", """
SELECT 'contribuintes' AS etapa, count(*) AS linhas, sum(v) AS valor
FROM (SELECT sum(valor_tot) AS v FROM v_divida GROUP BY id_pessoa, tipo_divida, da_aberto) t
UNION ALL SELECT 'dividas', count(*), sum(valor_tot) FROM v_divida
UNION ALL SELECT 'estoque', count(*), sum(valor_tot) FROM v_divida WHERE da_aberto = 1
UNION ALL SELECT 'fora da lista', 0, 0""")
def whole_run(src):
    """Build the stores, train behind the gate, score the stock and publish the lists, all through files.

    The published gate belongs to real data; here any model with an error below 1 passes it.
    """
    folder = files.scratch_folder(src.spark, "run")
    store, models, base = files.FeatureStore(src.spark, f"{folder}/store"), f"{folder}/models", cut_lineage(src.divida)
    pipelines.build_taxpayers(store, "2002-01", base, src.notas, models, trees=TREES)
    pipelines.build_debts(store, "2002-01", base)
    trained = pipelines.train(store, "2002-01", models, trees=TREES, r2=-1.0, mse=1.0)
    pipelines.score(store, "2002-01", trained["modelo"])
    pipelines.publish_lists(store, "2002-01", base, f"{folder}/listas")
    kept = [(pipelines.TAXPAYERS, "contribuintes", "valor_tot"), (pipelines.DEBTS, "dividas", "valor_total_da"),
            (pipelines.SCORED, "estoque", "valor_total_da")]
    lists = src.spark.read.parquet(f"{folder}/listas").where(
        (F.col("valor_total_da") < 1000) | (F.col("idade_divida") > fv.COLLECTION_MAX_AGE) | ~F.col("rating_divida").isin(fv.COLLECTION_RATINGS))
    rows = [store.read(table, "2002-01").agg(F.lit(stage).alias("etapa"), F.count(F.lit(1)).alias("linhas"), F.sum(money).alias("valor"))
            for table, stage, money in kept]
    rows.append(lists.agg(F.lit("fora da lista").alias("etapa"), F.count(F.lit(1)).alias("linhas"),
                          F.coalesce(F.sum("valor_total_da"), F.lit(0)).alias("valor")))
    return reduce(lambda a, b: a.union(b), rows)
