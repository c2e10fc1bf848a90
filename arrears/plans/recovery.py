"""Recovery index: regressors, comparison, acceptance and scoring."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.ratings import rating
from arrears.functions.scalars import code_map
from arrears.operators import trees as forests
from arrears.operators.joins import Conservation
from arrears.operators.stats import fit_scaler, regression_metrics
from arrears.operators.windows import in_training_share
from arrears.plans.features import FEATURES_V2, score_overrides, weighted_status
from arrears.plans.segments import classify
from arrears.session import ROWS_A_TASK, neighbouring_rows, tasks_for, training_rows

PREDICTION = "igr"
VECTOR = "atributos_igr"
STOP_MARK = "parada_igr"
NODE_MEMORY_MB = 512  # statistics of the nodes that one pass splits; more nodes a pass, fewer passes
FITS_AT_ONCE = 6
FORESTS_AT_ONCE = 4  # parts of a forest that are grown side by side; one for every core, if they have TREES_A_PART
TREES_A_PART = 8
SCALED, PART = "_escala", "_floresta"  # ends of the names of columns that only a model's own stages read
TRAINS = "_treina"


def split(df: DataFrame, key: Sequence[str], seed: int = fv.SEED) -> tuple[DataFrame, DataFrame]:
    """70 % of the keys to train, 30 % to test; the same rows under any partitioning."""
    is_training = in_training_share(key, seed)
    return df.where(is_training), df.where(~is_training)


def split_rows(frame: DataFrame, columns: Sequence[str], target: str, key: Sequence[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """The matrix written once and split, with each key hashed as it is written, not in every pass that follows."""
    marked = matrix(frame, columns, target, key).withColumn(TRAINS, in_training_share(key, seed))
    rows = training_rows(marked, key)
    return rows.where(TRAINS).drop(TRAINS), rows.where(~F.col(TRAINS)).drop(TRAINS)


def scaler_stage(train: DataFrame, columns: Sequence[str], kind: str | None) -> tuple[list[Transformer], list[str]]:
    """Scaling learned on the training rows only, as a stage that is saved with the model."""
    if kind is None:
        return [], list(columns)
    fitted = fit_scaler(train, columns, kind)
    scaled = ", ".join(
        f"(CAST(`{c}` AS DOUBLE) - ({centre!r}D)) / ({width!r}D) AS `{c}{SCALED}`" for c, (centre, width) in fitted.items()
    )
    return [SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")], [f"{c}{SCALED}" for c in columns]


def forest(trees: int = 100, depth: int = 15, seed: int = fv.SEED) -> RandomForestRegressor:
    """Parameters of a forest; ``grow_forest`` grows it."""
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True, checkpointInterval=5,
                                 maxMemoryInMB=NODE_MEMORY_MB)


def boosted(trees: int = 2000, rate: float = 0.02, share: float = 0.9, depth: int = 6, seed: int = 0,
            tolerance: float | None = None) -> GBTRegressor:
    """Boosted trees; the checkpoint interval keeps the chain of residuals short.

    With a tolerance, training ends at the first round that lowers the squared error of the rows set aside by less than
    that share of it (of 0.01, if it is smaller), and the trees up to the best round stay. Spark waits for no later
    round. Which rows are set aside is marked in ``STOP_MARK``.
    """
    trained = GBTRegressor(maxIter=trees, stepSize=rate, subsamplingRate=share, maxDepth=depth, seed=seed, checkpointInterval=20)
    return trained if tolerance is None else trained.copy({
        trained.validationTol: tolerance, trained.validationIndicatorCol: STOP_MARK})


def set_aside(train: DataFrame, regressor, key: Sequence[str], seed: int) -> DataFrame:
    """Mark two tenths of the training keys for a regressor that stops early; the test rows take no part in that."""
    if regressor.hasParam("validationIndicatorCol") and regressor.isSet("validationIndicatorCol"):
        return train.withColumn(regressor.getValidationIndicatorCol(), in_training_share(key, seed + 1, share=2))
    return train


def rounds(model: PipelineModel) -> int:
    """Trees that the regressor kept."""
    return model.stages[-1].getNumTrees


def round_errors(model: PipelineModel, rows: DataFrame) -> list[float]:
    """Squared error on the rows after each round, in one pass over them."""
    prepared = PipelineModel(model.stages[:-1]).transform(rows)
    return list(model.stages[-1].evaluateEachIteration(prepared, "squared"))


def fit(train: DataFrame, columns: Sequence[str], target: str, regressor, scaler: str | None = "standard") -> PipelineModel:
    """Scaler, assembler by column name and regressor as one pipeline; the target is never scaled."""
    stages, inputs = scaler_stage(train, columns, scaler)
    assembler = VectorAssembler(inputCols=inputs, outputCol=VECTOR)
    regressor = regressor.copy().setFeaturesCol(VECTOR).setLabelCol(target).setPredictionCol(PREDICTION)
    prepared = PipelineModel([*stages, assembler])
    rows = prepared.transform(train)
    if isinstance(regressor, RandomForestRegressor):
        return PipelineModel([*prepared.stages, *grow_forest(rows, columns, regressor)])
    # A round is a chain of short passes: a task for every core, not one for every shuffle partition.
    dealt = rows.coalesce(tasks_for(rows.count(), rows.sparkSession.sparkContext.defaultParallelism))
    return PipelineModel([*prepared.stages, regressor.fit(dealt)])


def tasks_of_a_part(rows: int, cores: int, parts: int) -> int:
    return max(math.ceil(cores / parts), math.ceil(rows / ROWS_A_TASK))


def parts_of_a_forest(trees: int, cores: int) -> int:
    """A part of one tree would choose from all features in every node, so parts have two at least."""
    return max(min(FORESTS_AT_ONCE, trees // 2), min(cores, trees // TREES_A_PART), 1)


def grow_forest(rows: DataFrame, columns: Sequence[str], regressor: RandomForestRegressor) -> list[Transformer]:
    """The trees of a forest as forests of some trees each, and their mean by trees.

    Trees of a forest are independent, so tasks grow whole trees (``operators.trees``) and the mean is the prediction of
    one forest of them all. Several models, so that none is too large to be opened at once.
    """
    trees, spark = regressor.getNumTrees(), rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    parts = parts_of_a_forest(trees, cores)
    ordered, _ = neighbouring_rows(rows, columns, [regressor.getFeaturesCol(), regressor.getLabelCol()])
    nodes, _ = forests.grow(ordered, regressor.getFeaturesCol(), len(columns), regressor, trees, cores, regression=True)
    ends = [trees * i // parts for i in range(parts + 1)]
    sizes = [end - start for start, end in zip(ends, ends[1:])]
    names = [f"{PREDICTION}{i}{PART}" for i in range(parts)]

    def opened(i: int) -> RandomForestRegressionModel:
        part = regressor.copy().setPredictionCol(names[i])
        return forests.open_forest(nodes, ends[i], sizes[i], part, RandomForestRegressionModel, len(columns), 0)

    grown_parts = side_by_side(spark, [(opened, i) for i in range(parts)], parts)
    total = " + ".join(f"`{name}` * {size}" for name, size in zip(names, sizes))
    mean = SQLTransformer(statement=f"SELECT *, ({total}) / {trees} AS `{regressor.getPredictionCol()}` FROM __THIS__")
    return [*grown_parts, mean]


def mean_baseline(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """Every prediction is the mean of the training target."""
    return test.withColumn(PREDICTION, F.lit(train.agg(F.avg(target)).first()[0]))


def prediction(model: PipelineModel, df: DataFrame) -> DataFrame:
    # Once only: every transformation broadcasts the trees anew.
    predicted = model.transform(df)
    return predicted.drop(VECTOR, *[c for c in predicted.columns if c.endswith((SCALED, PART))])


def importances(model: PipelineModel, columns: Sequence[str]) -> list[tuple[str, float]]:
    """Importances that add up to 1; those of a forest's parts count by their trees."""
    learned = [stage for stage in model.stages if hasattr(stage, "featureImportances")]
    found = sum(stage.featureImportances.toArray() * stage.getNumTrees for stage in learned)
    found = found / (found.sum() or 1.0)
    return sorted(zip(columns, map(float, found)), key=lambda item: -item[1])


def matrix(frame: DataFrame, columns: Sequence[str], target: str, key: Sequence[str]) -> DataFrame:
    """The columns that training and its metrics read."""
    return frame.select(*dict.fromkeys([*key, *columns, target]))


def train_index(frame: DataFrame, columns: Sequence[str], target: str, key: Sequence[str], regressor=None,
                scaler: str | None = "standard", seed: int = fv.SEED,
                watch: Conservation | None = None) -> tuple[PipelineModel, dict, list[tuple[str, float]]]:
    """Fit on 70 % of the keys; metrics on the rest; importances by name.

    ``watch`` is checked as soon as the rows are written, before anything is learned from them.
    """
    train, test = split_rows(frame, columns, target, key, seed)
    if watch is not None:
        watch.check()
    regressor = regressor or forest(seed=seed)
    model = fit(set_aside(train, regressor, key, seed), columns, target, regressor, scaler)
    metrics = regression_metrics(prediction(model, test), target, PREDICTION).first().asDict()
    return model, metrics, importances(model, columns)


def compare_models(frame: DataFrame, columns: Sequence[str], target: str, key: Sequence[str], regressors: Mapping[str, object],
                   scalers: Sequence[str] = ("standard", "robust", "minmax"), seed: int = fv.SEED) -> DataFrame:
    """Metrics of every scaler with every model; ``None`` as a model is the mean baseline.

    All fits read one written matrix and run side by side: levels and rounds of one model are chains of small jobs,
    which leave most cores to the others.
    """
    spark = frame.sparkSession
    train, test = split_rows(frame, columns, target, key, seed)

    def measured(scaler: str, name: str) -> tuple:
        regressor = regressors[name]
        if regressor is None:
            predicted = mean_baseline(train, test, target)
        else:
            predicted = prediction(fit(set_aside(train, regressor, key, seed), columns, target, regressor, scaler), test)
        m = regression_metrics(predicted, target, PREDICTION).first()
        return scaler, name, m["n"], m["r2"], m["mse"], m["rmse"], m["ccc"]

    rows = side_by_side(spark, [(measured, scaler, name) for scaler in scalers for name in regressors])
    return spark.createDataFrame(
        rows, "escala string, modelo string, n bigint, r2 double, mse double, rmse double, ccc double")


def side_by_side(spark: SparkSession, calls: Sequence[tuple[Callable, ...]], at_once: int = FITS_AT_ONCE) -> list:
    """Results of driver-side calls (function, arguments), at most ``at_once`` at a time, in the order given.

    Threads inherit job group, description and scheduler pool; the first failure is raised once all have ended.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(call), *arguments) for call, *arguments in calls]
    return [done.result() for done in waiting]


def residuals(predicted: DataFrame, target: str, key: Sequence[str] = (), without_ends: bool = True) -> DataFrame:
    """Observed, predicted and their difference, largest difference first.

    Trees predict few distinct values; the key columns let the sort split rows with equal differences.
    """
    table = predicted.withColumn("residuos", F.col(target) - F.col(PREDICTION))
    if without_ends:
        table = table.where((F.col(PREDICTION) != 0) & (F.col(PREDICTION) != 1))
    return table.orderBy(F.col("residuos").desc(), *key)


def accept_regressor(metrics: Mapping[str, float], r2: float = fv.GATE_R2, mse: float = fv.GATE_MSE) -> bool:
    return metrics["r2"] > r2 and metrics["mse"] < mse


def accept_segments(k: int, least: int = fv.GATE_CLUSTERS) -> bool:
    return k > least


def save_if_accepted(model: PipelineModel, accepted: bool, folder: str, name: str, when: datetime | None = None) -> str | None:
    """Save an accepted model under a dated name and return its path; leave a rejected one alone."""
    if not accepted:
        return None
    path = f"{folder.rstrip('/')}/{name}-{(when or datetime.now()):%Y-%m-%dT%H-%M-%S}"
    model.write().overwrite().save(path)
    return path


def open_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_stock_v1(framed: DataFrame, model: PipelineModel) -> DataFrame:
    """Index with overrides and first-generation rating; the class is found from its name."""
    numbers = {name: number for number, name, _ in fv.CLASSES_V1}
    scored = score_overrides(prediction(model, framed)).withColumn("class_contribuinte", code_map("class_contribuinte_nome", numbers))
    return scored.withColumn("rating_divida", rating("v1"))


def score_stock(frame: DataFrame, model: PipelineModel, variant: str = "k5") -> DataFrame:
    """Index with overrides and second-generation rating.

    Ratings number the classes their own way, so the rating class comes from the class name.
    """
    numbers = fv.RATING_K5_CLASS_OF_NAME if variant == "k5" else fv.RATING_K6_CLASS_OF_NAME
    ready = frame.fillna(0, FEATURES_V2)
    scored = score_overrides(prediction(model, ready), status="situacao_cobranca", age="idade_divida")
    rated = scored.withColumn("_classe", code_map("class_contribuinte_nome", numbers))
    return rated.withColumn("rating_divida", rating(variant, "_classe")).drop("_classe")


def score_requests(requests: DataFrame, classifier: PipelineModel, cluster_classes: Mapping[int, int], model: PipelineModel) -> DataFrame:
    """Score debts described only by their request fields, through the same stages as the stock."""
    weights = {number: weight for number, _, weight in fv.CLASSES_V1}
    derived = (
        requests.withColumnRenamed("tem_cpf", "cpf_existe").withColumn("status_situacao", weighted_status())
        .withColumn("historico_pagamento_em_qtd", F.col("historico_pagamento_em_qtd") + 1)
        .withColumn("historico_pagamento_em_valor", F.col("historico_pagamento_em_valor") + 1)
    )
    first = -1
    classes = {**dict(cluster_classes), first: fv.FIRST_DEBT_CLASS_V1}
    classed = classify(derived, classifier, first, "frequencia_da_pessoa")
    classed = classed.withColumn("class_contribuinte", code_map("class_contribuinte", classes))
    weighted = classed.withColumn("class_contribuinte_peso", code_map("class_contribuinte", weights))
    scored = score_overrides(prediction(model, weighted))
    return scored.withColumn("rating_divida", rating("v1")).drop("class_contribuinte", "situacao_ativa", "edificacao", "cpf_existe")
