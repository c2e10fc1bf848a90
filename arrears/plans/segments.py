"""Taxpayer segmentation: clusters, their quality, a classifier that repeats them, and class weights."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.scalars import code_map
from arrears.functions.semantics import capped, guarded, last_wins, present, ratio
from arrears.operators import trees as forests
from arrears.operators.stats import elbow
from arrears.operators.windows import in_training_share
from arrears.session import neighbouring_rows, training_rows

VECTOR = "atributos"
CLUSTER = "label_cluster"


def assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=VECTOR).transform(df)


def cluster(df: DataFrame, k: int, seed: int = fv.SEED, iterations: int = 300) -> KMeansModel:
    return KMeans(k=k, seed=seed, maxIter=iterations, featuresCol=VECTOR, predictionCol=CLUSTER).fit(df)


def sweep(df: DataFrame, ks: Sequence[int], seed: int = fv.SEED, iterations: int = 300) -> DataFrame:
    """Inertia and score per number of clusters; ``df`` is assembled and already cut from its lineage."""
    rows = []
    for k in ks:
        inertia = float(cluster(df, k, seed, iterations).summary.trainingCost)
        rows.append((k, inertia, -inertia))
    return df.sparkSession.createDataFrame(rows, "k int, inercia double, score double")


def best_k(curve: DataFrame) -> int:
    return elbow(curve).first()["k_ideal"]


def centroids(model: KMeansModel, columns: Sequence[str], digits: int = 3) -> list[dict]:
    return [
        {**{c: float(np.round(v, digits)) for c, v in zip(columns, centre)}, "cluster": i}
        for i, centre in enumerate(model.clusterCenters())
    ]


def cluster_order(model: KMeansModel, columns: Sequence[str], by: Sequence[str]) -> list[int]:
    """Cluster numbers from the lowest to the highest centroid in the named features.

    Cluster numbers are arbitrary, so names and ratings attach to this order.
    """
    centres = model.clusterCenters()
    places = [list(columns).index(b) for b in by]
    return sorted(range(len(centres)), key=lambda i: tuple(centres[i][p] for p in places))


def cluster_names(model: KMeansModel, columns: Sequence[str], by: Sequence[str] = ("historico_pagamento_em_valor", "quantidade_reparcelamento")) -> dict[int, str]:
    order = cluster_order(model, columns, by)
    names = fv.CLUSTER_NAMES.get(len(order), [f"CLASSE {i}" for i in range(len(order))])
    return dict(zip(order, names))


def silhouette(df: DataFrame) -> float:
    """Mean silhouette under squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol=VECTOR, predictionCol=CLUSTER).evaluate(df)


def silhouette_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Silhouette of every row from cluster moments: count, sum and sum of squared norms, one row per cluster."""
    x = [F.col(c).cast("double") for c in columns]
    norm = sum(v * v for v in x)
    moments = df.groupBy(CLUSTER).agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm).alias("q"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    ).collect()  # one row per cluster

    def mean_distance(m, members):
        dot = sum(v * F.lit(m[f"s{i}"]) for i, v in enumerate(x))
        return (norm * m["n"] - 2 * dot + F.lit(m["q"])) / F.lit(float(members))

    own = F.lit(None).cast("double")
    nearest = []
    for m in moments:
        is_own = F.col(CLUSTER) == m[CLUSTER]
        own = F.when(is_own, mean_distance(m, max(m["n"] - 1, 1)) if m["n"] > 1 else F.lit(None)).otherwise(own)
        nearest.append(F.when(~is_own, mean_distance(m, m["n"])))
    other = F.least(*nearest) if len(nearest) > 1 else nearest[0]
    return df.withColumn("silhueta", F.coalesce(F.try_divide(other - own, F.greatest(own, other)), F.lit(0.0)))


def train_classifier(df: DataFrame, columns: Sequence[str], key: Sequence[str], label: str = CLUSTER, trees: int = 100,
                     depth: int = 15, seed: int = fv.SEED) -> tuple[PipelineModel, float]:
    """Random forest that repeats a cluster label, and its accuracy on the 30 % of keys it has not seen."""
    is_training = in_training_share(key, seed)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True, checkpointInterval=5,
                                    maxMemoryInMB=512, featuresCol=VECTOR, labelCol=label,
                                    predictionCol="classe_prevista", probabilityCol="_p", rawPredictionCol="_r")
    assembler = VectorAssembler(inputCols=list(columns), outputCol=VECTOR)
    rows = df.drop(VECTOR)
    near, _ = neighbouring_rows(assembler.transform(rows.where(is_training)), columns, [VECTOR, label])
    cores = df.sparkSession.sparkContext.defaultParallelism
    nodes, classes = forests.grow(near, VECTOR, len(columns), forest, trees, cores, regression=False)
    grown = forests.open_forest(nodes, 0, trees, forest, RandomForestClassificationModel, len(columns), classes)
    model = PipelineModel([assembler, grown])
    held = model.transform(rows.where(~is_training))
    accuracy = held.agg(F.avg((F.col("classe_prevista") == F.col(label)).cast("double"))).first()[0]
    return model, accuracy or 0.0


def classify(df: DataFrame, model: PipelineModel, first_debt: int, frequency: str = "num_dist_cda") -> DataFrame:
    """Predicted class for every taxpayer; those with a single certificate get the extra class."""
    predicted = model.transform(df).drop(VECTOR, "_p", "_r")
    klass = last_wins([(F.col(frequency) == 1, first_debt)], otherwise=F.col("classe_prevista").cast("int"))
    return predicted.withColumn("class_contribuinte", klass).drop("classe_prevista")


def discriminant(counts: dict[tuple[str, int], int], names: Sequence[str]) -> np.ndarray:
    """Linear-discriminant coefficients of one-hot classes for a 0/1 target, from class × target counts.

    The columns add up to one, so the within-class covariance is singular and its pseudo-inverse is used. The
    matrices have one row per class.
    """
    table = np.array([[counts.get((n, t), 0) for n in names] for t in (0, 1)], dtype=float)
    sizes = table.sum(axis=1)
    total = sizes.sum()
    if (sizes == 0).any():
        return np.zeros(len(names))
    means = table / sizes[:, None]
    scatter = sum(np.diag(table[t]) - sizes[t] * np.outer(means[t], means[t]) for t in (0, 1))
    spread = np.sqrt(np.diag(scatter) / total)
    spread[spread == 0] = 1.0
    scaled = scatter / np.outer(spread, spread) / (total - 2)
    return np.linalg.pinv(scaled, rcond=1e-8, hermitian=True) @ ((means[1] - means[0]) / spread) / spread


def class_weights(taxpayers: DataFrame, name: str = "class_contribuinte_nome") -> DataFrame:
    """Weight per class: discriminant coefficients for full payment, handed out by rank.

    Only the class × target counts leave the cluster.
    """
    paid = capped(ratio("valor_pago", guarded("valor_tot"))).cast("int")
    grouped = present(taxpayers, name).groupBy(name).agg(
        F.count_if(paid == 1).alias("sim"), F.count_if(F.coalesce(paid, F.lit(0)) != 1).alias("nao"))
    rows = grouped.collect()  # one row per class
    counts = {(r[name], 1): r["sim"] for r in rows} | {(r[name], 0): r["nao"] for r in rows}
    names = sorted(r[name] for r in rows)
    weights = np.round(discriminant(counts, names), 5)
    known = [n for n in fv.WEIGHT_ORDER_V2 if n in names]
    receivers = known if len(known) == len(names) else names
    handed = zip(receivers, sorted(float(w) for w in weights))
    return taxpayers.sparkSession.createDataFrame(list(handed), f"{name} string, class_contribuinte_peso double")


def segment_taxpayers(taxpayers: DataFrame, training: DataFrame, columns: Sequence[str], key: Sequence[str], k: int | None = 5,
                      ks: Sequence[int] = tuple(range(2, 16)), trees: int = 100, depth: int = 15,
                      seed: int = fv.SEED) -> tuple[DataFrame, dict]:
    """Cluster the training slice, learn the clusters, classify everyone, name and weigh the classes.

    Without ``k`` the elbow of the sweep decides. Returns the classified taxpayers and what was learned.
    """
    prepared = training_rows(assembled(training, columns), key)
    curve = sweep(prepared, ks, seed) if k is None else None
    chosen = best_k(curve) if curve is not None else k
    model = cluster(prepared, chosen, seed)
    labelled = model.transform(prepared)
    classifier, accuracy = train_classifier(labelled, columns, key, trees=trees, depth=depth, seed=seed)
    names = {**cluster_names(model, columns), chosen: fv.FIRST_DEBT_NAME}
    classified = classify(taxpayers, classifier, chosen).withColumn(
        "class_contribuinte_nome", code_map("class_contribuinte", names))
    weights = class_weights(classified)
    weighted = classified.join(F.broadcast(weights), "class_contribuinte_nome", "left")
    return weighted, {
        "k": chosen, "curve": curve, "model": model, "classifier": classifier, "accuracy": accuracy, "names": names,
        "inertia": float(model.summary.trainingCost), "centroids": centroids(model, columns),
        "weights": weights, "labelled": labelled,
    }
