"""Complete runs: build stores, train behind the acceptance gate, score the stock, publish lists.

Each run reads and writes snapshots of a feature store, so a run can be repeated after a failure.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import fixed_values as fv
from arrears.functions.scalars import code_map
from arrears.operators.joins import Conservation, left_join
from arrears.plans import collection, features, recovery, segments
from arrears.session import cut_lineage
from arrears.sources.files import FeatureStore

TAXPAYERS, DEBTS, SCORED = "fs_contribuinte", "fs_igr", "estoque_avaliado"
CLUSTER_FEATURES_V1 = ["status_situacao", "historico_pagamento_em_qtd", "historico_pagamento_em_valor"]
INDEX_KEY = ["cda", "tipo_divida", "id_pessoa"]
TAXPAYER_KEY = ["id_pessoa", "tipo_divida"]  # taxpayers and debts are bucketed by it, so they join without an exchange


def build_taxpayers(store: FeatureStore, snapshot: str, certificates: DataFrame, invoices: DataFrame, model_folder: str | None = None,
                    k: int | None = 5, trees: int = 100, depth: int = 15) -> dict:
    """Profile, segment, name and weigh the taxpayers of both partitions; save the classifier if it is accepted."""
    people = cut_lineage(features.accessibility(features.taxpayer_profile(certificates, invoices)))
    classified, learned = segments.segment_taxpayers(
        people, features.training_slice(people), features.CLUSTER_FEATURES, ["id_pessoa", "tipo_divida"], k, trees=trees, depth=depth)
    store.publish(classified, TAXPAYERS, snapshot, TAXPAYER_KEY)
    accepted = recovery.accept_segments(learned["k"])
    path = recovery.save_if_accepted(learned["classifier"], accepted and bool(model_folder), model_folder or "", "classificador-contribuinte")
    return {"num_clusters": learned["k"], "inercia": learned["inertia"], "centroides": learned["centroids"],
            "acuracia": learned["accuracy"], "aceito": accepted, "modelo": path}


def build_debts(store: FeatureStore, snapshot: str, certificates: DataFrame) -> None:
    store.publish(features.debt_store(certificates), DEBTS, snapshot, TAXPAYER_KEY)


def train(store: FeatureStore, snapshot: str, model_folder: str, trees: int = 100, depth: int = 15,
          r2: float = fv.GATE_R2, mse: float = fv.GATE_MSE) -> dict:
    """Train the recovery index on closed recent debts; save the model only when it passes the gate."""
    people = features.first_debt_floor(store.read(TAXPAYERS, snapshot))
    watch = Conservation("training frame", value=("valor_total_da", "valor_total_da"))
    frame = features.training_frame(store.read(DEBTS, snapshot), people, watch=watch)
    model, metrics, weights = recovery.train_index(
        frame, features.FEATURES_V2, features.TARGET, INDEX_KEY, recovery.forest(trees, depth), watch=watch)
    path = recovery.save_if_accepted(model, recovery.accept_regressor(metrics, r2, mse), model_folder, "modelo-igr")
    return {**metrics, "importancias": weights, "modelo": path}


def stock(store: FeatureStore, snapshot: str, watch: Conservation | None = None) -> DataFrame:
    """Open certificates with the open-partition features of their taxpayers; ``watch`` observes the join."""
    people = store.read(TAXPAYERS, snapshot).where(F.col("da_aberto") == 1).select(
        "id_pessoa", "tipo_divida", "num_dist_cda", "quantidade_reparcelamento", "historico_pagamento_em_valor",
        "situacao_cobranca", "class_contribuinte", "class_contribuinte_nome", "class_contribuinte_peso")
    debts = store.read(DEBTS, snapshot).where(F.col("da_aberto") == 1).drop("quantidade_reparcelamento")
    if watch is None:
        return left_join(debts, people, TAXPAYER_KEY)
    return watch.leave(left_join(watch.enter(debts), people, TAXPAYER_KEY))


def score(store: FeatureStore, snapshot: str, model_path: str, variant: str = "k5") -> DataFrame:
    """Score and rate the open stock, publish it and return the rating summary."""
    watch = Conservation("scored stock", value=("valor_total_da", "valor_total_da"))
    rated = recovery.score_stock(stock(store, snapshot, watch), recovery.open_model(model_path), variant)
    store.publish(rated, SCORED, snapshot, watch=watch)
    return collection.rating_summary(store.read(SCORED, snapshot))


def publish_lists(store: FeatureStore, snapshot: str, certificates: DataFrame, folder: str) -> None:
    """Write the collection lists of a scored snapshot."""
    rated = store.read(SCORED, snapshot).select(
        *collection.FULL_KEY, "valor_total_da", "idade_divida", "num_dist_cda", "quantidade_reparcelamento",
        "historico_pagamento_em_valor", "situacao_cobranca", "class_contribuinte_nome", "igr", "rating_divida")
    profiles = {name: profile for _, name, profile in fv.CLASSES_V2}
    profiled = rated.withColumn("class_contribuinte_perfil", code_map("class_contribuinte_nome", profiles))
    lists = collection.collection_lists(profiled, certificates, store.read(TAXPAYERS, snapshot))
    collection.write_collection_lists(lists, folder)


def build_taxpayers_v1(store: FeatureStore, snapshot: str, properties: DataFrame, businesses: DataFrame, invoices: DataFrame,
                       k: int = 4, trees: int = 100, depth: int = 15) -> tuple[object, Mapping[int, int]]:
    """First-generation store with classes; returns the classifier and the class number of each cluster."""
    people = cut_lineage(features.taxpayer_store_v1(properties, businesses, invoices))
    frequent = people.where(F.col("frequencia_da_pessoa") > 1).select("id_pessoa", *CLUSTER_FEATURES_V1)
    prepared = cut_lineage(segments.assembled(frequent, CLUSTER_FEATURES_V1))
    clusters = segments.cluster(prepared, k)
    classifier, _ = segments.train_classifier(clusters.transform(prepared), CLUSTER_FEATURES_V1, ["id_pessoa"], trees=trees, depth=depth)
    order = segments.cluster_order(clusters, CLUSTER_FEATURES_V1, ["historico_pagamento_em_valor"])
    numbers = dict(zip(order, fv.CLUSTER_CLASSES_V1))
    first = -1
    classed = segments.classify(people, classifier, first, "frequencia_da_pessoa").withColumn(
        "class_contribuinte", code_map("class_contribuinte", {**numbers, first: fv.FIRST_DEBT_CLASS_V1}))
    store.publish(features.with_class_labels_v1(classed), TAXPAYERS, snapshot)
    return classifier, numbers


def score_v1(stock_rows: DataFrame, parcels: DataFrame, taxpayers: DataFrame, model_path: str, reference_year: int, legacy: bool = False) -> DataFrame:
    """First-generation batch scoring of the open stock."""
    framed = features.scoring_frame(features.stock_frame(stock_rows, parcels, taxpayers, reference_year), legacy)
    return recovery.score_stock_v1(framed, recovery.open_model(model_path))
