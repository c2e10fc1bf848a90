"""The named queries of this package: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import (bpe, byte_bpe, centroids, exact, hnsw, license, lines, mixing, negatives, pii, simhash,
                         toxicity, urls)
from arrears.llm.common import LOWER, UPPER, settle, table, text_print, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: run(tune(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    made = docs.select("doc_id", bpe.round_trip(spark, F.col("text"), tokenizer_path()).alias("made"))
    return made.select(
        "doc_id",
        (F.octet_length("made.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("made.ids", 256).alias("ids_sha256"),
        F.sha2("made.decoded", 256).alias("decoded_sha256"),
    )


TRIMMED = f"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}')"


@query("op2_pii")
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts are hashed where they lie; only texts with spans move, to be generalised."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    hits = settle(pii.candidates(docs))
    spans = settle(pii.find_spans(docs, hits=hits))
    hashed = docs.withColumn("own_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).withColumn(
        "print", text_print(F.col("text")))
    clean = pii.generalised_texts(hits, spans).select(
        F.col("id").alias("clean_id"), F.col("print").alias("clean_print"), F.sha2("clean", 256).alias("clean_sha256"))
    found = pii.per_document(hashed, spans).select("doc_id", "own_sha256", "print", "spans")
    found = found.join(clean, F.col("doc_id").eqNullSafe(F.col("clean_id")) & (F.col("print") == F.col("clean_print")), "left")
    base = F.filter("spans", lambda s: s["order"] < len(pii.KINDS))
    counts = [pii.count_of("spans", kind).alias(f"n_{kind}") for kind in pii.KINDS[:-1]]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(base), 256).alias("base_sha256"),
                        pii.as_text(F.col("spans")).alias("spans"),
                        F.coalesce("clean_sha256", "own_sha256").alias("clean_sha256"))


@query("op3_mixing", """
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS hash,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), source_size AS (
  SELECT source, sum(size) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
         3 * source_size AS most FROM source_size
), filled AS (
  SELECT *, most / weight AS brim,
         (sum(source_size) OVER () - coalesce(sum(most) OVER (
            ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, rank, CASE WHEN brim <= level THEN CAST(most AS DOUBLE)
         ELSE weight * max(CASE WHEN brim > level THEN level END) OVER () END AS target FROM filled
), placed AS (
  SELECT doc_id, size, source_size, target, rank, floor(target / source_size) AS passes,
         coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY hash, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), counted AS (
  SELECT *, CASE WHEN size > 0 THEN passes + CASE WHEN middle < target - passes * source_size THEN 1 ELSE 0 END
            ELSE 0 END AS copies, middle / target * CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS due,
         CASE (rank - 1) % 3 WHEN 0 THEN 7.5 WHEN 1 THEN 2.0 ELSE 0.5 END::DOUBLE AS first_level,
         CASE (rank - 1) % 3 WHEN 0 THEN -5.0 WHEN 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS slope
  FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * copies AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN 2.0 * due / (first_level + sqrt(greatest(0.0::DOUBLE,
            first_level * first_level + 2.0 * slope * due))) END AS first_position
FROM counted
""")
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, folder, "documents"))
    return plan.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        F.get("positions", F.lit(0)).alias("first_position"),
    ).orderBy("first_position", "doc_id")


@query("op4_line_dedup", f"""
WITH line AS (
  SELECT doc_id, place, {TRIMMED} AS key, line
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) AS split) AS cut
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= {lines.MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}
), judged AS (
  SELECT line.*, shared.key IS NOT NULL AND line.doc_id <> keeper AS gone FROM line LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_exact_dedup", """
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY text)
""")
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact.exact_duplicates(table(spark, folder, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("copies").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    field = toxicity.train(spark, docs, table(spark, folder, "labels"))
    judged = docs.withColumn("judged", toxicity.judge(spark, F.col("text"), field))
    return judged.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("judged.score").alias("score"),
        (F.col("judged.score") >= toxicity.REJECT).cast("int").alias("predicted"),
        F.size("judged.spans").cast("long").alias("n_spans"))


@query("op7_embeddings")
def op7_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    rows = hnsw.near_vectors(table(spark, folder, "embeddings"))
    return rows.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                       F.col("id").eqNullSafe(F.col("component")).alias("kept"))


@query("op9_license")
def op9_license(spark: SparkSession, folder: str) -> DataFrame:
    """Documents have no paths: source and language stand for the directory, the id for the file's name.

    One without source or language stands in no directory.
    """
    path = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    docs = table(spark, folder, "documents").select("doc_id", "text", path.alias("path"))
    return license.scan(docs).select("doc_id", "license", "license_score", "license_origin")


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    made = docs.select("doc_id", byte_bpe.round_trip(
        spark, F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).alias("made"))
    return made.select(
        "doc_id", F.size("made.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("made.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("made.decoded", 256).alias("decoded_sha256"))


def rounds_sql(rounds: int) -> str:
    """Each round of the clustering as two expressions in a row of common table expressions."""
    near = """
p{n} AS MATERIALIZED (
  SELECT row, vec_id, v, min({{'distance': list_sum(list_transform(list_zip(v, m), lambda q: (q[1] - q[2]) * (q[1] - q[2]))),
                             'cluster': c}}) AS best
  FROM kept, c{n} GROUP BY row, vec_id, v
)"""
    move = """,
s{n} AS (
  SELECT c, d, sum(x) AS s, count(*) AS n
  FROM (SELECT best.cluster AS c, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM p{n}) AS cut GROUP BY c, d
), c{m} AS MATERIALIZED (
  SELECT c{n}.c, coalesce(moved.m, c{n}.m) AS m FROM c{n} LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS m FROM s{n} GROUP BY c) AS moved USING (c)
),"""
    return "".join(near.format(n=n) + move.format(n=n, m=n + 1) for n in range(rounds)) + near.format(n=rounds)


@query("op12_centroids", f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {centroids.WIDTH}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.WIDTH}
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY hash) - 1 AS INTEGER) AS c, v AS m
  FROM (SELECT v, sha256('{centroids.SEED}:' || CAST(vec_id AS VARCHAR)) AS hash FROM kept
        ORDER BY hash LIMIT {centroids.CLUSTERS}) AS drawn
),{rounds_sql(centroids.ROUNDS)}
SELECT vec_id, best.cluster AS cluster, CAST(best.distance AS BIGINT) AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM p{centroids.ROUNDS} JOIN c{centroids.ROUNDS} ON c = best.cluster
""")
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    placed, about = centroids.cluster(table(spark, folder, "embeddings"))
    # One row per centroid.
    about = about.select("cluster", "cluster_inertia", "inertia", F.sha2(
        F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))
    return placed.join(F.broadcast(about), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query("op13_hard_negatives", f"""
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor({negatives.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(coalesce(
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM taken AS a JOIN taken AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE same
  QUALIFY place <= {negatives.POSITIVES}
)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (
         PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive AS p JOIN scored AS n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND {negatives.LOWEST} * p.score <= 100 * n.score AND 100 * n.score <= {negatives.HIGHEST} * p.score
QUALIFY rank <= {negatives.NEGATIVES}
""")
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh vector has the next label, so that near vectors of another label exist."""
    number = F.col("vec_id")
    rows = table(spark, folder, "embeddings").withColumn("label", F.when(
        number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, number % 50 == 0)
