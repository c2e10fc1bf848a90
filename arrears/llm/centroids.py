"""Centroid clustering in whole numbers: k-means whose every step is a built-in expression and exact.

Components become integers, so sums, means and distances do not depend on the order in which rows meet, and any number
of partitions gives the same clusters. A round is one pass: ``zip_with`` and ``aggregate`` compute the squared distance
to each centroid, which stands in the plan as a literal array, ``array_min`` over (distance, number) structs chooses
the cluster, and one grouping with a generated sum per component, combined on the map side, gives the next centroids.
Only those sums, one row per cluster, reach the driver, which divides them exactly. A round that moves no centroid ends
the work early: all later ones would move none either. The integer vectors are written to the checkpoint folder once
and read in each round, so a lost executor costs a read.

Rules: vectors that are null, of another length, or hold a null or non-finite component are left out; components stop
at ``MOST`` on either side, so that neither distances of 64 components nor sums of 2^36 rows leave a long; a null id is
an id like any other and comes last in the choice of first centroids, where equal ids follow each other by vector;
repeated rows count as often as they stand; with fewer vectors than centroids there are as many centroids as vectors;
of equally near centroids the smaller number wins; a cluster without vectors keeps its centroid; an inertia beyond a
long is null; an empty table gives an empty result. Other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import settle

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 8, 10, 64, 1024, 3
MOST = 1 << 27
LONGEST = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, infinite or not a number; never null."""
    return F.coalesce(~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def whole(vector: Column, scale: int, most: int = MOST) -> Column:
    """Each component as floor(scale * x), x as double, at most ``most`` on either side."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(
        x.cast("double") * scale, F.lit(float(most))), F.lit(float(-most)))))


def literal(numbers: list[int]) -> Column:
    """A constant array; folded from one text, as a plan of thousands of single literals takes seconds to analyse."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>")


def nearest(vector: Column, norm: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid; of equally near ones the smaller number.

    A squared distance is the vector's squared ``norm`` plus what the fold gives: the centroid's, less twice their
    product.
    """
    def away(centroid: list[int]) -> Column:
        products = F.zip_with(vector, literal([-2 * c for c in centroid]), lambda x, c: x * c)
        start = F.lit(sum(c * c for c in centroid)).cast("long")
        return F.aggregate(products, start, lambda total, product: total + product)

    best = F.array_min(F.array(*[F.struct(away(c).alias("more"), F.lit(n).alias("cluster"))
                                 for n, c in enumerate(centroids)]))
    return F.transform(F.array(best), lambda b: F.struct(
        (norm + b["more"]).alias("distance"), b["cluster"].alias("cluster")))[0]


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.orderBy(drawn.asc_nulls_last(), "vector").select("vector").limit(clusters).collect()
    return [list(row["vector"]) for row in rows]


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: exact floors of the means of the vectors nearest to each."""
    if not centroids:
        return centroids
    width = len(centroids[0])
    sums = (kept.select(nearest(F.col("vector"), F.col("norm"), centroids)["cluster"].alias("cluster"), "vector")
            .groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                    *[F.expr(f"sum(vector[{i}]) AS s{i}") for i in range(width)]).collect())
    out = list(centroids)
    for row in sums:
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return out


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED
            ) -> tuple[DataFrame, DataFrame]:
    """Two frames: (id, cluster, distance) of each vector that takes part, and (cluster, centroid, cluster_inertia,
    inertia) of each cluster, at most ``clusters`` rows."""
    spark = vectors.sparkSession
    vector = F.col(vector_column)
    kept = settle(vectors.where((F.size(vector) == width) & finite(vector)).select(
        F.col(id_column).alias("id"), whole(vector, scale).alias("vector")).withColumn("norm", F.aggregate(
            F.transform("vector", lambda x: x * x), F.lit(0).cast("long"), lambda total, square: total + square)))
    centroids = first_centroids(kept, clusters, seed)
    for _ in range(rounds):
        before, centroids = centroids, moved(kept, centroids)
        if centroids == before:
            break
    if not centroids:
        placed = kept.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    else:
        placed = kept.select("id", nearest(F.col("vector"), F.col("norm"), centroids).alias("at")).select(
            "id", "at.cluster", "at.distance")
    placed = settle(placed)
    inertia = {row["cluster"]: row["inertia"] for row in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).cast("string").alias("inertia")).collect()}
    of_each = [int(inertia.get(n) or 0) for n in range(len(centroids))]
    rows = [F.struct(F.lit(n).alias("cluster"), literal(c).alias("centroid"),
                     long_or_null(of_each[n]).alias("cluster_inertia"),
                     long_or_null(sum(of_each)).alias("inertia")) for n, c in enumerate(centroids)]
    shape = "array<struct<cluster:int,centroid:array<bigint>,cluster_inertia:bigint,inertia:bigint>>"
    about = spark.range(1).select(F.inline(F.array(*rows) if rows else F.array().cast(shape)))
    return placed, about


def long_or_null(value: int) -> Column:
    return F.lit(value if value <= LONGEST else None).cast("long")
