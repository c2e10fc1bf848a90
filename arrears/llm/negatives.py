"""Hard negatives by Fagin's threshold algorithm over integer inner products.

Components become integers, so scores are exact and ties are real. Anchors look up, first, their best rows of the same
label (positives), then, for each positive, the best rows of other labels inside a window of scores below it. Rows are
dealt by hash into shards, for positives within each label, for negatives regardless of it; anchors come in blocks; one
task holds one shard and one block, both bounded in bytes. In a task every dimension has the list of the shard's rows
sorted by that component. An anchor reads each list from its high end where its own component is positive, from its low
end where it is negative, and not at all where it is zero, some entries of every list at a time. Each row it meets is
scored whole by random access. The threshold, the anchor's inner product with the last value read of every list, bounds
the score of every row not met, so the search ends when it falls strictly below the score at which each window is
settled: its k-th best score so far, or its lower end. How many entries are read at a time follows what the anchor
before needed; that changes time only, never results. Tasks return at most k rows per anchor and window, and the best k
over all shards are taken by window functions that Spark limits before it shuffles.

The work is anchors times rows, in blocks: with dimensions by the dozen, thresholds fall late, and most rows of a shard
are scored.

Rules: rows with a null id, label or vector, or with a null or non-finite component, take no part; components stop at
``MOST`` on either side, so that scores stay exact; of vectors of different lengths the shorter reads as padded with
zeros; rows that repeat id, label and vector count once; rows that share an id with another label or vector are rows of
their own, but no row is a positive or a negative of an anchor with its own id; ties go to the smaller id, then to the
smaller hash of label and vector; an anchor without positives, and a positive without negatives, gives no row; an empty
table gives an empty result. Other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.centroids import finite, whole
from arrears.llm.common import settle

SCALE = 256
MOST = 1 << 20
POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95  # per cent of the positive's score
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 32 << 20
FIRST_DEPTH = 16
NOTHING = np.iinfo(np.int64).min
ASKED = ("own_id", "own_print", "own_label", "asked", "windows")
FOUND = "anchor_id long, anchor_print long, positive_score long, id long, print long, score long"


class Lists:
    """The rows of a shard with one sorted list of them per dimension."""

    def __init__(self, ids: np.ndarray, prints: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.lexsort((prints, ids))  # of equal scores the first row wins
        self.ids, self.prints, self.labels = ids[order], prints[order], labels[order]
        self.rows = rows[order]
        self.order = np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(self.rows, self.order.T, axis=0).T.copy()
        self.depth = FIRST_DEPTH

    def search(self, anchor: np.ndarray, allowed: np.ndarray,
               settled: Callable[[np.ndarray, np.ndarray], float]) -> tuple[np.ndarray, np.ndarray]:
        """Rows met, best first, with their scores; every row that could still change a window is among them.

        ``settled`` gives, for the allowed rows met so far and their scores, the score below which no further row
        counts.
        """
        n = len(self.rows)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        scores = np.zeros(n, self.rows.dtype)
        met = np.zeros(n, bool)
        if not len(up) and not len(down):
            met[:] = True  # every score is 0, no list is read
        read, step = 0, self.depth
        while not met.all():
            upto = min(n, read + step)
            touched = np.zeros(n, bool)
            touched[self.order[up, n - upto:n - read].ravel()] = True
            touched[self.order[down, read:upto].ravel()] = True
            new = np.flatnonzero(touched & ~met)
            if len(new) == n:
                scores = self.rows @ anchor
            else:
                scores[new] = self.rows[new] @ anchor
            met[new] = True
            threshold = anchor[up] @ self.values[up, n - upto] + anchor[down] @ self.values[down, upto - 1]
            read, step = upto, upto
            some = np.flatnonzero(met & allowed)
            if threshold < settled(some, scores[some]):
                break
        self.depth = max(FIRST_DEPTH, read // 2)
        some = np.flatnonzero(met & allowed)
        some = some[np.argsort(-scores[some], kind="stable")]
        return some, scores[some].astype(np.int64)


def kth(scores: np.ndarray, k: int) -> float:
    """The k-th best score, or what is below all if there are fewer."""
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def window(positive_score: int, lowest: int, highest: int) -> tuple[int, int]:
    """The scores s with lowest * p <= 100 * s <= highest * p, as both ends; the window may be empty."""
    return -(-lowest * positive_score // 100), highest * positive_score // 100


def positives_of(lists: Lists, anchor: np.ndarray, own: int, k: int) -> Iterator[tuple[int, int, int]]:
    """(window, row, score) of the k best rows that have another id than the anchor."""
    some, scores = lists.search(anchor, lists.ids != own, lambda _, met: kth(met, k))
    for row, score in zip(some[:k].tolist(), scores[:k].tolist()):
        yield NOTHING, row, score


def negatives_of(lists: Lists, anchor: np.ndarray, own: int, label: int, windows: list[int], k: int, lowest: int,
                 highest: int) -> Iterator[tuple[int, int, int]]:
    """(window, row, score) of the k best rows of other labels in each window; windows go by their positive's score."""
    ends = {p: window(p, lowest, highest) for p in windows}
    ends = {p: (low, high) for p, (low, high) in ends.items() if low <= high}
    if not ends:
        return

    def settled(_, met: np.ndarray) -> float:
        return min(max(low, kth(met[(met >= low) & (met <= high)], k)) for low, high in ends.values())

    some, scores = lists.search(anchor, (lists.labels != label) & (lists.ids != own), settled)
    for p, (low, high) in ends.items():
        inside = np.flatnonzero((scores >= low) & (scores <= high))[:k]
        for row, score in zip(some[inside].tolist(), scores[inside].tolist()):
            yield p, row, score


def dense(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer vectors as one matrix, padded with zeros or cut at ``width``."""
    vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = column < width
    out[row[kept], column[kept]] = values[kept]
    return out


def exact_type(rows: np.ndarray, anchors: np.ndarray) -> type:
    """The narrowest type in which every inner product, and every sum on the way to it, is exact."""
    if not rows.size or not anchors.size:
        return np.float32
    most = int(np.abs(rows).max()) * int(np.abs(anchors).max()) * rows.shape[1]
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def look_up(members: pa.Table, anchors: pa.Table, per_anchor: Callable) -> pa.Table:
    """One shard against one block of anchors."""
    fields = [("anchor_id", pa.int64()), ("anchor_print", pa.int64()), ("positive_score", pa.int64()),
              ("id", pa.int64()), ("print", pa.int64()), ("score", pa.int64())]
    out: list[list[int]] = [[] for _ in fields]
    if len(members) and len(anchors):
        width = min(int(vectors.combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max())
                    for vectors in (members["vector"], anchors["asked"]))
        rows, asked = dense(members["vector"], width), dense(anchors["asked"], width)
        kind = exact_type(rows, asked)
        lists = Lists(*(members[c].to_numpy() for c in ("id", "print", "label")), rows.astype(kind))
        about = anchors.select(["own_id", "own_print", "own_label", "windows"]).to_pylist()
        for anchor, vector in zip(about, asked.astype(kind)):
            for positive_score, row, score in per_anchor(lists, vector, anchor):
                for column, value in zip(out, (anchor["own_id"], anchor["own_print"], positive_score, int(lists.ids[row]),
                                               int(lists.prints[row]), score)):
                    column.append(value)
    return pa.table([pa.array(values, kind) for values, (_, kind) in zip(out, fields)], [name for name, _ in fields])


def bytes_of(vector: Column) -> Column:
    return F.lit(8).cast("long") * (F.size(vector) + 8)


def in_blocks(members: DataFrame, anchors: DataFrame, shards: Column, blocks: Column, by: list[str],
              per_anchor: Callable) -> DataFrame:
    """Every anchor against every member of the same ``by``, one shard and one block of anchors per task.

    Both sides hold their (``id``, ``print``, ``label``, ``vector``) and what ``shards`` and ``blocks`` are made of.
    """
    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))

    def own(count: Column) -> Column:
        return F.pmod(F.xxhash64("id", "print"), count)

    key = [*(f"by_{c}" for c in by), "shard", "block"]
    names = [F.col(c).alias(f"by_{c}") for c in by]
    held = members.select(*names, own(shards).alias("shard"), every(blocks).alias("block"), "id", "print", "label",
                          "vector")
    asked = anchors.select(*names, every(shards).alias("shard"), own(blocks).alias("block"), "id", "print", "label",
                           "vector", "windows").toDF(*[f"q_{c}" for c in key], *ASKED)
    return held.groupBy(*key).cogroup(asked.groupBy(*[f"q_{c}" for c in key])).applyInArrow(
        lambda left, right: look_up(left, right, per_anchor), FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each anchor and window, with their rank."""
    order = Window.partitionBy("anchor_id", "anchor_print", "positive_score").orderBy(
        F.desc("score"), "id", "print")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_column: str = "vec_id", vector_column: str = "embedding",
                   label_column: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lowest: int = LOWEST, highest: int = HIGHEST, scale: int = SCALE, shard_bytes: int = SHARD_BYTES,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the columns of ``vectors``; labels are whole numbers. Per anchor and positive, the
    best ``negatives`` rows whose score lies between ``lowest`` and ``highest`` per cent of the positive's.
    """
    vector = F.col(vector_column)
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & finite(vector)).select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
        whole(vector, scale, MOST).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = settle(rows.groupBy("id", "label", "vector").agg(F.max("anchor").alias("anchor"))
                  .withColumn("print", F.xxhash64("label", "vector")))
    # One row per label: how many bytes of rows and of anchors it has.
    per_label = settle(rows.groupBy("label").agg(
        F.sum(bytes_of(F.col("vector"))).alias("row_bytes"),
        F.sum(F.when(F.col("anchor"), bytes_of(F.col("vector"))).otherwise(0)).alias("anchor_bytes")))

    def parts(column: Column, most: int) -> Column:
        return F.greatest(F.ceil(column / most), F.lit(1).cast("long"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.join(per_label.where(F.col("anchor_bytes") > 0), "label")

    asked = rows.where("anchor").withColumn("windows", F.array().cast("array<long>"))
    near = settle(best(in_blocks(
        dealt(rows), dealt(asked), parts(F.col("row_bytes"), shard_bytes), parts(F.col("anchor_bytes"), block_bytes),
        ["label"], lambda lists, anchor, about: positives_of(lists, anchor, about["own_id"], positives)), positives))

    windows = near.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_print").alias("print")).agg(
        F.collect_set("score").alias("windows"))
    asked = rows.where("anchor").join(windows, ["id", "print"])
    total = per_label.agg(F.sum("row_bytes").alias("rows"), F.sum("anchor_bytes").alias("anchors")).first()
    far = best(in_blocks(
        rows, asked, F.lit(-(-(total["rows"] or 1) // shard_bytes)).cast("long"),
        F.lit(-(-(total["anchors"] or 1) // block_bytes)).cast("long"), [],
        lambda lists, anchor, about: negatives_of(lists, anchor, about["own_id"], about["own_label"], about["windows"],
                                                  negatives, lowest, highest)), negatives)
    chosen = near.select("anchor_id", "anchor_print", F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return chosen.join(far, ["anchor_id", "anchor_print", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
