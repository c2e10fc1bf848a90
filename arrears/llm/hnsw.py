"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard, and connected components.

Only vectors of one label and length are compared. Equal vectors form a class that takes part once and counts as many
as it has. The classes of a label are dealt by hash into shards of about ``SHARD_ROWS``; every class is looked up in
every shard of its label. Queries come in blocks of about ``BLOCK_ROWS``, so a label of any size becomes many bounded
tasks, each of which builds the shard's graph and searches it. After building, a task searches ``AUDITS`` linked members
whose neighbours it also finds by comparing them with the whole shard, and doubles the beam until ``RECALL`` of a
member's true links is found in the mean, so that small groups weigh as much as large ones. If no beam that is cheaper
than the whole shard gets there, queries are compared with the shard directly. Otherwise every query goes down the
layers, the beam settles on the bottom layer, and from what is similar enough the search spreads along the graph until
nothing new is similar. Cosines are verified in double precision.

A task gives one count per query and a spanning forest of the links it saw, never pairs of a group; components of the
forests' union are those of all links.

Rules: vectors that are null, empty, zero or hold a null or non-finite component, and those with a null label or null
id, link with nothing and are their own component; rows that repeat an id and a vector count once; vectors of different
lengths link with nothing of each other; a component is named by its smallest id, so ties decide nothing; an empty table
gives an empty result. Other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import settle
from arrears.llm.graph import components

COSINE = 0.93
SHARD_ROWS, BLOCK_ROWS = 16_384, 131_072
LINKS, BUILD_BEAM, FIRST_BEAM = 12, 32, 16
AUDITS, RECALL = 256, 0.995
SLACK = 0.02  # the search also spreads through vectors that miss the limit by this much
LINK, COUNT = 0, 1
FOUND = "kind int, node long, other long, links long"


class Graph:
    """A layered graph over unit vectors; layer 0 holds all of them, each higher layer about one in ``LINKS``."""

    def __init__(self, vectors: np.ndarray, seed: int):
        self.x = vectors
        n = len(vectors)
        draws = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(1 - draws) / math.log(LINKS)).astype(int), 8)
        self.layers = [np.full((n, 2 * LINKS), -1, np.int32)]
        for _ in range(int(self.level.max()) if n else 0):
            self.layers.append(np.full((n, LINKS), -1, np.int32))
        self.seen = np.zeros(n, np.int64)
        self.stamp = 0
        self.top = 0
        for node in range(1, n):
            self._insert(node)

    def _insert(self, node: int) -> None:
        q, level, start = self.x[node], self.level[node], self.level[self.top]
        at = np.array([self.top])
        for layer in range(start, level, -1):
            at = self.beam(q, at, layer, 1)[0]
        for layer in range(min(level, start), -1, -1):
            at, near = self.beam(q, at, layer, BUILD_BEAM)
            mine = self._choose(at, near, LINKS)
            table = self.layers[layer]
            table[node, :len(mine)] = mine
            for other in mine:
                row = table[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                else:
                    known = np.append(row, node)
                    near_other = self.x[known] @ self.x[other]
                    order = np.argsort(-near_other, kind="stable")
                    kept = self._choose(known[order], near_other[order], len(row))
                    row[:] = -1
                    row[:len(kept)] = kept
        if level > start:
            self.top = node

    def _choose(self, nodes: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """Of candidates, nearest first: those nearer to the node than to any chosen one, then the nearest others."""
        if len(nodes) <= most:
            return nodes
        among = self.x[nodes] @ self.x[nodes].T
        closest = np.full(len(nodes), -2.0)
        chosen, left = [], []
        for i in range(len(nodes)):
            if near[i] > closest[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                np.maximum(closest, among[i], out=closest)
            else:
                left.append(i)
        return nodes[(chosen + left)[:most]]

    def beam(self, q: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` nodes found from ``start``, nearest first, with their cosines."""
        self.stamp += 1
        table, seen, stamp = self.layers[layer], self.seen, self.stamp
        nodes, near = start, self.x[start] @ q
        seen[nodes] = stamp
        fresh = nodes
        while len(fresh):
            around = table[fresh].ravel()
            around = around[around >= 0]
            around = np.unique(around[seen[around] != stamp])
            if not len(around):
                break
            seen[around] = stamp
            close = self.x[around] @ q
            floor = near.min() if len(near) >= width else -2.0
            better = close > floor
            fresh, close = around[better], close[better]
            nodes, near = np.concatenate([nodes, fresh]), np.concatenate([near, close])
            if len(nodes) > width:
                best = np.argpartition(-near, width - 1)[:width]
                cut = near[best].min()
                nodes, near = nodes[best], near[best]
                fresh = fresh[close >= cut]
        order = np.argsort(-near, kind="stable")
        return nodes[order], near[order]

    def within(self, q: np.ndarray, limit: float, width: int) -> np.ndarray:
        """Nodes whose cosine with ``q`` reaches ``limit``, as far as the graph leads to them."""
        at = np.array([self.top])
        for layer in range(self.level[self.top], 0, -1):
            at = self.beam(q, at, layer, 1)[0]
        nodes, near = self.beam(q, at, 0, width)
        table, seen = self.layers[0], self.seen
        self.stamp += 1
        seen[nodes] = self.stamp
        found = [nodes[near >= limit]]
        edge = nodes[near >= limit - SLACK]
        while len(edge):
            around = table[edge].ravel()
            around = around[around >= 0]
            around = np.unique(around[seen[around] != self.stamp])
            seen[around] = self.stamp
            close = self.x[around] @ q
            found.append(around[close >= limit])
            edge = around[close >= limit - SLACK]
        return np.concatenate(found)


def audit(graph: Graph, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Members spread over the shard that have links, ``AUDITS`` or all there are, and their true links as flags.

    A member's hit on itself is no link.
    """
    n = len(graph.x)
    order = np.random.default_rng(n).permutation(n)
    tried, truth, known = [], [], 0
    for start in range(0, n, AUDITS):
        some = order[start:start + AUDITS]
        near = graph.x[some] @ graph.x.T >= limit
        near[np.arange(len(some)), some] = False
        linked = near.any(axis=1)
        tried.append(some[linked])
        truth.append(near[linked])
        known += int(linked.sum())
        if known >= AUDITS:
            break
    return np.concatenate(tried)[:AUDITS], np.concatenate(truth)[:AUDITS]


def audited_beam(graph: Graph, limit: float) -> int:
    """The narrowest beam, by doubling, that finds ``RECALL`` of a member's links in the mean over the audited members.

    A beam that looks at as many vectors as the shard has is no use: then the shard's size is given, which tells that
    queries are to be compared with the shard directly.
    """
    n, width = len(graph.x), FIRST_BEAM
    if width * 2 * LINKS >= n:
        return n
    tried, truth = audit(graph, limit)
    if not len(tried):
        return width
    links = truth.sum(axis=1)
    while width * 2 * LINKS < n:
        found = [truth[i, graph.within(graph.x[t], limit, width)].sum() for i, t in enumerate(tried)]
        if np.mean(found / links) >= RECALL:
            return width
        width *= 2
    return n


def met_by(graph: Graph, queries: np.ndarray, limit: float, width: int):
    """For each query the members that reach ``limit``: along the graph, or for the shard's width by comparing all."""
    if width < len(graph.x):
        for q in queries:
            yield graph.within(q, limit, width)
    else:
        for start in range(0, len(queries), AUDITS):
            for near in queries[start:start + AUDITS] @ graph.x.T >= limit:
                yield np.flatnonzero(near)


def search(key: tuple, members: pd.DataFrame, queries: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Counts of links per query, and a forest of them, between one block of queries and one shard."""
    if not len(members) or not len(queries):
        return pd.DataFrame(np.zeros((0, 4), np.int64), columns=["kind", "node", "other", "links"])
    members, queries = members.sort_values("id"), queries.sort_values("q_id")
    raw = np.stack(members["vector"].to_list()).astype(float)
    asked = np.stack(queries["q_vector"].to_list()).astype(float)
    size, asked_size = np.linalg.norm(raw, axis=1), np.linalg.norm(asked, axis=1)
    graph = Graph(raw / size[:, None], seed=int(key[2]) & 0xFFFF)
    width = audited_beam(graph, cosine)
    ids, copies = members["id"].to_numpy(np.int64), members["copies"].to_numpy(np.int64)
    own = queries["q_id"].to_numpy(np.int64)
    everyone, place = np.unique(np.concatenate([ids, own]), return_inverse=True)
    of_member, of_query = place[:len(ids)], place[len(ids):]
    root = np.arange(len(everyone))
    links = np.zeros(len(own), np.int64)
    for i, met in enumerate(met_by(graph, asked / asked_size[:, None], cosine - 1e-9, width)):
        q = asked[i]
        met = met[(raw[met] @ q) / (size[met] * asked_size[i]) >= cosine]
        met = met[ids[met] != own[i]]
        if len(met):
            links[i] = copies[met].sum()
            joined = np.unique(np.append(root[of_member[met]], root[of_query[i]]))
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
    hung = np.flatnonzero(root != np.arange(len(root)))
    linked = np.flatnonzero(links)
    return pd.DataFrame({
        "kind": np.repeat([LINK, COUNT], [len(hung), len(linked)]),
        "node": np.concatenate([everyone[hung], own[linked]]),
        "other": np.concatenate([everyone[root[hung]], own[linked]]),
        "links": np.concatenate([np.zeros(len(hung), np.int64), links[linked]]),
    })


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                 label_column: str = "label", cosine: float = COSINE, shard_rows: int = SHARD_ROWS,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (id, n_links, component) for each row of ``vectors``."""
    vector = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"),
                          F.col(vector_column).cast("array<double>").alias("vector"))
    usable = F.coalesce(
        F.col("id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull()
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    classes = settle(
        rows.where("usable").groupBy("label", F.size("vector").alias("width"), "vector")
        .agg(F.min("id").alias("id"), F.countDistinct("id").alias("copies")))
    sizes = classes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
    dealt = classes.join(sizes, ["label", "width"])
    shards, blocks = F.ceil(F.col("n") / shard_rows), F.ceil(F.col("n") / block_rows)
    hashed = F.xxhash64("id")
    key = ["label", "width", "shard", "block"]
    members = dealt.select("label", "width", F.pmod(hashed, shards).cast("long").alias("shard"), F.explode(
        F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "id", "copies", "vector")
    queries = dealt.select(
        F.col("label").alias("q_label"), F.col("width").alias("q_width"),
        F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("q_shard"),
        F.pmod(F.shiftright(hashed, 20), blocks).cast("long").alias("q_block"),
        F.col("id").alias("q_id"), F.col("vector").alias("q_vector"))
    found = settle(members.groupBy(key).cogroup(queries.groupBy(*[f"q_{k}" for k in key])).applyInPandas(
        lambda k, m, q: search(k, m, q, cosine), FOUND))
    counts = found.where(F.col("kind") == COUNT).groupBy(F.col("node").alias("class")).agg(F.sum("links").alias("links"))
    parts = components(found.where(F.col("kind") == LINK).select(F.col("node").alias("a"), F.col("other").alias("b")))
    parts = parts.withColumnRenamed("node", "class")
    known = classes.select(F.col("id").alias("class"), "label", "vector", "copies")
    known = known.join(counts, "class", "left").join(parts, "class", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component"), F.lit(True).alias("usable"))
    joined = rows.join(known, ["usable", "label", "vector"], "left")
    return joined.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                         F.coalesce("component", "id").alias("component"))
