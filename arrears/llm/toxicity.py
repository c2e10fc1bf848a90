"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels belong to documents, the field to words. Words whose spelling (the word, or its first letters) is much more
frequent in toxic documents than in clean ones are the first labels; a field is fitted to them, relabels the words of
toxic documents by its marginals, and is fitted again. A word's evidence is the sum of the weights of its spelling
features; the chain adds the weights of neighbouring labels. Forward and backward passes give each word its marginal,
words at ``SPAN`` or more are the offending spans, and a logistic model turns the marginals of a document (how many
words are expected toxic, how dense, how sure the surest) into its score. The logistic model is fitted on labelled rows
that the field has not seen.

Learning takes at most ``SAMPLE_ROWS`` labelled rows of at most ``SAMPLE_CHARS`` code points each, in the order of the
hash of their ids: a bounded sample, fitted on the driver. Scoring covers all rows and whole texts, moves no text
between tasks, and works through a partition in chunks of ``CHUNK_WORDS`` words or one text.

Rules: a null or empty text gets the score of a text without words; a null or conflicting label of a repeated id counts
as toxic if any of its labels is 1 and is left out if all are null; of the texts of a repeated id the field learns the
one with the smallest hash; rows that repeat a text have the same score; very long texts are scored whole; without
labels of both kinds every score is the share of toxic labels, or 0; an empty table gives an empty result. Scores and
spans are one column, which the caller names; all columns of the table pass through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_ROWS, SAMPLE_CHARS = 4_000, 12_000
CHUNK_WORDS = 150_000
KNOWN_WORDS = 200_000
BUCKETS = 1 << 18
HEADS = (4, 5, 6, 7)
RATIO, DOCUMENTS = 2.0, 8
ROUNDS, STEPS, RIDGE = 2, 60, 1e-4
SPAN, REJECT = 0.5, 0.7
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in HEADS if len(word) >= n)]


def buckets(word: str) -> list[int]:
    """Hashed features of a word, padded with bucket 0, whose weight stays zero."""
    found = [1 + zlib.crc32(f.encode("utf-8")) % (BUCKETS - 1) for f in features(word)]
    return found + [0] * (1 + len(HEADS) - len(found))


class Chains:
    """Sequences laid out step by step: the n-th words of all sequences lie together, longest sequence first."""

    def __init__(self, sizes: np.ndarray):
        order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[order] = np.arange(len(sizes))
        sorted_sizes = sizes[order]
        longest = int(sorted_sizes[0]) if len(sizes) else 0
        self.active = len(sizes) - np.searchsorted(sorted_sizes[::-1], np.arange(1, longest + 1), side="left")
        self.offset = np.concatenate([[0], np.cumsum(self.active)])
        begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        step = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
        self.place = self.offset[step] + np.repeat(rank, sizes)  # of each word in reading order

    def marginals(self, evidence: np.ndarray, chain: np.ndarray, pairs: bool = False):
        """Probability of label 1 of each word; with ``pairs``, also the expected counts of label pairs.

        With two labels, forward and backward messages are ratios of label 1 to label 0.
        """
        weight = np.empty(len(evidence))
        weight[self.place] = np.exp(np.clip(evidence, -30, 30))
        (c00, c01), (c10, c11) = np.exp(chain)
        ahead, back = np.empty(len(weight)), np.ones(len(weight))
        for t, (count, at) in enumerate(zip(self.active, self.offset)):
            here = slice(at, at + count)
            if t == 0:
                ahead[here] = weight[here]
            else:
                last = ahead[self.offset[t - 1]:self.offset[t - 1] + count]
                ahead[here] = weight[here] * (c01 + c11 * last) / (c00 + c10 * last)
        for t in range(len(self.active) - 2, -1, -1):
            count, at, after = self.active[t + 1], self.offset[t], self.offset[t + 1]
            more = weight[after:after + count] * back[after:after + count]
            back[at:at + count] = (c10 + c11 * more) / (c00 + c01 * more)
        both = ahead * back
        chance = (both / (1 + both))[self.place]
        if not pairs:
            return chance
        counts = np.zeros((2, 2))
        for t in range(len(self.active) - 1):
            count, at, after = self.active[t + 1], self.offset[t], self.offset[t + 1]
            left = ahead[at:at + count]
            right = weight[after:after + count] * back[after:after + count]
            joint = np.stack([np.full(count, c00), c01 * right, c10 * left, c11 * left * right])
            counts += (joint / joint.sum(0)).sum(1).reshape(2, 2)
        return chance, counts


class Field:
    """The fitted model: weights of hashed spelling features, of label pairs, and of the document's logistic score."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS, np.float32)
        self.bias = -4.0
        self.chain = np.zeros((2, 2))
        self.score_weights: np.ndarray | None = None
        self.constant = 0.0

    def evidence(self, rows: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[rows].sum(1, dtype=np.float64)

    def fit(self, rows: np.ndarray, words: np.ndarray, chains: Chains, labels: np.ndarray) -> None:
        """Adaptive gradient steps on the likelihood; ``rows`` are features of distinct words, ``words`` index them."""
        pairs = np.zeros((2, 2))
        laid = np.empty(len(labels))
        laid[chains.place] = labels
        for t in range(len(chains.active) - 1):
            count = chains.active[t + 1]
            left = laid[chains.offset[t]:chains.offset[t] + count]
            right = laid[chains.offset[t + 1]:chains.offset[t + 1] + count]
            ones = float(left @ right)
            pairs += [[count - left.sum() - right.sum() + ones, right.sum() - ones], [left.sum() - ones, ones]]
        total = max(1.0, len(labels) ** 0.5)
        seen_w, seen_c, seen_b = np.full(BUCKETS, 1e-6), np.full((2, 2), 1e-6), 1e-6
        for _ in range(STEPS):
            chance, expected = chains.marginals(self.evidence(rows)[words], self.chain, pairs=True)
            miss = np.bincount(words, labels - chance, len(rows))
            slope = np.bincount(rows.ravel(), np.repeat(miss, rows.shape[1]), BUCKETS) / total
            slope -= RIDGE * self.weights
            slope[0] = 0.0
            seen_w += slope ** 2
            self.weights += (0.5 * slope / np.sqrt(seen_w)).astype(np.float32)
            push = (pairs - expected) / total - RIDGE * self.chain
            push[0, 0] = 0.0
            seen_c += push ** 2
            self.chain += 0.2 * push / np.sqrt(seen_c)
            pull = miss.sum() / total
            seen_b += pull ** 2
            self.bias += 0.2 * pull / np.sqrt(seen_b)

    def score(self, chance: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.score_weights is None:
            return np.full(len(sizes), self.constant)
        logits = summary(chance, sizes) @ self.score_weights
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def summary(chance: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What the logistic model sees of each document: expected count, its density, the surest word, and a constant."""
    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    running = np.concatenate([[0.0], np.cumsum(chance)])
    expected = running[begins[1:]] - running[begins[:-1]]
    surest = np.zeros(len(sizes))
    filled = np.flatnonzero(sizes)
    if len(filled):
        surest[filled] = np.maximum.reduceat(chance, begins[:-1][filled])
    return np.stack([np.log1p(expected), 10 * expected / (20 + sizes), surest, np.ones(len(sizes))], axis=1)


def logistic(inputs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    weights = np.zeros(inputs.shape[1])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (labels - chance) - 0.1 * weights
        curve = (inputs * (chance * (1 - chance))[:, None]).T @ inputs + 0.1 * np.eye(len(weights))
        weights += np.linalg.solve(curve, slope)
    return weights


def learn(texts: list[str], toxic: np.ndarray) -> Field:
    """Fit field and score: two thirds of the rows for the field, one third for the score."""
    field = Field()
    if len(toxic) == 0 or toxic.min() == toxic.max():
        field.constant = float(toxic.mean()) if len(toxic) else 0.0
        return field
    split = [WORD.findall(text.lower()) for text in texts]
    number: dict[str, int] = {}
    words = [np.fromiter((number.setdefault(w, len(number)) for w in row), np.int64, len(row)) for row in split]
    spelled = list(number)
    rows = np.array([buckets(w) for w in spelled], np.int64).reshape(len(spelled), 1 + len(HEADS))
    mine = np.arange(len(toxic)) % 3 != 2
    suspect = suspects(spelled, [words[i] for i in np.flatnonzero(mine)], toxic[mine])
    body = [words[i] for i in np.flatnonzero(mine)]
    sizes = np.array([len(w) for w in body])
    flat = np.concatenate(body)
    in_toxic = np.repeat(toxic[mine], sizes) == 1
    chains = Chains(sizes)
    labels = (in_toxic & suspect[flat]).astype(np.float64)
    for turn in range(ROUNDS):
        field.fit(rows, flat, chains, labels)
        if turn < ROUNDS - 1:
            chance = chains.marginals(field.evidence(rows)[flat], field.chain)
            labels = (in_toxic & (chance >= 0.3)).astype(np.float64)
    rest = [words[i] for i in np.flatnonzero(~mine)]
    sizes = np.array([len(w) for w in rest])
    flat = np.concatenate(rest) if rest else np.zeros(0, np.int64)
    chance = Chains(sizes).marginals(field.evidence(rows)[flat], field.chain)
    field.score_weights = logistic(summary(chance, sizes), toxic[~mine].astype(np.float64))
    return field


def suspects(spelled: list[str], docs: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Of each distinct word, whether one of its features leans to toxic documents."""
    counts = (Counter(), Counter())
    names = [features(w) for w in spelled]
    for words, label in zip(docs, toxic):
        counts[int(label)].update({f for w in np.unique(words) for f in names[w]})
    base = np.log((toxic == 1).sum() + 1) - np.log((toxic == 0).sum() + 1)
    leaning = {f for f, n in counts[1].items()
               if n >= DOCUMENTS and np.log(n + 0.5) - np.log(counts[0][f] + 0.5) - base >= RATIO}
    return np.array([any(f in leaning for f in name) for name in names], bool)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
          text_column: str = "text", toxic_column: str = "toxic", sample_rows: int = SAMPLE_ROWS,
          sample_chars: int = SAMPLE_CHARS) -> Field:
    """Fit on a bounded sample of labelled rows that are not held out; the sample is taken by the hash of the id."""
    sample = labelled_sample(docs, labels, id_column, text_column, toxic_column, sample_rows, sample_chars).toPandas()
    sample = sample.assign(order=[zlib.crc32(str(i).encode()) for i in sample["id"]]).sort_values(["order", "id"])
    return learn(list(sample["text"]), sample["toxic"].to_numpy().astype(np.int64))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, toxic_column: str,
                    sample_rows: int, sample_chars: int) -> DataFrame:
    """At most ``sample_rows`` rows (id, toxic, text), one per id: of several texts the one with the smallest hash.

    Map tasks already reduce an id with many rows to one.
    """
    seen = labels.where(~held_out(F.col(id_column)) & F.col(toxic_column).isNotNull() & F.col(id_column).isNotNull())
    order = F.md5(F.col("id").cast("string"))
    chosen = (seen.groupBy(F.col(id_column).alias("id")).agg(F.max(toxic_column).alias("toxic"))
              .orderBy(order, "id").limit(sample_rows))  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    one = F.min(F.struct(F.sha2("text", 256).alias("hash"), "text"))
    return (rows.where(F.length("text") <= sample_chars).join(F.broadcast(chosen), "id")
            .groupBy("id", "toxic").agg(one.alias("one")).select("id", "toxic", "one.text"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


RESULT = "struct<score:double,spans:array<struct<start:int,end:int,chance:double>>>"


def judge(spark: SparkSession, text: Column, field: Field) -> Column:
    """Score and offending spans (code points, ends exclusive) of whole texts."""
    model = spark.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judged = Judge(model.value)
        for batch in batches:
            yield pa.array(judged.all(x.as_py() or "" for x in batch), pa.struct([
                ("score", pa.float64()), ("spans", pa.list_(pa.struct([
                    ("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())])))]))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, RESULT)(text)


class Judge:
    def __init__(self, field: Field):
        self.field, self.known = field, {}

    def all(self, texts: Iterator[str]) -> Iterator[dict]:
        chunk: list[str] = []
        evidence: list[np.ndarray] = []
        words = 0
        for text in texts:
            chunk.append(text)
            evidence.append(self.evidence(text))
            words += len(evidence[-1])
            if words >= CHUNK_WORDS:
                yield from self.flush(chunk, evidence)
                chunk, evidence, words = [], [], 0
        yield from self.flush(chunk, evidence)

    def evidence(self, text: str) -> np.ndarray:
        found = WORD.findall(text.lower())
        known = self.known
        new = [w for w in set(found) if w not in known]
        if new:
            if len(known) > KNOWN_WORDS:
                known.clear()
                new = list(set(found))
            known.update(zip(new, self.field.evidence(np.array([buckets(w) for w in new], np.int64)).tolist()))
        return np.fromiter(map(known.__getitem__, found), np.float64, len(found))

    def flush(self, texts: list[str], evidence: list[np.ndarray]) -> Iterator[dict]:
        if not texts:
            return
        sizes = np.array([len(e) for e in evidence])
        chance = Chains(sizes).marginals(np.concatenate(evidence), self.field.chain)
        ends = np.cumsum(sizes)
        for text, score, end, size in zip(texts, self.field.score(chance, sizes).tolist(), ends, sizes):
            yield {"score": score, "spans": offending(text, chance[end - size:end])}


def offending(text: str, chance: np.ndarray) -> list[dict]:
    hits = np.flatnonzero(chance >= SPAN)
    if not len(hits):
        return []
    low = text.lower()
    places = [m.span() for m in WORD.finditer(low)]
    back = None if len(low) == len(text) else lowered_places(text)
    out: list[dict] = []
    for hit in hits:
        start, end = places[hit] if back is None else (back[places[hit][0]], back[places[hit][1]])
        if out and hit - 1 == last:
            out[-1]["end"] = end
            out[-1]["chance"] = max(out[-1]["chance"], float(chance[hit]))
        else:
            out.append({"start": start, "end": end, "chance": float(chance[hit])})
        last = hit
    return out


def lowered_places(text: str) -> list[int]:
    """For each place of the lower-cased text, the place of its letter in the text (a few letters grow)."""
    out = [at for at, letter in enumerate(text) for _ in letter.lower()]
    return out + [len(text)]
