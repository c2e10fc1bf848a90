"""Exact deduplication by Patricia tries whose terminal nodes hold the smallest id and the number of copies.

Two rounds, both of tries over full byte strings. First each input partition inserts its texts, so a text that a third
of all rows share leaves a task as a few rows. Then texts are partitioned by length and content hash and the tries of
each partition say which row owns each text. A trie's size is bounded: beyond ``TRIE_BYTES`` its heaviest subtrees are
given out and freed; in the first round that only repeats a text later on, in the second a trie is one run of equal
(length, hash) in a partition that Spark has sorted, and sorting is where it spills. Owners are joined back to the rows
by the SHA-256 of the text; no text is moved twice.

Rules: a null text is empty; runs of ASCII white space count as one space each, at the ends too; a null id never owns a
text unless no row of the text has an id; repeated rows count each; very long texts are compared whole;
an empty table gives an empty result. Other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIE_BYTES = 48_000_000
FLUSH_ROWS, FLUSH_BYTES = 2_000, 8_000_000
OWNERS = "length int, hash long, text binary, keep_id long, copies long"


class Node:
    """An edge label, the children by the first byte of theirs, and at a terminal the owner of the text."""

    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: list | None = None):
        self.label, self.children, self.owner = label, {}, owner


class PatriciaTrie:
    def __init__(self):
        self.root, self.bytes = Node(b""), 0

    def insert(self, text: bytes, keep_id: int | None, copies: int) -> None:
        node, at = self.root, 0
        while True:
            if at == len(text):
                if node.owner is None:
                    node.owner = [keep_id, copies]
                else:
                    node.owner[0] = least(node.owner[0], keep_id)
                    node.owner[1] += copies
                return
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = Node(text[at:], [keep_id, copies])
                self.bytes += len(text) - at + 200
                return
            if not text.startswith(child.label, at):
                common = shared(child.label, text, at)
                upper = Node(child.label[:common])
                node.children[text[at]] = upper
                child.label = child.label[common:]
                upper.children[child.label[0]] = child
                self.bytes += 200
                child = upper
            at += len(child.label)
            node = child

    def shed(self, until: int) -> Iterator[tuple[bytes, int | None, int]]:
        """Give out and free the subtrees below the root, heaviest first, until ``until`` bytes are left."""
        if self.root.owner is not None:
            yield b"", *self.root.owner
            self.root.owner = None
        weights = {first: weight(child) for first, child in self.root.children.items()}
        for first in sorted(weights, key=weights.get, reverse=True):
            if self.bytes <= until:
                return
            yield from terminals(self.root.children.pop(first))
            self.bytes -= weights[first]


def shared(label: bytes, text: bytes, at: int) -> int:
    """Length of the common start of ``label`` and ``text[at:]``, found by halving."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def weight(node: Node) -> int:
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        total += len(node.label) + 200
        todo += node.children.values()
    return total


def terminals(node: Node) -> Iterator[tuple[bytes, int | None, int]]:
    todo = [(node, b"")]
    while todo:
        node, prefix = todo.pop()
        prefix += node.label
        if node.owner is not None:
            yield prefix, *node.owner
        todo += [(child, prefix) for child in node.children.values()]


def least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


class Rows:
    """Owner rows, gathered into record batches of bounded size."""

    def __init__(self):
        self.schema = pa.schema([("length", pa.int32()), ("hash", pa.int64()), ("text", pa.binary()),
                                 ("keep_id", pa.int64()), ("copies", pa.int64())])
        self.clear()

    def clear(self) -> None:
        self.rows, self.bytes = [], 0

    def add(self, text: bytes, hashed: int, keep_id: int | None, copies: int) -> bool:
        self.rows.append((len(text), hashed, text, keep_id, copies))
        self.bytes += len(text)
        return len(self.rows) >= FLUSH_ROWS or self.bytes >= FLUSH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 5
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.schema.types)],
                                          schema=self.schema)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First round: the distinct texts of a partition, or of as much of it as a trie may hold."""
    import xxhash

    trie, out = PatriciaTrie(), Rows()

    def give(until: int) -> Iterator[pa.RecordBatch]:
        for text, keep_id, copies in trie.shed(until):
            if out.add(text, xxhash.xxh64_intdigest(text, 0) - (1 << 63), keep_id, copies):
                yield out.batch()

    for batch in batches:
        for keep_id, text in zip(batch.column("id"), batch.column("text")):
            trie.insert(text.as_py().encode("utf-8"), keep_id.as_py(), 1)
            if trie.bytes > TRIE_BYTES:
                yield from give(TRIE_BYTES // 2)
    yield from give(-1)
    yield out.batch()


def settle_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second round: input sorted by (length, hash); each run of both is one trie, given out when the run ends."""
    trie, out, run = PatriciaTrie(), Rows(), None

    def give() -> Iterator[pa.RecordBatch]:
        if run is not None:
            for text, keep_id, copies in terminals(trie.root):
                if out.add(text, run[1], keep_id, copies):
                    yield out.batch()

    for batch in batches:
        for length, hashed, text, keep_id, copies in zip(*(batch.column(c) for c in out.schema.names)):
            here = (length.as_py(), hashed.as_py())
            if here != run:
                yield from give()
                trie, run = PatriciaTrie(), here
            trie.insert(text.as_py(), keep_id.as_py(), copies.as_py())
    yield from give()
    yield out.batch()


def owners(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per distinct normalised text: length, hash, text (binary), keep_id, copies."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), normalised(F.col(text_column)).alias("text"))
    local = rows.mapInArrow(combine, OWNERS)
    return (local.repartition("length", "hash").sortWithinPartitions("length", "hash")
            .mapInArrow(settle_owners, OWNERS))


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, keep_id, copies, digest) for each row of ``docs``; digest is the normalised text's SHA-256."""
    owned = owners(docs, id_column, text_column).select(F.sha2("text", 256).alias("digest"), "keep_id", "copies")
    rows = docs.select(F.col(id_column).alias("id"), F.sha2(normalised(F.col(text_column)), 256).alias("digest"))
    return rows.join(owned, "digest").select("id", "keep_id", "copies", "digest")
