"""Near-duplicates by SimHash: segment-popcount embedding, grid range-join, exact check, components.

A fingerprint of 64 bits has 32 segments of two bits. Their bit counts (0, 1 or 2) are its point; all 32 counts fit
one long, two bits each. The Manhattan distance of two points never exceeds the number of differing bits, so texts at
``DISTANCE`` or fewer bits have points at that distance or less. The 32 dimensions fall into three blocks: in at least
one block the points are then at Manhattan distance 0 or 1 (4 / 3 rounded down). The grid range-join lists every point
in its cell of each block and looks it up in that cell and in the cells one step up; of two neighbours at distance 1,
one lies a step above the other. So no pair within reach is missed, whatever the number of documents, and nothing is
capped. Pairs that meet are checked by their differing bits.

Copies share a fingerprint and take part once, so a group of copies never forms pairs.

Rules: a null or empty text, or one without words, has fingerprint zero and is linked like any other; whole texts are
read, whatever their length; a bit that is set in exactly half of the hashes is 0; rows that repeat an id or a text are
rows of their own, ``one_per_group`` keeps one of those that repeat both; a null id is larger than all others; an empty
table gives an empty result. Other columns pass through ``one_per_group`` under any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import LOWER, UPPER, WORD, fresh, row_key, settle, text_print
from arrears.llm.graph import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
EVEN = 0x5555555555555555
BLOCKS = (range(0, 11), range(11, 22), range(22, 32))  # of two-bit segments


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of a whole text over shingles of words, repeats counted; zero for a text without words or null.

    A to Z are lower-cased, words are runs without ASCII white space; fewer words than a shingle are one shingle. A
    bit is set if it is set in over half of the shingles' hashes.
    """
    lower = str.maketrans(UPPER, LOWER)
    words = re.compile(WORD).findall
    hashed = xxhash.xxh64_intdigest
    rest = range(1, shingle)

    def one(text: str | None) -> int:
        found = words((text or "").translate(lower) if not (text or "").isascii() else text.lower()) if text else []
        if not found:
            return 0
        if len(found) < shingle:
            rows = [" ".join(found)]
        else:
            rows = map(" ".join, zip(found, *(found[k:] for k in rest)))
        hashes = np.fromiter((hashed(row, SEED) for row in rows), "<u8")
        set_in = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<i8")[0])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((one(x.as_py()) for x in batch), pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "long")(text)


def embed(bits: str) -> str:
    """SQL for the bit counts of the 32 segments of ``bits``, packed as the segments lie (no sum may overflow)."""
    low, high = f"({bits} & {EVEN}L)", f"(shiftrightunsigned({bits}, 1) & {EVEN}L)"
    return f"(({low} ^ {high}) | shiftleft({low} & {high}, 1))"


def grid_links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``bits`` at most ``distance`` bits apart."""
    if distance >= 2 * len(BLOCKS):
        raise ValueError("three blocks one step apart reach a distance of 5 at most")
    point = embed("bits")
    home, up = [], []
    for number, block in enumerate(BLOCKS):
        mask = sum(3 << (2 * k) for k in block)
        cell = f"(p & {signed(mask)}L)"
        home.append(f"struct({number} AS block, {cell} AS cell, false AS moved)")
        for k in block:
            low, both = signed(1 << (2 * k)), signed(3 << (2 * k))
            count = f"(shiftrightunsigned(p, {2 * k}) & 3L)"
            up.append(f"CASE {count} WHEN 0L THEN struct({number} AS block, {cell} | {low}L AS cell, true AS moved) "
                      f"WHEN 1L THEN struct({number} AS block, {cell} ^ {both}L AS cell, true AS moved) END")
    base = points.select("bits", F.expr(point).alias("p"))
    listed = base.select(F.col("bits").alias("a"), F.explode(F.expr(f"array({', '.join(home)})")).alias("at"))
    asked = base.select(F.col("bits").alias("b"), F.explode(
        F.expr(f"filter(array({', '.join(home + up)}), x -> x IS NOT NULL)")).alias("at"))
    listed = listed.select("a", F.col("at.block").alias("block"), F.col("at.cell").alias("cell"))
    asked = asked.select("b", F.col("at.block").alias("block"), F.col("at.cell").alias("cell"), "at.moved")
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance) & (F.col("moved") | (F.col("a") < F.col("b")))
    return (listed.join(asked, ["block", "cell"]).where(near)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """Rows (id, print, bits, group, component) for each row of ``docs``: the hash of its text, its fingerprint, one
    fingerprint that names its group, and the smallest id it is linked with.

    Rows with a null id have a fingerprint and, unless a row with an id is linked with them, a null component.
    """
    prints = settle(docs.select(F.col(id_column).alias("id"), text_print(F.col(text_column)).alias("print"),
                                fingerprint(F.col(text_column), shingle).alias("bits")))
    points = settle(prints.groupBy("bits").agg(F.min("id").alias("least")))
    parts = components(grid_links(points, distance)).withColumnRenamed("node", "bits")
    # The component of a fingerprint, then the smallest id of the component.
    grouped = points.join(parts, "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    # Written, so that the join below reads both sides from exchanges of its own and a large component can be split.
    smallest = settle(grouped.groupBy("component").agg(F.min("least").alias("smallest")))
    classes = grouped.join(smallest, "component").select(
        "bits", F.col("component").alias("group"), F.col("smallest").alias("component"))
    return prints.join(classes, "bits").select("id", "print", "bits", "group", "component")


def one_per_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                  distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (a null id comes last, then the text's hash
    decides); of rows that repeat id and text, one."""
    keys = fresh(docs, "near_id", "near_nameless", "near_print")
    found = near_duplicates(docs, id_column, text_column, shingle, distance)
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "print"))
    kept = found.groupBy("group").agg(first.alias("first")).select(
        *row_key(F.col("first.id"), keys), F.col("first.print").alias(keys[2]))
    mine = docs.select("*", *row_key(F.col(id_column), keys), text_print(F.col(text_column)).alias(keys[2]))
    return mine.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
