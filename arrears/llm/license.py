"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, inherited down directories.

Every line is a possible header, and so are runs of up to ``RUN`` lines or paragraphs and every comment block, for
notices that are wrapped; every whole text is a possible licence file. Each gets the licence of the template it is
closest to, if their cosine reaches ``COSINE``. Templates are one-line notices, standard headers and the full texts of
``license_texts/`` (without copyright lines; full texts of the CC BY family are not among them). Document frequencies
of the templates' words are counted over all documents; a word that no template has weighs as much as a word of no
document. A file with a header has its own licence; other files take that of the nearest directory above them that
holds a licence file.

A text that reaches the cosine must hold one of the template's anchors: words without which the rest of the template's
weight falls short, chosen to be few and in few documents. Only headers and texts with such an anchor are turned into
words, so most texts are read once and moved nowhere, and nothing is lost. Templates are a bounded parameter, so their
weights may be collected and broadcast. A licence file is a text that as a whole reaches the cosine and either is called
so (``FILE_NAME``) or says little else: ``FILE_SHARE`` of its words, repeats counted, are the template's. So prose with a
notice licenses itself, never its directory. Directories are resolved once each, not once per file, and joined to the files
by a plain equi-join.

Rules: a null or empty text has no licence of its own; a null path stands in no directory and inherits nothing; a path
without a slash stands in the root directory, which is above all others; of equal cosines the licence with the smaller
name wins; among licence files of one directory the closest wins, then the smaller name; rows that repeat path and text
are judged alike; very long texts are read whole; an empty table gives an empty result. A column of the table that has
the name of an output column gives way to it; all others pass through.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import fresh, settle

COSINE = 0.8
RUN = 4
FILE_SHARE = 0.9
FILE_NAME = r"(?i)^(?:un)?(?:licen[cs]e|copying|copyright|notice)[^/]*$"
TOKEN = r"[\p{L}\p{N}]+"
# Full texts, standard headers and usual notices of public licences.
TEXTS = tuple((p.stem, p.read_text(encoding="utf-8"))
              for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))
GNU_HEADER = (
    "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public "
    "License as published by the Free Software Foundation{3} version {4} of the License, or (at your option) any later "
    "version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {2}General Public License for "
    "more details. You should have received a copy of the GNU {2}General Public License along with this {0}")
POSTAL = "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
ONLINE = ". If not, see <https://www.gnu.org/licenses/>."
HEADERS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("GPL-2.0", GNU_HEADER.format("program", ";", "", ";", "2") + POSTAL),
    ("GPL-3.0", GNU_HEADER.format("program", ":", "", ", either", "3") + ONLINE),
    ("LGPL-2.1", GNU_HEADER.format("library", ";", "Lesser ", "; either", "2.1") + POSTAL),
    ("LGPL-3.0", GNU_HEADER.format("library", ":", "Lesser ", ", either", "3") + ONLINE),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("ISC", "Released under the ISC License"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0"),
    *HEADERS, *TEXTS,
)
COMMENTS = r"(?m)(?:^[ \t]*+(?:#|//|/?\*|--|;|%)[^\n]*+\n?+)++"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def frequencies(docs: DataFrame, terms: DataFrame, text_column: str) -> DataFrame:
    """Rows (term, documents): how many documents hold each template word."""
    words = docs.select(F.explode(F.array_distinct(tokens(F.col(text_column)))).alias("term"))
    return words.join(F.broadcast(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("documents"))


def weigh(docs: DataFrame, templates: tuple[tuple[str, str], ...], text_column: str, cosine: float = COSINE):
    """Template vectors of length 1 as rows (template, licence, term, weight, idf), anchors, and the unknown's weight.

    All are as large as the templates.
    """
    spark = docs.sparkSession
    given = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)],
                                  "template int, licence string, text string")
    counts = given.select("template", "licence", F.explode(tokens(F.col("text"))).alias("term")).groupBy(
        "template", "licence", "term").agg(F.count(F.lit(1)).alias("times"))
    known = {r["term"]: r["documents"] for r in
             frequencies(docs, counts.select("term").distinct(), text_column).collect()}
    total = docs.count()
    rarest = math.log(total + 1.0) + 1.0
    vectors: dict[tuple[int, str], dict[str, float]] = {}
    idf: dict[str, float] = {}
    for row in counts.collect():
        idf[row["term"]] = math.log((total + 1.0) / (known.get(row["term"], 0) + 1.0)) + 1.0
        vectors.setdefault((row["template"], row["licence"]), {})[row["term"]] = row["times"] * idf[row["term"]]
    rows = []
    anchors: set[str] = set()
    for (template, licence), vector in sorted(vectors.items()):
        length = math.sqrt(sum(w * w for w in vector.values()))
        rows += [(template, licence, term, weight / length, idf[term]) for term, weight in vector.items()]
        rest = 1.0
        for term, weight in sorted(vector.items(), key=lambda x: ((known.get(x[0], 0) + 1) / x[1] ** 2, x[0])):
            if rest < cosine ** 2 - 1e-9:
                break
            anchors.add(term)
            rest -= (weight / length) ** 2
    weights = spark.createDataFrame(
        rows, "template int, licence string, term string, weight double, idf double")
    return weights, sorted(anchors), rarest


def runs(pieces: Column, code: int, anchor: str) -> Column:
    """Runs of 1 to ``RUN`` neighbouring pieces that hold an anchor, as structs (part, line)."""
    held = F.transform(pieces, lambda p: F.struct(p.alias("text"), p.rlike(anchor).alias("held")))

    def at(all_held: Column, place: Column, size: int) -> Column:
        some = F.slice(all_held, place, size)
        return F.when((F.size(some) == size) & F.exists(some, lambda p: p["held"]), F.struct(
            (place.cast("long") * 16 + code + size).alias("part"),
            F.array_join(F.transform(some, lambda p: p["text"]), "\n").alias("line")))

    # Bound to a name, so that pieces are made once and not at every place.
    return F.get(F.transform(F.array(held), lambda h: F.array_compact(F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(h)), lambda i: F.array(*[at(h, i, n) for n in range(1, RUN + 1)]))))), F.lit(0))


def closest(docs: DataFrame, id_columns: list[str], text_column: str, templates, cosine: float) -> DataFrame:
    """Rows (ids..., part, licence, score, covered): the best template of each header (part 0 up) and whole text (part
    -1), and the share of the part's words that the template has."""
    weights, anchors, rarest = weigh(docs, templates, text_column, cosine)
    weights = settle(weights)
    anchor = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(anchors)})(?![\p{{L}}\p{{N}}])" if anchors else r"(?!)"
    hit = docs.select(*id_columns, F.lower(F.col(text_column)).alias("text")).where(F.col("text").rlike(anchor))
    # A text of one line is its own licence file.
    blocks = F.regexp_extract_all("text", F.lit(COMMENTS), F.lit(0))
    blocks = F.filter(F.transform(blocks, lambda p, i: F.struct(
        (i.cast("long") * 16 + 15).alias("part"), p.alias("line"))), lambda b: b["line"].rlike(anchor))
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("part"), F.col("text").alias("line")))
    parts = hit.select(*id_columns, F.explode(F.concat(
        whole, runs(F.split("text", "\n", -1), 0, anchor),
        runs(F.split("text", r"\n[^\p{L}\p{N}]*\n", -1), 8, anchor), blocks)).alias("p"))
    parts = parts.select(*id_columns, "p.part", "p.line")
    unit = [*id_columns, "part"]
    words = parts.select(*unit, F.explode(tokens(F.col("line"))).alias("term")).groupBy(*unit, "term").agg(
        F.count(F.lit(1)).alias("times"))
    terms = F.broadcast(weights.select("term", "idf").distinct())
    weighed = words.join(terms, "term", "left").withColumn(
        "value", F.col("times") * F.coalesce("idf", F.lit(rarest)))
    lengths = F.sqrt(F.sum(F.col("value") * F.col("value")))
    # One pass: the squared length comes from rows without a template, the products from those with one.
    long = weighed.groupBy(*unit).agg(lengths.alias("length"), F.sum("times").alias("size"), F.collect_list(
        F.when(F.col("idf").isNotNull(), F.struct("term", "value", "times"))).alias("shared"))
    products = (long.select(*unit, "length", "size", F.explode("shared").alias("s"))
                .select(*unit, "length", "size", "s.term", "s.value", "s.times")
                .join(F.broadcast(weights), "term")
                .groupBy(*unit, "template", "licence").agg(
                    (F.sum(F.col("value") * F.col("weight")) / F.first("length")).alias("score"),
                    (F.sum("times") / F.first("size")).alias("covered")))
    best = F.min_by(F.struct("licence", "score", "covered"), F.struct(-F.col("score"), "licence", -F.col("covered")))
    return products.where(F.col("score") >= cosine).groupBy(*unit).agg(best.alias("best")).select(*unit, "best.*")


def folder_of(path: Column) -> Column:
    """The directory a path stands in, without its last slash; the root is the empty name."""
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).when(path.isNotNull(), "")


def with_parents(folder: Column) -> Column:
    """A directory and those above it, nearest first; the last is the root."""
    steps = F.split(folder, "/", -1)
    above = F.transform(F.sequence(F.size(steps), F.lit(1), F.lit(-1)),
                        lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    return F.array_distinct(F.concat(above, F.array(F.lit(""))))


def scan(files: DataFrame, path_column: str = "path", text_column: str = "text", templates=TEMPLATES,
         cosine: float = COSINE, licence: str = "license", score: str = "license_score",
         origin: str = "license_origin") -> DataFrame:
    """``files`` with licence, cosine and origin: ``own``, ``inherited``, or null where there is none."""
    hashed, folder = fresh(files, "text_print", "folder_path")
    path = F.col(path_column)
    work = files.withColumn(hashed, F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))).withColumn(
        folder, folder_of(path))
    ids = work.select(path.alias("path"), F.col(hashed).alias("print"), F.col(text_column).alias("text"))
    found = settle(closest(ids, ["path", "print"], "text", templates, cosine))
    best = F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), "licence"))
    headers = found.groupBy("path", "print").agg(best.alias("own"))
    named = F.regexp_substr("path", F.lit(r"[^/]*$")).rlike(FILE_NAME)
    licensed = (found.where((F.col("part") == -1) & F.col("path").isNotNull() & (named | (F.col("covered") >= FILE_SHARE)))
                .withColumn("folder", folder_of(F.col("path"))).groupBy("folder").agg(best.alias("held")))
    folders = work.where(F.col(folder).isNotNull()).select(F.col(folder).alias("below")).distinct()
    above = folders.select("below", F.posexplode(with_parents(F.col("below"))).alias("steps", "folder"))
    # Written, so that the join below reads both sides from exchanges of its own and a hot directory can be split.
    nearest = settle(above.join(licensed, "folder").groupBy("below").agg(F.min_by("held", "steps").alias("held")))
    joined = (work.join(headers, work[path_column].eqNullSafe(headers["path"]) & (work[hashed] == headers["print"]),
                        "left").join(nearest, work[folder] == nearest["below"], "left"))
    own, held = headers["own"], nearest["held"]
    taken = F.coalesce(own, held)
    return joined.select(
        *[work[c] for c in files.columns if c.lower() not in {n.lower() for n in (licence, score, origin)}], taken["licence"].alias(licence), taken["score"].alias(score),
        F.when(own.isNotNull(), "own").when(held.isNotNull(), "inherited").alias(origin))
