"""Personal data: patterns find it, and corpus co-occurrence finds the words in its documents that give it away.

Base spans are the values of four patterns that pass their checks. Each distinct value is a protected entity e. A word
w discloses it by their pointwise mutual information, log(p(w | e) / p(w)), estimated from whole documents: p(w) is the
share of documents that hold the word, p(w | e) that of the entity's documents, smoothed by ``SMOOTHING`` documents
that hold the word as often as any do, so that one document is weaker evidence than ten. The information content of the
entity, -log p(e), is the most it can be. Words whose share of it reaches ``DISCLOSURE`` become spans of kind ``term``
wherever they stand in documents that hold the entity, outside of base spans. ``sanitise`` generalises values to their
kind and terms to ``[TERM]``. An entity's documents are its distinct texts, so copies are no further evidence; p(w)
counts all documents, so the words of a text in wide circulation are common ones.

Document frequencies come from all words of all documents, combined on the map side before they move; texts are never
joined for them. Only texts in which a pattern matches are written aside, for
the places of their words. Everything is a built-in expression. The patterns take no step twice: a run of
characters is entered at its start or where the last value ended, and loops do not give back, so long runs cost linear
time and no stack.

Rules: a null text is empty and has no spans; offsets count code points, ends are exclusive; rows that repeat id and
text have the same spans each; a null id is an id of its own; values and words are compared in lower case; an entity of
all documents has no content and no terms; very long texts are read whole; an empty table gives an empty result. A
column of the table that has the name of an output column gives way to it; all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import fresh, others, settle

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DISCLOSURE, SMOOTHING = 0.85, 1.0
TERM = r"\p{L}{3,}"
BYTE_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def luhn(digits: Column) -> Column:
    placed = F.transform(F.split(F.reverse(digits), ""), lambda c, at: F.when(at % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(placed, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.length(digits)
    return (F.when(kind == "email", True)
            .when(kind == "ip", value.rlike(rf"^{BYTE_PART}(?:\.{BYTE_PART}){{3}}$"))
            .when(kind == "card", F.when(size.between(13, 19), luhn(digits)).otherwise(False))
            .otherwise(size.between(9, 15)))


def numbered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows (id, print, text), null texts empty."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, print, text, kind, pairs) of the texts in which a pattern matches; the rest of the corpus stays where
    it is."""
    own = F.col("text")
    needs = {"email": own.contains("@"), "phone": own.contains("+"), "ip": own.rlike("[0-9]"),
             "card": own.rlike("[0-9]")}
    found = [F.when(needs[kind], F.struct(F.lit(kind).alias("kind"), placed(pattern).alias("pairs")))
             for kind, pattern in PATTERNS.items()]
    hits = numbered(docs, id_column, text_column).select("id", "print", "text", F.explode(
        F.array_compact(F.array(*found))).alias("hit"))
    return hits.where(F.size("hit.pairs") > 0).select("id", "print", "text", "hit.kind", "hit.pairs")


def base_spans(hits: DataFrame) -> DataFrame:
    """Rows (id, print, kind, start, end, value): the values of candidates that pass."""
    # Rows that repeat id and text are one here; all values of a row and kind then lie in one partition.
    hits = hits.groupBy("id", "print", "kind").agg(F.first("pairs").alias("pairs"))
    each = with_places(hits, ["id", "print", "kind"])
    return each.where(passes(F.col("kind"), F.col("value"))).select(
        "id", "print", "kind", "start", "end", F.lower("value").alias("value"))


def placed(pattern: str) -> Column:
    """The matches of a pattern in ``text``, each with the length of what lies between it and the one before."""
    values = F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(F.col("text"), pattern, -1), F.length)
    return F.filter(F.arrays_zip(values.alias("value"), gaps.alias("gap")), lambda p: p["value"].isNotNull())


def with_places(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows (key, value, start, end) from one array of ``pairs`` per key: running sums of gaps and values."""
    each = rows.select(*key, F.posexplode("pairs").alias("at", "pair"))
    so_far = Window.partitionBy(*key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("pair.value").cast("long")
    end = F.sum(F.col("pair.gap").cast("long") + size).over(so_far)
    return each.select(*key, F.col("pair.value").alias("value"), (end - size).alias("start"), end.alias("end"))


def word_places(hits: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows (print, term, start, end): the words of the texts that hold values, outside of the values."""
    held = spans.select("print", F.col("start").alias("from"), F.col("end").alias("to")).distinct()
    own = hits.select("print", "text").join(held.select("print").distinct(), "print", "left_semi")
    words = with_places(own.dropDuplicates(["print"]).select("print", placed(TERM).alias("pairs")), ["print"])
    inside = (words["print"] == held["print"]) & (words["start"] < held["to"]) & (words["end"] > held["from"])
    return words.join(held, inside, "left_anti").select("print", F.lower("value").alias("term"), "start", "end")


def frequencies(texts: DataFrame) -> DataFrame:
    """Rows (term, word): how many documents hold each word."""
    words = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), F.lower))
    return texts.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("word"))


def disclosing(texts: DataFrame, places: DataFrame, spans: DataFrame, disclosure: float, smoothing: float
               ) -> DataFrame:
    """Rows (print, term) of the words that disclose a value of that text."""
    frequency, total = frequencies(texts), F.lit(float(max(texts.count(), 1)))
    holders = settle(spans.select("kind", "value", "print").distinct())
    entities = holders.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("entity"))
    both = (holders.join(places.select("print", "term").distinct(), "print")
            .groupBy("kind", "value", "term").agg(F.count(F.lit(1)).alias("both")))
    told = both.join(entities, ["kind", "value"]).join(frequency, "term")
    usual = F.col("word") / total
    given = (F.col("both") + F.lit(smoothing) * usual) / (F.col("entity") + F.lit(smoothing))
    content = F.log(total / F.col("entity"))
    share = F.when(content > 0, F.log(given / usual) / content).otherwise(0.0)
    # Written, so that a value of very many documents can be split in the join.
    told = settle(told.where(share >= disclosure).select("kind", "value", "term"))
    return told.join(holders, ["kind", "value"]).select("print", "term").distinct()


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", disclosure: float = DISCLOSURE,
               smoothing: float = SMOOTHING, hits: DataFrame | None = None) -> DataFrame:
    """Rows (id, print, kind, start, end) of all spans, told by id and text hash; ``hits`` are the written candidates,
    for callers that need them too."""
    hits = settle(candidates(docs, id_column, text_column)) if hits is None else hits
    spans = settle(base_spans(hits))
    texts = numbered(docs, id_column, text_column)
    places = word_places(hits, spans)
    told = disclosing(texts, places, spans, disclosure, smoothing)
    added = settle(places.join(told, ["print", "term"]).select("print", "start", "end"))
    row = ["id", "print", "kind", "start", "end"]
    rows = spans.select("id", "print").distinct().join(added, "print").withColumn("kind", F.lit("term"))
    return spans.select(row).union(rows.select(row))


def span_lists(spans: DataFrame) -> DataFrame:
    """Rows (id, print, spans, cuts): the spans of a text as (order, start, end), by kind and place; and as (start, end,
    from, kind), by place and cut where an earlier one ends, with the place from which text before them stays."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    row = Window.partitionBy("id", "print").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    cut = spans.withColumn("from", F.coalesce(F.max("end").over(row), F.lit(0)).cast("long"))
    return cut.groupBy("id", "print").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("order"), "start", "end"))).alias("spans"),
        F.sort_array(F.collect_list(F.when(F.col("end") > F.col("from"), F.struct(
            F.greatest("start", "from").alias("start"), "end", "from", "kind")))).alias("cuts"))


def generalised_texts(hits: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows (id, print, clean) of the texts with spans, each span replaced by its kind; other texts stay as they are."""
    texts = hits.select("id", "print", "text").dropDuplicates(["id", "print"])
    lists = span_lists(spans)
    same = texts["id"].eqNullSafe(lists["id"]) & (texts["print"] == lists["print"])
    return texts.join(lists, same).select(
        texts["id"], texts["print"], generalised(texts["text"], lists["cuts"]).alias("clean"))


def per_document(docs: DataFrame, spans: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 spans_column: str = "spans", clean: str | None = None) -> DataFrame:
    """``docs`` with an array of (order, start, end), in order of kind and place, empty where there are none; and, if
    ``clean`` names a column, the text with all spans replaced by their kind in brackets.

    Spans that overlap are cut where an earlier one ends, so nothing of any span stays.
    """
    key, hashed, mine, cuts, own = fresh(docs, "span_id", "span_print", "span_list", "cut_list", "own_print")
    lists = span_lists(spans).toDF(key, hashed, mine, cuts)
    # Hashed before the join, so that a text nobody selects is not shuffled.
    printed = docs.withColumn(own, F.xxhash64(F.coalesce(docs[text_column], F.lit(""))))
    same = printed[id_column].eqNullSafe(lists[key]) & (printed[own] == lists[hashed])
    joined = printed.join(lists, same, "left")
    made = [F.coalesce(lists[mine], F.array().cast("array<struct<order:int,start:bigint,end:bigint>>")).alias(spans_column)]
    if clean is not None:
        text = F.coalesce(printed[text_column], F.lit(""))
        made.append(F.when(lists[mine].isNull(), text).otherwise(generalised(text, lists[cuts])).alias(clean))
    return joined.select(*others(docs, spans_column, *([clean] if clean else [])), *made)


def generalised(text: Column, cuts: Column) -> Column:
    """The text between the cuts, and the kind of each in brackets; the cuts are in order and do not overlap."""
    def piece(c: Column) -> Column:
        kept = F.substring(text, (c["from"] + 1).cast("int"), (c["start"] - c["from"]).cast("int"))
        return F.concat(kept, F.lit("["), F.upper(c["kind"]), F.lit("]"))

    rest = F.substring(text, (F.element_at(cuts, -1)["end"] + 1).cast("int"), F.length(text))
    return F.concat(F.array_join(F.transform(cuts, piece), ""), rest)


def as_text(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    """How many spans of a list are of that kind. (A second argument of the lambda would be the place in the list.)"""
    order = KINDS.index(kind) + 1
    return F.size(F.filter(spans, lambda s: s["order"] == order)).cast("long")


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", clean: str = "clean_text",
             **thresholds) -> DataFrame:
    """``docs`` with its texts, values and disclosing words replaced by their kind in brackets."""
    spans, = fresh(docs, "span_list")
    found = find_spans(docs, id_column, text_column, **thresholds)
    return per_document(docs, found, id_column, text_column, spans, clean).drop(spans)
