"""Mixing sources to target weights along a curriculum whose weights change over training time.

Every source has a weight schedule over time 0 to 1, linear between knots; the integral of a schedule is the source's
weight. All sizes together are shared by weight; a source whose share exceeds ``MOST_REPEATS`` times its size stops
there, and the excess is shared anew by weight until none is above. A source then goes through its documents, in an
order fixed by the hash of the id, as often as its target says: whole passes and a last, partial one that ends at the
document whose middle lies nearest. The n-th word that a source gives is due when its integrated schedule has demanded
n words; inverting that integral gives every copy of a document its training position, and copies are sorted by range
of position.

The cumulative sizes inside a source are window sums inside 4,096 hash ranges per source on top of sums over whole
ranges, so a source with a third of all rows is spread over thousands of groups. Only the table of sources (one row
each) is ordered as a whole.

Rules: size is the number of words, null text 0; a null source is a source of its own, the last one; documents without
words, and sources without any, are taken zero times; equal ids follow each other by size, then by the hash of their
text; equal rows may change places, which changes no result; very long texts are counted whole; empty tables give empty
results; ``mix`` returns the table's columns, with ``position`` only to sort by, under a name that clashes with none.
Sources must be few enough for one task to order them (some millions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import fresh, row_key, settle, text_print, word_count

MOST_REPEATS = 3
RANGE_DIGITS = 3  # hexadecimal digits of the id's hash that name a range of a source
# Knots (time, level); the integrals are 5, 2 and 1: heavy sources lead, light ones come up later.
SCHEDULES = (
    ((0.0, 7.5), (1.0, 2.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)


def integral(schedule: tuple[tuple[float, float], ...]) -> float:
    return sum((t1 - t0) * (l0 + l1) / 2 for (t0, l0), (t1, l1) in zip(schedule, schedule[1:]))


def source_targets(sources: DataFrame, schedules=SCHEDULES, most: int = MOST_REPEATS) -> DataFrame:
    """Adds rank, weight and target to rows (key, source_size); keys sort as their sources do.

    Sources that reach their limit are the first ones by size over weight, so the level at which the others are filled
    is one running sum away.
    """
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    everything = Window.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(everything.orderBy("key"))).withColumn(
        "weight", F.element_at(weights, ((F.col("rank") - 1) % len(schedules) + 1).cast("int")))
    ranked = ranked.withColumn("limit", F.col("source_size") * most).withColumn(
        "brim", F.col("limit") / F.col("weight"))
    order = everything.orderBy("brim", "rank")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    beyond = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", (F.sum("source_size").over(everything) - before) / beyond)
    full = F.col("brim") <= F.col("level")
    level = F.max(F.when(~full, F.col("level"))).over(everything)
    return ranked.select("key", "source_size", "rank", "weight", F.when(full, F.col("limit").cast("double"))
                         .otherwise(F.col("weight") * level).alias("target"))


def due(share: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """The time at which a source's integrated schedule has reached ``share`` of its whole."""
    out = None
    for number, schedule in enumerate(schedules):
        demand = share * integral(schedule)
        reached, time = 0.0, None
        for (t0, l0), (t1, l1) in zip(schedule, schedule[1:]):
            slope = (l1 - l0) / (t1 - t0)
            more = demand - reached
            root = F.lit(l0) + F.sqrt(F.greatest(F.lit(0.0), F.lit(l0 * l0) + F.lit(2.0 * slope) * more))
            here = F.lit(t0) + F.when(root > 0, F.lit(2.0) * more / root).otherwise(0.0)
            time = here if time is None else F.when(demand >= reached, here).otherwise(time)
            reached += (t1 - t0) * (l0 + l1) / 2
        this = (rank - 1) % len(schedules) == number
        out = F.when(this, time) if out is None else out.when(this, time)
    return out


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), "b").otherwise(F.concat(F.lit("a"), source))


def plan_mix(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
             schedules=SCHEDULES, most: int = MOST_REPEATS) -> DataFrame:
    """Rows (id, print, key, size, source_size, target, copies, positions) for each row of ``docs``.

    ``print`` is the hash of the text, ``key`` the source behind a letter that sorts nulls last; positions lists the training time of each copy.
    """
    hashed = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    sized = settle(docs.select(
        F.col(id_column).alias("id"), text_print(F.col(text_column)).alias("print"),
        source_key(F.col(source_column)).alias("key"), word_count(F.col(text_column)).alias("size"),
        hashed.alias("hash")).withColumn("part", F.substring("hash", 1, RANGE_DIGITS)))
    parts = sized.groupBy("key", "part").agg(F.sum("size").alias("part_size"))
    targets = source_targets(parts.groupBy("key").agg(F.sum("part_size").alias("source_size")), schedules, most)
    along = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("key", "part", F.coalesce(F.sum("part_size").over(along), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("key", "part").orderBy("hash", "id", "size", "print")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.join(starts.join(targets, "key"), ["key", "part"]).withColumn(
        "before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    middle = F.col("before") + F.col("size") / 2
    placed = placed.withColumn("passes", passes.cast("long")).withColumn("middle", middle).withColumn(
        "copies", F.when(F.col("size") > 0, F.col("passes") + (F.col("middle") < rest).cast("long")).otherwise(0))
    times = F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1),
                        lambda k: due((k * F.col("source_size") + F.col("middle")) / F.col("target"),
                                      F.col("rank"), schedules))
    return placed.select("id", "print", "key", "size", "source_size", "target", "copies",
                         F.when(F.col("copies") > 0, times).otherwise(F.array().cast("array<double>"))
                         .alias("positions"))


def mix(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
        schedules=SCHEDULES, most: int = MOST_REPEATS) -> DataFrame:
    """The copies of documents that the mix takes, sorted by training position.

    Rows that repeat id, source and text are one document with the places of all of them.
    """
    plan = plan_mix(docs, id_column, source_column, text_column, schedules, most).where(F.col("copies") > 0)
    keys = fresh(docs, "mix_id", "mix_nameless", "mix_print", "mix_key")
    places, position = fresh(docs, "mix_places", "position")
    taken = plan.select(*row_key(F.col("id"), keys), F.col("print").alias(keys[2]), F.col("key").alias(keys[3]),
                        "positions").groupBy(keys).agg(F.flatten(F.collect_list("positions")).alias(places))
    mine = docs.select("*", *row_key(F.col(id_column), keys), text_print(F.col(text_column)).alias(keys[2]),
                       source_key(F.col(source_column)).alias(keys[3]))
    found = mine.join(taken, keys).dropDuplicates(keys)
    return found.select(*docs.columns, F.explode(places).alias(position)).orderBy(position, id_column)
