"""URL filtering: fixed host and path rules first, mined token rules for the rest.

Pages that a fixed rule covers are the labelled ones. Their URLs become sets of tokens (host labels, path segments,
extension, query keys), and FP-growth mines the token combinations that go with a label. Tokens that stand in the same
labelled rows are interchangeable there: they are merged into one item before mining, so k tokens that always come
together cost one item and not 2^k combinations, and a URL holds an item if it holds any of its tokens. Rules under the
minimum support or confidence are pruned, and so are rules that hold a shorter one of the same verdict and at least
their confidence: whatever they match, the shorter one does. A rule is indexed under its rarest item only; token sets
without a fixed rule look their items up in that index, and what meets is checked to hold the whole combination. The
matching rule of highest confidence decides, of equal ones that with the rarer rarest item (as with fixed rules the
more particular one: a host's own rule goes before one for ``/en/`` anywhere), then that of higher support, then
``block``; a URL that matches none is allowed.

Equal token sets are matched once, so a URL or host with a third of all rows weighs as one set; sets are brought back
to the pages by a plain equi-join. Digits never make a token of their own, they stand as ``#``.

Rules: a null URL, or one without ``://``, has an empty host and path and no tokens, so it is allowed; of two fixed
rules of equal length that fit, the first listed wins; repeated pages are judged alike; very long URLs are read whole,
and their tokens count like any others; without labelled pages nothing is mined; an empty table gives an empty result.
A column of the table that has the name of an output column gives way to it; all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import ascii_lower, fresh, settle

SUPPORT, CONFIDENCE = 0.002, 0.9
BLOCK, ALLOW = "block", "allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule(BLOCK, "net", "/"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"),
         Rule(ALLOW, "org", "/fr/"))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(behind(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    rest = behind(url)
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def behind(url: Column) -> Column:
    """What follows the first ``://``, or nothing."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as struct (verdict, name); null if none does.

    The list of fixed rules is a short parameter; long lists belong into the labels that rules are mined from.
    """
    fits = []
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        own = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits.append(F.when(own & F.startswith(path, F.lit(rule.path)),
                           F.struct(F.lit(rule.verdict).alias("verdict"), F.lit(rule.name).alias("name"))))
    return F.coalesce(*fits)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens of a URL, each marked by the part it comes from."""
    def mark(kind: str, parts: Column) -> Column:
        plain = F.transform(parts, lambda p: F.regexp_replace(p, "[0-9]+", "#"))
        return F.transform(F.filter(plain, lambda p: (p != "") & (p != "#")), lambda p: F.concat(F.lit(kind), p))

    low = ascii_lower(path)
    stem, ending = F.regexp_replace(low, r"\.[a-z0-9]{1,8}$", ""), F.regexp_extract(low, r"\.([a-z0-9]{1,8})$", 1)
    query = F.regexp_extract(behind(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(ascii_lower(query), "&", -1), lambda p: F.regexp_extract(p, r"^[^=]*", 0))
    return F.array_sort(F.array_distinct(F.concat(
        mark("host:", F.split(host, r"\.", -1)), mark("path:", F.split(stem, "/", -1)),
        mark("type:", F.array(ending)), mark("key:", keys))))


def merged(labelled: DataFrame) -> DataFrame:
    """Rows (token, item): the smallest of the tokens that stand in the same labelled rows as a token.

    Where a token stands shows in its number of rows and two sums of their hashes.
    """
    sets = labelled.groupBy("tokens").agg(F.count(F.lit(1)).alias("times"))
    held = sets.select(F.explode("tokens").alias("token"), "times", F.xxhash64("tokens").alias("one"),
                       F.xxhash64(F.lit(1), "tokens").alias("two"))
    where = held.groupBy("token").agg(F.sum("times").alias("rows"), *[
        F.sum(F.col(h).cast("decimal(38,0)")).alias(h) for h in ("one", "two")])
    items = where.groupBy("rows", "one", "two").agg(F.min("token").alias("item"))
    return where.join(items, ["rows", "one", "two"]).select("token", "item")


def mine(labelled: DataFrame, items: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rows (rule, items, verdict, confidence, support, rarest, rarity) from rows (tokens, verdict) and the items of
    the tokens.

    ``rarity`` is how many labelled rows hold the rarest item.
    """
    apart = settle(labelled.withColumn("row", F.monotonically_increasing_id()))
    baskets = (apart.select("row", "verdict", F.explode("tokens").alias("token")).join(items, "token")
               .groupBy("row", "verdict").agg(F.collect_set("item").alias("held")))
    baskets = settle(apart.select("row", "verdict").join(baskets.drop("verdict"), "row", "left").select(F.concat(
        F.coalesce("held", F.array().cast("array<string>")), F.array(F.concat(F.lit("label:"), "verdict"))).alias("basket")))
    model = FPGrowth(itemsCol="basket", minSupport=support, minConfidence=confidence).fit(baskets)
    is_label = lambda item: F.startswith(item, F.lit("label:"))
    rules = model.associationRules.where(is_label(F.element_at("consequent", 1))
                                         & ~F.exists("antecedent", is_label))
    counted = model.freqItemsets.where(F.size("items") == 1).select(
        F.element_at("items", 1).alias("item"), "freq")
    rules = settle(rules.select(
        F.xxhash64(F.array_join(F.array_sort("antecedent"), " ")).alias("rule"), F.col("antecedent").alias("items"),
        F.substring_index(F.element_at("consequent", 1), ":", -1).alias("verdict"), "confidence", "support"))
    ranked = (rules.select("rule", F.explode("items").alias("item")).join(counted, "item")
              .groupBy("rule").agg(
                  F.min_by("item", F.struct("freq", "item")).alias("rarest"), F.min("freq").alias("rarity")))
    return shortest(settle(rules.join(ranked, "rule")))


def shortest(rules: DataFrame) -> DataFrame:
    """The rules that hold no shorter one of the same verdict and at least their confidence; shorter ones are found
    through their rarest item."""
    shorter = rules.select(F.col("rule").alias("less"), F.col("items").alias("less_items"), F.col("rarest").alias("item"),
                           F.col("verdict").alias("less_verdict"), F.col("confidence").alias("less_confidence"))
    asked = rules.select("rule", "items", "verdict", "confidence", F.explode("items").alias("item"))
    covered = asked.join(shorter, "item").where(
        (F.col("verdict") == F.col("less_verdict")) & (F.col("less_confidence") >= F.col("confidence"))
        & (F.size("less_items") < F.size("items")) & (F.size(F.array_except("less_items", "items")) == 0))
    gone = covered.select("rule", "verdict").distinct()
    return rules.join(gone, ["rule", "verdict"], "left_anti")


def judge(pages: DataFrame, url_column: str = "url", rules: tuple[Rule, ...] = RULES, support: float = SUPPORT,
          confidence: float = CONFIDENCE, host: str = "host", path: str = "path", rule: str = "rule",
          verdict: str = "verdict") -> DataFrame:
    """``pages`` with host, path, the name of the fixed rule that fits or null, and the verdict."""
    own_host, own_path, found, tokens, strongest = fresh(pages, "url_host", "url_path", "found_rule", "url_tokens",
                                                         "strongest_rule")
    url = F.col(url_column)
    read = pages.withColumn(own_host, host_of(url)).withColumn(own_path, path_of(url))
    read = read.withColumn(found, rule_for(F.col(own_host), F.col(own_path), rules)).withColumn(
        tokens, tokens_of(url, F.col(own_host), F.col(own_path)))
    labelled = settle(read.where(F.col(found).isNotNull()).select(
        F.col(tokens).alias("tokens"), F.col(found)["verdict"].alias("verdict")))
    items = settle(merged(labelled))
    mined = mine(labelled, items, support, confidence)
    sets = settle(read.where(F.col(found).isNull()).select(F.col(tokens).alias("set")).distinct())
    asked = sets.select("set", F.explode("set").alias("token")).join(items, "token")
    asked = settle(asked.groupBy("set").agg(F.collect_set("item").alias("held")))
    asked = asked.select("set", "held", F.explode("held").alias("item"))
    met = asked.join(mined, asked["item"] == mined["rarest"]).where(
        F.size(F.array_except("items", "held")) == 0)
    # Written, so that the join below reads both sides from exchanges of its own and a hot set can be split.
    decided = settle(met.groupBy("set").agg(F.max_by("verdict", F.struct(
        "confidence", -F.col("rarity"), "support", "verdict")).alias(strongest)))
    joined = read.join(decided, read[tokens] == decided["set"], "left")
    return joined.select(
        *[read[c.name] for c in pages.schema if c.name.lower() not in {n.lower() for n in (host, path, rule, verdict)}],
        read[own_host].alias(host), read[own_path].alias(path), read[found]["name"].alias(rule),
        F.coalesce(read[found]["verdict"], decided[strongest], F.lit(ALLOW)).alias(verdict))
