"""URL filters: listed rules, and rules mined from labels by FP-growth.

A page's URL is a set of tokens (domain suffixes, path segments, parameters). Spark's FP-growth finds the sets that
are frequent among labelled pages together with their label; those that say "block" with enough confidence are rules.

Sets that say the same are not enumerated. Tokens that the same labelled pages have, such as the nested suffixes of a
host, are one item. Of longer and shorter suffixes of a host that differ the longer implies the shorter, so sets are
mined with the suffixes of one length at a time. A rule with another one inside it goes, since whatever it blocks the
other blocks. All of this leaves every verdict as the full list of rules would give it.

To match, rules are indexed by their rarest item: a page looks up its items, and a rule found must have all of its
items on the page.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.tables import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.6
#: At most so many mined rules are broadcast, of a few hundred bytes each.
BROADCAST_RULES = 100_000
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BLOCK = "label=block"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits; both null if none does.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL; digits are one sign, so numbered pages share theirs."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    segments = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.concat(F.lit("path="), F.regexp_replace(s, "[0-9]+", "9")))
    tail = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^?#]*(.*)$", 1)
    parameters = F.transform(F.filter(F.split(tail, "[?&#]"), lambda s: s != ""), lambda s: F.concat(F.lit("with="), F.regexp_replace(s, "[0-9]+", "9")))
    return F.array_distinct(F.concat(F.when(host == "", F.array().cast("array<string>")).otherwise(suffixes), segments, parameters))


def items_of_tokens(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(token, item, freq): tokens frequent enough for a rule, by what stands for all that the same rows have.

    ``labelled`` has a distinct ``row`` and its ``tokens``. There are at most tokens per row / ``min_support`` of them.
    """
    least = math.floor(min_support * labelled.count())
    each = labelled.select("row", F.explode("tokens").alias("token"))
    rows = [F.sum(F.xxhash64("row", F.lit(i)).cast("decimal(38,0)")).alias(f"rows{i}") for i in range(2)]
    found = each.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), *rows).where(F.col("freq") >= least)
    same = ["freq", "rows0", "rows1"]
    return found.join(found.groupBy(*same).agg(F.min("token").alias("item")), same).select("token", "item", "freq")


def _with_items(rows: DataFrame, key: str, items: DataFrame) -> DataFrame:
    """(key, items): the items of each row's tokens; rows without any are left out."""
    each = rows.select(key, F.explode("tokens").alias("token")).join(F.broadcast(items.select("token", "item")), "token")
    return each.groupBy(key).agg(F.collect_set("item").alias("items"))


def _suffix_of(token: Column) -> Column:
    """How many labels a host token has; 0 for other tokens."""
    return F.when(token.startswith("host="), F.size(F.split(token, r"\."))).otherwise(0)


def _levels(labelled: DataFrame, items: DataFrame) -> list[int]:
    """Lengths of host suffixes, without those whose items say of every row what those of a shorter one say."""
    each = labelled.select("row", F.explode("tokens").alias("token")).join(F.broadcast(items), "token")
    each = each.select("row", "item", _suffix_of(F.col("token")).alias("level")).where("level > 0")
    told = each.groupBy("level").agg(*[F.sum(F.xxhash64("row", "item", F.lit(i)).cast("decimal(38,0)")).alias(f"rows{i}") for i in range(2)])
    return sorted(r.level for r in told.groupBy("rows0", "rows1").agg(F.min("level").alias("level")).collect())


def mined_rules(labelled: DataFrame, items: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(items, rarest, confidence, support): sets of items whose pages are to be blocked, none of which holds another.

    ``labelled`` has ``row``, ``tokens`` and the boolean ``block``; ``items`` is what :func:`items_of_tokens` gives.
    Support is that of items and label together.
    """
    label = F.array(F.when(F.col("block"), BLOCK).otherwise("label=allow"))
    suffixes = _levels(labelled, items)
    found = None
    for level in suffixes or [0]:
        here = items.where(_suffix_of(F.col("token")).isin(0, level))
        sets = labelled.select("row", "block").join(_with_items(labelled, "row", here), "row", "left")
        sets = sets.select(F.array_distinct(F.concat(F.coalesce("items", F.array().cast("array<string>")), label)).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(sets)
        rules = model.associationRules.where(F.array_contains("consequent", BLOCK) & (F.size("consequent") == 1))
        rules = rules.where(~F.exists("antecedent", lambda t: t.startswith("label=")))
        rules = rules.select(F.array_sort("antecedent").alias("items"), "confidence", "support")
        found = rules if found is None else found.union(rules)
    found = stored(found.dropDuplicates(["items"]), "url-rules")
    freq = items.groupBy("item").agg(F.min("freq").alias("freq")).withColumnRenamed("item", "rarest")
    by_item = found.select("*", F.explode("items").alias("rarest")).join(F.broadcast(freq), "rarest")
    rarest = by_item.groupBy("items", "confidence", "support").agg(F.min(F.struct("freq", "rarest")).alias("r"))
    indexed = stored(rarest.select("items", F.col("r.rarest").alias("rarest"), "confidence", "support"), "url-rules")
    longer = _found(indexed.select(F.col("items").alias("key"), "items"), indexed).where(F.size("needed") < F.size("items"))
    return indexed.join(longer.select(F.col("key").alias("items")).distinct(), "items", "left_anti")


def _found(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, items, needed): rows (key, items) with the items of each rule that they hold."""
    index = rules.select(F.col("items").alias("needed"), "rarest")
    if index.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    looked_up = rows.select("key", "items", F.explode("items").alias("rarest")).join(index, "rarest")
    return looked_up.where(F.size(F.array_except("needed", "items")) == 0).select("key", "items", "needed")


def matched(pages: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The distinct keys of ``pages`` (key, tokens) that hold all items of some rule."""
    return _found(_with_items(pages, "key", items), rules).select("key").distinct()


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every page: the longest listed rule's, else "block" if a mined rule fits, else "allow".

    ``labels`` (doc_id, quality) marks pages by id; 0 means block. Pages without a label teach nothing, nor do null
    labels. A null URL, or one without ``://``, has an empty host and path and no tokens: it is allowed unless a listed
    rule fits. Repeated rows are judged each; equal URLs alike. Other columns are not looked at.
    """
    parts = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    known = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("block"))
    labelled = parts.join(known, "page_id").select(tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), "block")
    labelled = stored(labelled.withColumn("row", F.monotonically_increasing_id()), "labelled-urls")
    items = stored(items_of_tokens(labelled, min_support), "url-items")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    keyed = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"), F.coalesce("url", F.lit("")).alias("key"))
    distinct = keyed.where("listed IS NULL").select("key", "host", "path").distinct()
    distinct = distinct.select("key", tokens(F.col("key"), F.col("host"), F.col("path")).alias("tokens"))
    found = matched(distinct, mined_rules(labelled, items, min_support, min_confidence), items).select("key", F.lit("block").alias("mined"))
    return keyed.join(found, "key", "left").select("page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit("allow")).alias("verdict"))
