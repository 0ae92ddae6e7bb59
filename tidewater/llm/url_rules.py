"""URL filtering by association rules that FP-growth mines from labelled URLs.

Hand-written rules (host with its subdomains, path prefix) are applied first; the longest that fits decides. For the
rest, rules are learned: a labelled URL is a set of tokens (host labels and their words, path words) with its label,
and Spark's FP-growth finds token combinations that go with it, of any length. Every token that reaches the support
bound takes part; tokens that the same labelled URLs hold are one item, which a URL has if it has any of them: FP-growth
lists all combinations of a URL's frequent items, and without that, a family of URLs with many words in common would
give two to the power of their number. (Items that differ are not bounded: 25 of them together in 0.5 % of the URLs
would be too many.) Rules below the support and confidence bounds are pruned, and so are rules that hold a stronger
or equal rule. A rule is filed under its rarest item; URLs that share an item combination are matched once, by
joining their items with that index and checking the rest of the rule. A URL is blocked if its strongest matching rule
says so, and allowed if none matches.

Labels default to the hand-written rules' own verdicts, so that what they say of some hosts carries over to others.
Learning uses about ``SAMPLE_ROWS`` labelled URLs, by hash of the URL; matching covers every row.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed unless a
learned rule says otherwise (it has no tokens, so none does); repeated rows are judged each; an empty table gives no
rows and learns no rules; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: (verdict, host, path prefix).
HAND_WRITTEN = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
SAMPLE_ROWS = 20_000
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
_LABELS = {"block": "label:block", "allow": "label:allow"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def hand_written(rules: Sequence[tuple[str, str, str]] = HAND_WRITTEN) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the columns ``host`` and ``path``; both null if none does."""
    rule, verdict = F, F
    for said, name, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(prefix)
        rule, verdict = rule.when(fits, name + prefix), verdict.when(fits, said)
    none = F.lit(None).cast("string")
    return (none, none) if rule is F else (rule, verdict)


def tokens() -> Column:
    """Distinct tokens of the columns ``host`` and ``path``: labels, the words of hyphenated labels, path words."""
    labels = F.split("host", r"\.")
    words = F.flatten(F.transform(labels, lambda x: F.when(x.contains("-"), F.split(x, "-")).otherwise(F.array().cast("array<string>"))))
    path_words = F.split(F.lower("path"), "[^a-z]+")
    tagged = F.concat(F.transform(F.concat(labels, words), lambda x: F.concat(F.lit("host:"), x)), F.transform(path_words, lambda x: F.concat(F.lit("path:"), x)))
    return F.array_distinct(F.filter(tagged, lambda x: ~x.isin("host:", "path:")))


def mine(labelled: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Rules (items, verdict, confidence, support, token) from (url, tokens, verdict) rows, and the item of each token.

    ``token`` is the item to file a rule under. FP-growth lists every combination of a URL's frequent items, so
    tokens that always come together must not count one by one.
    """
    spark = labelled.sparkSession
    share = min(1.0, SAMPLE_ROWS / max(1, labelled.count()))
    place = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "url"), 1)
    sample = labelled.where(place <= F.lit(min(2**63 - 1, int(share * 2**63))))
    distinct = written(spark, sample.groupBy("url", "verdict").agg(F.first("tokens").alias("tokens")), "labelled-urls")
    least = math.ceil(MIN_SUPPORT * distinct.count())
    # Tokens that the same URLs hold are one item: their combinations would all say the same.
    mark = F.xxhash64("url", "verdict")
    held = distinct.select(F.explode("tokens").alias("token"), mark.alias("mark"))
    alike = held.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor("mark").alias("x"), F.bit_xor(F.xxhash64("mark")).alias("y")).where(F.col("n") >= least)
    groups = alike.groupBy("n", "x", "y").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    # At most tokens per URL / MIN_SUPPORT of them reach the driver.
    common = groups.orderBy(F.desc("n"), "tokens").collect()
    items = {t: r.tokens[0] for r in common for t in r.tokens}
    baskets = written(spark, distinct.select(F.array_sort(as_items("tokens", items)).alias("tokens"), "verdict"), "baskets")
    order = _strings([r.tokens[0] for r in common])
    rarest = F.element_at(F.array_sort(F.transform("items", lambda x: F.struct(F.array_position(order, x).alias("n"), x.alias("token")))), -1)["token"]
    ruled = written(spark, by_fp_growth(baskets).select("*", rarest.alias("token")), "rules")
    # A rule adds nothing to one that asks for less and is as sure. The smaller one's token is among the larger one's.
    larger = ruled.select("items", "confidence", F.explode("items").alias("token"))
    smaller = ruled.select("token", F.col("items").alias("part"), F.col("confidence").alias("part_confidence"))
    within = (F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0) & (F.col("part_confidence") >= F.col("confidence"))
    redundant = larger.join(smaller, "token").where(within).select("items").distinct()
    kept = ruled.join(redundant, "items", "left_anti")
    return kept, items


def as_items(tokens: str, items: dict[str, str]) -> Column:
    """The items that a URL's tokens stand for."""
    if not items:
        return F.array().cast("array<string>")
    known = F.create_map(*(F.lit(x) for pair in items.items() for x in pair))
    return F.array_distinct(F.filter(F.transform(tokens, lambda x: known[x]), lambda x: x.isNotNull()))


def by_fp_growth(baskets: DataFrame) -> DataFrame:
    """(items, verdict, confidence, support) of all rules in (tokens, verdict) rows, from FP-growth."""
    label = F.when(F.col("verdict") == "block", _LABELS["block"]).otherwise(_LABELS["allow"])
    model = FPGrowth(itemsCol="items", minSupport=MIN_SUPPORT, minConfidence=MIN_CONFIDENCE).fit(baskets.select(F.concat("tokens", F.array(label)).alias("items")))
    return (
        model.associationRules.where(F.col("consequent")[0].isin(*_LABELS.values()))
        .where(~F.arrays_overlap("antecedent", _strings(_LABELS.values())))
        .select(F.array_sort("antecedent").alias("items"), F.substring(F.col("consequent")[0], 7, 9).alias("verdict"), "confidence", "support")
    )


def _strings(values) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = HAND_WRITTEN, labelled: DataFrame | None = None, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, learned (tokens of the learned rule that decided, else null)."""
    spark = pages.sparkSession
    split = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url")).withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, said = hand_written(rules)
    ruled = split.select("*", tokens().alias("tokens"), rule.alias("rule"), said.alias("said"))
    if labelled is None:
        labelled = ruled.where("said is not null").select("url", "tokens", F.col("said").alias("verdict"))
    mined, items = mine(labelled)
    learned = written(spark, mined, "mined")
    used = {r[0] for r in learned.select(F.explode("items")).distinct().collect()}  # at most tokens per URL / MIN_SUPPORT
    marked = ruled.withColumn("combination", F.array_sort(as_items("tokens", {t: i for t, i in items.items() if i in used})))
    combinations = marked.where("said is null").select("combination").distinct()
    matched = (
        combinations.select("combination", F.col("combination").alias("held"), F.explode("combination").alias("token"))
        .join(learned, "token")
        .where(F.size(F.array_except("items", "held")) == 0)
        .groupBy("combination")
        .agg(F.max_by(F.struct(F.array_join("items", " ").alias("learned"), "verdict"), F.struct("confidence", "support", "verdict", "items")).alias("best"))
        .select("combination", F.col("best.learned").alias("learned"), F.col("best.verdict").alias("learned_verdict"))
    )
    decided = marked.join(written(spark, matched, "matched"), "combination", "left")
    hand = F.col("said").isNotNull()
    return decided.select("page_id", "host", "path", "rule", F.coalesce("said", "learned_verdict", F.lit("allow")).alias("verdict"), F.when(~hand, F.col("learned")).alias("learned"))
