"""Quality rules as weak supervision: rules vote or abstain, and a label model weighs their votes.

Per document a few figures are measured over the whole text; each rule votes good (1), bad (-1) or abstains (0) on
them. Votes that agree are counted over all documents (at most three votes to the power of the rules: a bounded
table). Expectation-maximisation on that table estimates how often each rule is right on good and on bad
documents and how common good ones are: the posterior of each vote pattern follows from the estimates, and the estimates from the posteriors,
each round one aggregate of the table. A document is kept if its posterior is at least one half, so no single rule
decides.

Everything is DataFrame expressions. The figures are written once, as a narrow table, and both passes read it.
Word windows are compared by a 64-bit hash inside one row; nothing is shuffled but the vote patterns.

Defined results: a null, empty or blank text has no words, so all figures are 0 and the base rule fails; repeated
rows are judged each; an empty table gives no rows; other columns are not read. With no votes at all the estimates
stay at their start.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_AT = 0.5
#: Starting values and bounds of the label model: a rule's accuracy on good and on bad documents, when it votes.
#: A rule is held to err on few good documents, and to see at least some bad ones.
START, SMOOTHING, PRIOR = (0.98, 0.5), 10, 0.8
GOOD_BOUNDS, BAD_BOUNDS, PRIOR_BOUNDS = (0.98, 0.998), (0.3, 0.99), (0.05, 0.9)
ROUNDS, SETTLED = 30, 1e-3


def figures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_shouts (longs)."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    split = base.select("doc_id", "text", F.array_remove(F.split("text", WHITE), "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    hashed = split.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    last = F.size("words") - WINDOW
    window = lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW)))
    windows = hashed.withColumn("windows", F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window)).otherwise(F.array().cast("array<long>")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = windows.withColumn("sorted", F.when(repeats, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = lambda x, i: (x["h"] == F.get("sorted", i - 1)["h"]) | (x["h"] == F.get("sorted", i + 1)["h"])
    found = placed.withColumn("found", F.array_sort(F.transform(F.filter("sorted", lambda x, i: F.coalesce(twin(x, i), F.lit(False))), lambda x: x["i"])))
    # Each found window covers its words, less those that the window before it covers already.
    covered = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    return found.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_shouts"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _band(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The voting rules over the figures: 1 good, -1 bad, 0 abstains."""
    length, symbols = _ratio("word_chars", "n_words"), _ratio("n_symbols", "n_words")
    lines, repeats = _ratio("n_dup_lines", "n_lines"), _ratio("n_repeat_words", "n_words")
    density = _ratio("n_symbols", "word_chars")
    upper, shouts, words = _ratio("n_upper", "word_chars"), _ratio("n_shouts", "n_words"), F.col("n_words")
    return {
        "word_length": _band(length, length.between(3, 10), (length < 2) | (length > 15)),
        "symbols": _band(symbols, symbols <= 0.05, symbols > 0.2),
        "symbol_density": _band(density, density <= 0.01, density > 0.03),
        "lines": _band(lines, (F.col("n_lines") >= 2) & (lines <= 0.1), lines > 0.3),
        "repeats": _band(repeats, repeats <= 0.05, repeats > 0.15),
        "size": _band(words, words >= 30, words < 8),
        "capitals": _band(upper, upper <= 0.2, upper > 0.5),
        "shouting": _band(shouts, shouts <= 0.1, shouts > 0.4),
    }


def posterior(accuracies: dict[str, tuple[float, float]], prior: float) -> Column:
    """Probability that a document is good, given its votes."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for rule, (good, bad) in accuracies.items():
        odds += F.when(F.col(rule) == 1, math.log(good / (1 - bad))).when(F.col(rule) == -1, math.log((1 - good) / bad)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, names: list[str]) -> tuple[dict[str, tuple[float, float]], float]:
    """Rules' accuracies on good and on bad documents, and the share of good ones, from (votes..., n) rows."""
    accuracies, prior = dict.fromkeys(names, START), PRIOR
    for _ in range(ROUNDS):
        p = posterior(accuracies, prior)
        weights = {"good": F.col("n") * p, "bad": F.col("n") * (1 - p)}
        right = {"good": 1, "bad": -1}
        sums = [F.sum(F.when(F.col(r) != 0, w)).alias(f"{r}_{k}") for r in names for k, w in weights.items()]
        hits = [F.sum(F.when(F.col(r) == right[k], w).otherwise(0)).alias(f"{r}_{k}_hits") for r in names for k, w in weights.items()]
        row = patterns.agg((F.sum(weights["good"]) / F.sum("n")).alias("prior"), *sums, *hits).first()
        new = {}
        for r in names:
            # START counts as SMOOTHING documents: a rule that hardly votes stays near it
            good, bad = (((row[f"{r}_{k}_hits"] or 0) + SMOOTHING * s) / ((row[f"{r}_{k}"] or 0) + SMOOTHING) for k, s in zip(right, START, strict=True))
            new[r] = _bounded(good, *GOOD_BOUNDS), _bounded(bad, *BAD_BOUNDS)
        new_prior = prior if row["prior"] is None else _bounded(row["prior"], *PRIOR_BOUNDS)
        moved = max(abs(new_prior - prior), *(abs(x - y) for r in names for x, y in zip(new[r], accuracies[r], strict=True)))
        accuracies, prior = new, new_prior
        if moved < SETTLED:
            break
    return accuracies, prior


def _bounded(x: float, least: float, most: float) -> float:
    return min(max(x, least), most)


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The figures of every document with base_failed, posterior and kept."""
    votes = rules()
    measured = written(docs.sparkSession, figures(docs, id_column, text_column), "figures")
    voted = measured.select("*", *(v.cast("int").alias(r) for r, v in votes.items()))
    # At most 3 ** rules rows, whatever the number of documents.
    patterns = written(docs.sparkSession, voted.groupBy(*votes).agg(F.count("*").alias("n")).coalesce(1), "votes")
    accuracies, prior = estimate(patterns, list(votes))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    good = posterior(accuracies, prior)
    return voted.select(*measured.columns, failed.alias("base_failed"), good.alias("posterior"), (~failed & (good >= KEEP_AT)).alias("kept"))
