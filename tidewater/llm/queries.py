"""Registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    backoff_lm,
    bpe_automaton,
    fill_in_middle,
    heap_counts,
    packing,
    periodic_runs,
    posting_lists,
    quality,
    secrets,
    simhash,
    substrings,
    url_rules,
    weak_rules,
)
from .common import table

VOCABULARY = "byte_bpe_50k.json"
#: Of ids whose checksum leaves this remainder nothing is learned.
FOLDS, HELD_OUT, HELD_OUT_OF_LANGUAGE = 5, 0, 1


def held_out(remainder: int = HELD_OUT):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == remainder, F.lit(False))


def planted(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text; one text of ten, by its id's checksum, repeats a stretch of itself from some word to its end."""
    words = periodic_runs.plain_words(doc_id, text)
    n, checksum = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or checksum % 10 or not n:
        return words
    g = checksum // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % period] for i in range(a, n)]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shares = quality.fit(docs, table(spark, sf_dir, "labels"), usable=~held_out())
    scored = quality.score(docs, shares)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.KEEP_AT).cast("int").alias("predicted"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op3_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op5_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_secrets_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_words(table(spark, sf_dir, "documents"))


def op11_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = backoff_lm.score(docs, ~held_out(HELD_OUT_OF_LANGUAGE))
    return scored.select("doc_id", held_out(HELD_OUT_OF_LANGUAGE).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = fill_in_middle.restore(fill_in_middle.transform(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), planted)
    higher = F.array_sort(
        "runs",
        lambda a, b: F.when(a.length * b.period != b.length * a.period, F.when(a.length * b.period > b.length * a.period, -1).otherwise(1))
        .when(a.start != b.start, F.when(a.start < b.start, -1).otherwise(1))
        .otherwise(F.when(a.period < b.period, -1).when(a.period > b.period, 1).otherwise(0)),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", F.get(higher, F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
