"""Quality classifier by supervised subword embeddings.

A text's features are its words, the character n-grams inside words (a blank marks a word's edge) and each word
that repeats the one before it, hashed into ``BUCKETS`` learned vectors. The vectors' mean goes through a softmax over two classes. Vectors and output weights
are trained together by stochastic gradient descent in numpy, one document after another with a falling rate, on a
bounded sample of labelled documents: about ``SAMPLE_ROWS``, taken by a hash of the id, so the same at each run.
Scoring covers every whole text; it adds up each bucket's share in the softmax input, which equals the mean's.

Defined results: an empty, blank or null text has only the feature that every document has, and gets its score;
without usable labels (none, null, or one class only) the score is 0.5; repeated labels of an id count once, by
their mean; repeated rows are scored each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_rows

BUCKETS = 1 << 16
DIMENSIONS = 8
NGRAMS = (2, 3, 4)
SAMPLE_ROWS = 3000
EPOCHS = 6
RATE = 0.4
KEEP_AT = 0.3
#: The bucket of a word that repeats the one before it.
REPEATED = 0
#: Characters scored at a time: the arrays stay in a processor's cache.
STEP_CHARS = 100_000

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_KEEP_BITS = np.uint64(64 - 16)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_P, _P_INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[i] = np.cumprod(x)
    return _POWERS


def features(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of features of some texts, as (places in the joined texts, buckets).

    The joined texts have one blank before each text and one at the end; ``places`` never decrease.
    """
    joined = " " + " ".join(t or "" for t in texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    blank = (codes == 0x20) | ((codes >= 9) & (codes <= 13))
    codes[blank] = 0x20
    edges = np.flatnonzero(blank)
    lo, hi = edges[:-1] + 1, edges[1:]
    some = hi > lo
    lo, hi = lo[some], hi[some]
    powers, inverses = _powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * powers[: len(codes)], out=sums[1:])
    words = (sums[hi] - sums[lo]) * inverses[lo]
    yield lo, bucket(words, 1)
    again = np.flatnonzero((words[1:] == words[:-1]) & (hi[:-1] + 1 == lo[1:])) + 1
    yield lo[again], np.full(len(again), REPEATED)
    hashes = codes + np.uint64(1)
    inside = ~blank
    for n in range(2, max(NGRAMS) + 1):
        hashes = hashes[:-1] * _P + codes[n - 1 :] + np.uint64(1)
        # blanks may only stand at the ends; a lone edge pair is no n-gram
        good = inside[1 : len(codes) - n + 2].copy() if n > 2 else inside[:-1] | inside[1:]
        for k in range(2, n - 1):
            good &= inside[k : len(codes) - n + 1 + k]
        if n > 2:
            good = good[: len(hashes)]
        if n in NGRAMS:
            places = np.flatnonzero(good)
            yield places, bucket(hashes[places], n)


def bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(kind)) * _MIX
    return ((mixed ^ (mixed >> np.uint64(32))) * _MIX >> _KEEP_BITS).astype(np.int64)


def text_starts(texts: list) -> np.ndarray:
    """Place of the blank before each text in the joined texts."""
    return np.cumsum([0, *(len(t or "") + 1 for t in texts)])[:-1]


def feature_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text with their counts."""
    found = [b for _, b in features([text])]
    return np.unique(np.concatenate(found), return_counts=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> np.ndarray:
    """Each bucket's share in the softmax input's difference (class 1 less class 0); the last entry is every document's.

    ``rows`` are (buckets, counts, label). The mean over a document is sum(count * share) / features.
    """
    shares = np.zeros(BUCKETS + 1, np.float32)
    labels = [y for _, _, y in rows]
    if len(set(labels)) < 2:
        return shares
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            buckets, counts, label = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            ids = np.append(buckets, BUCKETS)
            weights = np.append(counts, 1).astype(np.float32)
            weights /= weights.sum()
            mean = weights @ vectors[ids]
            z = mean @ output
            error = np.exp(z - z.max())
            error /= error.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            # a mean spreads its gradient over many buckets: scaled by their number, rare features learn as well
            vectors[ids] -= (rate * len(ids) ** 0.5) * weights[:, None] * back[None, :]
    return (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32)


def sample_labels(labels: DataFrame, rows: int = SAMPLE_ROWS, usable: Column | None = None) -> DataFrame:
    """(doc_id, label): one row per id, about ``rows`` of them by hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if usable is not None:
        known = known.where(usable)
    per_id = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    share = min(1.0, rows / max(1, per_id.count()))
    return per_id.where(F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 1) <= F.lit(min(2**63 - 1, int(share * 2**63))))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, usable: Column | None = None) -> np.ndarray:
    """Train on the sampled labels' documents; only their feature counts reach the driver (4 bytes a bucket)."""
    chosen = F.broadcast(sample_labels(labels, rows, usable).withColumnRenamed("doc_id", "_tw_id"))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_tw_id"))
    one = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def work(ids, labels, texts):
        counted = [feature_counts(t) for t in texts]
        return [ids, labels, [b.astype(np.uint16).tobytes() for b, _ in counted], [np.minimum(c, 65535).astype(np.uint16).tobytes() for _, c in counted]]

    got = map_rows(one, ["doc_id", "label", "text"], work, "doc_id long, label int, buckets binary, counts binary").collect()
    unpack = lambda x: np.frombuffer(x, np.uint16).astype(np.int64)
    return train([(unpack(r.buckets), unpack(r.counts), r.label) for r in sorted(got, key=lambda r: r.doc_id)])


def scores(texts: list, shares: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each text."""
    starts = text_starts(texts)
    total = np.full(len(texts), float(shares[BUCKETS]))
    count = np.ones(len(texts))
    for places, buckets in features(texts):
        sums = np.concatenate([[0.0], np.cumsum(shares[buckets], dtype=np.float64)])
        at = np.append(np.searchsorted(places, starts), len(places))
        # the blank before a text is its own; n-grams of two texts never join, they would hold it inside
        total += np.diff(sums[at])
        count += np.diff(at)
    return 1 / (1 + np.exp(-total / count))


def score(docs: DataFrame, shares: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score for every row."""
    return map_rows(docs, [id_column, text_column], lambda ids, texts: [ids, scores(texts, shares)], "doc_id long, score double", STEP_CHARS)


def keep_good(docs: DataFrame, shares: np.ndarray, at: float = KEEP_AT, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is ``at`` or more."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            good = [scores(texts[lo:hi], shares) >= at for lo, hi in chunks(texts, STEP_CHARS)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)
