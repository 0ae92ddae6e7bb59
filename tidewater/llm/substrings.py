"""Substring deduplication: words covered by a window of ``WINDOW`` words that starts anywhere else as well.

Equal windows must meet in one shard without every document being streamed through every shard. So windows are
grouped by content: a window's anchor is the least hash among its word ``GRAM``-grams, and consecutive windows with the
same anchor form a segment. Equal windows have equal anchors.

1. One pass over the texts gives each document a digest of its words and its anchors. Documents with equal words are
   copies: their windows all repeat, and one of them stands for the class from here on.
2. Anchors are counted; a window whose anchor occurs once is unique. Documents with repeated anchors are written.
3. Their segments with repeated anchors are written and collapsed by content. A segment found twice repeats as a whole,
   so only segments found once go on, each with its one place: no occurrence is joined back to its content.
4. Shards of segments, by anchor, get a compressed FM-index each (Burrows-Wheeler transform in a wavelet matrix).
   Segments found once are streamed through it: backward search gives matching statistics, and windows whose
   statistic reaches the threshold occur elsewhere. Anchors with more than ``SHARD_SEGMENTS`` different segments would
   not fit a shard; their windows are compared by 128-bit digests instead, which spreads them over all tasks.
5. What was found once returns to its document with the windows that do repeat; every other window of the document's
   written segments repeats. The document drops the covered words.

Defined results: a null, empty or blank text has no words; a text shorter than a window keeps all; repeated rows are
copies; an empty table gives no rows; other columns are kept by ``drop_repeats`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, written
from .fm_index import FMIndex

WINDOW, GRAM = 35, 8
#: Anchors are chosen among this many grams, so a segment has no more windows (they fit the bits of a long).
SPAN = WINDOW - GRAM + 1
SHARD_SEGMENTS, SHARD_WORDS = 2000, 200_000
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE_BITS = np.uint64((1 << 28) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(joined: bytes) -> np.ndarray:
    """A 64-bit hash of each word of blank-joined words."""
    raw = np.frombuffer(joined + b" ", np.uint8)
    ends = np.flatnonzero(raw == 0x20)
    starts = np.append(0, ends[:-1] + 1)
    powers, inverses = (np.full(len(raw), x, np.uint64) for x in (_P, _P_INVERSE))
    powers[0] = inverses[0] = 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw + np.uint64(1)) * np.cumprod(powers), out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * np.cumprod(inverses)[starts])


def runs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor) of each segment of a document's word hashes."""
    n = len(hashes) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(hashes) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams = grams * _P + hashes[k : len(hashes) - GRAM + 1 + k]
    grams = _mixed(grams)
    low = (grams & ~_PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[SPAN - width : SPAN - width + n])
    places = (low & _PLACE_BITS).astype(np.int64)
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    return first, np.diff(np.append(first, n)), grams[places[first]]


def profile(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, n_words, digest of the words (hexadecimal), digest of the text, anchors and those that occur twice in it."""

    def work(ids, texts):
        out: list[list] = [ids, [], [], [], []]
        for text in texts:
            raw = (text or "").encode()
            words = raw.split()
            joined = b" ".join(words)
            anchors = runs(word_hashes(joined))[2] if len(words) >= WINDOW else np.zeros(0, np.uint64)
            out[1].append(len(words))
            out[2].append(hashlib.sha256(joined).hexdigest())
            out[3].append(hashlib.sha256(raw).hexdigest())
            out[4].append(anchors.view(np.int64))
        return out

    return map_rows(docs, [id_column, text_column], work, "doc_id long, n_words long, digest string, text_digest string, anchors array<long>")


def suspects(docs: DataFrame, classes: DataFrame, text_column: str) -> DataFrame:
    """digest, text, anchors (those that repeat) of one document of each class that has any.

    Of equal texts one is kept, first where they are read, so copies meet nowhere; the join needs no further exchange.
    """
    short = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    anchors = classes.select(short.alias("short"), F.explode("anchors").alias("anchor"))
    repeated = anchors.groupBy("anchor").count().where("count > 1").select("anchor")
    # Keyed by a part of the digest: two classes that share it only get each other's anchors to check.
    by_class = anchors.distinct().join(repeated, "anchor").groupBy("short").agg(F.collect_list("anchor").alias("anchors"))
    wanted = classes.select("digest", "text_digest", short.alias("short")).join(by_class, "short").select("digest", "anchors", F.col("text_digest").alias("wanted_text"))
    texts = docs.select(F.sha2(text_column, 256).alias("own_text"), F.col(text_column).alias("text")).dropDuplicates(["own_text"])
    return texts.join(wanted, F.col("own_text") == F.col("wanted_text")).select("digest", "text", "anchors")


def segments(found: DataFrame) -> DataFrame:
    """For each document its segments with a repeated anchor: start, windows, anchor, content (digest of 16 bytes), words."""

    def work(digests, anchors, texts):
        out: list[list] = [digests, [], [], [], [], []]
        for wanted, text in zip(anchors, texts, strict=True):
            words = text.encode().split()
            first, count, anchor = runs(word_hashes(b" ".join(words)))
            anchor = anchor.view(np.int64)
            here = np.isin(anchor, np.array(wanted, np.int64))
            first, count = first[here].tolist(), count[here].tolist()
            contents = [b" ".join(words[a : a + n + WINDOW - 1]) for a, n in zip(first, count, strict=True)]
            row = (first, count, anchor[here].tolist(), [hashlib.blake2b(c, digest_size=16).digest() for c in contents], contents)
            for column, v in zip(out[1:], row, strict=True):
                column.append(v)
        return out

    schema = "digest string, starts array<int>, windows array<int>, anchors array<long>, contents array<binary>, words array<binary>"
    return map_rows(found, ["digest", "anchors", "text"], work, schema)


def search(shards: DataFrame) -> DataFrame:
    """digest, start, windows, mask (bit i: window i repeats) of segments found once; rows come sorted by anchor."""

    def resolve(rows: list[tuple]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        parts, queries, at = [], [], 0
        singles = [r[:3] for r in rows if r[3] == 1]
        for _, _, n, times, words in rows:
            if words is None:
                continue  # alone with its anchor: it meets no other
            symbols = [numbers.setdefault(w, len(numbers) + 1) for w in words.split(b" ")]
            if times == 1:
                queries.append((len(queries), n, at))
            parts += [*symbols, 0]
            at += len(symbols) + 1
        masks = []
        if queries:
            text = np.array(parts, np.int64)
            index = FMIndex(text, 2 * WINDOW)
            ends = np.concatenate([at + WINDOW - 1 + np.arange(n) for _, n, at in queries])
            repeats = index.matched(text, ends, WINDOW, 2) >= WINDOW
            cuts = np.cumsum([0, *(n for _, n, _ in queries)])
            masks = [int(np.packbits(repeats[a : a + n], bitorder="little").tobytes()[::-1].hex(), 16) for (_, n, _), a in zip(queries, cuts, strict=False)]
        found = iter(masks)
        columns = [
            pa.array([r[0] for r in singles], pa.string()),
            pa.array([r[1] for r in singles], pa.int32()),
            pa.array([r[2] for r in singles], pa.int32()),
            pa.array([0 if r[4] is None else next(found) for r in rows if r[3] == 1], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["digest", "start", "windows", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, size, last = [], [], 0, None
        for batch in batches:
            for anchor, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != last:
                    held += group if len(group) > 1 else [(*r[:4], None) for r in group]
                    group, last = [], anchor
                    if size > SHARD_WORDS:
                        yield resolve(held)
                        held, size = [], 0
                group.append(tuple(row))
                size += row[2] + WINDOW
        held += group if len(group) > 1 else [(*r[:4], None) for r in group]
        yield resolve(held)

    return shards.select("anchor", "digest", "start", "windows", "times", "words").mapInArrow(run, "digest string, start int, windows int, mask long")


def window_digests(found: DataFrame) -> DataFrame:
    """digest, start, window (16 bytes) of every window of the given segments."""

    def work(digests, starts, windows, contents):
        out: list[list] = [[], [], []]
        for digest, start, n, content in zip(digests, starts, windows, contents, strict=True):
            words = content.split(b" ")
            for i in range(n):
                out[0].append(digest)
                out[1].append(start + i)
                out[2].append(hashlib.blake2b(b" ".join(words[i : i + WINDOW]), digest_size=16).digest())
        return out

    return map_rows(found, ["digest", "start", "windows", "words"], work, "digest string, start int, window binary")


def exceptions(parts: DataFrame, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """digest, found: (start, windows, mask) of the segments and windows that were found once."""
    spark = parts.sparkSession
    each = parts.select("digest", F.explode(F.arrays_zip("starts", "windows", "anchors", "contents", "words")).alias("s")).select(
        "digest", F.col("s.starts").alias("start"), "s.windows", F.col("s.anchors").alias("anchor"), F.col("s.contents").alias("content"), "s.words"
    )
    # Of a content found once the first place is the only one.
    distinct = each.groupBy("anchor", "content").agg(F.count("*").alias("times"), *(F.first(c).alias(c) for c in ("digest", "start", "windows", "words")))
    distinct = written(spark, distinct, "contents", "zstd")
    # Few anchors are this common; they are written, so that their size decides how they are joined.
    hot = written(spark, distinct.groupBy("anchor").count().where(F.col("count") > shard_segments).select("anchor"), "hot-anchors")
    shards = distinct.join(hot, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    cold = search(shards)
    windows = window_digests(each.join(hot, "anchor", "left_semi"))
    once = windows.groupBy("window").agg(F.count("*").alias("times"), F.first("digest").alias("digest"), F.first("start").alias("start")).where("times = 1")
    warm = once.select("digest", "start", F.lit(1).alias("windows"), F.lit(0).cast("long").alias("mask"))
    return cold.union(warm).groupBy("digest").agg(F.collect_list(F.struct("start", "windows", "mask")).alias("found"))


def covered(n_words: int, starts: list[int], windows: list[int], found: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word lies in a repeated window: one of the given segments, less what was found once."""
    repeated = np.zeros(max(0, n_words - WINDOW + 1), bool)
    for start, n in zip(starts, windows, strict=True):
        repeated[start : start + n] = True
    for start, n, mask in found:
        repeated[start : start + n] = [mask >> i & 1 for i in range(n)]
    edges = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return np.cumsum(edges)[:n_words] > 0


def without(text: str, gone: np.ndarray) -> str:
    """The text less the given words, each with the white space after it."""
    parts, at, skipping = [], 0, False
    for m, drop in zip(WORDS.finditer(text), gone.tolist()):
        if drop and not skipping:
            parts.append(text[at : m.start()])
        elif skipping and not drop:
            at = m.start()
        skipping = drop
    return "".join(parts) if skipping else "".join([*parts, text[at:]])


def trimmed(found: DataFrame, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """digest, n_removed, kept_sha256, kept_text of the suspects that lose words."""

    def work(digests, starts, windows, once, texts):
        out: list[list] = [[], [], [], []]
        for digest, own_starts, own_windows, own, text in zip(digests, starts, windows, once, texts, strict=True):
            words = text.encode().split()
            gone = covered(len(words), own_starts, own_windows, [(x["start"], x["windows"], x["mask"]) for x in own or ()])
            if gone.any():
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                for column, v in zip(out, (digest, int(gone.sum()), hashlib.sha256(kept).hexdigest(), without(text, gone)), strict=True):
                    column.append(v)
        return out

    parts = written(found.sparkSession, segments(found), "segments", "zstd")
    marked = parts.select("digest", "starts", "windows").join(exceptions(parts, shard_segments), "digest", "left")
    schema = "digest string, n_removed long, kept_sha256 string, kept_text string"
    return map_rows(found.select("digest", "text").join(marked, "digest"), ["digest", "starts", "windows", "found", "text"], work, schema)


def _analysed(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows by profile, classes of copies, trimmed class documents)."""
    spark = docs.sparkSession
    rows = written(spark, profile(docs, id_column, text_column), "profiles")
    classes = rows.where(F.col("n_words") >= WINDOW).groupBy("digest").agg(F.count("*").alias("copies"), F.min(F.struct("text_digest", "anchors")).alias("own"))
    classes = written(spark, classes.select("digest", "copies", "own.text_digest", "own.anchors"), "classes")
    found = suspects(docs, classes, text_column)
    found = written(spark, found, "suspect-classes", "zstd")
    return rows, classes, trimmed(found)


def repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    rows, classes, losses = _analysed(docs, id_column, text_column)
    copies = classes.where("copies > 1").select("digest")
    marks = losses.select("digest", "n_removed", "kept_sha256").join(copies, "digest", "left_anti").union(
        copies.select("digest", F.lit(None).cast("long"), F.lit(EMPTY))
    )
    marks = written(docs.sparkSession, marks, "marks")
    joined = rows.select("doc_id", "n_words", "digest").join(marks, "digest", "left")
    removed = F.when(F.col("kept_sha256").isNull(), 0).otherwise(F.coalesce("n_removed", "n_words"))
    return joined.select("doc_id", "n_words", removed.cast("long").alias("n_removed"), F.coalesce("kept_sha256", "digest").alias("kept_sha256"))


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """The rows with repeated words taken out of the text, and the length, if there is one, set to the new text's."""
    rows, classes, losses = _analysed(docs, id_column, text_column)
    copies = classes.where("copies > 1").select("digest")
    kept = losses.select("digest", "kept_text").join(copies, "digest", "left_anti").union(copies.select("digest", F.lit("")))
    by_text = rows.groupBy("text_digest").agg(F.first("digest").alias("digest")).join(kept, "digest").select(F.col("text_digest").alias("_tw_digest"), F.col("kept_text").alias("_tw_kept"))
    joined = docs.join(written(docs.sparkSession, by_text, "kept-texts"), F.sha2(F.coalesce(docs[text_column], F.lit("")), 256) == F.col("_tw_digest"), "left")
    changed = F.col("_tw_kept").isNotNull()
    columns = [docs[f"`{c}`"] for c in docs.columns]
    values = {
        text_column: F.coalesce("_tw_kept", docs[text_column]),
        length_column: F.when(changed, F.length("_tw_kept").cast("long")).otherwise(docs[length_column]) if length_column in docs.columns else None,
    }
    return joined.select(*(values[c].cast(docs.schema[c].dataType).alias(c) if c in values else x for c, x in zip(docs.columns, columns, strict=True)))
