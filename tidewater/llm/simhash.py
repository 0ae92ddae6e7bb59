"""SimHash near-duplicates found through deletion-variant signatures.

A document's fingerprint has a bit where more than half of its word shingles' hashes have it. Fingerprints link at
``MAX_BITS`` or fewer differing bits. Sixty-four bits are cut into three segments, so of four differing bits some
segment holds at most one. Every distinct fingerprint is indexed under each segment with each one of its bits
masked; fingerprints that meet under a variant are compared in full. A pair counts only under its first variant.

The equality join on variants runs as one shuffle of (variant, fingerprint) rows and a pass over sorted runs, which
reports a spanning forest of each run's links, not all its pairs. Variants with more than ``BLOCK`` fingerprints
are split into blocks, and every pair of blocks is compared in a run of its own, so a run stays bounded and no link
is lost. Copies share a fingerprint and are one row here.

Defined results: a null, empty or blank text has fingerprint zero; fewer words than a shingle give one shingle of
all of them; repeated rows and copies fall into one component; a null id can be in a component but never names it
(unless it has no other); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, written
from .components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: (first bit, bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of a variant that are compared in one run.
BLOCK = 4096
#: Shingles whose bits are counted at a time.
_STEP = 200_000
#: In shorter runs all pairs are compared at once.
_SHORT_RUN = 8


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """The text's fingerprint as an unsigned integer."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - words_each + 1)
    lo = (ends - sizes)[:n].tolist()
    hi = ends[min(words_each, len(words)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _STEP):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(lo[at : at + _STEP], hi[at : at + _STEP], strict=True)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keys: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (signed 64 bits) and any further ``keys`` (longs) for every row."""

    def work(ids, *rest):
        *more, texts = rest
        return [ids, *more, np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)]

    return map_rows(docs, [id_column, *keys, text_column], work, ", ".join(["doc_id long", *(f"{k} long" for k in keys), "fp long"]))


def variants(distinct: DataFrame) -> DataFrame:
    """(variant, fp): each fingerprint under each segment with one bit masked."""
    keys = []
    for first, bits in SEGMENTS:
        segment = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1))
        keys += [segment.bitwiseAND(F.lit(~(1 << j))).bitwiseOR(F.lit((first + j) << 32)) for j in range(bits)]
    return distinct.select(F.explode(F.array(*keys)).alias("variant"), "fp")


def linked(x: np.ndarray, y: np.ndarray, variant: np.ndarray | int) -> np.ndarray:
    """Whether fingerprints link, and the variant is the first one under which they meet."""
    differ = x ^ y
    good = np.bitwise_count(differ) <= MAX_BITS
    bit = np.asarray(variant) >> 32
    for first, bits in SEGMENTS:
        own = np.bitwise_count((differ >> np.uint64(first)) & np.uint64((1 << bits) - 1))
        here, later = (bit >= first) & (bit < first + bits), bit >= first + bits
        good &= ~(later & (own <= 1)) & ~(here & (own == 0) & (bit != first))
    return good


def run_links(fps: np.ndarray, variant: int) -> list[tuple[int, int]]:
    """A spanning forest of the links in one run."""
    found, rest = [], fps
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            near = linked(rest, x, variant)
            if near.any():
                found += [(int(x), int(y)) for y in rest[near]]
                reached += list(rest[near])
                rest = rest[~near]
    return found


def forest(index: DataFrame) -> DataFrame:
    """(a, b) links of all runs of an index of (variant, lo, hi, fp) that is sorted by runs in each partition."""

    def of(held: list[np.ndarray], n: int) -> pa.RecordBatch:
        held = [h[:n] for h in held]
        variant, fps = held[0], held[3].view(np.uint64)
        starts = np.append(0, run_starts(held))
        sizes = np.diff(np.append(starts, n))
        run, size_of = np.repeat(np.arange(len(sizes)), sizes), np.repeat(sizes, sizes)
        left, right = [], []
        for lag in range(1, _SHORT_RUN):
            i = np.flatnonzero((run[lag:] == run[:-lag]) & (size_of[lag:] <= _SHORT_RUN))
            i = i[linked(fps[i], fps[i + lag], variant[i])]
            left.append(fps[i])
            right.append(fps[i + lag])
        for i in np.flatnonzero(sizes > _SHORT_RUN):
            pairs = run_links(np.unique(fps[starts[i] : starts[i] + sizes[i]]), int(variant[starts[i]]))
            left.append(np.array([a for a, _ in pairs], np.uint64))
            right.append(np.array([b for _, b in pairs], np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.int64)]
        for batch in batches:
            held = [np.append(h, batch.column(i).to_numpy(zero_copy_only=False)) for i, h in enumerate(held)]
            new = run_starts(held)
            if len(new):  # the last run may go on in the next batch
                yield of(held, new[-1])
                held = [h[new[-1] :] for h in held]
        if len(held[0]):
            yield of(held, len(held[0]))

    def run_starts(held: list[np.ndarray]) -> np.ndarray:
        variant, lo, hi, _ = held
        return 1 + np.flatnonzero((variant[1:] != variant[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))

    return index.mapInArrow(work, "a long, b long")


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b) links that connect all fingerprints within ``MAX_BITS`` bits, directly or through others."""
    spark = distinct.sparkSession
    # Stored fingerprints fit a few small files, but each becomes 64 rows: a task for each file would hold too many.
    index = variants(distinct.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "fp"))
    # Few variants are this common; they are written first, so that their size decides how they are joined.
    hot = written(spark, index.groupBy("variant").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("blocks > 1"), "hot-variants")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = (
        index.join(hot, "variant", "left")
        .select("variant", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks"))
        .select("variant", "fp", mine.alias("mine"), F.explode(others).alias("other"))
        .select("variant", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "fp")
    )
    runs = placed.repartition("variant", "lo", "hi").sortWithinPartitions("variant", "lo", "hi", "fp")
    return forest(runs).distinct()


def classes(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(class_fp, class_root, component_id) for every distinct fingerprint of ``prints`` (doc_id, fp)."""
    spark = prints.sparkSession
    distinct = written(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = components(links(distinct.select("fp"), block))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = written(spark, rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(named, "root").select(F.col("fp").alias("class_fp"), F.col("root").alias("class_root"), "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint (hexadecimal), component_id (smallest id reachable) for every row."""
    prints = written(docs.sparkSession, fingerprints(docs, id_column, text_column), "prints")
    found = classes(prints)
    return prints.join(found, prints.fp == found.class_fp, "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each component: that of the smallest id, and of its repeats any one.

    Rows are told apart by id and a hash of id and text; only rows that repeat are compared as a whole.
    """
    spark = docs.sparkSession
    mark = F.xxhash64(id_column, text_column)
    prints = written(spark, fingerprints(docs.withColumn("_tw_mark", mark), id_column, text_column, ("_tw_mark",)), "prints")
    found = classes(prints.select("doc_id", "fp"))
    kept = (
        prints.join(found, prints.fp == found.class_fp)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("class_root", F.col("component_id").alias("_tw_id"))
        .agg(F.min("_tw_mark").alias("_tw_kept"), F.count("*").alias("_tw_rows"))
        .select("_tw_id", "_tw_kept", "_tw_rows")
    )
    kept = written(spark, kept, "kept")
    columns = [docs[f"`{c}`"] for c in docs.columns]
    chosen = docs.join(kept, docs[id_column].eqNullSafe(F.col("_tw_id")) & (mark == F.col("_tw_kept")))
    once = chosen.where("_tw_rows = 1").select(*columns)
    again = chosen.where("_tw_rows > 1").select(*columns, "_tw_kept").dropDuplicates([id_column, "_tw_kept"]).drop("_tw_kept")
    return once.unionByName(again)
