"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a balanced clustering of a bounded sample: sets are halved again and again, so that all lists
get equal shares. They are searched through an in-memory neighbour graph, by beam search that compares a vector with the
neighbours of the centroids it opens and no others. (``MAX_LISTS`` centroids at most fit a task's memory; beyond
``MAX_LISTS`` * ``AIMED_ROWS`` vectors lists grow longer instead, and work with the square of the vectors.) Every vector goes to its nearest list, and a vector near a boundary also to up to ``REPLICAS`` - 1 further
ones that are not much farther. A query takes the lists whose centroids are within a distance ratio of its nearest,
up to a number of them. Distances in a list are exact.

That number and the ratio are measured, not fixed: ``CALIBRATION`` queries are compared with all vectors, and both grow
from ``PROBES`` and ``PROBE_RATIO`` until the lists hold ``RECALL`` of their true neighbours, up to all lists. The beam
is at least as wide. Vectors without clusters so get as many lists as they need at every size.

Equal vectors are one entry with their smallest ids: no query needs more of them than it wants neighbours, so a very
common vector costs nothing. A list longer than ``LIST_ROWS`` is cut into parts, and so are the queries that come to
it; parts meet parts in tasks of bounded size.

Defined results: rows with a null id, or a vector that is null, empty, zero, or holds a null, NaN or infinite
component take no part, and so do vectors of another length than the commonest; a repeated row counts once; a
query's own id is no candidate; ties go to the smaller id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

NEIGHBOURS = 10
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 8_000_000
#: Vectors aimed at in a list, and the bounds of the number of lists.
AIMED_ROWS, MAX_LISTS = 256, 32_768
#: Sampled vectors for each list, and values that are compared at a time.
ROWS_PER_LIST, STEP_VALUES = 3, 4_000_000
REPLICAS, REPLICA_RATIO = 4, 1.15
#: The least that a query takes; more if that does not hold this share of the true neighbours of so many queries.
PROBES, PROBE_RATIO = 64, 1.6
RECALL, CALIBRATION = 0.97, 256
DEGREE, BEAM, ENTRIES = 24, 96, 8
#: Centroids opened in one step are this part of the beam.
_OPENED_PART = 32
LIST_ROWS = 4000


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, fine) & F.exists(vector, lambda x: x != 0)


def halve(vectors: np.ndarray, lists: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Row numbers of ``lists`` clusters of (almost) equal size, by repeated balanced two-means."""
    todo, done = [(np.arange(len(vectors)), lists)], []
    while todo:
        rows, k = todo.pop()
        if k <= 1 or len(rows) < 2:
            done.append(rows)
            continue
        x = vectors[rows]
        left = k // 2
        cut = len(rows) * left // k
        a, b = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(8):
            order = np.argsort(((x - a) ** 2).sum(1) - ((x - b) ** 2).sum(1), kind="stable")
            a, b = x[order[:cut]].mean(0), x[order[cut:]].mean(0)
        todo += [(rows[order[cut:]], k - left), (rows[order[:cut]], left)]
    return [r for r in done if len(r)]


class Centroids:
    """The lists' centroids and their neighbour graph."""

    def __init__(self, centroids: np.ndarray):
        self.points = centroids
        self.probes, self.ratio = PROBES, PROBE_RATIO
        k = len(centroids)
        step = max(1, STEP_VALUES // k)
        near = np.concatenate([_nearest_others(centroids, lo, lo + step) for lo in range(0, k, step)])
        # besides the nearest, a few far links keep the graph in one piece
        far = (np.arange(k)[:, None] + np.array([1, 7, 61, 509])) % k
        self.links = np.concatenate([near, far], axis=1)
        self.entries = np.unique(np.linspace(0, k - 1, min(ENTRIES, k)).astype(int))
        #: Pairs of a query and a centroid whose distance was computed.
        self.compared = 0

    def _squared(self, queries: np.ndarray, which: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of pairs (query number, centroid number)."""
        self.compared += len(nodes)
        step = max(1, STEP_VALUES // self.points.shape[1])
        out = np.empty(len(nodes))
        for lo in range(0, len(nodes), step):
            d = queries[which[lo : lo + step]] - self.points[nodes[lo : lo + step]]
            out[lo : lo + step] = np.einsum("md,md->m", d, d)
        return out

    def search(self, queries: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, distances) of about the ``want`` nearest centroids of each query, nearest first."""
        n, k = len(queries), len(self.points)
        beam = min(max(BEAM, want), k)
        rows = np.arange(n)[:, None]
        width = max(1, beam // _OPENED_PART)
        seen = np.zeros((n, k), bool)
        ids = np.zeros((n, beam), int)
        far = np.full((n, beam), np.inf)
        opened = np.ones((n, beam), bool)
        new = np.repeat(self.entries[None, :], n, 0)
        while True:
            # the same centroid twice in one step: keep its first place
            order = np.argsort(new, axis=1, kind="stable")
            sorted_new = np.take_along_axis(new, order, 1)
            twice = np.zeros(new.shape, bool)
            np.put_along_axis(twice, order[:, 1:], sorted_new[:, 1:] == sorted_new[:, :-1], 1)
            fresh = ~seen[rows, new] & ~twice
            seen[rows, new] = True
            which, at = np.nonzero(fresh)
            square = np.full(new.shape, np.inf)
            square[which, at] = self._squared(queries, which, new[which, at])
            all_ids, all_far = np.concatenate([ids, new], 1), np.concatenate([far, square], 1)
            all_open = np.concatenate([opened, np.zeros_like(fresh)], 1)
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids, far, opened = (np.take_along_axis(x, best, 1) for x in (all_ids, all_far, all_open))
            waiting = np.where(opened | np.isinf(far), np.inf, far)
            nexts = np.argpartition(waiting, width - 1, axis=1)[:, :width] if width > 1 else waiting.argmin(1)[:, None]
            if np.isinf(waiting[rows, nexts]).all():
                break
            opened[rows, nexts] = True
            new = self.links[ids[rows, nexts]].reshape(n, -1)
        return ids[:, :want], np.sqrt(far[:, :want])

    def lists_for(self, vectors: np.ndarray) -> list[list[int]]:
        """Lists that hold each vector."""
        ids, far = self.search(vectors, 4 * REPLICAS)
        out = []
        for i, d in zip(ids.tolist(), far.tolist()):
            chosen = [i[0]]
            for j, dj in zip(i[1:], d[1:]):
                if dj > REPLICA_RATIO * d[0] or len(chosen) == REPLICAS:
                    break
                chosen.append(j)
            out.append(chosen)
        return out

    def lists_of_query(self, vectors: np.ndarray) -> list[list[int]]:
        """Lists to search for each query."""
        ids, far = self.search(vectors, self.probes)
        return [[j for j, dj in zip(i, d) if dj <= self.ratio * d[0] or j == i[0]] for i, d in zip(ids.tolist(), far.tolist())]

    def calibrate(self, vectors: np.ndarray, held: list[list[list[int]]]) -> float:
        """Set ``probes`` and ``ratio`` so that the lists of the queries hold ``RECALL`` of their neighbours; the share they hold.

        ``held`` has the lists of each true neighbour of each query.
        """
        k = len(self.points)
        far = np.sqrt(np.maximum(_squares(vectors, self.points), 0))
        order = np.argsort(far, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(k)[None, :].repeat(len(vectors), 0), 1)
        needed = [(int(place[q][lists].min()), float(far[q][lists].min() / max(far[q].min(), 1e-300))) for q, near in enumerate(held) for lists in near]
        if not needed:
            return 1.0
        places, ratios = (np.array(x) for x in zip(*needed, strict=True))
        last = math.ceil((1 + RECALL) / 2 * len(needed)) - 1  # the ratio may cost half of what may be missed
        self.ratio = max(PROBE_RATIO, float(np.sort(ratios)[last]) * (1 + 1e-9))
        fits = np.where(ratios <= self.ratio, places, k)
        self.probes = min(k, max(PROBES, 1 + int(np.sort(fits)[math.ceil(RECALL * len(needed)) - 1])))
        while True:
            taken = [set(x) for lo in range(0, len(vectors), 64) for x in self.lists_of_query(vectors[lo : lo + 64])]
            share = sum(not taken[q].isdisjoint(lists) for q, near in enumerate(held) for lists in near) / len(needed)
            if share >= RECALL or self.probes >= k:
                return share
            self.probes = min(k, math.ceil(1.1 * self.probes))  # the beam had missed some


def _nearest_others(points: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The ``DEGREE`` nearest other points of points ``lo`` to ``hi``, nearest first."""
    square = _squares(points[lo:hi], points)
    square[np.arange(len(square)), np.arange(lo, lo + len(square))] = np.inf
    most = min(DEGREE, len(points) - 1)
    if not most:
        return np.zeros((len(square), 0), int)
    near = np.argpartition(square, most - 1, axis=1)[:, :most]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(square, near, 1), axis=1, kind="stable"), 1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of a list column as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fit(entries: DataFrame, dimensions: int) -> Centroids | None:
    """Centroids from a sample of the distinct vectors, by hash of their smallest id; None if there is no vector."""
    n = entries.count()
    lists = min(MAX_LISTS, max(1, math.ceil(n / AIMED_ROWS)))
    rows = min(max(SAMPLE_ROWS, ROWS_PER_LIST * lists), max(1, SAMPLE_VALUES // dimensions))
    share = min(1.0, rows / max(1, n))
    place = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "entry"), 1)
    chosen = entries.where(place <= F.lit(min(2**63 - 1, int(share * 2**63)))).select("entry", "vector").orderBy("entry").limit(2 * rows)
    sample = matrix(chosen.toArrow().column("vector"))
    if not len(sample):
        return None
    lists = min(lists, len(sample))
    return Centroids(np.stack([sample[r].mean(0) for r in halve(sample, lists, np.random.default_rng(3))]))


def _placed(rows: DataFrame, centroids: Centroids, queries: bool) -> DataFrame:
    """The rows with an array of their lists."""
    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, T.StructField("lists", T.ArrayType(T.IntegerType()))])
    at = rows.columns.index("vector")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                x = matrix(part.column(at))
                found = centroids.lists_of_query(x) if queries else centroids.lists_for(x)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, "lists"])

    return rows.mapInArrow(run, schema)


def calibrate(centroids: Centroids, entries: DataFrame, index: DataFrame, queries: DataFrame, want: int) -> None:
    """Fit the centroids' probes to a bounded sample of the queries, which is compared with all entries."""
    some = queries.orderBy(F.xxhash64(F.lit("calibrate"), "query"), "query").limit(CALIBRATION).select("query", "vector").toArrow()
    if not some.num_rows:
        return
    names, y = some.column("query").to_numpy(), matrix(some.column("vector"))

    def run(batches):
        near = np.full((len(y), want), np.inf)
        ids = np.full((len(y), want), -1, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                entry = part.column(0).to_numpy()
                square = _squares(y, matrix(part.column(1)))
                square[names[:, None] == entry[None, :]] = np.inf
                all_near = np.concatenate([near, square], 1)
                all_ids = np.concatenate([ids, np.broadcast_to(entry, square.shape)], 1)
                best = np.argpartition(all_near, want - 1, axis=1)[:, :want]
                near, ids = np.take_along_axis(all_near, best, 1), np.take_along_axis(all_ids, best, 1)
        q, at = np.nonzero(np.isfinite(near))
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(ids[q, at]), pa.array(near[q, at])], names=["q", "entry", "square"])

    rank = F.row_number().over(Window.partitionBy("q").orderBy("square", "entry"))
    true = entries.select("entry", "vector").mapInArrow(run, "q int, entry long, square double").withColumn("n", rank).where(F.col("n") <= want).select("q", "entry")
    true = F.broadcast(written(entries.sparkSession, true, "true-neighbours"))  # at most CALIBRATION * want rows
    held: list[list[list[int]]] = [[] for _ in names]
    for row in index.join(true, "entry").groupBy("q", "entry").agg(F.collect_list("list").alias("lists")).collect():
        held[row.q].append(row.lists)
    centroids.calibrate(y, held)


def _nearest_in(want: int):
    """Search of one part of a list for one part of its queries."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            entries, members = left.column("entry").to_numpy(), left.column("members").to_pylist()
            x, queries = matrix(left.column("vector")), right.column("query").to_numpy()
            y = matrix(right.column("vector"))
            for lo in range(0, len(y), 256):
                rough = _squares(y[lo : lo + 256], x)
                k = min(want, len(x)) - 1
                # the rough squares only choose; a margin covers their rounding
                bounds = np.partition(rough, k, axis=1)[:, k]
                margin = 1e-9 * (np.abs(bounds) + (x * x).sum(1).max() + (y[lo : lo + 256] ** 2).sum(1))
                for i, row in enumerate(rough):
                    close = np.flatnonzero(row <= bounds[i] + margin[i])
                    d = np.sqrt(((x[close] - y[lo + i]) ** 2).sum(1))
                    for j in np.lexsort((entries[close], d))[:want]:
                        for column, v in zip(out, (queries[lo + i], entries[close[j]], d[j], members[close[j]]), strict=True):
                            column.append(v)
        return pa.table({"query": pa.array(out[0], pa.int64()), "entry": pa.array(out[1], pa.int64()), "distance": pa.array(out[2], pa.float64()), "members": pa.array(out[3], pa.list_(pa.int64()))})

    return run


def nearest(embeddings: DataFrame, is_query: Column, want: int = NEIGHBOURS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's nearest other vectors. ``is_query`` is a condition on column ``vec_id``."""
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    common = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimensions = common.d if common else 1
    rows = vectors.where(F.size("vector") == dimensions).groupBy("vector", "vec_id").agg(F.lit(1).alias("one")).drop("one")
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    entries = rows.withColumn("n", first).where(F.col("n") <= want + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    entries = written(spark, entries.select(F.col("members")[0].alias("entry"), "members", "vector"), "entries")
    centroids = fit(entries, dimensions)
    if centroids is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = rows.where(is_query).join(entries.select("vector", "entry"), "vector").select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query"), "vector")
    asked = written(spark, asked, "queries")
    one_each = asked.groupBy("query").agg(F.first("vector").alias("vector"))
    index = written(spark, _placed(entries, centroids, False).withColumn("list", F.explode("lists")).drop("lists"), "index")
    calibrate(centroids, entries, index, one_each, want)
    queries = written(spark, _placed(one_each, centroids, True).withColumn("list", F.explode("lists")).drop("lists"), "probes")
    # One row per list: at most MAX_LISTS.
    sizes = index.groupBy("list").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("index_parts")).join(
        queries.groupBy("list").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("query_parts")), "list"
    )
    sizes = F.broadcast(written(spark, sizes, "list-sizes"))
    part = lambda key, parts: F.pmod(F.xxhash64(key), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = index.join(sizes, "list").withColumn("a", part("entry", "index_parts")).withColumn("b", every("query_parts")).select("list", "a", "b", "entry", "members", "vector")
    right = queries.join(sizes, "list").withColumn("b", part("query", "query_parts")).withColumn("a", every("index_parts")).select("list", "a", "b", "query", "vector")
    key = ["list", "a", "b"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_nearest_in(want + 1), "query long, entry long, distance double, members array<long>")
    once = found.groupBy("query", "entry").agg(F.min("distance").alias("distance"), F.first("members").alias("members"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "entry"))
    top = once.withColumn("n", rank).where(F.col("n") <= want + 1)
    opened = top.select("query", F.transform("members", lambda m: F.struct(F.col("distance").alias("score"), m.alias("vec_id"))).alias("near"))
    best = opened.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list("near"))).alias("near"))
    chosen = asked.join(best, "query").select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, want).alias("near"))
    return chosen.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
