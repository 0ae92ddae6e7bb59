"""Load each delivered file once: a streaming listing of the stage says which files are new."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.store import TableStore
from ..operators.versions import Files
from ..schemas import STAGING, TableSpec
from ..session import require_ansi
from ..sources.delimited import read_lines, strict_rows, tolerant_rows

ALL_AVAILABLE: Mapping[str, object] = {"availableNow": True}
#: New files of one micro-batch, whose paths the driver holds.
FILES_PER_BATCH = 10_000
_FILE = "path string, modificationTime timestamp, length bigint, content binary"
#: Checkpoint of the load that follows a stage for all tables.
WHOLE_STAGE = "stage"

Rows = Callable[[SparkSession, TableSpec, DataFrame], DataFrame]


def ingest_new_files(
    store: TableStore,
    spec: TableSpec,
    stage_dir: str,
    pattern: str | None = None,
    trigger: Mapping[str, object] = ALL_AVAILABLE,
    max_files_per_trigger: int | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start loading the files not loaded yet into one staging table.

    The checkpoint remembers the files. A micro-batch gets a number of its own in the table and keeps
    it, so a batch repeated after a failure replaces itself, and one of a new checkpoint replaces
    nothing. ``trigger={"processingTime": "1 minute"}`` keeps
    following the folder; ``after_batch`` then runs what depends on the new rows.
    """
    if followed_whole(store):
        raise RuntimeError("this store's stage is followed for all tables by one load: use ingest_stage")
    patterns = {spec: pattern or spec.pipe_pattern}
    return _load(store, patterns, stage_dir, "ingest", spec.name, tolerant_rows, trigger, max_files_per_trigger, after_batch)


def ingest_stage(
    store: TableStore,
    specs: Sequence[TableSpec],
    stage_dir: str,
    trigger: Mapping[str, object] = ALL_AVAILABLE,
    max_files_per_trigger: int | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """The same for all tables together: the stage is listed once, under one checkpoint.

    Each micro-batch's files are dealt to their tables by path pattern and the tables are loaded side by side.
    A store's stage is followed either this way or table by table.
    """
    if started_singly(store):
        raise RuntimeError("this store's stage is followed table by table: use ingest_new_files")
    if followed_whole(store) and {s.name for s in specs} != set(STAGING):
        raise RuntimeError("this store's stage is followed for all tables: files of the others would be passed over")
    patterns = {spec: spec.pipe_pattern for spec in specs}
    return _load(store, patterns, stage_dir, "ingest", WHOLE_STAGE, tolerant_rows, trigger, max_files_per_trigger, after_batch)


def bulk_load_new_files(
    store: TableStore, spec: TableSpec, stage_dir: str, pattern: str | None = None
) -> StreamingQuery:
    """Add the rows of bulk files not loaded yet, by the strict rules: a bad row aborts the load.

    Lineage columns are NULL. The bulk load has a checkpoint of its own, so each file is loaded once
    and later deliveries are added to what is there.
    """
    patterns = {spec: pattern or spec.bulk_pattern}
    return _load(store, patterns, stage_dir, "bulk", spec.name, strict_rows, ALL_AVAILABLE)


def followed_whole(store: TableStore) -> bool:
    """Whether one load follows the stage for all tables."""
    return _started(store, "ingest", WHOLE_STAGE)


def started_singly(store: TableStore) -> bool:
    """Whether a load follows the stage for some table alone."""
    return any(_started(store, "ingest", name) for name in STAGING)


def _started(store: TableStore, kind: str, name: str) -> bool:
    path = store.control_path(f"{kind}/{name}")
    return Files(store.spark, path).exists(path)


def _load(
    store: TableStore,
    patterns: Mapping[TableSpec, str],
    stage_dir: str,
    kind: str,
    name: str,
    rows: Rows,
    trigger: Mapping[str, object],
    max_files_per_trigger: int | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    require_ansi(store.spark)
    # The content column is not asked for: the stream lists files and opens none.
    files = (
        store.spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger or FILES_PER_BATCH)
        .load(stage_dir)
        .select("path")
    )

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.collect())
        own = {spec: [p for p in paths if re.fullmatch(pattern, p)] for spec, pattern in patterns.items()}
        # The query's id is kept in its checkpoint: a new checkpoint is a new load.
        load = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")

        def load_table(spec: TableSpec) -> None:
            new = rows(store.spark, spec, read_lines(store.spark, own[spec]))
            store.write_batch(spec, new, store.batch_number(spec, load, batch_id))

        named = [spec for spec in patterns if own[spec]]
        # Each table's load gets a copy of the session's properties.
        loads = [(inheritable_thread_target(store.spark)(load_table), spec) for spec in named]
        with ThreadPoolExecutor(max_workers=8) as pool:
            for done in [pool.submit(*each) for each in loads]:
                done.result()
        if named and after_batch:
            after_batch(batch_id)

    return (
        files.writeStream.queryName(f"{kind}_{name}")
        .foreachBatch(load_batch)
        .option("checkpointLocation", store.control_path(f"{kind}/{name}"))
        .trigger(**trigger)
        .start()
    )


def follow_stage(
    store: TableStore,
    spec: TableSpec,
    stage_dir: str,
    job: Callable[[TableStore], object],
    interval: str = "1 minute",
    **options,
) -> StreamingQuery:
    """Keep loading new files and run ``job`` (a change merge) after each batch."""
    return ingest_new_files(
        store,
        spec,
        stage_dir,
        trigger={"processingTime": interval},
        after_batch=lambda _: job(store),
        **options,
    )


def ingest_status(query: StreamingQuery) -> DataFrame:
    """Latest load status as one row."""
    progress = query.lastProgress
    return SparkSession.active().createDataFrame(
        [
            (
                query.name,
                query.isActive,
                progress["batchId"] if progress else None,
                progress["numInputRows"] if progress else None,
                progress["timestamp"] if progress else None,
            )
        ],
        "name string, is_active boolean, batch_id bigint, new_files bigint, reported_at string",
    )
