"""Parquet tables that can be merged into, rewriting only the storage blocks a change touches."""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..schemas import BATCH_COLUMN, NO_KEY_BLOCK, TableSpec
from .changes import ACTION, DELETE, INSERT, IS_UPDATE
from .merge import BEFORE, DELETED, INSERTED, KEPT, MERGE_FLAG, UPDATED, upsert
from .versions import Files, Note, Versions

_BATCHES = StructType().add("load", StringType()).add("batch", LongType()).add("number", LongType())
#: Partition columns of every write: its number, and whether a file holds the table's rows or change images.
VERSION_COLUMN, KIND_COLUMN = "_version", "_kind"
ROWS, IMAGES = "rows", "images"
#: Files that the buckets of a new table's narrow blocks may come to.
BUCKET_FILES = 1024
_APPLIED = "tidewater.version"


@dataclass(frozen=True)
class MergeCounts:
    inserted: int = 0
    updated: int = 0

    @property
    def affected(self) -> int:
        return self.inserted + self.updated


@dataclass(frozen=True)
class JobResult:
    """What a job did: rows affected and a readable status."""

    rows_affected: int
    message: str


class TableStore:
    """Tables below one root folder, read through the session's catalog.

    Each write is a folder of its own, ``<root>/<layer>/<table>/_version=<n>``, that never moves. A note commits it,
    and then the locations of the touched partitions are changed in the catalog: readers see a block as it
    was before or after a write, never without files. Keyed tables are bucketed by their key, so a merge
    shuffles its batch alone. One writer per table at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = "tw_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        self._known: dict[str, int] = {}

    def path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.layer}/{spec.name}"

    def control_path(self, name: str) -> str:
        return f"{self.root}/control/{name}"

    def versions(self, spec: TableSpec) -> Versions:
        return Versions(self.spark, self.path(spec), self.control_path(f"commits/{spec.layer}/{spec.name}"))

    # -- reading -------------------------------------------------------------------------------

    def table_name(self, spec: TableSpec) -> str:
        """The table's name in the catalog; an absent table is created without rows."""
        name = f"{self.database}.{spec.layer}_{spec.name}"
        if name in self._known:
            return name
        versions = self.versions(spec)
        if not self.spark.catalog.tableExists(name):
            first = next(iter(versions.listed()), None)
            buckets = versions.committed(first[0] - 1)[0].buckets if first else self._new_buckets(spec)
            self._create_entry(spec, name, buckets)
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
        clustered = described.where("col_name = 'Num Buckets'").first()
        self._known[name] = int(clustered.data_type) if clustered else 0
        self._catch_up(spec, versions)
        return name

    def read_partitioned(self, spec: TableSpec) -> DataFrame:
        """The table with its partition column."""
        return self.spark.table(self.table_name(spec)).select(*spec.columns.names, spec.partition_column)

    def read(self, spec: TableSpec) -> DataFrame:
        return self.read_partitioned(spec).select(*spec.columns.names)

    def blocks(self, spec: TableSpec) -> list[int]:
        """Partition values, from the catalog alone."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.table_name(spec)}").collect()
        return [int(r[0].split("=")[1]) for r in found]

    def zones(self, spec: TableSpec) -> DataFrame:
        """block, stored (rows), low, high (of the spec's zone column, as text) of each block that has rows."""
        name = self.table_name(spec)
        noted = self.versions(spec).zones(self.spark, self._applied(name))
        newest = noted.groupBy("block").agg(F.max_by(F.struct("stored", "low", "high"), "version").alias("of"))
        return newest.select("block", "of.*").join(self._block_rows(spec), "block", "left_semi")

    def dealt(self, spec: TableSpec) -> int | None:
        """Partitions by key from which a whole write or merge of the table goes on without another exchange.

        None for a table without buckets, or whose first write is yet to decide on them.
        """
        return None if spec.narrow else self._buckets(spec) or None

    # -- whole-table writes --------------------------------------------------------------------

    def create(self, spec: TableSpec, replace: bool = False) -> None:
        """Create the table without rows; an existing one is kept unless ``replace``."""
        self.recover(spec)
        if replace:
            versions = self.versions(spec)
            self._commit(spec, versions, self._note(spec, versions, whole=True))

    def overwrite(self, spec: TableSpec, df: DataFrame) -> None:
        """Replace all rows. The old ones stay until the new ones are written."""
        self._create_fitting(spec, df)
        self.recover(spec)
        rows = self._conform(spec, df).withColumn(spec.partition_column, spec.stored_block())
        buckets = self._buckets(spec)
        if buckets:
            rows = rows.repartition(buckets, *spec.keys)
        self._replace(spec, rows.withColumn(MERGE_FLAG, F.lit(INSERTED)), whole=True)

    def write_batch(self, spec: TableSpec, df: DataFrame, batch_id: int) -> None:
        """Store one load of a staging table. Repeating a batch replaces it."""
        self.recover(spec)
        rows = self._conform(spec, df).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
        versions = self.versions(spec)
        version = versions.next_version()
        folder = versions.folder(version)
        rows.write.mode("overwrite").partitionBy(BATCH_COLUMN).parquet(f"{folder}/{KIND_COLUMN}={ROWS}")
        stored = versions.files.exists(f"{folder}/{KIND_COLUMN}={ROWS}/{BATCH_COLUMN}={batch_id}")
        written = {"blocks": [batch_id]} if stored else {"emptied": [batch_id]}
        self._commit(spec, versions, Note(version, batch_id, **written))

    def batch_number(self, spec: TableSpec, load: str, batch_id: int) -> int:
        """The table's number of a load's batch: given once, and above all numbers in use."""
        path = self.control_path(f"batches/{spec.name}")
        given = read_or_empty(self.spark, path, _BATCHES)
        mine = (F.col("load") == load) & (F.col("batch") == batch_id)
        own, highest = given.agg(F.max(F.when(mine, F.col("number"))), F.max("number")).first()
        if own is not None:
            return own
        number = 1 + max(-1, -1 if highest is None else highest, self.newest_number(spec))
        row = self.spark.range(1).select(
            F.lit(load).alias("load"),
            F.lit(batch_id).cast("bigint").alias("batch"),
            F.lit(number).cast("bigint").alias("number"),
        )
        row.write.mode("append").parquet(path)
        return number

    # -- row-level changes ---------------------------------------------------------------------

    def merge(
        self,
        spec: TableSpec,
        source: DataFrame,
        update: Sequence[str],
        insert: Sequence[str],
        on_update: Mapping[str, Column] | None = None,
        on_insert: Mapping[str, Column] | None = None,
        keys_from: DataFrame | None = None,
        offset: tuple[str, int] | None = None,
    ) -> MergeCounts:
        """Upsert ``source`` and rewrite the blocks it touches.

        ``keys_from`` is a cheaper DataFrame holding (at least) the source's keys, used to find
        those blocks. The table's rows of a bucket meet the batch's where they are stored and are
        written from there: only the batch is exchanged. ``offset`` (consumer, number) is committed with
        the rows, so a consumer that recovers first never applies a batch twice, NULL keys included.
        """
        self.recover(spec)
        keys = source if keys_from is None else keys_from
        touched = [r.b for r in keys.select(spec.stored_block().alias("b")).distinct().collect()]
        if not touched:
            if offset:
                self.commit_offset(*offset)
            return MergeCounts()
        return self._replace(spec, self.merged(spec, source, touched, update, insert, on_update, on_insert), offset=offset)

    def merged(
        self,
        spec: TableSpec,
        source: DataFrame,
        touched: Sequence[int],
        update: Sequence[str],
        insert: Sequence[str],
        on_update: Mapping[str, Column] | None = None,
        on_insert: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """The touched blocks' rows after a merge, flagged, with the row before where images are kept."""
        target = self._only_blocks(spec, touched).select(*spec.columns.names)
        rows = upsert(target, source, spec.keys, update, insert, on_update, on_insert, before=spec.feed)
        return rows.withColumn(spec.partition_column, spec.stored_block())

    def update_where(
        self, spec: TableSpec, condition: Column, values: Mapping[str, Column]
    ) -> int:
        """Set ``values`` where ``condition`` holds; returns the number of rows changed."""
        self.recover(spec)
        touched = self._blocks_with(spec, condition)
        if not touched:
            return 0
        rows = self._only_blocks(spec, touched)
        hit = F.coalesce(condition, F.lit(False))
        changed = [
            (F.when(hit, values[f.name]).otherwise(F.col(f.name)) if f.name in values else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in rows.schema
        ]
        before = [F.when(hit, F.struct(*spec.columns.names)).alias(BEFORE)] if spec.feed else []
        flag = F.when(hit, UPDATED).otherwise(KEPT).alias(MERGE_FLAG)
        return self._replace(spec, rows.select(*changed, *before, flag), in_place=True).updated

    def delete_where(self, spec: TableSpec, condition: Column) -> int:
        """Delete the rows where ``condition`` holds; returns how many there were."""
        self.recover(spec)
        touched = self._blocks_with(spec, condition)
        if not touched:
            return 0
        hit = F.coalesce(condition, F.lit(False))
        rows = self._only_blocks(spec, touched)
        before = [F.when(hit, F.struct(*spec.columns.names)).alias(BEFORE)] if spec.feed else []
        flag = F.when(hit, DELETED).otherwise(KEPT).alias(MERGE_FLAG)
        self._replace(spec, rows.select("*", *before, flag), in_place=True, touched=touched)
        return sum(touched.values())

    # -- change batches ------------------------------------------------------------------------

    def newest_number(self, spec: TableSpec) -> int:
        """Highest number of a committed write; -1 without any."""
        return max((number for _, number, _, _ in self.versions(spec).listed()), default=-1)

    def images(self, spec: TableSpec, after: int, upto: int) -> DataFrame:
        """Before and after images of the writes numbered above ``after`` up to ``upto``.

        Columns of the table, its partition column (for a staging table the load a row came with), ``_action``,
        ``_is_update`` and the write's version.
        """
        self.table_name(spec)
        versions = self.versions(spec)
        schema = StructType(
            [
                *spec.read_schema.fields,
                StructField(ACTION, StringType()),
                StructField(IS_UPDATE, BooleanType()),
                StructField(spec.partition_column, LongType()),
                StructField(VERSION_COLUMN, LongType()),
            ]
        )
        wanted = [v for v, number, kind, _ in versions.listed() if kind == "images" and after < number <= upto]
        folders = [f"{versions.folder(v)}/{KIND_COLUMN}={IMAGES}" for v in wanted]
        folders = [f for f in folders if versions.files.exists(f)]
        if not folders:
            return empty_rows(self.spark, schema)
        found = self.spark.read.schema(schema).option("basePath", self.path(spec)).parquet(*folders)
        return found.select(*schema.names)

    # -- interrupted writes --------------------------------------------------------------------

    def recover(self, spec: TableSpec) -> None:
        """Show writes that were committed when their driver was lost, and drop those that were not.

        Every write does this first. It is for the table's one writer: a reader must not call it.
        """
        self.table_name(spec)
        versions = self.versions(spec)
        self._catch_up(spec, versions)
        versions.drop_unfinished()

    def commit_offset(self, consumer: str, upto: int) -> None:
        """Note that a feed's consumer has applied all batches up to ``upto``."""
        self.spark.range(1).select(
            F.lit(consumer).alias("consumer"),
            F.lit(upto).cast("bigint").alias("upto"),
            F.current_timestamp().alias("at"),
        ).write.mode("append").parquet(self.control_path(f"offsets/{consumer}"))

    def vacuum(self, spec: TableSpec, applied_upto: int = -1) -> int:
        """Delete files that no block of the table uses any more; returns how many folders went.

        Images stay unless their number is at most ``applied_upto``, the least offset of the feed's consumers. Not
        for times when readers that began before the last write may still be running.
        """
        self.recover(spec)
        versions = self.versions(spec)
        used: dict[int, int] = {}
        for note in versions.committed():
            kept = {} if note.whole else {b: v for b, v in used.items() if b not in note.emptied}
            used = kept | dict.fromkeys(note.blocks, note.version)
        gone = 0
        for version, number, kind, _ in versions.listed():
            rows = f"{versions.folder(version)}/{KIND_COLUMN}={ROWS}"
            for name in versions.files.names(rows):
                if "=" in name and used.get(int(name.split("=")[1])) != version:
                    versions.files.delete(f"{rows}/{name}")
                    gone += 1
            images = f"{versions.folder(version)}/{KIND_COLUMN}={IMAGES}"
            if kind == "images" and number <= applied_upto and versions.files.exists(images):
                versions.files.delete(images)
                gone += 1
        return gone

    # -- writing -------------------------------------------------------------------------------

    def _replace(
        self,
        spec: TableSpec,
        flagged: DataFrame,
        touched: Mapping[int, int] | None = None,
        whole: bool = False,
        in_place: bool = False,
        offset: tuple[str, int] | None = None,
    ) -> MergeCounts:
        """Write flagged rows as a new version and put their blocks in place of the table's, or of all.

        ``touched`` blocks that got no rows are removed. ``in_place`` marks writes to loads that are there: in a
        staging table they take a number of their own.
        """
        versions = self.versions(spec)
        images = spec.feed and not whole
        note = self._note(spec, versions, images=images, whole=whole, offset=offset, in_place=in_place)
        folder = versions.folder(note.version)
        self._write(spec, self._images(spec, flagged) if images else self._rows_only(spec, flagged), folder)
        stats = self._measure(spec, folder, versions.files)
        emptied = sorted(set(touched or ()).difference(r.block for r in stats))
        zones = sorted((r.block, r.stored, r.low, r.high) for r in stats) if spec.zone else []
        note = dataclasses.replace(note, blocks=sorted(r.block for r in stats), emptied=emptied, zones=zones)
        self._commit(spec, versions, note)
        return MergeCounts(sum(r.inserted for r in stats), sum(r.updated for r in stats))

    def _note(self, spec: TableSpec, versions: Versions, in_place: bool = False, **what) -> Note:
        version = versions.next_version()
        number = self.newest_number(spec) + 1 if in_place and spec.layer == "staging" else version
        return Note(version, number, buckets=self._buckets(spec), **what)

    def _rows_only(self, spec: TableSpec, flagged: DataFrame) -> DataFrame:
        rows = flagged.where(F.col(MERGE_FLAG) != DELETED)
        return rows.select(*spec.columns.names, MERGE_FLAG, F.lit(ROWS).alias(KIND_COLUMN), spec.partition_column)

    def _images(self, spec: TableSpec, flagged: DataFrame) -> DataFrame:
        """Rows to keep and, from the same pass, the images of what changed.

        Which copies a row gets is one of four fixed lists: unlike structs collected in an array, Spark compiles that.
        """
        flag, copy = F.col(MERGE_FLAG), F.col("_copy")
        row, old, new = 0, 1, 2
        lists = {KEPT: [row], INSERTED: [row, new], UPDATED: [row, old, new], DELETED: [old]}
        copies = F.coalesce(*[F.when(flag == kind, F.array(*map(F.lit, each))) for kind, each in lists.items()])
        return flagged.withColumn("_copy", F.explode(copies)).select(
            *[F.when(copy == old, F.col(f"{BEFORE}.{c}")).otherwise(F.col(c)).alias(c) for c in spec.columns.names],
            MERGE_FLAG,
            F.when(copy == old, DELETE).when(copy == new, INSERT).alias(ACTION),
            F.when(copy != row, flag == UPDATED).alias(IS_UPDATE),
            F.when(copy == row, ROWS).otherwise(IMAGES).alias(KIND_COLUMN),
            spec.partition_column,
        )

    def _write(self, spec: TableSpec, rows: DataFrame, folder: str) -> None:
        buckets = self._buckets(spec)
        columns = (KIND_COLUMN, spec.partition_column)
        if not buckets:
            # AQE splits a large block over several tasks.
            together = rows.hint("rebalance", *columns).sortWithinPartitions(*columns, *spec.cluster_by)
            together.write.partitionBy(*columns).parquet(folder)
            return
        writer = rows.write.format("parquet").partitionBy(*columns).bucketBy(buckets, *spec.keys)
        # Spark writes buckets for named tables only: the name goes again, the files stay.
        name = f"{self.database}.write_{uuid4().hex}"
        try:
            writer.sortBy(*(spec.cluster_by or spec.keys)).option("path", folder).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _measure(self, spec: TableSpec, folder: str, files: Files) -> list:
        """One line for each block just written: rows, flags, and the range of the zone column."""
        path = f"{folder}/{KIND_COLUMN}={ROWS}"
        if not files.exists(path):
            return []
        column = spec.partition_column
        zone = F.col(spec.zone).cast("string") if spec.zone else F.lit(None).cast("string")
        fields = [f for f in spec.read_schema if f.name == spec.zone]
        schema = StructType([*fields, StructField(MERGE_FLAG, StringType()), StructField(column, LongType())])
        rows = self.spark.read.schema(schema).parquet(path)
        return (
            rows.groupBy(F.col(column).alias("block"))
            .agg(
                F.count(F.lit(1)).alias("stored"),
                F.count_if(F.col(MERGE_FLAG) == INSERTED).alias("inserted"),
                F.count_if(F.col(MERGE_FLAG) == UPDATED).alias("updated"),
                F.min(zone).alias("low"),
                F.max(zone).alias("high"),
            )
            .collect()
        )

    # -- the catalog ---------------------------------------------------------------------------

    def _new_buckets(self, spec: TableSpec) -> int:
        """A new table has no more buckets than the session has shuffle partitions."""
        return min(spec.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def _create_fitting(self, spec: TableSpec, df: DataFrame) -> None:
        """Create a table of many narrow blocks without buckets: their files would outnumber its keys.

        Its merges shuffle the touched blocks along with the batch. The blocks are counted for narrow ones only.
        """
        name = f"{self.database}.{spec.layer}_{spec.name}"
        if not spec.narrow or name in self._known or self.versions(spec).listed() or self.spark.catalog.tableExists(name):
            return
        blocks = self._conform(spec, df).select(spec.stored_block().alias("b")).distinct().count()
        if blocks * self._new_buckets(spec) > BUCKET_FILES:
            self._create_entry(spec, name, 0)

    def _buckets(self, spec: TableSpec) -> int:
        return self._known[self.table_name(spec)]

    def _create_entry(self, spec: TableSpec, name: str, buckets: int) -> None:
        column = spec.partition_column
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.read_schema)
        clustered = f" CLUSTERED BY ({', '.join(spec.keys)}) INTO {buckets} BUCKETS" if buckets else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/catalog'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{column}` bigint) USING parquet"
            f" PARTITIONED BY (`{column}`){clustered} LOCATION '{self.path(spec)}'"
            f" TBLPROPERTIES ('{_APPLIED}' = '-1')"
        )

    def _applied(self, name: str) -> int:
        return int(self.spark.sql(f"SHOW TBLPROPERTIES {name} ('{_APPLIED}')").first()[1])

    def _commit(self, spec: TableSpec, versions: Versions, note: Note) -> None:
        versions.commit(note)
        self._show(spec, versions, note)

    def _catch_up(self, spec: TableSpec, versions: Versions) -> None:
        """Bring the catalog to the newest committed write. Each step can be repeated."""
        for note in versions.committed(self._applied(self.table_name(spec))):
            self._show(spec, versions, note)

    def _show(self, spec: TableSpec, versions: Versions, note: Note) -> None:
        """Let the catalog's partitions point to a committed write."""
        name, column = self.table_name(spec), spec.partition_column
        there = set(self.blocks(spec))
        place = {b: f"{versions.folder(note.version)}/{KIND_COLUMN}={ROWS}/{column}={b}" for b in note.blocks}

        def move(b: int) -> None:
            self.spark.sql(f"ALTER TABLE {name} PARTITION (`{column}`='{b}') SET LOCATION '{place[b]}'")

        # One statement a block, each with a copy of the session's properties; several at a time, as each mostly
        # waits for the catalog.
        moves = [(inheritable_thread_target(self.spark)(move), b) for b in note.blocks if b in there]
        with ThreadPoolExecutor(max_workers=8) as pool:
            for done in [pool.submit(*each) for each in moves]:
                done.result()
        new = [f"PARTITION (`{column}`='{b}') LOCATION '{place[b]}'" for b in note.blocks if b not in there]
        if new:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
        gone = (there.difference(note.blocks) if note.whole else there.intersection(note.emptied)) if there else ()
        if gone:
            listed = ", ".join(f"PARTITION (`{column}`='{b}')" for b in sorted(gone))
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {listed}")
        if note.offset:
            self.commit_offset(*note.offset)
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_APPLIED}' = '{note.version}')")
        self.spark.catalog.refreshTable(name)

    # -- helpers -------------------------------------------------------------------------------

    def _conform(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        """The spec's columns in order and type; columns the input lacks are NULL."""
        have = set(df.columns)
        return df.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in spec.read_schema
            ]
        )

    def _blocks_with(self, spec: TableSpec, condition: Column) -> dict[int, int]:
        """Stored blocks that hold rows of the condition, and how many."""
        hits = self.read_partitioned(spec).filter(condition)
        found = hits.groupBy(F.col(spec.partition_column).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        return {r.b: r.n for r in found.collect()}

    def _only_blocks(self, spec: TableSpec, blocks: Sequence[int]) -> DataFrame:
        """The rows of some blocks. The list is the one the catalog is to change anyway: partitions, not rows."""
        return self.read_partitioned(spec).filter(F.col(spec.partition_column).isin(list(blocks)))

    def _block_rows(self, spec: TableSpec) -> DataFrame:
        return self.spark.sql(f"SHOW PARTITIONS {self.table_name(spec)}").select(
            F.split_part("partition", F.lit("="), F.lit(-1)).cast("bigint").alias("block")
        )


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet rows at ``path``; nothing there yet means no rows."""
    if Files(spark, path).exists(path):
        return spark.read.schema(schema).parquet(path)
    return empty_rows(spark, schema)


def empty_rows(spark: SparkSession, schema: StructType | str) -> DataFrame:
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(0).select(*columns)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], partitions: int | None = None):
    """Write so that range filters on ``columns`` skip files and row groups.

    The range partitioner samples the data, so a value held by very many rows gets its own
    partition; pass all clustering columns so that ties on the first are split by the next.
    """
    names = [F.col(c) for c in columns]
    ranged = df.repartitionByRange(partitions, *names) if partitions else df.repartitionByRange(*names)
    ranged.sortWithinPartitions(*names).write.mode("overwrite").parquet(path)
