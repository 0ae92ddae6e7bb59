"""Change feed of a stored table: what a consumer has not applied yet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType, TimestampType

from ..operators.changes import append_feed, narrowed, net_changes
from ..operators.store import VERSION_COLUMN, TableStore, read_or_empty
from ..schemas import BATCH_COLUMN, TableSpec

BEFORE_ALL = -(2**62)
_OFFSETS = (
    StructType()
    .add("consumer", StringType())
    .add("upto", LongType())
    .add("at", TimestampType())
)


@dataclass(frozen=True)
class Pending:
    """Waiting change rows. ``restarted``: the table was written as a whole, and the rows are all it holds now.

    ``kept``: the part of the rows that was persisted for a consumer that reads them more than once.
    """

    rows: DataFrame
    count: int
    upto: int | None
    restarted: bool = False
    kept: DataFrame | None = None

    def release(self) -> None:
        if self.kept is not None:
            self.kept.unpersist()


class ChangeFeed:
    """Rows added, changed and deleted since the consumer last committed.

    Every write of a table has a number. A load's rows are a partition of a staging table, so new ones are read
    from there; deletes, updates and merges write before and after images under their own number. Reading
    lists and opens only what is new. Rows that came after the offset are shown as they are now, and images of
    older rows as their net difference, so a row that came and went in between does not appear.

    Offsets are appended after the rows were applied. A merge that is given the offset commits it
    with its rows; any other consumer that fails in between gets the same rows again.
    """

    def __init__(self, store: TableStore, spec: TableSpec, consumer: str):
        if not spec.feed:
            raise ValueError(f"{spec.name} keeps no change images")
        self.store = store
        self.spec = spec
        self.consumer = consumer

    @property
    def _offset_path(self) -> str:
        return self.store.control_path(f"offsets/{self.consumer}")

    def committed(self) -> int | None:
        """The offset; None if the feed was not started."""
        offsets = read_or_empty(self.store.spark, self._offset_path, _OFFSETS)
        return offsets.agg(F.max("upto")).first()[0]

    def start(self, include_initial: bool = False) -> None:
        """Begin after the rows already stored, or with them if ``include_initial``.

        Starting a feed that has an offset changes nothing.
        """
        if self.committed() is None:
            self.commit(BEFORE_ALL if include_initial else self.store.newest_number(self.spec))

    def pending(self, keep: bool = False, columns: Sequence[str] | None = None) -> Pending:
        """Unapplied rows, their number, and the offset to commit once they are applied.

        ``keep`` persists the net changes, which take a shuffle to find, until ``release``. Rows of new loads are read
        from the table each time. ``columns``, of the table and of the feed, are all that the rows shall have: as many
        rows, of which little else than these columns is shuffled and kept.
        """
        committed = self.committed()
        if committed is None:
            raise RuntimeError(f"feed {self.consumer} was not started")
        upto = self.store.newest_number(self.spec)
        if upto <= committed:
            rows = self._rows(committed, self._changed(committed, committed, columns), committed, columns)
            return Pending(rows, 0, None)
        versions = self.store.versions(self.spec).listed()
        restarted = any(kind == "whole" and committed < number <= upto for _, number, kind, _ in versions)
        if restarted:
            rows = append_feed(self.store.read(self.spec), self.spec.keys)
            rows = rows.select(*columns) if columns else rows
            return Pending(rows, rows.count(), upto, restarted)
        changed = self._changed(committed, upto, columns)
        kept = changed.persist() if keep else None
        rows = self._rows(committed, changed, upto, columns)
        try:
            return Pending(rows, rows.count(), upto, kept=kept)
        except Exception:
            if keep:
                changed.unpersist()
            raise

    def _changed(self, after: int, upto: int, columns: Sequence[str] | None) -> DataFrame:
        """Net difference of the images."""
        images = self.store.images(self.spec, after, upto).drop(VERSION_COLUMN)
        origin = self.spec.partition_column
        if origin == BATCH_COLUMN:
            # A load that came after the offset is read as it is now: its images are history.
            images = images.where(F.col(origin) <= after)
        if columns:
            images = narrowed(images, self.spec.keys, columns, [origin])
            return net_changes(images, self.spec.keys, origin).select(*columns)
        return net_changes(images, self.spec.keys, origin).drop(origin)

    def _rows(self, after: int, changed: DataFrame, upto: int, columns: Sequence[str] | None) -> DataFrame:
        if self.spec.partition_column != BATCH_COLUMN:
            return changed
        batch = F.col(BATCH_COLUMN)
        added = self.store.read_partitioned(self.spec).where((batch > after) & (batch <= upto))
        added = append_feed(added.drop(BATCH_COLUMN), self.spec.keys)
        return (added.select(*columns) if columns else added).unionByName(changed)

    def commit(self, upto: int) -> None:
        self.store.commit_offset(self.consumer, upto)
