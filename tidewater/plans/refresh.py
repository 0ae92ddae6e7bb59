"""The whole chain: load new files, merge changes, refresh the reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target

from ..operators.store import JobResult, TableStore
from ..schemas import DERIVED, STAGING
from ..session import freed_shuffles
from ..streaming.ingest import bulk_load_new_files, followed_whole, ingest_new_files, ingest_stage, started_singly
from .gold import (
    DEFAULT_AS_OF,
    load_customer_ltv,
    load_daily_sales_summary,
    newest_order_date,
)
from .silver import SILVER_JOBS, merge_changes


def _side_by_side(store: TableStore, steps: Sequence[Callable[[], object]]) -> list:
    """Run independent Spark jobs at the same time; results in the given order."""
    # Each step gets a copy of the session's properties: shared ones would mix up the steps' query numbers.
    own = [inheritable_thread_target(store.spark)(step) for step in steps]
    with ThreadPoolExecutor(max_workers=8) as pool:
        return [f.result() for f in [pool.submit(step) for step in own]]


def create_tables(store: TableStore, replace: bool = False) -> None:
    specs = (*STAGING.values(), *DERIVED.values())
    _side_by_side(store, [lambda spec=spec: store.create(spec, replace) for spec in specs])


def initial_load(store: TableStore, stage_dir: str, tables: Sequence[str] = tuple(STAGING)) -> None:
    """Add bulk files not loaded yet to the staging tables; a bad row aborts its table's load."""
    loads = [bulk_load_new_files(store, STAGING[name], stage_dir) for name in tables]
    for load in loads:
        load.awaitTermination()


def start_feeds(store: TableStore, include_initial: bool = False) -> None:
    for job in SILVER_JOBS:
        job.feed(store).start(include_initial)


def ingest_all(store: TableStore, stage_dir: str, tables: Sequence[str] = tuple(STAGING)) -> None:
    """Load new files of the tables.

    All tables share one load, which lists the stage once. Some of them, or a store whose tables were begun
    one by one, have a load each.
    """
    specs = [STAGING[name] for name in tables]
    if followed_whole(store) or not started_singly(store) and len(specs) == len(STAGING):
        loads = [ingest_stage(store, specs, stage_dir)]
    else:
        loads = [ingest_new_files(store, spec, stage_dir) for spec in specs]
    for load in loads:
        load.awaitTermination()


def refresh(store: TableStore, stage_dir: str, as_of: date = DEFAULT_AS_OF) -> list[JobResult]:
    """One run in dependency order. Each step can be repeated; merges without news do nothing."""
    with freed_shuffles(store.spark):
        ingest_all(store, stage_dir)
        merges = [lambda job=job: merge_changes(store, job) for job in SILVER_JOBS]
        merged = _side_by_side(store, merges)
        newest = newest_order_date(store)
        reports = [
            lambda: load_daily_sales_summary(store, newest=newest),
            lambda: load_customer_ltv(store, as_of, newest=newest),
        ]
        return merged + _side_by_side(store, reports)
