"""Relational operators that Spark has no single call for."""

from .changes import append_feed, keep_inserts, newest_changes, pending_count, table_changes
from .dedup import latest_per_key
from .masking import MASKS, mask_email, mask_phone, mask_ssn, masked
from .merge import deactivate_stale, delete_where, upsert
from .quantiles import exact_quantiles
from .store import JobResult, MergeCounts, TableStore

__all__ = [
    "append_feed",
    "keep_inserts",
    "newest_changes",
    "pending_count",
    "table_changes",
    "latest_per_key",
    "MASKS",
    "mask_email",
    "mask_phone",
    "mask_ssn",
    "masked",
    "deactivate_stale",
    "delete_where",
    "upsert",
    "exact_quantiles",
    "JobResult",
    "MergeCounts",
    "TableStore",
]
