"""Incremental file loading and the change feeds that follow it."""

from .feed import ChangeFeed, Pending
from .ingest import follow_stage, ingest_new_files, ingest_stage, ingest_status

__all__ = ["ChangeFeed", "Pending", "follow_stage", "ingest_new_files", "ingest_stage", "ingest_status"]
