"""The stage: a folder of delivered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_stage(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files below ``path`` (path, modification time, length). File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )
    return files.filter(F.col("path").rlike(rf"^(?:{pattern})\z")) if pattern else files


def staged_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Distinct file, modification time and time of this listing, newest first."""
    return (
        list_stage(spark, path, pattern)
        .select(
            F.col("path").alias("file_name"),
            F.col("modificationTime").alias("last_modified"),
            F.current_timestamp().alias("scanned_at"),
        )
        .distinct()
        .orderBy(F.col("last_modified").desc_nulls_first(), "file_name")
    )
