"""Delimited text with a declared schema.

Every column is read as text and cast by position, so a bad value fails the load in both modes
instead of becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, VarcharType

from ..schemas import LINEAGE, TableSpec, stored_type
from ..session import require_ansi
from ..workspace import scratch_dir

# An unquoted empty field is NULL, a quoted one is the empty text: the NULL marker is a character
# that text files do not hold, so the two stay apart.
_COMMON = {"sep": ",", "quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": ""}
# Bulk load: spaces are trimmed and a row with too few or too many fields aborts the load.
CSV_BULK = {
    **_COMMON,
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
# Pipe: spaces are kept, missing fields are NULL and surplus fields are dropped.
CSV_PIPE = {**_COMMON, "mode": "PERMISSIVE"}


def path_matches(pattern: str) -> Column:
    """The whole file path matches. Spark applies this to the file list, before opening files."""
    return F.col("_metadata.file_path").rlike(rf"^(?:{pattern})\z")


def read_lines(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """value, file, modified, block (first byte of the split) of every line, in splits of any size."""
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    if pattern:
        lines = lines.filter(path_matches(pattern))
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def counted(lines: DataFrame) -> DataFrame:
    """The lines with their order in a split and whether they hold an odd number of quotes."""
    # Bytes and not characters: these need not be counted.
    odd = (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    return lines.withColumns({"line": F.monotonically_increasing_id(), "odd": odd})


def _split_table(lines: DataFrame) -> DataFrame:
    """For each split: a number, whether it starts inside quotes, whether records in it may span lines, and the header.

    The first pass: quotes are counted where the lines are read, and only one row for each split is shuffled. A prefix
    sum over a file's splits tells whether an odd number of quotes lies before one. A file has one stamp: collecting
    it lets Spark aggregate by hash, where the header's text alone would make it sort all lines.
    """
    splits = lines.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"),
        F.array_max(F.collect_set("modified")).alias("modified"),
        F.min_by("value", F.when(F.col("block") == 0, F.col("line"))).alias("header"),
    )
    whole_file = Window.partitionBy("file")
    before = whole_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    unbalanced = F.sum("odd").over(whole_file) % 2 == 1
    opened = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    complaint = F.raise_error(F.concat(F.lit("unbalanced quotes in "), F.col("file"))).cast("boolean")
    return splits.select(
        F.col("file").alias("_file"),
        F.col("block").alias("_block"),
        F.col("modified").alias("_modified"),
        F.monotonically_increasing_id().alias("split"),
        F.when(unbalanced, complaint).otherwise(opened).alias("opened"),
        ((F.col("odd") > 0) | opened).alias("tangled"),
        F.max("header").over(whole_file).alias("header"),
    )


def records(lines: DataFrame) -> DataFrame:
    """file, modified, record: delivered rows, whose quoted fields may hold line breaks; headers are left out.

    Splits of a file are read by as many tasks as there are. A split in which no line has an odd number of quotes,
    and that starts outside of them, holds a record on each line. Only the others' lines are brought
    together, split by split: a running count of quotes numbers the records there, continued over the file's splits.
    A line that equals the file's header is taken for one. A file with an odd number of quotes is an error.
    """
    spark = lines.sparkSession
    marked = counted(lines)
    path = scratch_dir(spark, "splits")
    table = _split_table(marked)
    table.write.parquet(path)  # a row for each split: its size decides how it is joined
    splits = spark.read.schema(table.schema).parquet(path)
    placed = marked.join(splits, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))

    is_header = (F.col("block") == 0) & (F.col("value") == F.col("header"))
    simple = placed.where(~F.col("tangled") & ~is_header).select("file", "modified", F.col("value").alias("record"))
    each = simple if splits.where("tangled").isEmpty() else simple.union(_spanning(placed, splits))
    # Asked for first, as few rows hold one: the expression is slow.
    stripped = F.when(F.contains("record", F.lit("\r")), F.regexp_replace("record", "\r$", ""))
    each = each.withColumn("record", stripped.otherwise(F.col("record")))
    return each.where(F.trim("record") != "")


def _spanning(placed: DataFrame, splits: DataFrame) -> DataFrame:
    """The records of splits in which a record may span lines, or that start within one.

    Lines are brought together and sorted by the number of their split: the file's path and stamp, which are
    longer than most lines, are added to the records at the end.
    """
    in_split = Window.partitionBy("split").orderBy("line")
    quotes_before = F.coalesce(F.sum("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = (quotes_before + F.col("opened").cast("int")) % 2 == 0
    tangled = placed.where("tangled").select("split", "block", "line", "value", "odd", "opened")
    tangled = tangled.withColumn("begins", begins.cast("int"))
    tangled = tangled.withColumn("number", F.sum("begins").over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
    files = splits.groupBy("_file").agg(F.min("split").alias("of"), F.max("_modified").alias("modified"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    held = tangled.groupBy(F.col("split").alias("_split")).agg(F.max("number").alias("held"))
    numbered = (
        held.join(splits, F.col("_split") == F.col("split"))
        .select("_split", "_file", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
        .join(files.select(F.col("_file").alias("_path"), "of"), F.col("_file") == F.col("_path"))
        .select("_split", "of", "before")
    )
    tangled = tangled.join(numbered, F.col("split") == F.col("_split"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    found = (
        tangled.groupBy(F.col("of").alias("_of"), (F.col("before") + F.col("number")).alias("record_number"))
        .agg(F.min("block").alias("first_block"), parts.alias("parts"))
        .where("NOT (first_block = 0 AND record_number = 1)")
    )
    record = F.array_join(F.transform("parts", lambda p: p.value), "\n").alias("record")
    return found.join(files, F.col("_of") == F.col("of")).select(F.col("_file").alias("file"), "modified", record)


def read_text_columns(spark: SparkSession, spec: TableSpec, options: dict[str, str], lines: DataFrame) -> DataFrame:
    """The fields of a table's lines as text, with ``from_source`` and ``created_at`` of their file."""
    schema = ", ".join(f"`{f.name}` string" for f in spec.file_columns)
    parsed = records(lines).select(
        F.from_csv("record", schema, options).alias("fields"),
        F.col("file").alias("from_source"),
        F.col("modified").alias("created_at"),
    )
    return parsed.select("fields.*", "from_source", "created_at")


def _cast(column: Column, declared: DataType, truncate: bool) -> Column:
    if not isinstance(declared, VarcharType):
        return column.cast(declared)
    if truncate:
        return F.left(column, F.lit(declared.length))
    too_long = F.length(column) > declared.length
    return F.when(
        too_long, F.raise_error(F.concat(F.lit(f"text longer than {declared.length}: "), column))
    ).otherwise(column)


def project_positional(
    df: DataFrame, fields: list[StructField], truncate: bool = True, extra: list[Column | str] | None = None
) -> DataFrame:
    """Cast the n-th text column to the n-th field's type.

    Over-long text is cut when ``truncate`` (an explicit cast) and is an error otherwise (a store
    into a bounded column).
    """
    if len(df.columns) < len(fields):
        raise ValueError(f"{len(fields)} fields declared, {len(df.columns)} columns given")
    columns = [
        _cast(F.col(name), field.dataType, truncate).alias(field.name)
        for name, field in zip(df.columns, fields)
    ]
    return df.select(*columns, *(extra or []))


def bulk_load(
    spark: SparkSession, path: str, spec: TableSpec, pattern: str | None = None
) -> DataFrame:
    """All files of a table below ``path``; the first bad row aborts. Lineage columns are NULL."""
    require_ansi(spark)
    lines = read_lines(spark, path, pattern or spec.bulk_pattern)
    return strict_rows(spark, spec, lines)


def strict_rows(spark: SparkSession, spec: TableSpec, lines: DataFrame) -> DataFrame:
    """A table's rows by the strict rules. Lineage columns are NULL."""
    text = read_text_columns(spark, spec, CSV_BULK, lines)
    return with_lineage(project_positional(text, spec.file_columns, truncate=False))


def tolerant_rows(spark: SparkSession, spec: TableSpec, lines: DataFrame) -> DataFrame:
    """A table's rows by the tolerant rules, with their lineage.

    ``from_source`` is the file path, ``created_at`` the file's modification time (an instant, so no
    zone shift is added) and ``_ingested_at`` the time of the load.
    """
    text = read_text_columns(spark, spec, CSV_PIPE, lines)
    lineage = ["from_source", "created_at", F.current_timestamp().alias("_ingested_at")]
    return project_positional(text, spec.file_columns, truncate=True, extra=lineage)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the lineage columns a table lacks, as NULL (additive schema evolution)."""
    missing = [
        F.lit(None).cast(stored_type(kind)).alias(name)
        for name, kind in LINEAGE
        if name not in df.columns
    ]
    return df.select("*", *missing)
