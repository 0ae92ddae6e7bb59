"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..workspace import scratch_dir

#: Characters handled at a time inside a task; a longer text is a chunk of its own.
CHUNK_CHARS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark alone so that any path it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, and a lost executor costs a reread."""
    path = scratch_dir(spark, f"llm-{label}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(
    df: DataFrame, columns: list[str], work: Callable[..., list], schema: str, chars: int = CHUNK_CHARS
) -> DataFrame:
    """Apply ``work(*column_lists) -> column_lists`` to chunks of rows whose texts stay below ``chars``.

    The last of ``columns`` is the text that is measured. Only these columns leave the JVM.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(lengths(batch.column(batch.num_columns - 1)), chars):
                part = batch.slice(lo, hi - lo)  # only a chunk at a time becomes Python objects
                got = work(*(part.column(i).to_pylist() for i in range(batch.num_columns)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(got, types, strict=True)], names=names
                )

    out = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_type

    names, types = out.names, [to_arrow_type(f.dataType) for f in out.fields]
    return df.select(*columns).mapInArrow(run, out)


def lengths(texts: pa.Array) -> list[int]:
    """Characters (bytes of binary values, items of lists) of each; 0 for a null."""
    kind = pa.types
    if kind.is_list(texts.type) or kind.is_large_list(texts.type):
        measure = pc.list_value_length
    else:
        measure = pc.binary_length if kind.is_binary(texts.type) or kind.is_large_binary(texts.type) else pc.utf8_length
    return pc.fill_null(measure(texts), 0).to_pylist()


def chunks(texts: list, chars: int) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts`` that hold about ``chars`` characters each (a longer text stands alone)."""
    return spans([len(t) if t is not None else 0 for t in texts], chars)


def spans(sizes: list[int], chars: int) -> Iterator[tuple[int, int]]:
    """The same for texts of given sizes."""
    lo = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > chars:
            yield lo, i
            lo, held = i, 0
        held += n + 1
    if lo < len(sizes):
        yield lo, len(sizes)
