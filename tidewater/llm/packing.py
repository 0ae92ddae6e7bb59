"""Concatenate and cut: all documents as one token stream, cut into fixed windows.

Pass one tokenises each partition once, writes every document's ids with its place in the partition, and so gives
the partitions' token totals. Prefix sums over the totals (one row per partition) turn local places into global
offsets. Pass two cuts every document at the multiples of the window length; a document that crosses one leaves a
boundary record on each side. Only the last sequence can need padding. Documents with the same written table
always get the same places, so a lost executor repeats its share only.

Defined results: a null or empty text is the end token alone; repeated rows are packed each; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import scratch_dir
from .common import chunks
from .heap_counts import byte_symbols
from .pieces import SPECIAL_MARK, PieceCache, ragged

LENGTH = 2048
END_TOKEN = 1
#: Characters tokenised at a time: the more, the fewer lookups for pieces that repeat.
CHUNK_CHARS = 1_000_000
_STREAM = "doc_id long, part int, part_start long, doc_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tokens:
    """Ids of texts under a byte-level vocabulary file; each distinct piece is encoded once."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            described = json.load(f)
        to_byte = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in described["model"]["vocab"].items()}
        specials = {t["content"]: t["id"] for t in described["added_tokens"]}
        special = next(iter(specials), None)
        self.special = specials.get(special)
        self.coding = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens=specials)
        self._forget()
        self.pieces = PieceCache(self._learn, self._forget, special)

    def _learn(self, piece: str) -> None:
        if piece == SPECIAL_MARK:
            self.ids.append(self.special)
        else:
            self.ids.extend(self.coding.encode_ordinary(piece))
        self.ends.append(len(self.ids))

    def _forget(self) -> None:
        # Arrays of fixed width: numpy reads them in place, however many pieces are known.
        self.ids, self.ends = array("I"), array("q", [0])

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's ids start, with the end."""
        numbers, bounds = self.pieces.split(texts)
        ids, ends = ragged(np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64), numbers)
        return ids, np.concatenate([[0], ends])[bounds]


_TOKENS: dict[str, Tokens] = {}


def tokens(vocabulary: str) -> Tokens:
    if vocabulary not in _TOKENS:
        _TOKENS[vocabulary] = Tokens(vocabulary)
    return _TOKENS[vocabulary]


def token_stream(docs: DataFrame, vocabulary: str, end_token: int = END_TOKEN, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pass one: each document's ids (32-bit, little-endian), its partition and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            names, texts = (batch.column(i).to_pylist() for i in range(2))
            for lo, hi in chunks(texts, CHUNK_CHARS):
                ids, bounds = tokens(vocabulary)(texts[lo:hi])
                blobs = [np.append(ids[a:b], np.uint32(end_token)).astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                sizes = np.diff(bounds) + 1
                starts = place + np.cumsum(sizes) - sizes
                place += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[lo:hi], pa.int64()), pa.array([part] * (hi - lo), pa.int32()), pa.array(starts), pa.array(sizes), pa.array(blobs, pa.binary())],
                    names=["doc_id", "part", "part_start", "doc_tokens", "ids"],
                )

    return docs.select(id_column, text_column).mapInArrow(run, _STREAM)


def cut(stream: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pass two, over the written stream: one row per piece."""
    totals = stream.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    # One row per partition of the stream, not per document: the only rows that meet in one place.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_offset"))
    placed = stream.join(F.broadcast(offsets), "part").select("doc_id", (F.col("part_offset") + F.col("part_start")).alias("at"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, at, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
                data, at, doc = memoryview(blob.as_buffer()), at.as_py(), doc.as_py()
                n = len(data) // 4
                edges = [0, *range(length - at % length, n, length), n]
                for a, b in zip(edges, edges[1:]):
                    rows.append((doc, a, b - a, zlib.crc32(data[4 * a : 4 * b]), n, (at + a) // length, (at + a) % length))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=[x.split()[0] for x in _PIECES.split(", ")])

    return placed.mapInArrow(run, _PIECES)


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_token: int = END_TOKEN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "llm-token-stream")
    stream = token_stream(docs, vocabulary, end_token)
    stream.write.option("compression", "zstd").parquet(path)
    return cut(spark.read.schema(stream.schema).parquet(path), length)
