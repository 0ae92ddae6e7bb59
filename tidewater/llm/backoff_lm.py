"""Language-model scores from a weighted backoff automaton.

The model interpolates n-grams: an n-gram with history h has the probability (c(hw) + ``MASS`` * p(w | shorter h)) /
(c(h) + ``MASS``), down to words, which are add-a-half smoothed over the vocabulary and one unknown word. As an automaton,
every counted n-gram shorter than ``ORDER`` is a state with an arc for each word seen after it; a failure arc, weighted
log10(``MASS`` / (c(h) + ``MASS``)), leads to the state of the next shorter history; the state of the empty history has an arc
for every word. One left-to-right traversal of a text carries the state and adds the weights of the arcs it takes.

The counts grow with the corpus, so no task holds them all:

1. One pass over the texts writes blocks of documents as word numbers, with the block's own word list.
2. Each block's distinct n-grams, hashed to 64 bits and sorted, are cut at the same borders everywhere into shards, whose
   number follows from the number of tokens. A shard adds its blocks' counts and answers each block with the totals, in
   the order of the question. A very common n-gram is one entry a block.
3. A block with its totals has every arc that its documents can take: it builds that part of the automaton and walks it.

Two different n-grams that share a 64-bit hash (one bit tells words from longer ones) would be counted as one: among 10**7
different words the odds for any such pair are 5 in 10**6, and an affected text's score moves by a word's weight. Blocks are read from a written table, so a lost
executor repeats its share only and blocks stay what they were.

Defined results: a null, empty or blank text is its end alone; a null id is learned from; repeated rows count each; with
nothing to learn from every token has probability 1; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, written

ORDER = 2
#: Weight of the shorter history, in counts.
MASS = 200.0
#: Characters of a block of documents, and n-grams of a shard; one longer text is a block of its own.
BLOCK_CHARS, SHARD_GRAMS = 3_000_000, 3_000_000
#: Word numbers of a text's start (never scored) and end.
START, END = 0, 1
#: Hashed names of the two: no word holds a blank. Hashes of words are odd, all others even, the start's too.
_START, _END = b" <", b" >"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_WORD = np.uint64(1)
_BLOCKS = "block long, ids binary, no_id binary, learned binary, sizes binary, tokens binary, words binary, n_tokens long, learned_tokens long"
_RESULT = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def tokenised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers with each text's start and end, tokens of each text with both, hash of each word number)."""
    numbers = {_START: START, _END: END}
    number = numbers.setdefault
    tokens: list[int] = []
    sizes = []
    for text in texts:
        words = (text or "").encode().lower().split()
        tokens.append(START)
        tokens += [number(w, len(numbers)) for w in words]
        tokens.append(END)
        sizes.append(len(words) + 2)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers)) | _WORD
    hashes[START] ^= _WORD
    return np.array(tokens, np.int64), np.array(sizes, np.int64), hashes


class Grams:
    """The distinct n-grams of a block of texts, level by level; level 0 are its words."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, order: int):
        n, words = len(tokens), len(hashes)
        ends = np.repeat(np.cumsum(sizes), sizes)
        #: Per level: the n-gram that starts at each place (-1: it would cross the text's end).
        self.at = [tokens]
        #: Per level: prefix n-gram, last word and hash of each distinct n-gram.
        self.prefix, self.last, self.keys = [np.full(words, -1)], [np.arange(words)], [hashes]
        for k in range(1, order):
            valid = np.flatnonzero(np.arange(n) + k < ends)
            codes, back = np.unique(self.at[-1][valid] * words + tokens[valid + k], return_inverse=True)
            at = np.full(n, -1)
            at[valid] = back
            prefix, last = codes // words, codes % words
            keys = (self.keys[-1][prefix] ^ np.uint64(k)) * _BASE + hashes[last]
            keys = (keys ^ (keys >> np.uint64(32))) * _MIX
            self.at.append(at)
            self.prefix.append(prefix)
            self.last.append(last)
            self.keys.append((keys ^ (keys >> np.uint64(29))) & ~_WORD)

    def sorted_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """All levels' hashes in ascending order, and the order."""
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        return keys[order], order

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """Weighted occurrences of the n-grams of all levels; ``weight`` is given per place."""
        return np.concatenate([np.bincount(at[at >= 0], weight[at >= 0], len(k)) for at, k in zip(self.at, self.keys, strict=True)])

    def suffixes(self, level: int) -> np.ndarray:
        """For each n-gram of a level, the n-gram of the level below that lacks its first word."""
        out = np.empty(len(self.keys[level]), np.int64)
        places = np.flatnonzero(self.at[level] >= 0)
        out[self.at[level][places]] = self.at[level - 1][places + 1]
        return out

    def levels(self, values: np.ndarray) -> list[np.ndarray]:
        return np.split(values, np.cumsum([len(k) for k in self.keys])[:-1])


def blocks(docs: DataFrame, learn: Column, id_column: str, text_column: str, chars: int) -> DataFrame:
    """One row for each block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for ids, learned, texts in gathered(batches, chars):
            tokens, sizes, hashes = tokenised(texts)
            learned = np.array(learned, bool)
            row = [
                block,
                np.array([i or 0 for i in ids], np.int64).tobytes(),
                np.array([i is None for i in ids], bool).tobytes(),
                learned.tobytes(),
                sizes.tobytes(),
                packed(tokens, np.uint16),
                hashes.tobytes(),
                len(tokens),
                int((sizes - 1)[learned].sum()),
            ]
            kinds = [pa.int64(), *[pa.binary()] * 6, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in _BLOCKS.split(", ")])
            block += 1

    chosen = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(learn, F.lit(True)).alias("learned"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, _BLOCKS)


def gathered(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[list[list]]:
    """Columns of rows whose texts reach ``chars`` characters, over the borders of Arrow batches."""
    held: list[list] = [[], [], []]
    size = 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for lo, hi in chunks(columns[-1], chars // 8):
            part = [c[lo:hi] for c in columns]
            more = sum(len(t or "") + 1 for t in part[-1])
            if size and size + more > chars:
                yield held
                held, size = [[], [], []], 0
            held = [h + p for h, p in zip(held, part, strict=True)]
            size += more
    if held[0]:
        yield held


def block_grams(row: dict, order: int) -> tuple[Grams, np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, tokens, sizes, which documents are learned from) of a written block."""
    tokens, sizes = unpacked(row["tokens"], np.uint16), np.frombuffer(row["sizes"], np.int64)
    return Grams(tokens, sizes, np.frombuffer(row["words"], np.uint64), order), tokens, sizes, np.frombuffer(row["learned"], bool)


def by_significance(hashes: np.ndarray) -> bytes:
    """Sorted hashes as their first bytes, then their second bytes and so on, which compresses well."""
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8).T.tobytes()


def hashes_of(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def packed(numbers: np.ndarray, kind: type = np.uint8) -> bytes:
    """Mostly small numbers in ``kind`` each; larger ones follow behind, in order, in eight bytes."""
    most = np.iinfo(kind).max
    large = numbers[numbers >= most].astype(np.int64)
    return b"".join([len(numbers).to_bytes(8, "little"), np.minimum(numbers, most).astype(kind).tobytes(), large.tobytes()])


def unpacked(blob: bytes, kind: type = np.uint8) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    small = np.frombuffer(blob, kind, n, 8)
    numbers = small.astype(np.int64)
    numbers[small == np.iinfo(kind).max] = np.frombuffer(blob, np.uint8, offset=8 + small.nbytes).view(np.int64)
    return numbers


def borders(shards: int) -> np.ndarray:
    """First hash of each shard but the first."""
    return np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)


def questions(held: DataFrame, shards: int, order: int) -> DataFrame:
    """shard, block, the sorted hashes and the block's own counts of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams, _, sizes, learned = block_grams(row, order)
                keys, by_key = grams.sorted_keys()
                own = grams.counts(np.repeat(learned, sizes).astype(np.float64))[by_key].astype(np.int64)
                cuts = [0, *np.searchsorted(keys, borders(shards)).tolist(), len(keys)]
                parts = [(s, a, b) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                for some in (parts[i : i + 256] for i in range(0, len(parts), 256)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([s for s, _, _ in some], pa.int64()),
                            pa.array([row["block"]] * len(some), pa.int64()),
                            pa.array([by_significance(keys[a:b]) for _, a, b in some], pa.binary()),
                            pa.array([packed(own[a:b]) for _, a, b in some], pa.binary()),
                        ],
                        names=["shard", "block", "keys", "own"],
                    )

    return held.select("block", "learned", "sizes", "tokens", "words").mapInArrow(run, "shard long, block long, keys binary, own binary")


def answers(asked: DataFrame) -> DataFrame:
    """shard, block, totals of its hashes over all blocks, learned words (on a shard's first row)."""

    def run(table: pa.Table) -> pa.Table:
        keys = [hashes_of(x.as_py()) for x in table["keys"]]
        own = np.concatenate([unpacked(x.as_py()) for x in table["own"]])
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(back, own, len(distinct)).astype(np.int64)
        learned = int(((distinct & _WORD > 0) & (totals > 0)).sum())
        given = np.split(totals[back], np.cumsum([len(k) for k in keys])[:-1])
        return pa.table(
            {
                "shard": table["shard"].cast(pa.int64()),
                "block": table["block"].cast(pa.int64()),
                "totals": pa.array([packed(g) for g in given], pa.binary()),
                "words": pa.array([learned, *[0] * (len(given) - 1)], pa.int64()),
            }
        )

    return asked.groupBy("shard").applyInArrow(run, "shard long, block long, totals binary, words long")


class Automaton:
    """The part of the backoff automaton that a block's texts can reach, laid along their places.

    States are the counted n-grams below ``order``, arcs the counted n-grams: each leads from the state of its first
    words, labelled with its last, to the state of its longest suffix that is one. A place knows for each length of
    history the arc that its word would take from there (NaN if there is none) and that state's failure weight.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, vocabulary: int, order: int, mass: float):
        self.order = order
        probability = (counts[0] + 0.5) / (tokens + 0.5 * (vocabulary + 1))
        self.base = np.log10(probability)
        known = counts[0] > 0
        n = len(grams.at[0])
        self.known = known[grams.at[0]]
        #: By length of history: weight of the arc into each place, and of the failure arc on the way there.
        self.arcs = [self.base[grams.at[0]]]
        self.fails = [np.zeros(n)]
        for k in range(1, order):
            prefix, suffix = grams.prefix[k], grams.suffixes(k)
            probability = (counts[k] + mass * probability[suffix]) / (counts[k - 1][prefix] + mass)
            weight = np.where(counts[k] > 0, np.log10(probability), np.nan)
            failure = np.log10(mass / (counts[k - 1][prefix] + mass))
            starts = np.flatnonzero(grams.at[k] >= 0)
            arc, fail = np.full(n, np.nan), np.zeros(n)
            arc[starts + k] = weight[grams.at[k][starts]]
            fail[starts + k] = failure[grams.at[k][starts]]
            self.arcs.append(arc)
            self.fails.append(fail)

    def walk(self, start: int, end: int) -> float:
        """log10 probability of the tokens behind ``start``, a text's start, up to ``end``."""
        arcs = [a[start + 1 : end].tolist() for a in self.arcs]
        fails = [f[start + 1 : end].tolist() for f in self.fails]
        known = self.known[start:end].tolist()
        longest, score = self.order - 1, 0.0
        held = min(1, longest) if known[0] else 0  # length of the state's history
        for i, word_known in enumerate(known[1:]):
            weight = arcs[held][i]
            while weight != weight:  # no such arc: fall back to the next shorter history
                score += fails[held][i]
                held -= 1
                weight = arcs[held][i]
            score += weight
            if word_known:
                held = min(held + 1, longest)
        return score


def scored(held: DataFrame, totals: DataFrame, tokens: int, vocabulary: int, order: int, mass: float) -> DataFrame:
    """The result rows of every block."""

    def run(block: pa.Table, own: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        grams, numbers, sizes, _ = block_grams(row, order)
        shard_order = np.argsort(own["shard"].to_numpy())
        given = [unpacked(own["totals"][int(i)].as_py()) for i in shard_order]
        counts = np.empty(sum(len(g) for g in given), np.int64)
        counts[grams.sorted_keys()[1]] = np.concatenate(given)
        counts = grams.levels(counts)
        automaton = Automaton(grams, counts, tokens, vocabulary, order, mass)
        ends = np.cumsum(sizes)
        spans = list(zip((ends - sizes).tolist(), ends.tolist(), strict=True))
        known = np.concatenate([[0], np.cumsum(automaton.known)])
        missing = np.frombuffer(row["no_id"], bool)
        ids = np.frombuffer(row["ids"], np.int64)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=missing),
                "n_tokens": pa.array(sizes - 1),
                "n_known": pa.array([int(known[b] - known[a + 1]) for a, b in spans], pa.int64()),
                "base_score": pa.array([math.fsum(automaton.base[numbers[a + 1 : b]].tolist()) for a, b in spans], pa.float64()),
                "score": pa.array([automaton.walk(a, b) for a, b in spans], pa.float64()),
            }
        )

    return held.drop("n_tokens", "learned_tokens").groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, _RESULT)


def score(
    docs: DataFrame,
    learn: Column,
    order: int = ORDER,
    mass: float = MASS,
    block_chars: int = BLOCK_CHARS,
    shard_grams: int = SHARD_GRAMS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row; learned from rows where ``learn`` holds."""
    spark = docs.sparkSession
    held = written(spark, blocks(docs, learn, id_column, text_column, block_chars), "lm-blocks")
    all_tokens, tokens = (n or 0 for n in held.agg(F.sum("n_tokens"), F.sum("learned_tokens")).first())
    shards = max(1, -(-all_tokens * order // shard_grams))
    totals = written(spark, answers(questions(held, shards, order)), "lm-totals")
    vocabulary = totals.agg(F.sum("words")).first()[0] or 0
    found = scored(held, totals.drop("words"), tokens, vocabulary, order, mass)
    return found.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
