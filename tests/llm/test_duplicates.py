"""Near-duplicates, components and repeated substrings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import simhash, substrings
from tidewater.llm.common import chunks, lengths, spans
from tidewater.llm.components import components
from tidewater.llm.fm_index import FMIndex

from .cases import AWKWARD, documents, words


def plain_print(text):
    parts = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(parts[i : i + 4]) for i in range(max(1, len(parts) - 3))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def near_texts():
    base = words(400, 3)
    out = []
    for i in range(40):
        changed = base[:]
        for k in range(i % 6):
            changed[(17 * i + 31 * k) % 400] = f"new{i}{k}"
        out.append(" ".join(changed))
    return out


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(-60, 60), r.randrange(-60, 60)) for _ in range(70)] + [(0, i) for i in range(100, 160)] + [(i, i + 1) for i in range(200, 240)]
    got = {x.node: x.root for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots({n for p in pairs if p[0] != p[1] for n in p}, pairs)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [4, 4096])
def test_links_reach_all_that_differ_by_four_bits(spark, block):
    r = random.Random(4)
    prints = [r.getrandbits(64) for _ in range(300)]
    for p in prints[:40]:
        for _ in range(6):
            q = p
            for b in r.sample(range(64), r.randint(1, 6)):
                q ^= 1 << b
            prints.append(q)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fp long")
    got = {x.class_fp: x.component_id for x in simhash.classes(frame, block).collect()}
    linked = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = roots(range(len(prints)), linked)
    assert got == {signed[i]: want[i] for i in range(len(prints))}


def test_near_duplicates(spark):
    texts = AWKWARD + near_texts()
    docs = documents(spark, texts + [texts[9]], [*range(len(texts)), None])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_print(t) for t in texts]
    want = roots(range(len(texts)), [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    for i in range(len(texts)):
        assert got[i] == (f"{prints[i]:016x}", want[i])
    assert got[None] == got[9]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_one_of_each_group_stays(spark):
    texts = near_texts() + ["something else entirely", "something else entirely", "and this too here"]
    ids = [*range(40), 50, 50, None]
    docs = documents(spark, texts, ids)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    near = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs.where("doc_id < 40")).collect()}
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [*sorted(set(near.values())), 50]
    assert [r.text for r in rows if r.doc_id is None] == ["and this too here"]
    assert simhash.keep_one(documents(spark, [])).count() == 0


def plain_repeats(texts):
    split = [(t or "").encode().split() for t in texts]
    windows = Counter(tuple(w[i : i + 35]) for w in split for i in range(len(w) - 34))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - 34):
            if windows[tuple(w[i : i + 35])] > 1:
                gone |= set(range(i, i + 35))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def passages():
    shared, other = words(60, 11), words(35, 12)
    texts = list(AWKWARD)
    for i in range(12):
        texts.append(" ".join(words(40 + i, 100 + i) + shared[: 60 - 2 * i] + words(30, 200 + i) + (other if i % 2 else other[:34]) + words(3, 300 + i)))
    own = words(50, 13)
    return [*texts, " ".join(own + words(20, 14) + own), "\n".join(words(36, 15)), " ".join(words(36, 15)), "same " * 36, "same " * 35]


@pytest.mark.parametrize("shard_segments", [1, 2000])
def test_repeated_words(spark, monkeypatch, shard_segments):
    monkeypatch.setattr(substrings.trimmed, "__defaults__", (shard_segments,))
    texts = passages()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_words(documents(spark, texts)).collect()}
    assert got == dict(enumerate(plain_repeats(texts)))
    assert substrings.repeated_words(documents(spark, [])).count() == 0


def test_repeated_words_leave_the_text(spark):
    texts = passages()
    docs = documents(spark, texts)
    out = substrings.drop_repeats(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    for i, (text, (_, removed, digest)) in enumerate(zip(texts, plain_repeats(texts), strict=True)):
        assert hashlib.sha256(b" ".join((rows[i].text or "").encode().split())).hexdigest() == digest
        assert rows[i].n_chars == (None if text is None else len(rows[i].text))
        if not removed:
            assert rows[i].text == text


def test_fm_index():
    r = np.random.default_rng(1)
    text = np.append(r.integers(1, 5, 400), 0)
    index = FMIndex(text, 12)
    ends = np.arange(11, 400)
    got = index.matched(text, ends, 12, 2)
    spelled = text.tolist()
    for e, n in zip(ends.tolist(), got.tolist(), strict=True):
        times = lambda k: sum(spelled[i : i + k] == spelled[e - k + 1 : e + 1] for i in range(len(spelled) - k))  # noqa: B023, E731
        assert (n == 0 or times(n) >= 2) and (n == 12 or times(n + 1) < 2)


def test_near_dedup_stage_is_the_simhash_operator(spark):
    docs = documents(spark, [*near_texts(), *AWKWARD, "null id"], [*range(40 + len(AWKWARD)), None])
    rows = corpus_pipeline.one_of_each(spark, docs, "").collect()
    want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(want - {None})
    assert corpus_pipeline.one_of_each(spark, documents(spark, []), "").count() == 0


def test_suspects_hold_one_document_of_each_class(spark):
    """Copies are collapsed where they are read: neither they nor their texts are exchanged again."""
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [f"{passage} a", f"{passage} a", f"{passage} b", f"{passage}  b", None, "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.profile(docs, "doc_id", "text")
    grouped = rows.where("n_words >= 35").groupBy("digest").agg(F.min(F.struct("text_digest", "anchors")).alias("own"))
    classes = grouped.select("digest", "own.text_digest", "own.anchors").localCheckpoint()
    found = substrings.suspects(docs, classes, "text").collect()
    assert len(found) == len({r.digest for r in found}) == 2
    assert {r.digest for r in found} == {r.digest for r in classes.collect()}


def test_few_files_of_fingerprints_are_spread_before_they_become_variants(spark, monkeypatch):
    seen = []
    real = simhash.variants
    monkeypatch.setattr(simhash, "variants", lambda df: (seen.append(df.rdd.getNumPartitions()), real(df))[1])
    distinct = spark.range(40).selectExpr("id * 1234567890123 AS fp").union(spark.createDataFrame([(1,), (3,)], "fp long")).coalesce(1)
    found = {tuple(sorted(r)) for r in simhash.links(distinct).collect()}
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    assert (1, 3) in found


def test_sizes_of_a_chunk():
    assert lengths(pa.array(["ab", None, "\u00e4\u00f6\u00fc"])) == [2, 0, 3]
    assert lengths(pa.array([b"abc", None])) == [3, 0]
    assert lengths(pa.array([[1, 2], None, []])) == [2, 0, 0]
    assert list(spans([3, 0, 9, 1], 5)) == list(chunks(["abc", None, "x" * 9, "y"], 5))
