"""Counting, encoding, decoding and packing against the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewater.llm import bpe_automaton, heap_counts, packing, pieces

from .cases import AWKWARD, documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def strange(n=1500):
    r = random.Random(1)
    alphabet = [chr(i) for i in range(32, 127)] + ["\n", "\t", " ", " ", "'", "'", "s", "é", "日", "　", "\x1f", "­", "٣", "²"]
    return ["".join(r.choices(alphabet, k=r.randint(1, 40))) for _ in range(n)]


def test_automaton_and_heap_agree_with_the_library(library):
    texts = [t or "" for t in AWKWARD] + strange() + ["a" * 700, "aaa aaaaa", "lol" * 300]
    coder, counted = bpe_automaton.Encoder(VOCABULARY), heap_counts.Counter(VOCABULARY)
    want = [ids_of(library, t) for t in texts]
    assert [x.tolist() for x in coder.encode(texts)] == want
    assert counted(texts) == [len(x) for x in want]
    assert [coder.automaton.decode(x) for x in want] == texts


def test_long_texts_and_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(pieces, "LONG_TEXT", 500)
    monkeypatch.setattr(pieces, "MAX_PIECES", 50)
    coder = bpe_automaton.Encoder(VOCABULARY)
    for text in AWKWARD:
        assert coder.encode([text])[0].tolist() == ids_of(library, text)


def test_gadgets_on_a_small_vocabulary():
    symbols = heap_counts.byte_symbols()
    vocab = {s: i for i, s in enumerate(symbols)}
    merges = [("a", "a"), ("aa", "a"), ("a", "b"), ("aa", "b"), ("b", "b")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    machine = bpe_automaton.Automaton(vocab, merges, {})
    ranks = {m: k for k, m in enumerate(merges)}

    def plain(word):
        parts = list(word)
        while pairs := [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]:
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    for n in range(1, 9):
        for k in range(1 << n):
            word = "".join("ab"[k >> i & 1] for i in range(n))
            assert [machine.labels[t].decode() for t in machine.encode_word(word.encode())] == plain(word)
            assert heap_counts.merged_count(list(word), ranks) == len(plain(word))


def test_frames(spark, library):
    docs = documents(spark, AWKWARD)
    want = {i: ids_of(library, t) for i, t in enumerate(AWKWARD)}
    for r in heap_counts.token_counts(docs, VOCABULARY, limit=100).collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((AWKWARD[r.doc_id] or "").encode()), len(want[r.doc_id]), len(want[r.doc_id]) > 100)
    for r in bpe_automaton.round_trips(docs, VOCABULARY).collect():
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((AWKWARD[r.doc_id] or "").encode()).hexdigest()
    encoded = bpe_automaton.encode(docs, VOCABULARY)
    assert {r.doc_id: r.text for r in bpe_automaton.decode(encoded, VOCABULARY).collect()} == {i: t or "" for i, t in enumerate(AWKWARD)}


@pytest.mark.parametrize("length", [64, 2048])
def test_packing(spark, library, length):
    docs = documents(spark, AWKWARD + AWKWARD[:3], [*range(len(AWKWARD)), None, 0, 0]).repartition(3)
    rows = packing.pack(docs, VOCABULARY, length).collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in rows:  # gapless, and only the last sequence is short
        assert (r.sequence_id, r.offset) == (at // length, at % length) and 0 < r.length <= length - r.offset
        at += r.length
    assert at == sum(len(ids_of(library, t)) + 1 for t in AWKWARD + AWKWARD[:3])
    for i in range(3, len(AWKWARD)):
        ids = np.array([*ids_of(library, AWKWARD[i]), 1], "<u4")
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
        for r in own:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_empty_tables(spark):
    none = documents(spark, [])
    assert heap_counts.token_counts(none, VOCABULARY).count() == 0
    assert bpe_automaton.round_trips(none, VOCABULARY).count() == 0
    assert packing.pack(none, VOCABULARY).count() == 0
