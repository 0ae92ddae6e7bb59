"""Language-model scores, fill-in-the-middle and periodic runs against plain computations."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import backoff_lm, fill_in_middle, periodic_runs, queries

from .cases import AWKWARD, DOCS, documents, words


def split(text):
    return (text or "").encode().split()


# -- scores ------------------------------------------------------------------------------------------------------


def plain_scores(texts, learned, order, mass):
    """(tokens, known, base score, score) of each text, by recursion over shorter histories."""
    counts, singles = Counter(), Counter()
    for text in (t for t, use in zip(texts, learned, strict=True) if use):
        tokens = [b" start", *(text or "").encode().lower().split(), b" end"]
        singles.update(tokens[1:])
        for k in range(1, order + 1):
            counts.update(tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1))
    total, distinct = sum(singles.values()), len(singles)

    def probability(history, word):
        if not history:
            return (singles[word] + 0.5) / (total + 0.5 * (distinct + 1))
        return (counts[(*history, word)] + mass * probability(history[1:], word)) / (counts[history] + mass)

    out = []
    for text in texts:
        tokens = [b" start", *(text or "").encode().lower().split(), b" end"]
        base = [math.log10(probability((), w)) for w in tokens[1:]]
        full = [math.log10(probability(tuple(tokens[max(0, i - order + 1) : i]), tokens[i])) for i in range(1, len(tokens))]
        out.append((len(base), sum(singles[w] > 0 for w in tokens[1:]), sum(base), sum(full)))
    return total, out


@pytest.mark.parametrize(("order", "block_chars", "shard_grams"), [(2, 6_000_000, 3_000_000), (2, 3000, 700), (3, 5000, 1500), (1, 9000, 400)])
def test_scores_equal_the_recursion(spark, order, block_chars, shard_grams):
    r = random.Random(3)
    texts = AWKWARD + [" ".join(r.choice(["To", "be", "or", "not", f"w{r.randrange(40)}"]) for _ in range(r.randrange(60))) for _ in range(150)]
    texts += ["only here unseen words", "be or not to be"]
    learned = [i % 5 != 1 for i in range(len(texts) - 2)] + [False, False]
    docs = documents(spark, texts).repartition(3)
    got = backoff_lm.score(docs, F.col("doc_id").isin([i for i, use in enumerate(learned) if use]), order, 7.0, block_chars, shard_grams)
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    total, want = plain_scores(texts, learned, order, 7.0)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(texts)
    for i, (n, known, base, score) in enumerate(want):
        assert (rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (n, known, total)
        assert rows[i].base_score == pytest.approx(base, rel=1e-9) and rows[i].score == pytest.approx(score, rel=1e-9)


def test_probabilities_of_a_history_add_up(spark):
    """All continuations of a two-word text, over the vocabulary and one unknown word, have probability one."""
    learned = ["a b c", "a c", "b a b", "c"]
    endings = ["", "a", "b", "c", "zz"]
    texts = learned + [f"a b {e}" for e in endings]
    got = backoff_lm.score(documents(spark, texts), F.col("doc_id") < 4, 3, 2.0)
    score = {r.doc_id: r.score for r in got.collect()}
    _, plain = plain_scores(texts, [True] * 4 + [False] * 5, 3, 2.0)
    assert all(score[i] == pytest.approx(p[3]) for i, p in enumerate(plain))
    # "a b" + end is a text; "a b x" has an end of its own to take off again
    to = {}
    for e, i in zip(endings[1:], range(5, 9), strict=True):
        _, with_end = plain_scores([*learned, f"a b {e}"], [True] * 4 + [False], 3, 2.0)
        assert with_end[4][3] == pytest.approx(score[i])
        to[e] = score[i]
    assert 10 ** score[4] < 1 and all(10**v < 1 for v in to.values())


def test_scores_of_odd_rows(spark):
    twice = spark.createDataFrame([(None, "a b", "en", "s", 3, 0.5, "d", 1), (7, "a b", "en", "s", 3, 0.5, "d", 1), (7, "a b", "en", "s", 3, 0.5, "d", 1)], DOCS)
    rows = backoff_lm.score(twice, F.col("doc_id") > 0).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(0, 3, 3, 9), (7, 3, 3, 9), (7, 3, 3, 9)]
    assert len({r.score for r in rows}) == 1
    nothing = backoff_lm.score(documents(spark, ["a b", None]), F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in nothing] == [(0, 0, 0.0, 0.0)] * 2
    assert backoff_lm.score(documents(spark, []), F.lit(True)).count() == 0


def test_held_out_texts_are_likelier_under_the_model(spark, small):
    rows = queries.op11_backoff_automaton(spark, small).where("held_out").collect()
    assert rows and all((r.doc_id is not None) and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows)
    assert sum(r.score for r in rows) > 0.96 * sum(r.base_score for r in rows)


def test_query_scores_equal_the_recursion(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    total, want = plain_scores([d.text for d in docs], [zlib.crc32(str(d.doc_id).encode()) % 5 != 1 for d in docs], backoff_lm.ORDER, backoff_lm.MASS)
    rows = {r.doc_id: r for r in queries.op11_backoff_automaton(spark, small).collect()}
    for d, (n, known, base, score) in zip(docs, want, strict=True):
        r = rows[d.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


# -- fill in the middle ------------------------------------------------------------------------------------------


UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_output(text, row_id):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if row_id is None else row_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle(spark):
    texts = [*AWKWARD, "a <P> b", "<S", " lead and trail \n", "x y\xa0z", "🤖 é́ " * 40, *(" ".join(words(i % 90, i)) for i in range(200))]
    rows = documents(spark, [*texts, "no id at all here"], [*range(len(texts)), None])
    out = fill_in_middle.restore(fill_in_middle.transform(rows)).collect()
    assert len(out) == len(texts) + 1
    seen = Counter()
    for r in out:
        text = texts[r.doc_id] if r.doc_id is not None else "no id at all here"
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_output(text, r.doc_id)
        assert r.restored == (text or "")
        seen[r.form] += 1
    assert all(seen[f] > 10 for f in ("plain", "spm", "psm"))
    assert fill_in_middle.transform(documents(spark, [])).count() == 0


def test_fill_in_middle_marks_cut_short(spark):
    """Pieces that end or begin with parts of a mark come back whole."""
    texts = ["<S <P <M S> P> M>", "<<<P <S<S >>", "M> <P"] * 60
    out = fill_in_middle.restore(fill_in_middle.transform(documents(spark, texts), rate=100)).collect()
    assert all(r.restored == texts[r.doc_id] and r.form != "plain" for r in out)


@pytest.mark.parametrize("units", [0, 1, 7, 8, 9, 64, 65, 4097])
def test_skip_list_reaches_every_rank(units):
    widths = np.random.default_rng(units).integers(1, 9, units)
    lanes = fill_in_middle.SkipList(widths)
    sums = np.concatenate([[0], np.cumsum(widths)])
    ranks = range(units + 1) if units < 100 else random.Random(1).sample(range(units + 1), 300)
    assert all(lanes.code_points(k) == sums[k] for k in ranks)
    assert all(len(x) == -(-len(y) // 8) for (x, _), (y, _) in zip(lanes.lanes[1:], lanes.lanes, strict=False))
    assert all(x.sum() == units and y.sum() == widths.sum() for x, y in lanes.lanes)


# -- periodic runs -----------------------------------------------------------------------------------------------


def plain_runs(s, least=24, repeats=3):
    out = []
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            if s[i] != s[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            part = s[i : j + p]
            smaller = any(part[q:] == part[:-q] for q in range(1, p))
            if len(part) >= max(least, repeats * p) and not smaller:
                out.append((i, len(part), p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences():
    r = random.Random(8)
    for _ in range(300):
        s = [r.randrange(r.randrange(1, 4) + 1) for _ in range(r.randrange(1, 80))]
        if r.random() < 0.8:
            a, p = r.randrange(len(s)), 1 + r.randrange(len(s) // 3 + 1)
            s = s[:a] + [s[a + (i - a) % p] if a + (i - a) % p < len(s) else 0 for i in range(a, len(s))]
        yield s


def test_lyndon_lengths():
    for s in sequences():
        s = s[:25]
        for ordered in (s, [max(s) - x for x in s]):
            want = [max(e - i for e in range(i + 1, len(s) + 1) if all(ordered[i:e] < ordered[k:e] for k in range(i + 1, e))) for i in range(len(s))]
            assert periodic_runs.lyndon_array(np.array(ordered)) == want


@pytest.mark.parametrize(("least", "repeats"), [(24, 3), (6, 3), (2, 2), (9, 4)])
def test_runs(least, repeats):
    found = 0
    for s in sequences():
        want = plain_runs(s, least, repeats)
        assert [tuple(x) for x in periodic_runs.word_runs([str(x).encode() for x in s], least, repeats).tolist()] == want
        found += len(want)
    assert found > 50


def runs_row(row_id, text):
    """The contract's columns, from all periods tried one by one."""
    found = split(text)
    n, h = len(found), zlib.crc32(str(row_id).encode())
    if row_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        found = [*found[:a], *(found[a + (i - a) % p] for i in range(a, n))]
    runs = plain_runs(found)
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (
        len(runs),
        *best,
        best[0] if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(found) if i not in gone)).hexdigest(),
    )


def test_run_query(spark, tmp_path):
    r = random.Random(5)
    texts = [t for t in AWKWARD if t is None or len(t) < 5000]
    texts += [" ".join(words(r.randrange(90), 3000 + i)) for i in range(150)]
    texts += ["a b c " * 8, "a b c " * 8 + "a", "z " + "a b " * 12 + "c d " * 12, " ".join(words(30, 1) * 3), "x " * 23, "x " * 24 + "y " * 30]
    rows = documents(spark, [*texts, "q r " * 20], [*range(len(texts)), None])
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: tuple(x)[1:] for x in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        assert got[i] == runs_row(i, text), i
    assert got[None] == runs_row(None, "q r " * 20)
    assert sum(x[0] for x in got.values()) > 10
    assert periodic_runs.periodic_runs(documents(spark, [])).count() == 0


def test_run_query_on_given_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").where("length(text) < 3000").collect()
    got = {x.doc_id: tuple(x)[1:] for x in queries.op13_periodic_runs(spark, small).collect()}
    assert docs and all(got[d.doc_id] == runs_row(d.doc_id, d.text) for d in docs)
