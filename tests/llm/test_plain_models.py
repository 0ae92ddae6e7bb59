"""The classifier's forward pass and gradient steps, and the label model, against plain computations."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest

from tidewater.llm import quality, weak_rules

from .cases import AWKWARD, documents, words

M = (1 << 64) - 1
P, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def plain_bucket(h, kind):
    mixed = ((h ^ kind) * MIX) & M
    return (((mixed ^ (mixed >> 32)) * MIX) & M) >> 48


def plain_features(text):
    """Bucket of every word, repeated word and character n-gram, one by one."""
    found, before = [], None
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        word = m.group()
        found.append(plain_bucket(sum((ord(c) + 1) * pow(P, k, 1 << 64) for k, c in enumerate(word)) & M, 1))
        if before and before[0] == word and before[1] + 1 == m.start():
            found.append(quality.REPEATED)
        before = word, m.end()
        edged = f" {word} "
        for n in (2, 3, 4):
            for i in range(len(edged) - n + 1):
                h = 0
                for c in edged[i : i + n]:
                    h = (h * P + ord(c) + 1) & M
                found.append(plain_bucket(h, n))
    return found


def test_scores_are_a_plain_forward_pass():
    r = np.random.default_rng(4)
    shares = r.normal(size=quality.BUCKETS + 1).astype(np.float32)
    texts = [t for t in AWKWARD if t is None or len(t) < 5000] + ["same same same x", "a a  a", " ".join(words(40, 9)), "🤖 é"]
    got = quality.scores(texts, shares)
    for text, score in zip(texts, got, strict=True):
        found = plain_features(text)
        z = (float(shares[quality.BUCKETS]) + sum(float(shares[b]) for b in found)) / (1 + len(found))
        assert score == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-6)


def test_training_takes_plain_gradient_steps(monkeypatch):
    """Each step's gradient from the loss itself, by central differences over the touched numbers."""
    monkeypatch.setattr(quality, "EPOCHS", 2)
    monkeypatch.setattr(quality, "BUCKETS", 6)
    rows = [(np.array([0, 2]), np.array([1, 3]), 1), (np.array([1, 2, 4]), np.array([2, 1, 1]), 0), (np.array([5]), np.array([4]), 1)]
    got = quality.train(rows, seed=11)

    rng = np.random.default_rng(11)
    d = quality.DIMENSIONS
    vectors = rng.uniform(-1 / d, 1 / d, (7, d)).astype(np.float32).astype(float)
    output = np.zeros((d, 2))

    def loss(v, o, row):
        buckets, counts, label = row
        share = {int(b): c / (counts.sum() + 1) for b, c in zip(buckets, counts, strict=True)} | {6: 1 / (counts.sum() + 1)}
        z = sum(w * v[b] for b, w in share.items()) @ o
        return math.log(sum(math.exp(x) for x in z)) - z[label]

    def slope(f, x):
        out = np.zeros_like(x)
        for at in np.ndindex(*x.shape):
            kept = x[at]
            x[at] = kept + 1e-5
            up = f()
            x[at] = kept - 1e-5
            out[at] = (up - f()) / 2e-5
            x[at] = kept
        return out

    done, steps = 0, 2 * len(rows)
    for _ in range(2):
        for i in rng.permutation(len(rows)):
            rate = quality.RATE * (1 - done / steps)
            done += 1
            by_vectors = slope(lambda: loss(vectors, output, rows[i]), vectors)  # noqa: B023
            by_output = slope(lambda: loss(vectors, output, rows[i]), output)  # noqa: B023
            output -= rate * by_output
            vectors -= rate * math.sqrt(len(rows[i][0]) + 1) * by_vectors
    assert np.allclose(got, vectors @ (output[:, 1] - output[:, 0]), atol=1e-4)


def plain_votes(r):
    """The eight rules on one document's figures, worded once more."""
    per = lambda a, b: a / max(b, 1)
    length, symbols, density = per(r.word_chars, r.n_words), per(r.n_symbols, r.n_words), per(r.n_symbols, r.word_chars)
    lines, repeats = per(r.n_dup_lines, r.n_lines), per(r.n_repeat_words, r.n_words)
    upper, shouts = per(r.n_upper, r.word_chars), per(r.n_shouts, r.n_words)
    bands = [
        (3 <= length <= 10, length < 2 or length > 15),
        (symbols <= 0.05, symbols > 0.2),
        (density <= 0.01, density > 0.03),
        (r.n_lines >= 2 and lines <= 0.1, lines > 0.3),
        (repeats <= 0.05, repeats > 0.15),
        (r.n_words >= 30, r.n_words < 8),
        (upper <= 0.2, upper > 0.5),
        (shouts <= 0.1, shouts > 0.4),
    ]
    return [-1 if bad else 1 if good else 0 for good, bad in bands]


def plain_label_model(votes):
    """Expectation-maximisation document by document; posterior of each."""
    votes = np.array(votes)
    k = votes.shape[1]
    good, bad, prior = np.full(k, weak_rules.START[0]), np.full(k, weak_rules.START[1]), weak_rules.PRIOR

    def posteriors():
        like_good = np.where(votes == 1, good, np.where(votes == -1, 1 - good, 1)).prod(1) * prior
        like_bad = np.where(votes == -1, bad, np.where(votes == 1, 1 - bad, 1)).prod(1) * (1 - prior)
        return like_good / (like_good + like_bad)

    for _ in range(weak_rules.ROUNDS):
        p = posteriors()
        before = np.concatenate([good, bad, [prior]])
        smooth = weak_rules.SMOOTHING
        good = np.array([((p * (votes[:, j] == 1)).sum() + smooth * weak_rules.START[0]) / ((p * (votes[:, j] != 0)).sum() + smooth) for j in range(k)])
        bad = np.array([(((1 - p) * (votes[:, j] == -1)).sum() + smooth * weak_rules.START[1]) / (((1 - p) * (votes[:, j] != 0)).sum() + smooth) for j in range(k)])
        good, bad = good.clip(*weak_rules.GOOD_BOUNDS), bad.clip(*weak_rules.BAD_BOUNDS)
        prior = min(max(p.mean(), weak_rules.PRIOR_BOUNDS[0]), weak_rules.PRIOR_BOUNDS[1])
        if np.abs(np.concatenate([good, bad, [prior]]) - before).max() < weak_rules.SETTLED:
            break
    return posteriors()


def test_posteriors_equal_a_plain_label_model(spark, small):
    given = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect() if len(r.text or "") < 20000]
    texts = [*given, *(t for t in AWKWARD if t is None or len(t) < 5000), *(" ".join(w + "!!#$%" for w in words(50, 70 + i)) for i in range(6))]
    rows = weak_rules.judge(documents(spark, texts)).collect()
    want = plain_label_model([plain_votes(r) for r in rows])
    for r, p in zip(rows, want, strict=True):
        assert r.posterior == pytest.approx(p, abs=1e-9)
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.kept == (not failed and p >= weak_rules.KEEP_AT)
    assert 0 < sum(r.kept for r in rows) < len(rows)
