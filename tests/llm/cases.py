"""Small documents with every awkward case."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, part int"


def documents(spark, texts, ids=None, schema=DOCS):
    """Rows with columns whose names operators use inside, to see that they do not mind."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, 0.5, "d", 1) for i, t in zip(ids, texts, strict=True)], schema)


def words(n, seed):
    r = random.Random(seed)
    return [r.choice(["alpha", "Beta", "gamma", "don't", "naïve", "x1", "42"]) + str(r.randrange(500)) for _ in range(n)]


LONG = " ".join(words(6000, 5))
AWKWARD = [
    None, "", "  \n\t ", "one", "a b c", "It's it'll ''s 'tis\n\n  x <|endoftext|> y", "日本語 テキスト 🤖", "\x00\x1c\x85 z",
    "word " * 300, LONG, LONG, LONG + " tail", "token = \"0123456789abcdef0123456789abcdef\"", "A b c",
]
