"""Secret scanning by a linear-chain conditional random field over base patterns.

Base patterns find assignments, access keys and long hexadecimal strings. A chain model then tags every token as
begin, inside or outside of a secret, from shape features of the token and its neighbours and from features of the
whole text, and adds the tagged spans that no base span touches. It learns from a bounded sample (about
``SAMPLE_DOCS`` documents by hash of the id, ``WINDOWS`` token windows): windows around base spans and elsewhere as they
are, and the same surroundings with made-up secrets or look-alikes in them. The made-up ones have other key names,
alphabets, lengths and prefixes than the patterns ask for, or no assignment at all; the look-alikes are addresses, paths,
identifiers, numbers and dates. So it adds secrets that no pattern names.

Decoding is Viterbi's, exact, but skips what cannot matter: a token whose outside score leads by more than any two
transitions could change is outside in every best path, so the chain falls apart there into short runs.

Defined results: a null or empty text has no spans; repeated rows are scanned each; an empty table, or a sample
without words, gives a model that adds nothing; other columns are kept by ``redact`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "model")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
KEY_NAMES = re.compile(r"pass|secret|token|key|pwd|auth|credential")
MARKS = "\"'`,.;:!?()[]{}<>|#$%&*="
LEAST_MODEL_SPAN = 8
REDACTED = "[REDACTED]"

SAMPLE_DOCS = 20_000
WINDOWS, REACH = 8000, 8
ROUNDS, RATE, DECAY = 80, 0.15, 1e-3
MAX_TOKENS = 200_000
#: Neighbours whose features count for a token.
ROLES = (-2, -1, 0, 1)
OUTSIDE, BEGIN, INSIDE = range(3)
#: Numbers of values of each token feature, see ``shape``.
SIZES = (9, 16, 4, 5, 2, 3, 2, 3, 8, 5)
BASES = tuple(int(x) for x in np.cumsum((0, *SIZES))[:-1])
FEATURES = sum(SIZES) + 1
NOTHING = FEATURES - 1  # before the first and after the last token
FILE_SIZES = (4, 3)
FILE_FEATURES = sum(FILE_SIZES)


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of the base patterns' matches, in order."""
    found = [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


#: Key names of the made-up secrets, as people write them.
PRACTICE_KEYS = (
    "passphrase", "passcode", "auth", "private_key", "access_key", "client_secret", "login", "signature", "session_key",
    "db_password", "SECRET", "bearer_token", "encryption_key", "authToken", "smtp_pass",
)
_LOWER = re.compile("[a-z]+")
_RUNS = re.compile("[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+")
_ALPHABETS = (
    string.ascii_lowercase + string.digits,
    string.ascii_uppercase + string.digits,
    string.ascii_letters + string.digits,
    string.ascii_letters + string.digits,
    string.ascii_letters + string.digits + "+/",
    string.ascii_letters + string.digits + "-_",
    "0123456789ABCDEF",
    "0123456789abcdef",
)


def _drawn(r: random.Random, alphabet: str, n: int) -> str:
    return "".join(r.choices(alphabet, k=n))


def _value(r: random.Random) -> str:
    """A secret's own characters, sometimes behind a short prefix or in three parts."""
    alphabet = r.choice(_ALPHABETS)
    body = _drawn(r, alphabet, r.randint(14, 56))
    if r.random() < 0.08:
        return ".".join(_drawn(r, alphabet, r.randint(14, 30)) for _ in range(3))
    if r.random() < 0.4:
        prefix = [_drawn(r, string.ascii_lowercase, r.randint(2, 5)) for _ in range(r.randint(1, 2))]
        sign = r.choice("_-")
        return sign.join([*prefix, body])
    return body


def made_up_secret(r: random.Random) -> tuple[list[str], list[int]]:
    """Words of a secret in some form, and their tags."""
    key, value, quote = r.choice(PRACTICE_KEYS), _value(r), r.choice(['"', "'", "", ""])
    held = f"{quote}{value}{quote}{r.choice(['', '', ',', '.', ';'])}"
    forms = (
        [key, r.choice("=:"), held],
        [f"{key}:", held],
        [f"{key}={held}"],
        [f'"{key}":', f'"{value}"'],
        ["Authorization:", r.choice(["Bearer", "Basic", "Token"]), value],
        [key, "is", held],
        ["export", f"{key.upper()}={held}"],
        [held],
        [held],
    )
    words = r.choice(forms)
    return words, [OUTSIDE] * (len(words) - 1) + [BEGIN]


def look_alike(r: random.Random) -> list[str]:
    """Words that look a little like a secret."""
    name = lambda: _drawn(r, string.ascii_lowercase, r.randint(3, 9))
    digits = lambda n: _drawn(r, string.digits, n)
    forms = (
        [f"https://{name()}.{r.choice(['com', 'org', 'net'])}/{name()}/{name()}{digits(3)}?{name()}={digits(5)}"],
        [f"/{name()}/{name()}/{name()}_{digits(2)}.{r.choice(['py', 'txt', 'csv'])}"],
        [f"{name()}.{name()}{digits(2)}@{name()}.com"],
        [digits(r.randint(9, 20))],
        [f"{digits(4)}-0{digits(1)}-{digits(2)}T{digits(2)}:{digits(2)}:{digits(2)}Z"],
        [f"+{digits(2)}-{digits(3)}-{digits(7)}"],
        [f"v{digits(1)}.{digits(2)}.{digits(1)}-{name()}"],
        [name() + name().capitalize() + name().capitalize() + digits(1)],
        [f"{name()}_{name()}_{name()}"],
        [f"{name()}-{name()}-{name()}-{digits(4)}"],
        [f"{name()}{digits(r.randint(1, 5))}"],
        [f"{name()}:", f"{name()}{digits(2)}"],
        ["password", "is", name()],
        [name().upper() + "-" + digits(6)],
        [r.choice("-=_*#a") * r.randint(8, 40)],
        [f"id={digits(8)}"],
        ["token", name(), name()],
        [f"{digits(3)}.{digits(3)}.{digits(2)}.{digits(1)}:{digits(4)}"],
    )
    return r.choice(forms)


def shape(word: str) -> tuple[int, ...]:
    """Feature numbers of a token."""
    core = word.strip(MARKS)
    n = len(core)
    if word.isalpha() and n < 16:  # most words: no digits, marks or assignments
        kind = 1 if core.islower() else 2 if core.isupper() else 3
        values = (min(n // 4, 8), kind, 0, 0, 0, 0, int(bool(KEY_NAMES.search(core.lower()))), 0, 0, 4)
    else:
        digits = sum(map(str.isdigit, core))
        lower, upper = any(map(str.islower, core)), any(map(str.isupper, core))
        other = not core.isalnum() and n > 0
        turns = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:]))
        assign = 1 if core == "" and word.strip("\"'") in ("=", ":") else 2 if word.rstrip("\"'").endswith(("=", ":")) else 0
        address = 1 if "@" in core or "://" in core else 2 if core.replace(".", "").isdigit() and "." in core or core.isdigit() else 0
        values = (
            min(n // 4, 8),
            lower + 2 * upper + 4 * (digits > 0) + 8 * other,
            0 if not digits else 1 if digits * 4 < n else 2 if digits * 4 < 3 * n else 3,
            min(4, (turns + 1) // 2),
            int(word[:1] in "\"'" and n > 0),
            assign,
            int(n < 24 and bool(KEY_NAMES.search(core.lower()))),
            address,
            min(7, len(_RUNS.findall(core)) // 2),
            min(4, max(map(len, _LOWER.findall(core)), default=0) // 2),
        )
    return tuple(b + v for b, v in zip(BASES, values, strict=True))


def file_features(words: int, text: str) -> tuple[int, int]:
    size = 0 if words < 50 else 1 if words < 500 else 2 if words < 5000 else 3
    signs = text.count("=") + text.count(":")
    return size, FILE_SIZES[0] + (0 if not signs else 1 if signs * 50 < words else 2)


@dataclass
class Model:
    """Weights by role, feature and tag; transitions; weights of the file's features."""

    roles: np.ndarray = field(default_factory=lambda: np.zeros((len(ROLES), FEATURES, 3)))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))
    file: np.ndarray = field(default_factory=lambda: np.zeros((FILE_FEATURES, 3)))
    trained: bool = False


def window(words: list[str], tags: list[int], centre: int, file: tuple[int, int]) -> tuple[list[int], list[int], tuple[int, int]]:
    """(token features, tags, file features) around a place."""
    at = range(centre - REACH - 2, centre + REACH + 2)
    shapes = [shape(words[i]) if 0 <= i < len(words) else (NOTHING,) * len(SIZES) for i in at]
    return [x for s in shapes for x in s], [tags[i] if 0 <= i < len(words) else OUTSIDE for i in at], file


def windows_of(text: str, some: int) -> list[tuple[list[int], list[int], tuple[int, int]]]:
    """Training windows of a text, around its secrets or around some word: as it is, and with something made up there."""
    places = [(m.start(), m.end()) for m in WORDS.finditer(text)]
    if not places:
        return []
    words = [text[a:b] for a, b in places]
    starts = np.array([a for a, _ in places])
    tags = [OUTSIDE] * len(words)
    spans = []
    for begin, _, end, secret in base_spans(text):
        first, last = (np.searchsorted(starts, [secret, end - 1], side="right") - 1).tolist()
        for i in range(max(first, 0), last + 1):
            tags[i] = INSIDE if i > first else BEGIN
        spans.append((int(np.searchsorted(starts, begin, side="right")) - 1, first, last + 1))
    r = random.Random(some)
    file = file_features(len(words), text)
    out = []
    if not spans:
        if some % 8:
            return []
        odd = [i for i, w in enumerate(words) if len(w) >= 8 and not w.isalpha()]
        c = odd[some % len(odd)] if odd and some % 16 else some // 16 % len(words)
        spans = [(c, c, c)]
    for before, first, after in spans[:3]:
        out.append(window(words, tags, first, file))
        for made in range(2):
            new, marks = (look_alike(r), None) if made and r.random() < 0.7 else made_up_secret(r)
            left = words[max(0, before - REACH - 2) : before]
            mixed = left + new + words[after : after + REACH + 2]
            held = tags[max(0, before - REACH - 2) : before] + (marks or [OUTSIDE] * len(new)) + tags[after : after + REACH + 2]
            out.append(window(mixed, held, len(left) + len(new) - 1, file))
    return out


def sample(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> list:
    """Training windows from the sampled documents, at most ``WINDOWS``, by hash of the document's id."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    # The sign bit is shifted out: shares of 63 bits keep their size at any number of rows.
    place = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), id_column), 1)
    chosen = docs.where(place <= F.lit(min(2**63 - 1, int(share * 2**63)))).select(place.alias("place"), F.col(text_column).alias("text"))

    def work(places, texts):
        rows = [(p, *w) for p, t in zip(places, texts, strict=True) for w in windows_of(t or "", p)]
        return [[p for p, *_ in rows], [any(y) for _, _, y, _ in rows], [f for _, f, _, _ in rows], [y for _, _, y, _ in rows], [list(x) for *_, x in rows]]

    found = map_rows(chosen, ["place", "text"], work, "place long, hit boolean, features array<int>, tags array<int>, file array<int>")
    return found.orderBy("place", "features").limit(WINDOWS).collect()


def train(rows: list) -> Model:
    """Maximum likelihood by full-batch Adam steps; forward and backward passes run over all windows at once."""
    model = Model()
    if not any(r.hit for r in rows):
        return model
    k = len(SIZES)
    feats = np.array([r.features for r in rows]).reshape(len(rows), -1, k)
    tags = np.array([r.tags for r in rows])[:, 2:-1]
    file = np.array([r.file for r in rows])
    n, length = tags.shape
    by_role = [feats[:, 2 + r : 2 + r + length] for r in ROLES]
    params = [model.roles, model.moves, model.file]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    gold = np.eye(3)[tags]
    for step in range(1, ROUNDS + 1):
        scores = sum(model.roles[i][f].sum(2) for i, f in enumerate(by_role)) + model.file[file].sum(1)[:, None]
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0]
        for t in range(1, length):
            alpha[:, t] = scores[:, t] + np.logaddexp.reduce(alpha[:, t - 1, :, None] + model.moves, axis=1)
        for t in range(length - 2, -1, -1):
            beta[:, t] = np.logaddexp.reduce(model.moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        error = np.exp(alpha + beta - total[:, None, None]) - gold
        pairs = np.exp(alpha[:, :-1, :, None] + model.moves + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None])
        moves = pairs.sum((0, 1)) - np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
        roles = np.stack([np.stack([np.bincount(f.ravel(), np.repeat(error[:, :, y].ravel(), k), FEATURES) for y in range(3)], 1) for f in by_role])
        files = np.stack([np.bincount(file.ravel(), np.repeat(error[:, :, y].sum(1), 2), FILE_FEATURES) for y in range(3)], 1)
        for p, g, m, v in zip(params, (roles, moves, files), first, second, strict=True):
            g = g / n + DECAY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.trained = True
    return model


class Tagger:
    """Finds the model's secrets in texts; one per task."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.shapes: dict[tuple, int] = {}
        self.rows: list[np.ndarray] = []
        self._row((NOTHING,) * len(SIZES))
        #: Two transitions can change a path's score by no more.
        self.sway = 2 * float(model.moves.max() - model.moves.min()) + 1e-9

    def _row(self, features: tuple) -> int:
        got = self.shapes.get(features)
        if got is None:
            got = self.shapes[features] = len(self.rows)
            self.rows.append(np.stack([self.model.roles[i][list(features)].sum(0) for i in range(len(ROLES))]))
        return got

    def _number(self, word: str) -> int:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > MAX_TOKENS:
                self.known.clear()
            got = self._row(shape(word))
            if len(word) <= 64:
                self.known[word] = got
        return got

    def tags(self, text: str) -> list[tuple[int, int]]:
        """(first word, last word) of every tagged secret."""
        words = WORDS.findall(text)
        if not words or not self.model.trained:
            return []
        known = self.known
        numbers = [known[w] if w in known else self._number(w) for w in words]
        padded = np.array([0, 0, *numbers, 0])
        table = np.asarray(self.rows) if len(self.rows) != getattr(self, "_size", 0) else self._table
        self._table, self._size = table, len(self.rows)
        n = len(words)
        scores = sum(table[padded[2 + r : 2 + r + n], i] for i, r in enumerate(ROLES))
        scores = scores + self.model.file[list(file_features(n, text))].sum(0)
        open_ = scores[:, OUTSIDE] - scores[:, 1:].max(1) <= self.sway
        if not open_.any():
            return []
        edges = np.flatnonzero(np.diff(np.concatenate([[0], open_, [0]])))
        found: list[tuple[int, int]] = []
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            path = viterbi(scores[a:b], self.model.moves, a > 0, b < n)
            for i, tag in enumerate(path, a):
                if tag == BEGIN or tag == INSIDE and not (found and found[-1][1] == i - 1):
                    found.append((i, i))
                elif tag == INSIDE:
                    found[-1] = found[-1][0], i
        return found


def viterbi(scores: np.ndarray, moves: np.ndarray, after_outside: bool, before_outside: bool) -> list[int]:
    """Best tags of a run that stands between outside tokens, or at an end of the text."""
    best = scores[0] + (moves[OUTSIDE] if after_outside else 0)
    back = []
    for s in scores[1:]:
        ways = best[:, None] + moves
        back.append(ways.argmax(0))
        best = ways.max(0) + s
    if before_outside:
        best = best + moves[:, OUTSIDE]
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def all_spans(text: str, tagger: Tagger) -> list[tuple[int, int, int, int]]:
    """Base spans and the model's, in order, as ``base_spans`` gives them."""
    found = base_spans(text)
    tagged = tagger.tags(text)
    if tagged:
        places = [(m.start(), m.end()) for m in WORDS.finditer(text)]
        taken = found[:]
        for first, last in tagged:
            a, b = places[first][0], places[last][1]
            a += len(text[a:b]) - len(text[a:b].lstrip(MARKS))
            b -= len(text[a:b]) - len(text[a:b].rstrip(MARKS))
            if b - a >= LEAST_MODEL_SPAN and all(b <= s or e <= a for s, _, e, _ in taken):
                found.append((a, 3, b, a))
    return sorted(found)


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    return train(sample(docs, id_column, text_column))


def _written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


def scan(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (``kind:start:end``, comma-joined) for every row."""
    taggers: list[Tagger] = []

    def work(ids, texts):
        if not taggers:
            taggers.append(Tagger(model))
        out: list[list] = [ids, [], [], [], [], []]
        for text in texts:
            spans = all_spans(text or "", taggers[0])
            base = [s for s in spans if s[1] < 3]
            for k in range(3):
                out[1 + k].append(sum(s[1] == k for s in base))
            out[4].append(hashlib.sha256(_written(base).encode()).hexdigest())
            out[5].append(_written(spans))
        return out

    return map_rows(docs, [id_column, text_column], work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: Model, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """The rows with every secret in the text replaced, and the length, if there is one, set to the new text's."""
    names = docs.columns
    taggers: list[Tagger] = []

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        parts, at = [], 0
        for _, _, end, start in sorted(all_spans(text, taggers[0]), key=lambda s: s[3]):
            if end > at:
                parts += [text[at : max(at, start)], REDACTED if start >= at else ""]
                at = end
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taggers.append(Tagger(model))
        for batch in batches:
            columns = list(batch.columns)
            at = names.index(text_column)
            old = columns[at].to_pylist()
            new = [clean(t) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            if length_column in names:
                kept = columns[names.index(length_column)]
                sizes = [n if a == b else len(b) for n, a, b in zip(kept.to_pylist(), old, new, strict=True)]
                columns[names.index(length_column)] = pa.array(sizes, kept.type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
