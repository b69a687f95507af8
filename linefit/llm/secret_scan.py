"""Secrets in texts: fixed patterns, and what a linear-chain conditional random field adds.

The field tags every token of a whole text as outside of a secret, its begin or its inside, by
the token's shape, the two words before and the word after it, and features of the whole text
(shares of tokens with digits and of separators, length, kind of source). It is trained in numpy
on windows of texts whose tags are the matches of the patterns; every window with a secret also
comes without its neighbouring words, so that shape alone has to tell. Viterbi finds the best tags.

Viterbi runs where it can matter only. With scores relative to "outside", let m be the most that
transitions can favour another tag at one place. Where both other tags score below -m, exchanging
either for "outside" gains in every sequence, so the best one has "outside" there; what is
left are short stretches between such places, decoded side by side.

Patterns match leftmost and without overlap per kind, and a match's span is all of it (for
``assign`` from the name to the end of the value). A span of the field has kind ``crf``, at least
``LEAST`` characters, and overlaps no match.

Sample: windows come from about ``SAMPLE`` texts, at most ``WINDOWS`` with and as many without a
secret. Without any match in the sample there is no field and only matches are found.

Edge cases: a null text has no spans; null keys, repeated rows and empty tables pass through; texts
and tokens may be of any length. Ties between taggings go to "outside", then "begin". Columns other
than those named are not carried, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import discard, pieces_of, staged

# The patterns, their names in order, and the least length of a match (of the value).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "crf")
LEAST_MATCH = {"assign": 8, "access": 16, "hex": 32}

SAMPLE = 20_000
WINDOWS = 800
AROUND = 10
LONGEST = 48
LEAST = 8
ROUNDS = 80
BUCKETS = 4096
NO_WORD = BUCKETS
SOURCES = 64
OUT, BEGIN, INSIDE = 0, 1, 2
EDGE = "\n\n"  # between texts; no token
SEPARATORS = "=:\"'`,;()<>[]{}|"
TOKEN = f"[^\\s{re.escape(SEPARATORS)}]+|[{re.escape(SEPARATORS)}]"
STEPS = (1, 2, 3, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64)
SPANS = "array<struct<kind:string,start:int,end:int>>"


def matches(text: str) -> list[tuple[int, int, int, int]]:
    """(start, number of kind, end, start of the value) of the patterns' matches, in order."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        for m in re.finditer(ASSIGN, text, re.I | re.A):
            if len(m[2]) >= LEAST_MATCH["assign"]:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        for m in re.finditer(ACCESS, text):
            if len(m[0]) >= LEAST_MATCH["access"]:
                found.append((m.start(), 1, m.end(), m.start()))
    for m in re.finditer(HEX[:-1] + "{%d,}" % LEAST_MATCH["hex"], text):  # runs are maximal
        found.append((m.start(), 2, m.end(), m.start()))
    return sorted(found)


# --- features -------------------------------------------------------------------------------


def _step(n: int) -> int:
    return sum(n > s for s in STEPS)


def shape(token: str) -> tuple[str, ...]:
    """What a token looks like, as names of features."""
    n = len(token)
    if n == 1 and token in SEPARATORS:
        return ("separator",)
    if token.isalpha():
        case = "title" if token.istitle() else "lower" if token.islower() else "upper" if token.isupper() else "mixed"
        return f"n{_step(n)}", f"word {case}", f"word n{_step(n)}"
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    kinds = "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in token)
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    out = [f"n{_step(n)}", f"digits{5 * digits // n}", f"letters{5 * letters // n}", f"turns{5 * turns // n}"]
    out += ["has " + k for k in sorted(set(kinds))] + [f"first {kinds[0]}", f"last {kinds[-1]}"]
    if re.fullmatch("[0-9a-f]+", token) and digits < n:
        out.append("hex")
    if re.fullmatch("[A-Za-z0-9+/_-]+", token) and digits and letters:
        out += ["code", f"code n{_step(n)}"]
    out += sorted({f"sign {c}" for c in token if not c.isalnum() and c.isascii()})[:4]
    return tuple(out)


def word_bucket(token: str, look: tuple[str, ...]) -> int:
    """The feature of a token as a neighbour: itself if it is a word or sign, else its shape."""
    name = token.lower() if len(token) <= 20 and (token.isalpha() or len(token) == 1) else " ".join(look[:3])
    return crc32(name.encode()) % BUCKETS


def file_features(tokens: int, with_digits: int, separators: int, source: str | None) -> tuple[int, int, int, int]:
    """Numbers of the features of a whole text, one of each group."""
    return (
        min(5, 20 * with_digits // max(tokens, 1)), min(5, 10 * separators // max(tokens, 1)),
        min(9, tokens.bit_length() // 2), SOURCES if source is None else crc32(source.encode()) % SOURCES,
    )


FILE_SIZES = (6, 6, 10, SOURCES + 1)


class Vocabulary(dict):
    """token → (number of its shape, its bucket as a neighbour), packed into one number."""

    MOST = 300_000

    def __init__(self):
        super().__init__()
        self.shapes: dict[tuple[str, ...], int] = {}
        self.begin()

    def begin(self):
        self.clear()
        self.shapes.clear()
        self.shapes[(EDGE,)] = 0
        self[EDGE] = NO_WORD

    def __missing__(self, token: str) -> int:
        look = shape(token)
        number = self.shapes.setdefault(look, len(self.shapes))
        packed = number << 13 | word_bucket(token, look)
        self[token] = packed
        return packed


# --- training -------------------------------------------------------------------------------


def _windows(text: str, source: str | None, seed: int) -> Iterator[tuple[bool, list[str], list[int], tuple]]:
    """(has a secret, tokens, tags, features of the text) for stretches of one text."""
    found = list(re.finditer(TOKEN, text))
    if not found:
        return
    tokens = [m[0] for m in found]
    tags = np.zeros(len(found), np.int8)
    starts, ends = np.array([m.start() for m in found]), np.array([m.end() for m in found])
    secrets = []
    for _, _, end, start in matches(text):
        inside = np.flatnonzero((starts < end) & (ends > start))
        if len(inside) and not tags[inside[0]]:
            tags[inside], tags[inside[0]] = INSIDE, BEGIN
            secrets.append((max(0, inside[0] - AROUND), inside[-1] + 1 + AROUND))
    about = file_features(
        len(tokens), sum(any(c.isdigit() for c in t) for t in tokens), sum(t in SEPARATORS for t in tokens), source
    )
    first = seed % max(1, len(tokens) - 2 * AROUND)
    for has, (a, b) in [(True, s) for s in secrets[:8]] + [(False, (first, first + 2 * AROUND))]:
        b = min(b, a + LONGEST)
        if has or not tags[a:b].any():
            yield has, tokens[a:b], tags[a:b].tolist(), about


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, "text"):
        rows = []
        for text, source in zip(batch.column("text").to_pylist(), batch.column("source").to_pylist()):
            seed = crc32((text or "").encode())
            rows += [(seed, *w) for w in _windows(text or "", source, seed)]
        kinds = (pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int8()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            ["seed", "has", "tokens", "tags", "about"],
        )


@dataclass
class Field:
    """A trained field: scores of "begin" and "inside" relative to "outside"."""

    shapes: dict[str, np.ndarray]  # feature → two scores
    before2: np.ndarray  # (BUCKETS + 1, 2) and so on: by bucket of a neighbouring word
    before: np.ndarray
    after: np.ndarray
    about: list[np.ndarray]  # by number of the feature, for each group
    moves: np.ndarray  # (from, to)

    def of_shape(self, look: tuple[str, ...]) -> np.ndarray:
        if look == (EDGE,):
            return np.full(2, -1e30)
        return sum((self.shapes[f] for f in look if f in self.shapes), np.zeros(2))

    @property
    def margin(self) -> float:
        """The most that transitions can favour another tag over "outside" at one place."""
        t = self.moves
        return max(
            t[p, s] + t[s, n] - t[p, OUT] - t[OUT, n] for p in range(3) for n in range(3) for s in (BEGIN, INSIDE)
        )


def train(windows: list[tuple[list[str], list[int], tuple]], rounds: int = ROUNDS) -> Field:
    """Field of greatest penalised likelihood over the windows, by Adam steps on all of them."""
    vocabulary = Vocabulary()
    size = max(len(w[0]) for w in windows)
    n = len(windows)
    packed = np.full((n, size + 4), NO_WORD, np.int64)
    tags, lengths = np.zeros((n, size), np.int64), np.array([len(w[0]) for w in windows])
    plain = np.zeros(n, bool)
    for i, (tokens, tag, *rest) in enumerate(windows):
        packed[i, 2 : 2 + len(tokens)] = [vocabulary[t] for t in tokens]
        tags[i, : len(tag)] = tag
        plain[i] = len(rest) > 1 and rest[1]
    real = np.arange(size) < lengths[:, None]
    looks = [list(k) for k in vocabulary.shapes]
    names = {f: i for i, f in enumerate(dict.fromkeys(f for look in looks for f in look))}
    member = np.zeros((len(looks), len(names)))
    for i, look in enumerate(looks):
        member[i, [names[f] for f in look]] = 1
    number, bucket = packed[:, 2 : 2 + size] >> 13, np.where(plain[:, None], NO_WORD, packed & 8191)
    near = [bucket[:, 2 + d : 2 + d + size] for d in (-2, -1, 1)]
    about = np.array([w[2] for w in windows])

    sizes = [len(names), *[BUCKETS + 1] * 3, *FILE_SIZES]
    cuts = np.cumsum([0, *sizes]) * 2
    w = np.zeros(cuts[-1] + 9)
    view = lambda v, i: v[cuts[i] : cuts[i + 1]].reshape(-1, 2)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    rows = np.arange(n)
    wanted = np.eye(3)[tags] * real[..., None]
    previous = np.concatenate([np.zeros((n, 1), np.int64), tags[:, :-1]], axis=1)
    moved = np.zeros(9)
    np.add.at(moved, (previous * 3 + tags)[real], 1.0)
    np.add.at(moved, tags[rows, lengths - 1] * 3 + OUT, 1.0)

    for step in range(1, rounds + 1):
        moves = w[-9:].reshape(3, 3)
        score = np.zeros((n, size, 3))
        score[..., 1:] = (member @ view(w, 0))[number]
        for i in range(3):
            score[..., 1:] += view(w, 1 + i)[near[i]]
        score[..., 1:] += sum(view(w, 4 + g)[about[:, g]] for g in range(4))[:, None]
        tag_share, move_share = _marginals(score, moves, lengths, real)
        slope = np.zeros_like(w)
        off = (tag_share - wanted)[..., 1:] * real[..., None]
        flat = number.ravel()
        by_shape = np.stack([np.bincount(flat, off[..., s].ravel(), len(looks)) for s in range(2)], axis=1)
        view(slope, 0)[:] = member.T @ by_shape
        for i in range(3):
            for s in range(2):
                view(slope, 1 + i)[:, s] = np.bincount(near[i].ravel(), off[..., s].ravel(), BUCKETS + 1)
            view(slope, 1 + i)[NO_WORD] = 0
        total = off.sum(axis=1)
        for g, m in enumerate(FILE_SIZES):
            for s in range(2):
                view(slope, 4 + g)[:, s] = np.bincount(about[:, g], total[:, s], m)
        slope[-9:] = move_share.ravel() - moved
        slope = slope / n + 2e-3 * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        w -= 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)

    return Field(
        {f: view(w, 0)[i] for f, i in names.items()}, *[view(w, 1 + i) for i in range(3)],
        [view(w, 4 + g) for g in range(4)], w[-9:].reshape(3, 3),
    )


def _marginals(score, moves, lengths, real):
    """Shares of tags (windows, places, 3) and summed shares of moves (3, 3), each window having
    "outside" before and after it."""
    n, size, _ = score.shape
    forward = np.zeros((n, size, 3))
    forward[:, 0] = moves[OUT] + score[:, 0]
    for t in range(1, size):
        stepped = _log_sum(forward[:, t - 1][:, :, None] + moves, 1) + score[:, t]
        forward[:, t] = np.where(real[:, t, None], stepped, forward[:, t - 1])
    backward = np.broadcast_to(moves[:, OUT], (n, 3)).copy()
    whole = _log_sum(forward[:, -1] + backward, 1)
    tags, pairs = np.zeros((n, size, 3)), np.zeros((3, 3))
    ends = np.exp(forward[:, -1] + backward - whole[:, None])
    pairs[:, OUT] += ends.sum(axis=0)
    for t in range(size - 1, -1, -1):
        here = real[:, t]
        tags[:, t] = np.where(here[:, None], np.exp(forward[:, t] + backward - whole[:, None]), 0)
        ahead = score[:, t] + backward
        if t:
            both = np.exp(forward[:, t - 1][:, :, None] + moves + ahead[:, None, :] - whole[:, None, None])
            pairs += both[here].sum(axis=0)
        else:
            pairs[OUT] += tags[:, 0].sum(axis=0)
        backward = np.where(here[:, None], _log_sum(moves + ahead[:, None, :], 2), backward)
    return tags, pairs


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def learn(docs: DataFrame, text: str = "text", source: str | None = None) -> Field | None:
    """A field trained on a sample of ``docs``; None if it has no match of a pattern."""
    total = docs.count()
    read = docs.select(F.col(f"`{text}`").alias("text"), _source(source).alias("source"))
    share = min(1.0, SAMPLE / max(total, 1))
    drawn = read.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(np.ceil(share * (1 << 20))))
    table, path = staged(
        drawn.mapInArrow(_sampled, "seed long, has boolean, tokens array<string>, tags array<byte>, about array<int>"),
        "windows",
    )
    taken = {
        has: table.where(F.col("has") == has).orderBy("seed", "tokens").limit(WINDOWS).collect()  # short windows
        for has in (True, False)
    }
    discard(docs.sparkSession, path)
    if not taken[True]:
        return None
    rows = [(r["tokens"], r["tags"], tuple(r["about"]), plain) for has, plain in ((True, False), (True, True), (False, False))
            for r in taken[has]]
    return train(rows)


def _source(source: str | None):
    return F.lit(None).cast("string") if source is None else F.col(f"`{source}`").cast("string")


# --- decoding -------------------------------------------------------------------------------


def viterbi(score: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of stretches of ``score`` (places, 3), each between two places outside."""
    tags = np.zeros(len(score), np.int8)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    if not len(starts):
        return tags
    best = moves[OUT] + score[starts]
    from_ = []
    for t in range(1, int(lengths[0])):
        alive = int(np.searchsorted(-lengths, -t, "left"))  # those longer than t
        steps = best[:alive, :, None] + moves
        came = steps.argmax(axis=1)
        best[:alive] = np.take_along_axis(steps, came[:, None], 1)[:, 0] + score[starts[:alive] + t]
        from_.append(came)
    tag = (best + moves[:, OUT]).argmax(axis=1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        alive = int(np.searchsorted(-lengths, -t, "left"))
        tags[starts[:alive] + t] = tag[:alive]
        if t:
            tag[:alive] = from_[t - 1][np.arange(alive), tag[:alive]]
    return tags


class Tagger:
    """Tags of whole texts by a field."""

    def __init__(self, field: Field):
        self.field, self.vocabulary = field, Vocabulary()
        self.margin = field.margin
        self.looks = np.zeros((0, 2))
        self.digits = self.separators = np.zeros(0, bool)

    def _look_scores(self):
        shapes = self.vocabulary.shapes
        if len(shapes) != len(self.looks):
            self.looks = np.array([self.field.of_shape(s) for s in shapes])
            self.digits = np.array(["has d" in s for s in shapes])
            self.separators = np.array([s == ("separator",) for s in shapes])
        return self.looks

    def tags(self, texts: list[list[str]], sources: list[str | None]) -> list[np.ndarray]:
        """Tags of each text's tokens."""
        if len(self.vocabulary) > Vocabulary.MOST:
            self.vocabulary.begin()
            self.looks = self.looks[:0]
        tokens = [EDGE, EDGE]
        for text in texts:
            tokens += text
            tokens += (EDGE, EDGE)
        packed = np.fromiter(map(self.vocabulary.__getitem__, tokens), np.int64, len(tokens))
        looks, f = self._look_scores(), self.field
        number, bucket = packed >> 13, packed & 8191
        score = looks[number]
        score[2:] += f.before2[bucket[:-2]]
        score[1:] += f.before[bucket[:-1]]
        score[:-1] += f.after[bucket[1:]]
        starts = 2 + np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])]).astype(np.int64)
        digits = np.concatenate([[0], np.cumsum(self.digits[number])])
        signs = np.concatenate([[0], np.cumsum(self.separators[number])])
        about = np.zeros((len(texts), 2))
        for i, (text, source) in enumerate(zip(texts, sources)):
            a, b = starts[i], starts[i] + len(text)
            numbers = file_features(len(text), int(digits[b] - digits[a]), int(signs[b] - signs[a]), source)
            about[i] = sum(f.about[g][k] for g, k in enumerate(numbers))
        score[2:] += np.repeat(about, [len(t) + 2 for t in texts], axis=0)
        unsure = score.max(axis=1) >= -self.margin
        edges = np.flatnonzero(np.diff(np.concatenate([[False], unsure, [False]]).astype(np.int8)))
        first, last = edges[::2], edges[1::2]
        full = np.concatenate([np.zeros((len(score), 1)), score], axis=1)
        tags = viterbi(full, first, last - first, f.moves)
        return [tags[starts[i] : starts[i] + len(t)] for i, t in enumerate(texts)]


def _added(text: str, tags: np.ndarray, base: list[tuple]) -> list[tuple[int, int, int]]:
    """Spans of tagged tokens that overlap no match and are long enough."""
    out, start, end = [], None, None
    for tag, m in zip(tags.tolist(), re.finditer(TOKEN, text)):
        if start is not None and tag != INSIDE:
            out.append((start, 3, end))
            start = None
        if tag != OUT:
            start, end = m.start() if start is None else start, m.end()
    if start is not None:
        out.append((start, 3, end))
    return [s for s in out if s[2] - s[0] >= LEAST and not any(s[0] < b[2] and b[0] < s[2] for b in base)]


def scan(
    docs: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text", source: str | None = None
) -> DataFrame:
    """(key, spans) of every row: array of (kind, start, end) by start, then kind, in code points."""
    read = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), _source(source).alias("source")
    )

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field) if field else None
        token = re.compile(TOKEN)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in pieces_of(batches, "text", 2 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [[m[:3] for m in matches(t)] for t in texts]
            if tagger:
                tags = tagger.tags([token.findall(t) for t in texts], batch.column("source").to_pylist())
                for i, tagged in enumerate(tags):
                    if tagged.any():
                        found[i] = sorted(found[i] + _added(texts[i], tagged, found[i]))
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, kind)], ["key", "spans"])

    kind = read.schema["key"].dataType.simpleString()
    return read.mapInArrow(spans, f"key {kind}, spans {SPANS}").withColumnRenamed("key", key)


def digests(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: matches of each pattern, a digest of them all, and all spans as text."""
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number_of(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    spans = F.col("spans")
    counts = [number_of(k).alias(f"n_{k}") for k in KINDS[:3]]
    base = F.filter(spans, lambda s: s["kind"] != KINDS[3])
    return scanned.select(
        F.col(f"`{key}`"), *counts, F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans")
    )
