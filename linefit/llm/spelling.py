"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One inserted, deleted or replaced letter changes the counts of a word's letters by at most two in
sum (L1). Words of one length are the points of k-d trees over these counts. A word searches the
tree of its own length, where a replacement takes one letter away and adds one, and the tree of
the words one letter shorter, where it has all of a word's letters and one more. A subtree goes
unvisited if its bounding box is farther away than that; what is left is compared letter by letter.

The upper part of each tree is cut from a bounded sample of the words (``SAMPLE``), which decides
nothing but the sizes of its cells: every word is put into its cell and routed to all cells that
its searches may reach. A task builds the lower part of one cell's tree at a time and streams the
searching words past it. A cell that turns out larger than ``MOST`` words or ``MOST_BYTES`` is
dealt over several, each of which gets all of its searches.

Edge cases: a null text is empty, a null key an empty key; repeated rows count each time. Ties for
a form go to the first in code-point order. Runs may be of any length. An empty table, or one without a word, gives no
rows. Columns besides key and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import discard, pieces_of, staged

LEAST_LENGTH = 7
LEAST_TIMES = 2
RATIO = 10
ODD_ONE_OUT = 31
SAMPLE = 200_000
CELL = 16_384
MOST = 65_536
MOST_BYTES = 32 << 20
LEAF = 128
LETTERS = 26 + 64
KEPT = 200_000
FOUND = "word string, n long, n_near long, best_n long, form string"


def _letter_numbers() -> np.ndarray:
    """Number of each letter by its code point: a–z, then U+00C0–U+00FF."""
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(26)
    table[192:256] = np.arange(26, LETTERS)
    return table


def _matrix(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points (all below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _counts(matrix: np.ndarray) -> np.ndarray:
    """How often each row has each letter."""
    rows = np.arange(len(matrix))[:, None] * LETTERS
    flat = np.bincount((rows + _letter_numbers()[matrix]).ravel(), minlength=len(matrix) * LETTERS)
    return flat.reshape(-1, LETTERS).astype(np.int16 if matrix.shape[1] < 30_000 else np.int64)


def _cut(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that part the rows most evenly (count or fewer, and more)."""
    if counts.max() <= 8:
        levels = np.arange(counts.max())[:, None] * np.ones(counts.shape[1], np.int64)
    else:
        middle = np.median(counts, axis=0).astype(np.int64)
        levels = np.stack([middle, np.maximum(middle - 1, 0)])
    best, cut = 0, None
    for level in levels:
        below = (counts <= level).sum(axis=0)
        even = np.minimum(below, len(counts) - below)
        j = int(even.argmax())
        if even[j] > best:
            best, cut = even[j], (j, int(level[j]))
    return cut


# --- the upper part: cells ------------------------------------------------------------------

Cells = dict  # length → nested (letter, count, left, right), with numbers of cells as leaves


def _cells_of(sample: list[str], share: float) -> tuple[Cells, int]:
    """Trees over the sample, cut until a cell stands for about ``CELL`` of all words."""
    most = max(2, int(CELL * share))
    by_length: dict[int, list[str]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word)
    total = 0

    def grown(counts):
        nonlocal total
        cut = _cut(counts) if len(counts) > most else None
        if cut is None:
            total += 1
            return total - 1
        low = counts[:, cut[0]] <= cut[1]
        return (*cut, grown(counts[low]), grown(counts[~low]))

    trees = {}
    for length, words in sorted(by_length.items()):
        if len(words) > most:
            trees[length] = grown(_counts(_matrix(words)))
    return trees, total


def _routes(tree, counts: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, rows) for all cells that may hold a word of which a row has at most ``more``
    letters too many and ``fewer`` too few."""
    start = np.zeros(len(counts), np.int64)
    stack = [(tree, np.arange(len(counts)), start, start, {})]
    while stack:
        node, rows, over, under, box = stack.pop()
        if not isinstance(node, tuple):
            yield node, rows
            continue
        letter, level, left, right = node
        q = counts[rows, letter].astype(np.int64)
        low, high = box.get(letter, (0, None))
        over_before = 0 if high is None else np.maximum(q - high, 0)
        under_before = np.maximum(low - q, 0)
        for child, bounds in ((left, (low, level)), (right, (level + 1, high))):
            o = over - over_before + (0 if bounds[1] is None else np.maximum(q - bounds[1], 0))
            u = under - under_before + np.maximum(bounds[0] - q, 0)
            near = (o <= more) & (u <= fewer)
            if near.any():
                stack.append((child, rows[near], o[near], u[near], {**box, letter: bounds}))


POINT, SAME, LONGER = 0, 1, 2


def _router(trees: Cells, parts: dict[tuple[int, int], int]):
    """Rows of (length, cell, part, kind, word, n) from batches of (word, n)."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "word"):
            words = np.array(batch.column("word").to_pylist(), object)
            times = batch.column("n").to_numpy()
            lengths = np.array([len(w) for w in words], np.int64)
            out = []  # (length, cell, part, kind, rows)

            def put(length, kind, more, fewer, rows, counts):
                cells = _routes(trees[length], counts, more, fewer) if length in trees else [(-1, np.arange(len(rows)))]
                for cell, near in cells:
                    n = parts.get((length, cell), 1)
                    if kind == POINT:
                        own = np.array([crc32(w.encode()) % n for w in words[rows[near]]])
                        out.extend((length, cell, p, kind, rows[near[own == p]]) for p in range(n))
                    else:
                        out.extend((length, cell, p, kind, rows[near]) for p in range(n))

            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                counts = _counts(_matrix(words[rows].tolist()))
                put(int(length), POINT, 0, 0, rows, counts)
                put(int(length), SAME, 1, 1, rows, counts)
                if length > LEAST_LENGTH:
                    put(int(length) - 1, LONGER, 1, 0, rows, counts)
            for some in _in_blocks(out):
                sizes = [len(o[4]) for o in some]
                rows = np.concatenate([o[4] for o in some])
                heads = [pa.array(np.repeat([o[i] for o in some], sizes), pa.int32()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*heads, pa.array(words[rows], pa.string()), pa.array(times[rows])],
                    ["length", "cell", "part", "kind", "word", "n"],
                )

    return route


def _in_blocks(out: list[tuple]) -> Iterator[list[tuple]]:
    """The entries in lists of bounded size."""
    some, size = [], 0
    for entry in out:
        some.append(entry)
        size += len(entry[4]) * (16 + entry[0])
        if size > 16 << 20:
            yield some
            some, size = [], 0
    if some:
        yield some


# --- the lower part: search within a cell ---------------------------------------------------


class Tree:
    """A k-d tree over the letter counts of words of one length, with tight boxes."""

    def __init__(self, words: list[str]):
        self.matrix = _matrix(words)
        self.length = self.matrix.shape[1]
        counts = _counts(self.matrix)
        self.used = np.flatnonzero(counts.any(axis=0))
        counts = counts[:, self.used]
        self.order, self.nodes = np.arange(len(words)), []
        self._grow(counts, 0, len(words))
        self.counts = counts[self.order]
        self.top = self.counts.max(axis=0)
        self.steps = self._steps(self.counts) if self.top.sum() <= 512 else None

    def _grow(self, counts, start: int, end: int) -> int:
        rows = counts[self.order[start:end]]
        number = len(self.nodes)
        self.nodes.append(None)
        cut = _cut(rows) if end - start > LEAF else None
        children = None
        if cut is not None:
            low = rows[:, cut[0]] <= cut[1]
            here = self.order[start:end].copy()
            middle = start + int(low.sum())
            self.order[start:middle], self.order[middle:end] = here[low], here[~low]
            children = (self._grow(counts, start, middle), self._grow(counts, middle, end))
        self.nodes[number] = (rows.min(axis=0), rows.max(axis=0), start, end, children)
        return number

    def _steps(self, counts: np.ndarray) -> np.ndarray:
        """For each letter as many zeros and ones as a word here has of it at most, ones first:
        the product of two words' rows is the number of letters they share."""
        return np.concatenate(
            [counts[:, [j]] > np.arange(top) for j, top in enumerate(self.top)], axis=1
        ).astype(np.float32)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word, point) one edit apart, for words as long as the points or a letter longer."""
        matrix = _matrix(words)
        longer = matrix.shape[1] - self.length
        more, fewer = 1, 1 - longer
        counts = _counts(matrix)
        strange = counts.sum(axis=1) - counts[:, self.used].sum(axis=1)
        counts = counts[:, self.used]
        steps = None if self.steps is None else self._steps(counts)
        share = self.length - fewer
        firsts, seconds = [], []
        stack = [(0, np.flatnonzero(strange <= more))]
        while stack:
            node, rows = stack.pop()
            low, high, start, end, children = self.nodes[node]
            q = counts[rows]
            over = np.maximum(q - high, 0).sum(axis=1) + strange[rows]
            close = (over <= more) & (np.maximum(low - q, 0).sum(axis=1) <= fewer)
            rows = rows[close]
            if not len(rows):
                continue
            if children:
                stack.extend((child, rows) for child in children)
                continue
            for some in np.array_split(rows, 1 + len(rows) * (end - start) * len(self.used) // 8_000_000):
                if steps is not None:
                    shared = steps[some] @ self.steps[start:end].T
                else:
                    shared = np.minimum(counts[some][:, None], self.counts[None, start:end]).sum(axis=2)
                a, b = np.nonzero(shared >= share)
                a, b = some[a], self.order[start + b]
                for part in np.array_split(np.arange(len(a)), 1 + len(a) * self.length // 8_000_000):
                    fine = self._one_edit(matrix[a[part]], self.matrix[b[part]])
                    firsts.append(a[part][fine])
                    seconds.append(b[part][fine])
        if not firsts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(firsts), np.concatenate(seconds)

    def _one_edit(self, q: np.ndarray, p: np.ndarray) -> np.ndarray:
        if q.shape[1] == p.shape[1]:
            return (q != p).sum(axis=1) == 1
        head = np.logical_and.accumulate(q[:, :-1] == p, axis=1).sum(axis=1)
        tail = np.logical_and.accumulate((q[:, 1:] == p)[:, ::-1], axis=1).sum(axis=1)
        return head + tail >= self.length


def _best(of: np.ndarray, other: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each number in ``of``: how many others, and which is the largest (then the first)."""
    order = np.lexsort((other, -times[other], of))
    of, other = of[order], other[order]
    found, first, many = np.unique(of, return_index=True, return_counts=True)
    return found, many, other[first]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words from rows sorted by cell, the cell's points first, each kind by word."""
    cell, points, times, tree = None, [], [], None

    def rows(words, n, others, other_n, found):
        mine, many, best = found
        form = [others[i] for i in best.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in mine.tolist()], pa.string()), pa.array(n[mine]), pa.array(many),
             pa.array(other_n[best]), pa.array(form, pa.string())],
            ["word", "n", "n_near", "best_n", "form"],
        )

    for batch in pieces_of(batches, "word", 2 << 20):
        heads = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
        words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        edges = np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *edges], [*edges, len(heads)]):
            *where, kind = heads[start].tolist()
            if where != cell:
                cell, points, times, tree = where, [], [], None
            if kind == POINT:
                points.extend(words[start:end])
                times.append(n[start:end])
                continue
            if not points:
                continue
            if tree is None:
                tree, sizes = Tree(points), np.concatenate(times)
            own, own_n = words[start:end], n[start:end]
            a, b = tree.near(own)
            if len(a):
                yield rows(own, own_n, points, sizes, _best(a, b, sizes))
                if kind == LONGER:
                    yield rows(points, sizes, own, own_n, _best(b, a, own_n))


# --- the operator ---------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and how often a task has met them, passed on whenever ``KEPT`` are held."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
    held: dict[bytes, int] = {}

    def flushed():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
            ["word", "n"],
        )
        held.clear()
        return batch

    for batch in pieces_of(batches, "text"):
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            seed = crc32(f"{key or ''}:".encode())
            for run, times in Counter(runs.findall(text or "")).items():
                word = run.encode().lower()  # of bytes only A–Z have a lower case
                h = crc32(word, seed)
                if h % ODD_ONE_OUT == 0:
                    if len(run) == LEAST_LENGTH:
                        continue
                    at, whole = h % len(run), word.decode()
                    word = (whole[:at] + whole[at + 1:]).encode()
                held[word] = held.get(word, 0) + times
            if len(held) > KEPT:
                yield flushed()
    yield flushed()


def words_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``LEAST_LENGTH`` letters that occur ``LEAST_TIMES``.

    In one document of 31, as the key and the word decide, a word misses a letter.
    """
    read = docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    return (
        read.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_TIMES)
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, form) for every row of the staged table (word, n): how many words
    are one edit away, and of those the one with largest n. No form and n_near 0 if there are none."""
    spark = words.sparkSession
    total = words.count()
    share = min(1.0, SAMPLE / max(total, 1))
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = sorted(r[0] for r in drawn.select("word").collect())  # about SAMPLE at most
    trees, cells = _cells_of(sample, share)
    sizes = (
        words.mapInArrow(_sizer(trees), "length int, cell int, n long").groupBy("length", "cell")
        .agg(F.sum("n").alias("n"))
    )
    large = sizes.where((F.col("n") > MOST) | (F.col("n") * F.col("length") > MOST_BYTES)).collect()
    parts = {
        (r["length"], r["cell"]): -(-max(r["n"] * MOST_BYTES, r["n"] * r["length"] * MOST) // (MOST * MOST_BYTES))
        for r in large  # of cells larger than the sample foretold only
    }
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(3 * cells + sum(parts.values()), 20_000))
    found = (
        words.mapInArrow(_router(trees, parts), "length int, cell int, part int, kind int, word string, n long")
        .repartition(tasks, "length", "cell", "part")
        .sortWithinPartitions("length", "cell", "part", "kind", "word").mapInArrow(_searched, FOUND)
    )
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                        F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct(-F.col("best_n"), "form")))
    return (
        found.unionByName(none).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n", "n_near", (-F.col("best.col1")).alias("best_n"), "best.form")
    )


def _sizer(trees: Cells):
    """How many words of a batch belong to each cell."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "word"):
            by_length: dict[int, list[str]] = {}
            for word in batch.column("word").to_pylist():
                by_length.setdefault(len(word), []).append(word)
            out = []
            for length, words in by_length.items():
                if length in trees:
                    out += [(length, c, len(r)) for c, r in _routes(trees[length], _counts(_matrix(words)), 0, 0)]
                else:
                    out.append((length, -1, len(words)))
            kinds = (pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], ["length", "cell", "n"]
            )

    return sizes


def _roots(forms: DataFrame) -> tuple[DataFrame, str]:
    """Staged (word, root) for (word, form), and its path: each round doubles the steps taken.

    A form is ``RATIO`` times as frequent as its word, so no chain has more than 18 steps.
    """
    known, path = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved, next_path = staged(known.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        ), "roots")
        discard(known.sparkSession, path)
        path = next_path
        known = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return known, path


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per word: ``word, form, root, n, n_near, form_n``.

    ``form`` is the most frequent of the words one edit away if it is ``RATIO`` times as frequent
    as the word, else null; ``root`` is where following forms ends (the word itself without one).
    """
    words, path = staged(words_of(docs, key, text), "words")
    near, near_path = staged(near_words(words), "near-words")
    discard(docs.sparkSession, path)
    kept = F.col("best_n") >= RATIO * F.col("n")
    out = near.select(
        "word", F.when(kept, F.col("form")).alias("form"), "n", "n_near", F.when(kept, F.col("best_n")).alias("form_n"),
    )
    roots, _ = _roots(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
