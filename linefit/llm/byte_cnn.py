"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes (A-Z lower-cased) are cut into windows of ``WINDOW`` bytes. Bytes are
embedded, filters of several widths slide over them, the largest answer of each filter in the
window passes a rectifier and a softmax layer gives the languages' shares. A text's shares are
those of its windows, weighted by their bytes. The network is trained in numpy on at most
``PER_LANGUAGE`` windows of each language, drawn from labelled rows by a hash of their key.

Filters act on bytes one by one, so their parts are tabulated for pairs of bytes; applying
them is table look-ups and maxima over batches of windows.

Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing is
labelled; an empty table gives no rows. Repeated rows give repeated results. Other columns are
carried as they are, whatever their names; only the two new ones may not be taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefit.llm.common import named, once_per_process, pieces_of, row_of, unpacked

WINDOW, EMBEDDED, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
PER_LANGUAGE, EPOCHS, BATCH, RATE = 1500, 6, 64, 0.004
UNKNOWN = "und"
#: Windows that are in memory at once when the network is applied.
AT_ONCE = 256

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def windows_of(data: bytes) -> np.ndarray:
    """Rows of ``WINDOW`` bytes; the last one is filled up with zeros."""
    padded = data.translate(_LOWER) + bytes(-len(data) % WINDOW)
    return np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 × EMBEDDED
    filters: dict[int, np.ndarray]  # width → (width·EMBEDDED) × FILTERS
    offsets: dict[int, np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def tables(self) -> dict[int, tuple[np.ndarray, np.ndarray | None]]:
        """For each width: what a pair of bytes adds at its start, and what the rest adds."""
        made = {}
        for width, w in self.filters.items():
            parts = [self.embedding @ w[k * EMBEDDED : (k + 1) * EMBEDDED] for k in range(width)]
            pair = lambda a, b: (a[:, None] + b[None]).reshape(65_536, FILTERS)
            rest = None if width == 2 else parts[2] if width == 3 else pair(parts[2], parts[3])
            made[width] = (pair(parts[0], parts[1]).astype(np.float32), rest)
        return made

    def shares(self, windows: np.ndarray, tables) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        pooled = []
        for width, (first, rest) in tables.items():
            last = WINDOW - width + 1
            seen = first[pairs[:, :last]]
            if width == 3:
                seen += rest[windows[:, 2:]]
            elif width == 4:
                seen += rest[pairs[:, 2:]]
            pooled.append(seen.max(axis=1) + self.offsets[width])
        return softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.weights + self.bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 5) -> Network:
    """Adam over batches; gradients reach only the place where each filter answered most."""
    random = np.random.default_rng(seed)
    scale = lambda *shape: random.standard_normal(shape).astype(np.float32) * 0.2
    net = Network(
        languages, scale(256, EMBEDDED), {w: scale(w * EMBEDDED, FILTERS) for w in WIDTHS},
        {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
        scale(len(WIDTHS) * FILTERS, len(languages)), np.zeros(len(languages), np.float32),
    )
    values = [net.embedding, *net.filters.values(), *net.offsets.values(), net.weights, net.bias]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(EPOCHS):
        order = random.permutation(len(windows))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            grads = _gradients(net, windows[rows], labels[rows])
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for v, g, m, s in zip(values, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * m / (np.sqrt(s) + 1e-8)
    return net


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    n = len(windows)
    embedded = net.embedding[windows]
    pooled, places, columns = [], [], []
    for width in WIDTHS:
        last = WINDOW - width + 1
        seen = np.concatenate([embedded[:, k : k + last] for k in range(width)], axis=2)
        answer = seen @ net.filters[width]
        place = answer.argmax(axis=1)
        pooled.append(np.take_along_axis(answer, place[:, None], 1)[:, 0] + net.offsets[width])
        columns.append(seen[np.arange(n)[:, None], place])  # n × FILTERS × (width·EMBEDDED)
        places.append(place)
    hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
    error = softmax(hidden @ net.weights + net.bias)
    error[np.arange(n), labels] -= 1
    error /= n
    back = (error @ net.weights.T) * (hidden > 0)
    d_embedding = np.zeros_like(net.embedding)
    d_filters, d_offsets = [], []
    for i, width in enumerate(WIDTHS):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        d_filters.append(np.einsum("nf,nfd->df", g, columns[i]))
        d_offsets.append(g.sum(axis=0))
        to_bytes = (g[:, :, None] * net.filters[width].T[None]).reshape(n, FILTERS, width, EMBEDDED)
        for k in range(width):
            np.add.at(d_embedding, windows[np.arange(n)[:, None], places[i] + k], to_bytes[:, :, k])
    return [d_embedding, *d_filters, *d_offsets, hidden.T @ error, error.sum(axis=0)]


def learn(
    docs: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Network | None:
    """A network from the rows with ``usable`` and a label, or None if there are none.

    Of each language, the ``per_language`` rows whose hashes are smallest give one window each,
    from a place that a hash picks; of equal rows one counts. How many different rows a language
    has, about, tells below which hash they lie, so only a few more are gathered and sorted.
    """
    body = named(text)
    place = F.xxhash64(named(key), F.length(body))
    begin = F.pmod(place, F.greatest(F.length(body) - WINDOW, F.lit(1))).cast("int") + 1
    rows = docs.where(usable & named(label).isNotNull() & body.rlike("\\p{L}")).select(
        named(label).alias("label"), F.substring(body, begin, F.lit(WINDOW)).alias("snippet"),
        place.alias("place"),
    ).withColumn("order", F.xxhash64("place", "snippet"))
    sizes = rows.groupBy("label").agg(F.approx_count_distinct("order", 0.02).alias("n")).collect()
    if not sizes:
        return None
    wanted = 1.2 * per_language + 200
    cuts = docs.sparkSession.createDataFrame(  # one row per language
        [(r["label"], -(1 << 63) + min((1 << 64) - 1, int((1 << 64) * wanted / max(r["n"], 1)))) for r in sizes],
        "label string, cut long",
    )
    few = rows.join(F.broadcast(cuts), "label").where(F.col("order") <= F.col("cut")).drop("cut").distinct()
    nth = F.row_number().over(W.partitionBy("label").orderBy("order", "place", "snippet"))
    sample = few.withColumn("nth", nth).where(F.col("nth") <= per_language).orderBy("label", "nth")
    # languages × per_language short texts
    found = [(r["label"], r["snippet"]) for r in sample.select("label", "snippet").collect()]
    languages = sorted({name for name, _ in found})
    at = {name: i for i, name in enumerate(languages)}
    windows = np.stack([windows_of(snippet.encode() or b" ")[0] for _, snippet in found])
    return train(windows, np.array([at[name] for name, _ in found]), languages)


def scored(
    docs: DataFrame, network: Network | None, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the columns ``carry``, or all, but the text), the text if it is carried as ``text``,
    ``language`` and ``share`` of the whole text.

    Of languages with equal shares the first in order is taken. Texts of any length are read
    window by window.
    """
    body = named(text)
    lettered = F.coalesce(body.rlike("\\p{L}"), F.lit(False))
    carry = docs.columns if carry is None else carry
    kept = ["row", "text"] if text in carry else ["row"]
    rows = docs.select(row_of(docs, [c for c in carry if c != text]), body.alias("text"), lettered.alias("lettered"))
    if network is None:
        return rows.select(*kept, F.lit(UNKNOWN).alias("language"), F.lit(0.0).alias("share"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = once_per_process("cnn", network.weights.tobytes(), network.tables)
        for batch in pieces_of(batches, "text", 1 << 20):
            names, shares = [], []
            for body, letters in zip(batch.column("text").to_pylist(), batch.column("lettered").to_pylist()):
                if not letters:
                    names.append(UNKNOWN)
                    shares.append(0.0)
                    continue
                data = body.encode()
                windows, total = windows_of(data), np.zeros(len(network.languages))
                for start in range(0, len(windows), AT_ONCE):
                    part = network.shares(windows[start : start + AT_ONCE], tables)
                    weight = np.full(len(part), WINDOW)
                    if start + AT_ONCE >= len(windows):
                        weight[-1] = len(data) - (len(windows) - 1) * WINDOW
                    total += weight @ part
                best = int(total.argmax())
                names.append(network.languages[best])
                shares.append(min(1.0, float(total[best] / len(data))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(shares, pa.float64())],
                [*kept, "language", "share"],
            )

    schema = T.StructType([
        *(rows.schema[c] for c in kept), T.StructField("language", T.StringType()), T.StructField("share", T.DoubleType()),
    ])
    return rows.mapInArrow(score, schema)


def predict(
    docs: DataFrame, network: Network | None, text: str = "text", carry: list[str] | None = None,
    language: str = "_language", share: str = "_share",
) -> DataFrame:
    """The columns ``carry`` (all, if None) with the language and its share, named as asked."""
    carry = docs.columns if carry is None else carry
    clash = {language, share} & set(carry)
    if clash:
        raise ValueError(f"the table has columns {sorted(clash)}: give the new ones other names")
    found = scored(docs, network, text, carry)
    columns = unpacked(found, carry, {text: F.col("text")} if text in carry else {})
    return found.select(*columns, F.col("language").alias(language), F.col("share").alias(share))
