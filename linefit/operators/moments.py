"""First and second moments of label and features: all a linear model needs of its rows.

One aggregate gives n, the means and the centred sums of products. Training statistics of a
cross-validation fold are the other folds' statistics added up, and gradients, ridge weights
and errors are functions of them, so a whole grid costs one scan.

Three widths of feature vector:

* up to ``FEW`` one covariance per pair of columns: tasks keep deviations from their running
  means and merge them pairwise, so a column far from zero loses no digits;
* up to ``NARROW`` one ``sum`` per pair of columns, all in generated code (so many covariances
  would be too much code: they took seven times as long at 9 features, the same at 3);
* up to ``WIDE`` each task turns its Arrow batches into one matrix per group with numpy, and
  the matrix rows are added by a partial-then-final vector sum;
* beyond, the matrix would outgrow a task's data, and estimators read the rows once per
  iteration instead (``solver``), unless they are told to take moments.

The driver receives (groups × width²) numbers, never rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefit.functions import vectors as V

FEW = 4
NARROW = 9
WIDE = 2000
BRANCHES = 256
PIECE = 2_000_000
# Below this share of the squared mean a variance has lost too many digits to be trusted.
CANCELLED = 1e-5


class BadRows(ValueError):
    """Rows a model cannot be fitted on: a null, NaN or infinite value, or another width."""


@dataclass(frozen=True)
class Moments:
    """Statistics of the columns (features…, label) over ``n`` rows."""

    n: int
    mean: np.ndarray
    products: np.ndarray  # sums of products of deviations from the mean

    @staticmethod
    def from_sums(n: int, sums: np.ndarray, products: np.ndarray, origin: np.ndarray) -> Moments:
        """From plain sums of ``z - origin`` and of their products."""
        mean = sums / n
        return Moments(n, origin + mean, products - n * np.outer(mean, mean))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(
            n,
            self.mean + gap * (other.n / n),
            self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n),
        )

    @property
    def width(self) -> int:
        return len(self.mean) - 1

    def rmse(self, weights: np.ndarray, intercept: float = 0.0) -> float:
        """Error of a linear model on these rows."""
        c = np.append(-np.asarray(weights, dtype=float), 1.0)
        spread = c @ self.products @ c / self.n
        offset = c @ self.mean - intercept
        return float(np.sqrt(max(spread, 0.0) + offset**2))

    def is_certain(self, weights: np.ndarray, certain: float = 1e-6) -> bool:
        """Whether :meth:`rmse` has enough digits: not so where a fit is near perfect and the
        error is the small difference of large sums."""
        c = np.append(-np.asarray(weights, dtype=float), 1.0)
        return bool(c @ self.products @ c > certain * (abs(c) @ abs(self.products) @ abs(c)))

    def gradient(self, weights: np.ndarray) -> np.ndarray:
        """Sum over the rows of (w·x − y)·x, without intercept."""
        c = np.append(np.asarray(weights, dtype=float), -1.0)
        return (self.products @ c + self.n * self.mean * (self.mean @ c))[:-1]


def merge(parts: Iterable[Moments]) -> Moments:
    return reduce(add, parts)


def feature_width(df: DataFrame, features: str) -> int:
    """Width of the feature vectors: from metadata, else from one row."""
    width = V.known_width(df, features)
    if width is None:
        row = df.select(F.size(V.as_array(df, features))).first()
        if row is None:
            raise ValueError("no rows to fit on")
        width = row[0]
    if width is None or width < 1:
        raise BadRows(f"column {features!r} starts with a null or empty vector")
    return width


def _usable(columns: Sequence[Column]) -> Column:
    """True where every column is a finite number (0·x is 0 only for those)."""
    zero = reduce(add, [c * F.lit(0.0) for c in columns])
    return F.coalesce(zero == 0.0, F.lit(False))


def _raise_bad(bad: int, rows: int) -> None:
    if rows == 0:
        raise ValueError("no rows to fit on")
    if bad:
        raise BadRows(
            f"{bad} of {rows} rows hold a null, non-finite or wrongly sized value; "
            "take them out first (see finite_rows)"
        )


def finite_rows(
    df: DataFrame, label: str = "label", features: str = "features", width: int | None = None
) -> DataFrame:
    """The rows a model can be fitted on.

    Where neither ``width`` nor the column's metadata tells how wide vectors should be, one
    aggregate looks at all of them, and more than one width is an error.
    """
    v = V.as_array(df, features)
    width = width or V.known_width(df, features)
    if width is None:
        found = df.where(v.isNotNull()).agg(F.min(F.size(v)), F.max(F.size(v))).first()
        if found[0] is None:
            return df.limit(0)
        if found[0] != found[1]:
            raise BadRows(f"vectors are {found[0]} to {found[1]} wide: say which width is right")
        width = found[0]
    if width <= V.WRITTEN_OUT:
        usable = _usable([F.col(label), *[V.element(v, j) for j in range(width)]])
    else:
        usable = _usable([F.col(label)]) & F.forall(v, lambda x: _usable([x]))
    return df.filter(usable & (F.size(v) == width))


def collect_moments(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    by: Column | None = None,
    width: int | None = None,
) -> dict:
    """Moments per value of ``by`` (one entry, None, without it), which has to be a column of
    few values such as a fold: the driver receives width² numbers for each.

    Beyond ``FEW`` features the sums start from zero. Where a column turns out to vary little
    around a large mean, they are taken a second time around the means found, which keeps all digits.
    """
    width = width or feature_width(df, features)
    sums_of = _narrow_sums if width <= NARROW else _wide_sums
    group = F.lit(None).cast("int") if by is None else by
    rows = df.select(
        group.alias("group"),
        V.as_array(df, features).alias("x"),
        F.col(label).cast("double").alias("y"),
    )
    if width <= FEW:
        return _covariances(rows, width, by is not None)
    origin = np.zeros(width + 1)
    found = sums_of(rows, width, origin, by is not None)
    total = merge(found.values())
    variance = np.diag(total.products) / total.n
    if np.any(variance < CANCELLED * total.mean**2):
        found = sums_of(rows, width, total.mean, by is not None)
    return found


def _covariances(rows: DataFrame, width: int, grouped: bool) -> dict:
    z = [V.element(F.col("x"), j) for j in range(width)] + [F.col("y")]
    pairs = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    table = rows.groupBy(*(["group"] if grouped else [])).agg(
        F.count("*").alias("n"),
        F.count_if(_usable(z) & (F.size("x") == width)).alias("usable"),
        *[F.avg(c) for c in z],
        *[F.var_pop(z[i]) if i == j else F.covar_pop(z[i], z[j]) for i, j in pairs],
    ).collect()
    counted = sum(r["n"] for r in table)
    _raise_bad(counted - sum(r["usable"] for r in table), counted)
    found = {}
    for r in table:
        values = list(r)[3:] if grouped else list(r)[2:]
        products = np.empty((width + 1, width + 1))
        for (i, j), value in zip(pairs, values[width + 1 :]):
            products[i, j] = products[j, i] = value * r["n"]
        found[r["group"] if grouped else None] = Moments(r["n"], np.array(values[: width + 1]), products)
    return found


def _narrow_sums(rows: DataFrame, width: int, origin: np.ndarray, grouped: bool) -> dict:
    raw = [V.element(F.col("x"), j) for j in range(width)] + [F.col("y")]
    z = [c - F.lit(float(o)) if o else c for c, o in zip(raw, origin)]
    pairs = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    table = rows.groupBy(*(["group"] if grouped else [])).agg(
        F.count("*").alias("n"),
        F.count_if(_usable(raw) & (F.size("x") == width)).alias("usable"),
        *[F.sum(c) for c in z],
        *[F.sum(z[i] * z[j]) for i, j in pairs],
    ).collect()
    counted = sum(r["n"] for r in table)
    _raise_bad(counted - sum(r["usable"] for r in table), counted)
    found = {}
    for r in table:
        values = list(r)[3:] if grouped else list(r)[2:]
        products = np.empty((width + 1, width + 1))
        for (i, j), value in zip(pairs, values[width + 1 :]):
            products[i, j] = products[j, i] = value
        found[r["group"] if grouped else None] = Moments.from_sums(
            r["n"], np.array(values[: width + 1]), products, origin
        )
    return found


def _batch_reader(width: int):
    """Function over Arrow batches: for each piece of a batch its usable rows (features…,
    label) as a matrix, their positions in the piece, and the number of other rows.

    Pieces hold at most ``PIECE`` numbers, which bounds a task's memory at any width. It is an
    inner function so that tasks receive its code and need not have this package installed.
    """
    length = max(1, PIECE // width)

    def rows_of(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, int]:
        vectors = piece.column("x")
        sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        fits = sizes == width
        if not fits.all():
            vectors = vectors.filter(pa.array(fits))
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        y = piece.column("y").to_numpy(zero_copy_only=False).astype(float)[fits]
        z = np.column_stack([x, y])
        good = np.isfinite(z).all(axis=1)
        return z[good], np.flatnonzero(fits)[good], piece.num_rows - int(good.sum())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, length):
                piece = batch.slice(start, length)
                yield piece, *rows_of(piece)

    return read


def _wide_sums(rows: DataFrame, width: int, origin: np.ndarray, grouped: bool) -> dict:
    """Each task adds up (1, z)ᵀ(1, z) per group; row i of the matrix travels as one vector,
    from its diagonal element on (the matrix is symmetric).

    Row 0 is (count, sums); an extra row −1 counts the unusable rows. A task sends width²/2
    numbers per group however many rows it read, so larger input splits make this cheaper. The
    tasks' rows are added in two steps, so that no task takes in one from each of them.
    """

    kind = rows.schema["group"].dataType.simpleString()
    if kind != "string":
        rows = rows.withColumn("group", F.col("group").cast("bigint"))
        kind = "bigint"
    group_type = pa.string() if kind == "string" else pa.int64()
    read = _batch_reader(width)

    def vectors(group, index, lines) -> pa.RecordBatch:
        columns = [
            pa.array([group] * len(lines), group_type),
            pa.array(index, pa.int32()),
            pa.array(lines, pa.list_(pa.float64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["group", "i", "row"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices: dict = {}
        bad = 0
        for batch, z, position, unusable in read(batches):
            bad += unusable
            augmented = np.column_stack([np.ones(len(z)), z - origin])
            if not grouped:
                matrices[None] = matrices.get(None, 0.0) + augmented.T @ augmented
                continue
            coded = batch.column("group").dictionary_encode()
            codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)[position]
            for code in np.unique(codes):
                g = None if code < 0 else coded.dictionary[int(code)].as_py()
                part = augmented[codes == code]
                matrices[g] = matrices.get(g, 0.0) + part.T @ part
        if bad:
            yield vectors(None, [-1], [np.array([float(bad)])])
        for g, matrix in matrices.items():
            yield vectors(g, range(len(matrix)), [line[i:] for i, line in enumerate(matrix)])

    table = (
        rows.mapInArrow(partial, f"group {kind}, i int, row array<double>")
        .groupBy("group", "i", (F.spark_partition_id() % BRANCHES).alias("branch"))
        .agg(Summarizer.sum(array_to_vector("row")).alias("row"))
        .groupBy("group", "i")
        .agg(Summarizer.sum(F.col("row")).alias("row"))
        .select("group", "i", vector_to_array("row").alias("row"))
        .collect()
    )
    bad = sum(int(round(r["row"][0])) for r in table if r["i"] == -1)
    matrices: dict = {}
    for r in table:
        i = r["i"]
        if i >= 0:
            matrix = matrices.setdefault(r["group"], np.empty((width + 2, width + 2)))
            matrix[i, i:] = matrix[i:, i] = r["row"]
    counted = {g: int(round(m[0, 0])) for g, m in matrices.items()}
    _raise_bad(bad, bad + sum(counted.values()))
    return {
        g: Moments.from_sums(counted[g], m[0, 1:], m[1:, 1:], origin) for g, m in matrices.items()
    }


def squared_loss(
    rows: DataFrame, weights: np.ndarray, label: str = "label", features: str = "features"
) -> tuple[int, float, np.ndarray]:
    """Row count, sum of squared errors and gradient for given weights, at any width.

    The tasks' gradients are added in two steps, so that no single task has to take in one
    from each of them.
    """
    w = np.asarray(weights, dtype=float)
    read = _batch_reader(len(w))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) + 3)
        for _, z, _, unusable in read(batches):
            error = z[:, :-1] @ w - z[:, -1]
            total[:3] += len(z), unusable, error @ error
            total[3:] += error @ z[:, :-1]
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["row"])

    narrow = rows.select(
        V.as_array(rows, features).alias("x"), F.col(label).cast("double").alias("y")
    )
    total = (
        narrow.mapInArrow(partial, "row array<double>")
        .groupBy((F.spark_partition_id() % BRANCHES).alias("branch"))
        .agg(Summarizer.sum(array_to_vector("row")).alias("row"))
        .agg(Summarizer.sum(F.col("row")).alias("row"))
        .first()["row"]
        .toArray()
    )
    n, bad = (int(round(v)) for v in total[:2])
    _raise_bad(bad, n + bad)
    return n, float(total[2]), total[3:]
