"""Whitening of embeddings by an incremental eigendecomposition.

A vector's entries c become integers x = floor(64 c) + 1000000 (``scale`` and
``offset``), so that counts, sums and deviations are exact. The eigenvectors of
the covariance of all vectors come from three steps:

1. Every task keeps a few spectra (lanes) and applies one centred rank-one
   update per vector: the eigenvalues of D + z z' are the roots of the secular
   equation 1 + sum z_i^2 / (d_i - t) = 0, found between the poles by a
   rational iteration inside a shrinking bracket. Entries of z that are
   negligible, and equal poles after a rotation, are deflated: they keep their
   eigenpair. The eigenvectors are those of the roots found (Loewner's
   formula), so they stay orthogonal.
2. Lanes, then tasks, are combined by successive rank-one updates: one per
   eigenpair of the other spectrum, one for the difference of the means. Tasks
   meet in a tree of ``trees.FAN_IN`` spectra per group; a spectrum is d^2 numbers.
3. A distributed Rayleigh-Ritz step projects the exactly centred vectors on the
   basis found, sums the d x d matrix of products in the same tree, and turns
   the basis by its eigenvectors. A last pass measures the covariance of the
   whitened vectors against the identity.

Only sums, spectra and matrices of the dimension's size reach the driver.

Defined results: rows whose vector is null or empty, or holds a null,
non-finite or huge entry (2^46 or more, whose x would leave the long range),
are dropped; if lengths differ, so are rows without the commonest length (of
equally common ones the least). Repeated rows count each. A null id is kept. A
deviation beyond the long range is null. Components whose eigenvalue is not
above 1e-12 of the trace cannot be scaled and are left out, so a table of equal
vectors gives rows without components; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded
from sift.llm.trees import in_tree

SCALE, OFFSET = 64.0, 1_000_000
LANES = 16
_EPS = np.finfo(np.float64).eps
_ROOT = 1e-13  # of the size of its terms, the secular function at a root
_LARGEST = 2.0 ** 46
_LONG = 2 ** 63 - 1


def _deflate_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, tol: np.ndarray) -> None:
    """Rotates the eigenvectors of equal poles, so that only the last of them
    has a part in z. In place; poles ascend."""
    equal = values[:, 1:] - values[:, :-1] <= tol[:, None]
    for i in np.flatnonzero(equal.any(axis=0)):
        lanes = np.flatnonzero(equal[:, i] & (z[:, i] != 0))
        if not len(lanes):
            continue
        a, b = z[lanes, i], z[lanes, i + 1]
        r = np.hypot(a, b)
        s, c = (a / r)[:, None], (b / r)[:, None]
        low, high = vectors[lanes, :, i], vectors[lanes, :, i + 1]
        vectors[lanes, :, i], vectors[lanes, :, i + 1] = c * low - s * high, s * low + c * high
        z[lanes, i], z[lanes, i + 1] = 0.0, r


def _secular_roots(values: np.ndarray, z2: np.ndarray, active: np.ndarray):
    """Per lane and active pole i the root above it, as root i minus pole j (an
    array lanes x i x j, accurate also next to a pole), and the roots."""
    d = values.shape[1]
    total = z2.sum(axis=1, keepdims=True)
    following = np.where(active, np.arange(d), d)
    following = np.minimum.accumulate(following[:, ::-1], axis=1)[:, ::-1]
    following = np.concatenate([following[:, 1:], np.full((len(values), 1), d)], axis=1)
    last, following = following == d, np.minimum(following, d - 1)
    above = np.where(last, values + total, np.take_along_axis(values, following, axis=1))
    width = np.where(active, above - values, 1.0)
    below = np.tri(d)
    weight = z2[:, None, :]
    seen = np.where(active, values, np.inf)  # a deflated pole has no part

    def at(poles, mu):
        gap = poles - mu[:, :, None]
        part = weight / gap
        negative, total = np.einsum("gij,ij->gi", part, below), part.sum(axis=2)
        return total + 1.0, total - 2 * negative + 1.0, np.divide(part, gap, out=part)

    middle, _, _ = at(seen[:, None, :] - values[:, :, None], width / 2)
    from_above = (middle < 0) & ~last & active  # the root lies nearer to the pole above
    origin = np.where(from_above, above, values)
    poles = seen[:, None, :] - origin[:, :, None]
    low = np.where(from_above, -width / 2, 0.0)
    high = np.where(from_above, 0.0, np.where(last, width, width / 2))
    upper = np.take_along_axis(z2, following, axis=1)  # start: the two poles next to the root, the rest constant
    with np.errstate(all="ignore"):
        c = middle + 2 * (z2 - upper) / width
        a, b = c * width + z2 + upper, z2 * width
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        mu = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root)) - (origin - values)
    mu = np.where(~last & (mu > low) & (mu < high), mu, (low + high) / 2)
    first, second = values - origin, above - origin
    for _ in range(60):
        f, size, slope = at(poles, mu)
        open_ = active & (np.abs(f) > _ROOT * size) & (high - low > 2 * _EPS * np.abs(mu))
        if not open_.any():
            break
        low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
        psi = np.einsum("gij,ij->gi", slope, below)
        phi = slope.sum(axis=2) - psi
        one, two = first - mu, second - mu
        with np.errstate(all="ignore"):
            a = (one + two) * f - one * two * (psi + phi)
            b, c = one * two * f, f - one * psi - two * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, one + one * one * psi / (f - one * psi), step)
            new = mu + step
        inside = (new > low) & (new < high)
        mu = np.where(open_, np.where(inside, new, (low + high) / 2), mu)
    return mu[:, :, None] - poles, origin + mu  # the gap to a deflated pole is not used


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray):
    """Spectra of A + v v' from those of A, lane by lane: ascending ``values``
    (lanes, d) and ``vectors`` (lanes, d, d) in columns; A has no negative
    eigenvalue."""
    z = np.matmul(v[:, None, :], vectors)[:, 0]
    norm = np.sqrt((z * z).sum(axis=1))
    tol = 8 * _EPS * np.maximum(values[:, -1], norm * norm)
    if (values[:, 1:] - values[:, :-1] <= tol[:, None]).any():
        vectors = vectors.copy()
        _deflate_equal(values, vectors, z, tol)
    active = np.abs(z) * norm[:, None] > tol[:, None]
    if not active.any():
        return values, vectors
    z = np.where(active, z, 0.0)
    gap, roots = _secular_roots(values, z * z, active)
    pair = active[:, :, None] & active[:, None, :]
    own = np.eye(values.shape[1], dtype=bool)[None]
    apart = np.where(own | ~pair, 1.0, values[:, :, None] - values[:, None, :])
    z_new = np.sqrt(np.abs(np.prod(np.where(pair, gap / apart, 1.0), axis=1)))
    z_new = np.where(active, np.copysign(z_new, z), 0.0)
    turn = np.where(pair, z_new[:, None, :] / np.where(pair, -gap, 1.0), 0.0)
    turn /= np.maximum(np.sqrt((turn * turn).sum(axis=2, keepdims=True)), 1e-300)
    turn = np.where(own & ~active[:, :, None], 1.0, turn)
    values = np.where(active, roots, values)
    vectors = np.matmul(vectors, turn.transpose(0, 2, 1))
    if (values[:, 1:] < values[:, :-1]).any():
        order = np.argsort(values, axis=1, kind="stable")
        values = np.take_along_axis(values, order, axis=1)
        vectors = np.take_along_axis(vectors, order[:, None, :], axis=2)
    return values, vectors


class Spectra:
    """Counts, means and spectra of the scatter of several lanes of vectors."""

    def __init__(self, lanes: int, d: int):
        self.n, self.mean = np.zeros(lanes), np.zeros((lanes, d))
        self.values, self.vectors = np.zeros((lanes, d)), np.tile(np.eye(d), (lanes, 1, 1))

    def add(self, rows: np.ndarray) -> None:
        """One row to each of the first ``len(rows)`` lanes."""
        v = np.zeros_like(self.mean)
        k = len(rows)
        v[:k] = rows - self.mean[:k]
        after = self.n[:k] + 1
        self.mean[:k] += v[:k] / after[:, None]
        v[:k] *= np.sqrt(self.n[:k] / after)[:, None]
        self.n[:k] = after
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _half(self, start: int, stop: int) -> Spectra:
        part = Spectra.__new__(Spectra)
        part.n, part.mean = self.n[start:stop].copy(), self.mean[start:stop].copy()
        part.values, part.vectors = self.values[start:stop].copy(), self.vectors[start:stop].copy()
        return part

    def absorb(self, other: Spectra) -> None:
        """The lanes of ``other`` into the first lanes of this one."""
        k = len(other.n)
        for j in range(other.values.shape[1] - 1, -1, -1):
            weight = np.sqrt(np.maximum(other.values[:, j], 0.0))
            if not weight.any():
                continue
            v = np.zeros_like(self.mean)
            v[:k] = weight[:, None] * other.vectors[:, :, j]
            self.values, self.vectors = rank_one(self.values, self.vectors, v)
        both = self.n[:k] + other.n
        share = other.n / np.maximum(both, 1)
        v, apart = np.zeros_like(self.mean), other.mean - self.mean[:k]
        v[:k] = np.sqrt(self.n[:k] * share)[:, None] * apart
        self.values, self.vectors = rank_one(self.values, self.vectors, v)
        self.mean[:k] += share[:, None] * apart
        self.n[:k] = both

    def joined(self) -> Spectra:
        """One lane of all."""
        lanes = self
        while len(lanes.n) > 1:
            half = (len(lanes.n) + 1) // 2
            left, right = lanes._half(0, half), lanes._half(half, len(lanes.n))
            left.absorb(right)
            lanes = left
        return lanes


def _integers(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return np.floor(SCALE * flat).astype(np.int64)


_SPECTRUM = "slot long, n long, sums array<long>, mean array<double>, numbers array<double>"


def _spectrum_batch(slot: int, n: int, sums: list, spectrum: Spectra) -> pa.RecordBatch:
    numbers = np.concatenate([spectrum.values[0], spectrum.vectors[0].reshape(-1)])
    return pa.RecordBatch.from_arrays(
        [pa.array([slot], pa.int64()), pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.int64())),
         pa.array([spectrum.mean[0]], pa.list_(pa.float64())), pa.array([numbers], pa.list_(pa.float64()))],
        names=["slot", "n", "sums", "mean", "numbers"])


def _updater(d: int):
    """The spectrum of a task's vectors, without the offset."""

    def run(batches):
        from pyspark import TaskContext
        lanes, n, sums = None, 0, np.zeros(d, object)
        for batch in batches:
            x = _integers(batch.column(0), d)
            if lanes is None and len(x):
                lanes = Spectra(max(1, min(LANES, 65536 // (d * d), len(x) // d)), d)
            n += len(x)
            sums += x.sum(axis=0)
            for at in range(0, len(x), len(lanes.n) if lanes else 1):
                lanes.add(x[at:at + len(lanes.n)].astype(np.float64))
        if n:
            yield _spectrum_batch(TaskContext.get().partitionId(), n, [int(s) for s in sums], lanes.joined())

    return run


def _combiner(d: int):
    def run(key, table):
        total, n, sums = None, 0, [0] * d
        for row in table.sort_by("slot").to_pylist():
            numbers, one = np.array(row["numbers"]), Spectra(1, d)
            one.n[0], one.mean[0] = row["n"], row["mean"]
            one.values[0], one.vectors[0] = numbers[:d], numbers[d:].reshape(d, d)
            n, sums = n + row["n"], [a + b for a, b in zip(sums, row["sums"])]
            if total is None:
                total = one
            else:
                total.absorb(one)
        return pa.Table.from_batches([_spectrum_batch(key[0].as_py(), n, sums, total)])

    return run


_MATRIX = "slot long, numbers array<double>"


def _matrix_batch(slot: int, numbers: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([slot], pa.int64()), pa.array([numbers.reshape(-1)], pa.list_(pa.float64()))],
        names=["slot", "numbers"])


def _adder(key, table):
    total = np.sum([np.array(row) for row in table.sort_by("slot")["numbers"].to_pylist()], axis=0)
    return pa.Table.from_batches([_matrix_batch(key[0].as_py(), total)])


@dataclass
class Whitening:
    """``components`` in columns, by falling ``eigenvalues`` (variances);
    ``explained`` shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def _centred(x: np.ndarray, n: int, sums: np.ndarray):
    """n x - S without the offset, exactly: 64-bit where it fits, else Python
    integers; and whether squares of it can be summed in 64 bits."""
    top = int(np.abs(x).max(initial=0))
    if n * top + max((abs(int(s)) for s in sums), default=0) < 2 ** 62:
        t = n * x - sums.astype(np.int64)
    else:
        t = n * x.astype(object) - sums
    largest = int(np.abs(t).max(initial=0))
    return t, t.dtype != object and largest * largest * x.shape[1] <= _LONG


def _valid(df: DataFrame, vec_col: str) -> DataFrame:
    entries = F.col(vec_col).cast("array<double>")
    sound = F.forall(entries, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < _LARGEST))
    return df.where(F.col(vec_col).isNotNull() & sound & (F.size(vec_col) > 0))


def _vectors(df: DataFrame, vec_col: str, d: int) -> DataFrame:
    return (_valid(df, vec_col).where(F.size(vec_col) == d)
            .select(F.col(vec_col).cast("array<double>").alias("vector")))


def fit(df: DataFrame, *, components: int = 32, vec_col: str = "embedding") -> Whitening | None:
    """The whitening of all valid vectors of ``df``; None if there is none."""
    df = bounded(df)
    common = (_valid(df, vec_col).groupBy(F.size(vec_col).alias("d")).count()
              .orderBy(F.desc("count"), "d").first())
    if common is None:
        return None
    d = common["d"]
    vectors = _vectors(df, vec_col, d)
    spectrum = in_tree(vectors.mapInArrow(_updater(d), _SPECTRUM), _combiner(d), _SPECTRUM, "spectra")
    n, sums = spectrum["n"], np.array(spectrum["sums"], object)
    basis = np.array(spectrum["numbers"])[d:].reshape(d, d)

    def products(matrix, batches):
        from pyspark import TaskContext
        total, k = None, matrix.shape[1]
        for batch in batches:
            t, _ = _centred(_integers(batch.column(0), d), n, sums)
            y = (t / n).astype(np.float64) @ matrix
            y = np.hstack([y, np.ones((len(y), 1))])
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _matrix_batch(TaskContext.get().partitionId(), total)

    def measured(matrix):
        """Covariance, centred, of the vectors projected on the columns."""
        rows = vectors.mapInArrow(lambda batches: products(matrix, batches), _MATRIX)
        size = matrix.shape[1] + 1
        total = np.array(in_tree(rows, _adder, _MATRIX, "products")["numbers"]).reshape(size, size) / n
        return total[:-1, :-1] - np.outer(total[-1, :-1], total[-1, :-1])

    ritz = measured(basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, found = values[::-1], (basis @ turn)[:, ::-1]
    trace = float(np.trace(ritz))
    keep = np.flatnonzero(values > 1e-12 * trace)[:components]
    values, found = values[keep], found[:, keep]
    found = found / np.sqrt((found * found).sum(axis=0))
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(len(keep))])
    error = 0.0
    if len(keep):
        error = float(np.abs(measured(found / np.sqrt(values)) - np.eye(len(keep))).max())
    return Whitening(n, [int(s) + OFFSET * n for s in sums], found, values, values / (trace or 1.0), error)


def whiten(df: DataFrame, model: Whitening, *, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per valid row of the model's dimension: ``vec_id``, ``deviation`` and
    ``whitened``, one number per component."""
    d, n = model.dimension, model.n
    sums = np.array([s - OFFSET * n for s in model.sums], object)
    scaled = model.components / np.sqrt(model.eigenvalues)

    def run(batches):
        for batch in batches:
            t, fits = _centred(_integers(batch.column(1), d), n, sums)
            if fits:
                deviation = pa.array((t * t).sum(axis=1), pa.int64())
            else:
                exact = [sum(int(e) ** 2 for e in row) for row in t]
                deviation = pa.array([e if e <= _LONG else None for e in exact], pa.int64())
            white = (t / n).astype(np.float64) @ scaled
            offsets = pa.array(np.arange(len(white) + 1, dtype=np.int32) * scaled.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), deviation, pa.ListArray.from_arrays(offsets, pa.array(white.reshape(-1)))],
                names=["vec_id", "deviation", "whitened"])

    rows = (_valid(bounded(df), vec_col).where(F.size(vec_col) == d)
            .select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector")))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {id_type}, deviation long, whitened array<double>")


def whitened_rows(df: DataFrame, *, components: int = 32, id_col: str = "vec_id",
                  vec_col: str = "embedding") -> DataFrame:
    """Per valid row and component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    model = fit(df, components=components, vec_col=vec_col)
    if model is None:
        id_type = df.schema[id_col].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            [], f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
                "explained double, identity_error double")
    shares = F.array(*[F.lit(float(e)) for e in model.explained])
    return (whiten(df, model, id_col=id_col, vec_col=vec_col)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", F.element_at(shares, F.col("place") + 1).alias("explained"),
                    F.lit(model.identity_error).alias("identity_error")))
