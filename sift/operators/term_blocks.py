"""Sums over texts and terms by blocks of terms, and logistic regressions on them (M3, M4, M7).

The 0/1 features of the texts are dealt by term into blocks, each whole in one
partition on the executors' disks. Vectors with a number per text travel; a
vector with a number per term never does: for residuals r of the texts a block
sums them by term (a gradient), scales the sums and adds them up by text again,
which are the margins of the texts under that gradient.

``minimise`` is spark.ml's training (Breeze's L-BFGS with a strong Wolfe search, on
standardised and centred features, coefficients penalised, the intercept not),
written on these margins. Every vector of L-BFGS starts at 0 and is a
combination of the gradients so far. So it is held as its few coefficients;
products follow from the gradients' products with each other, and a step along
a direction needs the direction's margins only. An iteration costs one pass over
the blocks, its line search none.

The driver holds, per text and fit of a pass, some ten numbers in memory and two
for each iteration in a local file; a pass takes as many fits as ``FIT_MB``
allows.
"""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Generator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_scratch_path
from .ngram_terms import bounded, stored

PAIRS = 6 << 20     # of text and term in a block, about
PART = 1 << 20      # of these at once
PIECE = 1 << 17     # numbers of a result in a row
FIT_MB = 32         # of one number per text and fit
_POSITIONS = 33     # monotonically_increasing_id: partition << 33 | position


def _dealer(starts, blocks: int):
    def run(batches):
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            rows = np.array([starts[i >> _POSITIONS] for i in ids.tolist()], np.int64) + (ids & ((1 << _POSITIONS) - 1))
            rows = np.repeat(rows, np.diff(lists.offsets.to_numpy())).astype(np.int32)
            terms = lists.flatten().to_numpy()
            block = terms % blocks
            order = np.argsort(block, kind="stable")
            rows, terms = rows[order], (terms // blocks)[order].astype(np.int32)
            ends = np.cumsum(np.bincount(block, minlength=blocks))
            some = np.flatnonzero(np.diff(ends, prepend=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32())] + [pa.array([x[(ends[b - 1] if b else 0):ends[b]].tobytes() for b in some.tolist()],
                                                         pa.binary()) for x in (rows, terms)],
                names=["block", "rows", "terms"])

    return run


def _pieces(values: np.ndarray, width: int, names):
    """Rows (piece, numbers) of a (columns, n) array, so many of n to a piece."""
    for at in range(0, values.shape[1], width):
        yield pa.RecordBatch.from_arrays(
            [pa.array([at // width], pa.int64()), pa.array([values[:, at:at + width].tobytes()], pa.binary())], names=names)


def _added(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            numbers = np.frombuffer(numbers)
            total[piece] = total[piece] + numbers if piece in total else numbers
    for piece, numbers in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([numbers.tobytes()], pa.binary())],
                                         names=["piece", "numbers"])


def _worker(sent, blocks: int, terms: int, texts: int, wanted: str):
    """Per block: sums of the residuals by term, scaled; added up by text
    (``wanted`` = rows), or as they are (terms)."""

    def run(batches):
        residuals, folds, outside = sent.value
        held: dict[int, list] = {}
        for batch in batches:
            for block, rows, ids in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(block, []).append((np.frombuffer(rows, np.int32), np.frombuffer(ids, np.int32)))
        columns = len(residuals)
        out, constant, some = np.zeros((columns, texts)) if wanted == "rows" else None, np.zeros(columns), bool(held)
        for block in list(held):
            pieces = held.pop(block)
            size = len(range(block, terms, blocks))
            parts, now, n = [], [], 0
            for piece in pieces:  # pieces of about PART pairs
                now.append(piece)
                n += len(piece[0])
                if n >= PART:
                    parts.append(tuple(np.concatenate(x) for x in zip(*now)))
                    now, n = [], 0
            if now:
                parts.append(tuple(np.concatenate(x) for x in zip(*now)))
            del pieces, now
            sums, mean = np.zeros((columns, size)), np.zeros(size)
            for rows, ids in parts:
                for c in range(columns):
                    sums[c] += np.bincount(ids, residuals[c][rows], size)
            if folds is not None:
                many = int(folds.max()) + 1 if len(folds) else 1
                counts = np.zeros(size * many)
                for rows, ids in parts:
                    counts += np.bincount(ids * np.int64(many) + folds[rows], minlength=size * many)
                counts, sizes = counts.reshape(size, many), np.bincount(folds, minlength=many)
                for c, left in enumerate(outside):
                    here = counts.sum(axis=1) - (counts[:, left] if left is not None else 0)
                    n = len(folds) - (sizes[left] if left is not None else 0)
                    with np.errstate(divide="ignore"):
                        inverse = np.where((here > 0) & (here < n), n * (n - 1) / (here * (n - here)), 0.0)
                    mean = here / n
                    sums[c] = inverse * (sums[c] - mean * residuals[c].sum())
                    constant[c] += (mean * sums[c]).sum()
            if wanted == "rows":
                for rows, ids in parts:
                    for c in range(columns):
                        out[c] += np.bincount(rows, sums[c][ids], texts)
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(block, terms, blocks)), pa.array(mean), *[pa.array(s) for s in sums]],
                    names=["term_id", "mean", *[f"w{c}" for c in range(columns)]])
        if wanted == "rows" and some:
            yield from _pieces(out - constant[:, None], max(1, PIECE // columns), ["piece", "numbers"])

    return run


@dataclass
class TermBlocks:
    """The (text, term) pairs of ``texts`` numbered texts and ``terms`` terms."""

    pairs: DataFrame
    blocks: int
    terms: int
    table: pa.Table                      # columns of the texts, in the order of their numbers
    folds: np.ndarray | None = None      # of the texts: features are then standardised within a fit's texts
    texts: int = field(init=False)

    def __post_init__(self):
        self.texts = self.table.num_rows

    def _run(self, residuals: list[np.ndarray], outside: list[int | None], wanted: str, schema: str) -> DataFrame:
        sent = self.pairs.sparkSession.sparkContext.broadcast((residuals, self.folds, outside))
        return self.pairs.mapInArrow(_worker(sent, self.blocks, self.terms, self.texts, wanted), schema)

    def margins(self, residuals: list[np.ndarray], outside: list[int | None]) -> np.ndarray:
        """For each residuals of the texts, the texts' margins under the sums
        by term; a fit leaves out the fold ``outside``."""
        width = max(1, PIECE // len(residuals))
        rows = self._run(residuals, outside, "rows", "piece long, numbers binary")
        parts = min(-(-self.texts // width), self.blocks)
        summed = rows.repartition(max(1, parts), "piece").mapInArrow(_added, "piece long, numbers binary").toArrow()
        out = np.zeros((len(residuals), self.texts))
        for piece, numbers in zip(summed["piece"].to_pylist(), summed["numbers"].to_pylist()):
            part = out[:, piece * width:(piece + 1) * width]
            part[:] = np.frombuffer(numbers).reshape(part.shape)
        return out

    def sums(self, residuals: list[np.ndarray], outside: list[int | None]) -> DataFrame:
        """The sums by term: (term_id, mean of the last fit's feature, w0, w1, ...)."""
        return self._run(residuals, outside, "terms", "term_id long, mean double" + "".join(f", w{c} double" for c in range(len(residuals))))

    def release(self) -> None:
        self.pairs.unpersist()


def deal(texts: DataFrame, terms: int) -> TermBlocks:
    """Blocks of ``texts``: ``term_ids``, and columns for the driver. Nothing of
    the texts' order is assumed; a term that comes twice in a text counts twice."""
    spark = texts.sparkSession
    numbered = stored(texts.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    table = numbered.drop("term_ids").toArrow().sort_by("_number")
    ids = table["_number"].to_numpy()
    parts, counts = np.unique(ids >> _POSITIONS, return_counts=True)
    starts = dict(zip(parts.tolist(), (np.cumsum(counts) - counts).tolist()))
    pairs = numbered.agg(F.sum(F.size("term_ids"))).first()[0] or 0
    blocks = max(1, min(spark.sparkContext.defaultParallelism, terms), -(-pairs // PAIRS))
    dealt = (bounded(numbered.select("_number", F.coalesce("term_ids", F.array().cast("array<int>"))))
             .mapInArrow(_dealer(starts, blocks), "block int, rows binary, terms binary")
             .repartitionById(blocks, F.col("block")).persist(StorageLevel.DISK_ONLY))
    return TermBlocks(dealt, blocks, terms, table.drop_columns(["_number"]))


# --- L-BFGS ---------------------------------------------------------------------------

class Vectors:
    """Vectors of one length in a local file of the driver."""

    def __init__(self, size: int):
        self.size, self.n, self.file = size, 0, tempfile.TemporaryFile()

    def append(self, vector: np.ndarray) -> None:
        self.file.seek(0, 2)
        self.file.write(vector.tobytes())
        self.n += 1

    def _each(self):
        self.file.seek(0)
        for _ in range(self.n):
            yield np.frombuffer(self.file.read(8 * self.size))

    def products(self, vector: np.ndarray) -> np.ndarray:
        return np.array([v @ vector for v in self._each()])

    def combined(self, factors: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        for f, v in zip(factors, self._each()):
            if f:
                out += f * v
        return out


class _Failed(Exception):
    pass


@dataclass
class Fit:
    margins: np.ndarray        # of all texts, those left out included
    dual: np.ndarray | None    # by text: the coefficients are its scaled sums by term
    intercept: float           # for centred features
    iterations: int = 0


def minimise(label: np.ndarray, inside: np.ndarray, reg: float, max_iter: int,
             tolerance: float = 1e-6, memory: int = 10) -> Generator[np.ndarray, np.ndarray, Fit]:
    """One logistic regression on the texts ``inside``: asks for the margins of
    residuals and returns the fit."""
    n, ones = int(inside.sum()), int(label[inside].sum())
    if n == 0:
        raise ValueError("no comments to train on")
    if ones in (0, n):  # as spark.ml: no coefficients, an infinite intercept
        always = np.inf if ones else -np.inf
        return Fit(np.full(len(label), always), np.zeros(len(label)), always)
    gradients, residuals = Vectors(len(label)), Vectors(len(label))
    products = np.zeros((0, 0))  # of the gradients
    combined = []                # of each residual's part in them

    def dot(a, b) -> float:
        (u, x), (v, y) = a, b
        return float(u @ products[:len(u), :len(v)] @ v + x * y)

    def plus(a, factor, b):
        size = max(len(a[0]), len(b[0]))
        return np.pad(a[0], (0, size - len(a[0]))) + factor * np.pad(b[0], (0, size - len(b[0]))), a[1] + factor * b[1]

    def loss(m) -> float:
        z = m[inside]
        return float((np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z))) - label[inside] * z).sum() / n)

    def residual(m):
        return np.where(inside, np.exp(-np.logaddexp(0, -m)) - label, 0.0)

    def penalty(x) -> float:
        return 0.5 * reg * dot((x[0], 0.0), (x[0], 0.0))

    x, m = (np.zeros(0), float(np.log(ones / (n - ones)))), np.zeros(len(label))  # m without the intercept

    def gradient(x, m):
        """Adds the gradient at x to the others."""
        nonlocal products
        r = residual(m + x[1])
        along = (yield r) / n + reg * m
        k = gradients.n
        known = np.pad(x[0], (0, k - len(x[0]))) @ products if k else np.zeros(0)
        new = gradients.products(r) / n + reg * known
        own = r @ along / n + reg * (np.pad(x[0], (0, k - len(x[0]))) @ new if k else 0.0)
        products = np.block([[products, new[:, None]], [new[None], np.array([[own]])]])
        part = np.zeros(k + 1)
        part[k] = 1
        for factor, earlier in zip(x[0], combined):
            part[:len(earlier)] += reg * factor * earlier
        combined.append(part)
        gradients.append(along)
        residuals.append(r)
        unit = np.zeros(k + 1)
        unit[k] = 1
        return unit, float(r.sum() / n)

    g = yield from gradient(x, m)
    value, steps, changes, iteration, failed = loss(m + x[1]) + penalty(x), [], [], 0, False
    while iteration < max_iter and np.sqrt(max(0.0, dot(g, g))) > max(tolerance * value, 1e-8):
        try:
            direction = _direction(g, steps, changes, dot, plus)
            along = gradients.combined(direction[0])

            def phi(t, x=x, m=m, direction=direction, along=along):
                at, here = plus(x, t, direction), m + t * along
                r = residual(here + at[1])
                slope = float(r @ (along + direction[1]) / n) + reg * dot((at[0], 0.0), (direction[0], 0.0))
                return t, loss(here + at[1]) + penalty(at), slope

            t = _wolfe(phi, 1.0 / np.sqrt(dot(direction, direction)) if iteration == 0 else 1.0)
            if t * np.sqrt(max(0.0, dot(g, g))) < 1e-10:
                raise _Failed
        except _Failed:
            if failed:
                break
            steps, changes, failed = [], [], True
            continue
        moved = plus(x, t, direction)
        m = m + t * along
        after = yield from gradient(moved, m)
        steps.insert(0, plus(moved, -1.0, x))
        changes.insert(0, plus(after, -1.0, g))
        del steps[memory:], changes[memory:]
        x, g, value, failed = moved, after, loss(m + moved[1]) + penalty(moved), False
        iteration += 1
    parts = np.zeros(residuals.n)
    for factor, part in zip(x[0], combined):
        parts[:len(part)] += factor * part
    return Fit(m + x[1], residuals.combined(parts) / n, x[1], iteration)


def _direction(g, steps, changes, dot, plus):
    q, factors = g, []
    for s, y in zip(steps, changes):
        factors.append(dot(s, q) / (dot(s, y) or np.nan))
        if np.isnan(factors[-1]):
            raise _Failed
        q = plus(q, -factors[-1], y)
    if steps:
        sy, yy = dot(steps[0], changes[0]), dot(changes[0], changes[0])
        if not sy >= 0:
            raise _Failed
        q = q[0] * (sy / yy), q[1] * (sy / yy)
    for s, y, factor in reversed(list(zip(steps, changes, factors))):
        q = plus(q, factor - dot(y, q) / dot(s, y), s)
    return -q[0], -q[1]


def _wolfe(phi, t: float) -> float:
    """A step that meets the strong Wolfe conditions."""
    first = low = phi(0.0)
    _, value, slope = first
    if slope > 0:
        raise _Failed

    def between(a, b):
        d1 = a[2] + b[2] - 3 * (a[1] - b[1]) / (a[0] - b[0])
        d2 = np.sqrt(d1 * d1 - a[2] * b[2]) if d1 * d1 >= a[2] * b[2] else np.nan
        width = b[0] - a[0]
        at = b[0] - width * (b[2] + d2 - d1) / (b[2] - a[2] + 2 * d2)
        least, most = a[0] + 0.1 * width, a[0] + 0.9 * width
        return least if at < least else most if at > most else at

    def zoom(low, high):
        for _ in range(10):
            c = phi(between(high, low) if low[0] > high[0] else between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= 0.9 * abs(slope):
                    return c[0]
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _Failed

    for i in range(10):
        c = phi(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(slope):
            return c[0]
        if c[2] >= 0:
            return zoom(c, low)
        low = c
        t *= 1.5
    raise _Failed


def regressions(blocks: TermBlocks, label: np.ndarray, fits: list[tuple[int | None, float]], max_iter: int) -> list[Fit]:
    """Logistic regressions on the texts, each without one fold (or None) and
    with a penalty; those of a pass go step by step together."""
    many = max(1, (FIT_MB << 20) // (8 * max(1, blocks.texts)))
    out: list[Fit] = [None] * len(fits)
    for start in range(0, len(fits), many):
        running = {}
        for k in range(start, min(start + many, len(fits))):
            fold, reg = fits[k]
            inside = np.ones(len(label), np.bool_) if fold is None else blocks.folds != fold
            running[k] = minimise(label, inside, reg, max_iter)
        asked, answers = {}, dict.fromkeys(running)
        while running:
            for k in list(running):
                try:
                    asked[k] = running[k].send(answers[k])
                except StopIteration as done:
                    out[k] = done.value
                    del running[k]
                    asked.pop(k, None)
            if running:
                answers = dict(zip(running, blocks.margins([asked[k] for k in running], [fits[k][0] for k in running])))
    return out


# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
