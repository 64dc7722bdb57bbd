"""Gradient-boosted trees with a logistic loss over binned features, and
calibrated thresholds.

All that boosting needs of its rows is, per distinct row of bins, how many
there are and how many of them are true: a cell. Each level of a tree needs the
sums of gradients and curvatures by node, feature and bin. These are summed as
whole numbers (``SCALE`` to one), so the trees do not depend on how the cells
are dealt: a few cells are summed in the driver, more of them by tasks, which
hand on sums of a fixed size, one job a level.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.learning import sigmoid

SCALE = 2.0 ** 24
BINS = 32


@dataclass
class Trees:
    """Complete binary trees of one depth: per tree the feature and cut of
    every inner node in level order, and the values of the leaves."""

    depth: int
    prior: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def leaf_of(self, x: np.ndarray, tree: int) -> np.ndarray:
        return _reached(x, self.features[tree], self.cuts[tree], self.depth)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of each row."""
        total = np.full(len(x), self.prior)
        for k, leaves in enumerate(self.leaves):
            total += leaves[self.leaf_of(x, k)]
        return sigmoid(total)

    def on_values(self, edges: list[np.ndarray]) -> Trees:
        """The trees on values, of trees on bins."""
        cuts = [np.array([edges[f][int(c)] if np.isfinite(c) else c for f, c in zip(*tree)])
                for tree in zip(self.features, self.cuts)]
        return Trees(self.depth, self.prior, self.features, cuts, self.leaves)


def _reached(x: np.ndarray, features: np.ndarray, cuts: np.ndarray, level: int) -> np.ndarray:
    """The node of each row among those of a level."""
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    for _ in range(level):
        right = x[rows, features[node]] > cuts[node]
        node = 2 * node + 1 + right
    return node - (2 ** level - 1)


def quantile_edges(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The distinct inner quantiles, as ``np.quantile``, of sorted values that
    occur so many times each."""
    if not len(values):
        return np.empty(0)
    ends = np.cumsum(counts)
    low, high, part = quantile_ranks(int(ends[-1]), bins)
    return edges_between(*(values[np.searchsorted(ends, k, "right")].astype(np.float64) for k in (low, high)), part)


def quantile_ranks(total: int, bins: int = BINS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inner quantiles of so many values: the ranks, from 0, of the values
    below and above each, and the part of the way between them."""
    at = np.linspace(0, 1, bins + 1)[1:-1] * (total - 1)
    return np.floor(at), np.ceil(at), at - np.floor(at)


def edges_between(a: np.ndarray, b: np.ndarray, part: np.ndarray) -> np.ndarray:
    return np.unique(np.where(part < 0.5, a + (b - a) * part, b - (b - a) * (1 - part)))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The number of edges below each value."""
    return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


class Cells:
    """Rows of bins with their number and the number of true ones."""

    def __init__(self, bins: np.ndarray, n: np.ndarray, hits: np.ndarray):
        self.bins, self.n, self.hits = bins, n, hits
        self.margins, self.trees = np.zeros(len(n)), 0

    @classmethod
    def of(cls, rows: pa.Table | pa.RecordBatch) -> Cells:
        """From the columns bins, n, hits."""
        n, hits = (rows.column(c).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch)
                   else rows.column(c).to_numpy() for c in ("n", "hits"))
        packed = b"".join(rows.column("bins").to_pylist())
        return cls(np.frombuffer(packed, np.uint8).reshape(len(n), len(packed) // max(1, len(n))), n, hits)

    def scores(self, model: Trees) -> np.ndarray:
        """As ``predict``; a model that has grown goes on from its last tree."""
        for k in range(self.trees, len(model.leaves)):
            self.margins += model.leaves[k][model.leaf_of(self.bins, k)]
        self.trees = len(model.leaves)
        return sigmoid(model.prior + self.margins)

    def sums(self, model: Trees, features: np.ndarray, cuts: np.ndarray, level: int) -> np.ndarray:
        """Gradients and curvatures by node of a level of the next tree,
        feature and bin."""
        p = self.scores(model)
        node = _reached(self.bins, features, cuts, level)
        out = np.zeros((2, 2 ** level, self.bins.shape[1], BINS), np.int64)
        for side, part in enumerate((self.n * p - self.hits, self.n * (p * (1 - p) + 1e-6))):
            part = np.rint(SCALE * part)
            for f in range(self.bins.shape[1]):
                out[side, :, f] = np.bincount(node * BINS + self.bins[:, f], part, 2 ** level * BINS).reshape(-1, BINS)
        return out


def grown(sums: Callable[..., np.ndarray], share: float, edges: list[np.ndarray], *, trees: int = 40,
          depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Trees:
    """Trees on bins by second-order boosting; ``sums`` as ``Cells.sums``, and
    the share of true rows."""
    share = min(max(share, 1e-4), 1 - 1e-4)
    model = Trees(depth, float(np.log(share / (1 - share))))
    exists = np.arange(BINS) < np.array([len(e) for e in edges])[:, None]
    for _ in range(trees):
        features, cuts = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        ends = np.zeros((2, 2 ** depth))
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            whole = sums(model, features, cuts, level)
            g, h = whole / SCALE
            gl, hl = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
            gain = np.where(exists, gain, -np.inf).reshape(width, -1)
            for n, best in enumerate(gain.argmax(axis=1).tolist()):
                if gain[n, best] > 1e-9:
                    features[first + n], cuts[first + n] = divmod(best, BINS)
                f, cut = features[first + n], cuts[first + n]
                left = whole[:, n, f, :int(min(cut, BINS)) + 1].sum(axis=1)
                ends[:, 2 * n] = left / SCALE
                ends[:, 2 * n + 1] = (whole[:, n, f].sum(axis=1) - left) / SCALE
        model.features.append(features)
        model.cuts.append(cuts)
        model.leaves.append(-rate * ends[0] / (ends[1] + ridge))
    return model


def boost(x: np.ndarray, y: np.ndarray, **options) -> Trees:
    """Trees on values from the rows of an array."""
    edges = [quantile_edges(*np.unique(column, return_counts=True)) for column in x.T]
    cells = Cells(binned(x, edges), np.ones(len(y)), y)
    return grown(cells.sums, y.mean(), edges, **options).on_values(edges)


def boost_cells(cells: DataFrame, share: float, edges: list[np.ndarray], *, max_cells: int = 100_000,
                **options) -> Trees:
    """Trees on bins from all cells (bins, n, hits) of a stored table. Up to
    ``max_cells`` are summed in the driver, more in tasks, with equal sums."""
    cells = cells.select("bins", "n", "hits")
    if cells.count() <= max_cells:
        return grown(Cells.of(cells.toArrow()).sums, share, edges, **options)

    def sums(model, features, cuts, level):
        def run(batches):
            total = sum(Cells.of(batch).sums(model, features, cuts, level) for batch in batches if batch.num_rows)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(np.ravel(total)[at], pa.int64())],
                                             names=["at", "part"])

        rows = cells.mapInArrow(run, "at long, part long").groupBy("at").agg(F.sum("part").alias("part")).toArrow()
        out = np.zeros((2, 2 ** level, len(edges), BINS), np.int64)
        out.reshape(-1)[rows["at"].to_numpy()] = rows["part"].to_numpy()
        return out

    return grown(sums, share, edges, **options)


def calibrated_threshold(scores: np.ndarray, hits: np.ndarray, precision: float, least: float,
                         n: np.ndarray | None = None) -> float:
    """The lowest score from which on the share of true rows is at least
    ``precision``, and not below ``least``; above 1 if there is none. A score
    stands for ``n`` rows, ``hits`` of them true."""
    if not len(scores):
        return 2.0
    order = np.argsort(-scores, kind="stable")
    n = np.ones(len(scores)) if n is None else n
    ranked = scores[order]
    ok = np.cumsum(hits[order]) / np.cumsum(n[order]) >= precision
    last = np.ones(len(scores), np.bool_)  # ends of runs of equal scores
    last[:-1] = ranked[1:] != ranked[:-1]
    good = np.flatnonzero(ok & last)
    return max(least, float(ranked[good[-1]])) if len(good) else 2.0
