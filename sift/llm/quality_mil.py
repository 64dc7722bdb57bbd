"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is described by numbers and encoded
by a small network; a gated attention weighs the passages, and the weighted
mean of their encodings is scored. Only whole texts are labelled: the weights
of the passages are learned from the labels of their texts.

Training uses at most ``max_bags`` labelled rows and runs on the driver on a
few numbers per passage; classes are weighted alike. Scoring is one map over
the documents.

Defined results: null and empty texts are bags of one empty passage and are
scored like any other; rows without a label are not learned from; without any
labelled row every score is 0.5, with labels of one class only it is that
class; repeated rows and ids are scored row by row; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded, field_of, packed
from sift.llm.learning import adam, labelled_texts, sigmoid
from sift.llm.passages import FEATURES, passage_features


@dataclass
class MilModel:
    """Encoder, gated attention and scorer; ``constant`` if nothing could be
    learned."""

    params: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    constant: float | None = None

    def forward(self, rows: np.ndarray, starts: np.ndarray):
        """Attention of every passage and score of every bag."""
        state = _forward(self.params, np.clip((rows - self.mean) / self.scale, -8, 8), starts)
        return state["a"], state["p"]


def _forward(w: dict, x: np.ndarray, starts: np.ndarray) -> dict:
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ w["encode"] + w["bias"])
    t, s = np.tanh(h @ w["tanh"]), sigmoid(h @ w["gate"])
    e = (t * s) @ w["attend"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"sizes": sizes, "h": h, "t": t, "s": s, "a": a, "z": z,
            "p": sigmoid(z @ w["score"] + w["prior"])}


def _backward(w: dict, x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray,
              decay: float) -> dict:
    f = _forward(w, x, starts)
    sizes, h, t, s, a = f["sizes"], f["h"], f["t"], f["s"], f["a"]
    d = (f["p"] - y) * weight
    dz = np.repeat(d[:, None] * w["score"], sizes, axis=0)
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
    dg = de[:, None] * w["attend"]
    dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ w["tanh"].T + ds @ w["gate"].T) * (1 - h * h)
    g = {"score": f["z"].T @ d, "prior": d.sum(), "attend": (t * s).T @ de, "tanh": h.T @ dt,
         "gate": h.T @ ds, "encode": x.T @ dh, "bias": dh.sum(axis=0)}
    return {k: v + decay * w[k] if k not in ("prior", "bias") else v for k, v in g.items()}


def fit(bags: list[np.ndarray], y: np.ndarray, *, hidden: int = 16, attention: int = 8,
        steps: int = 200, rate: float = 0.02, decay: float = 1e-4) -> MilModel:
    """Train on bags of passage rows with labels 0 and 1."""
    width = bags[0].shape[1] if bags else FEATURES
    zero, one = np.zeros(width), np.ones(width)
    if not len(y):
        return MilModel({}, zero, one, 0.5)
    if y.min() == y.max():
        return MilModel({}, zero, one, float(y[0]))
    rows = np.concatenate(bags).astype(np.float64)
    starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = np.clip((rows - mean) / scale, -8, 8)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    rnd = np.random.default_rng(0)
    params = {"encode": rnd.normal(0, width ** -0.5, (width, hidden)), "bias": np.zeros(hidden),
              "tanh": rnd.normal(0, hidden ** -0.5, (hidden, attention)),
              "gate": rnd.normal(0, hidden ** -0.5, (hidden, attention)),
              "attend": rnd.normal(0, attention ** -0.5, attention),
              "score": rnd.normal(0, hidden ** -0.5, hidden), "prior": np.zeros(())}
    params = adam(params, lambda w: _backward(w, x, starts, y, weight, decay), steps, rate)
    return MilModel(params, mean, scale)


def _described(batches):
    """Label and passage rows of the training texts."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        rows = [passage_features(t).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
            names=["doc_id", "label", "passages"])


def learn(docs: DataFrame, labels: DataFrame, *, max_bags: int = 4000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", **options) -> MilModel:
    """Train from the texts of ``docs`` whose id has a label (1: good; other
    values: bad) in ``labels``."""
    marked = labels.select(id_col, (F.col(label_col) == 1).cast("int").alias("label"))
    texts = labelled_texts(bounded(docs), marked, max_bags, id_col=id_col, text_col=text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = (texts.select("doc_id", "label", "text")
            .mapInArrow(_described, f"doc_id {id_type}, label int, passages binary").toArrow())
    bags = sorted(zip(rows["doc_id"].to_pylist(), rows["label"].to_pylist(), rows["passages"].to_pylist()))
    arrays = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, _, b in bags]
    return fit(arrays, np.array([label for _, label, _ in bags], float), **options)


def score_texts(texts: list[bytes | None], model: MilModel) -> np.ndarray:
    """Score of each text, from 0 to 1."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    out, bags, size, first = np.empty(len(texts)), [], 0, 0
    for k, text in enumerate(texts):
        bags.append(passage_features(text))
        size += len(bags[-1])
        if size >= 4096 or k == len(texts) - 1:
            starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
            out[first:k + 1] = model.forward(np.concatenate(bags).astype(float), starts)[1]
            bags, size, first = [], 0, k + 1
    return out


def score(docs: DataFrame, model: MilModel, *, id_col: str = "doc_id", text_col: str = "text",
          keep_columns: bool = False) -> DataFrame:
    """``doc_id`` (with ``keep_columns`` instead all columns of ``docs`` in a
    struct ``doc``) and ``score`` per row of ``docs``."""
    kept = [packed(docs)] if keep_columns else [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]

    def run(batches):
        for batch in batches:
            texts = field_of(batch.column(0), text_col) if keep_columns else batch.column(1)
            scores = score_texts(texts.cast(pa.binary()).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)],
                                             names=[batch.schema.names[0], "score"])

    df = bounded(docs).select(*kept)
    return df.mapInArrow(run, df.drop("text").withColumn("score", F.lit(0.0)).schema)


def keep_good(docs: DataFrame, model: MilModel, *, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below ``least``."""
    scored = score(docs, model, text_col=text_col, keep_columns=True)
    return scored.where(F.col("score") >= least).select("doc.*")
