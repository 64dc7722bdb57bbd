"""Small models trained on the driver from bounded samples of labelled rows.

The samples are drawn in Spark and have a stated maximum of rows, so neither
the driver nor a task ever holds more than that; the models are arrays of a
fixed size that travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, max_rows: int, *key_cols: str) -> DataFrame:
    """At most ``max_rows`` rows, those with the least hash of ``key_cols``:
    the same rows in every run and partitioning. All rows if there are fewer."""
    return rows.orderBy(F.xxhash64(*key_cols), *key_cols).limit(max_rows)


def labelled_texts(docs: DataFrame, labels: DataFrame, max_rows: int, *, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "label") -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` rows of ``labels`` with a
    label; only these few ids and labels are broadcast."""
    some = bounded_sample(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                          .select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")),
                          max_rows, "doc_id", "label")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(some), "doc_id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def adam(params: dict[str, np.ndarray], gradients: Callable[[dict], dict], steps: int,
         rate: float) -> dict[str, np.ndarray]:
    """Minimise by Adam; ``gradients`` maps parameters to their gradients."""
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    for step in range(1, steps + 1):
        for k, g in gradients(params).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            up = first[k] / (1 - 0.9 ** step)
            params[k] = params[k] - rate * up / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return params
