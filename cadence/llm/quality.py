"""Quality by pairwise ranking (Bradley and Terry).

A document's score is linear in its features. From labelled documents pairs are drawn, each low one
against several high ones; the logistic loss of the difference of their features is minimised, so only
comparisons matter and no base rate is fitted. The threshold is a quantile of the scores of the labelled
sample: the share of low documents in it. Scores are moved and squeezed so that it lies at ``THRESHOLD``.

Features describe the whole text: shares of characters, how words repeat, lines, lengths. The sample is at most
``SAMPLE`` labelled rows outside the held-out fifth; every row is scored.

Defined cases: null and empty texts have the features of a text without words, and a score; null labels are
left out, repeated ones count as the larger; without labels of both kinds every score is 1; rows that repeat an
id are scored on their own; a null id is scored; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm import words
from cadence.llm.tables import only, stage
from cadence.llm.toxicity import labelled

SAMPLE = 20_000
PAIRS = 20
THRESHOLD = 0.3
RIDGE = 1e-3
_SIGNS = b"!%$&*#|.,;:?-_/\\()[]{}<>=+@'\""
_UPPER, _DIGIT, _HIGH = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _DIGIT[48:58], _HIGH[128:] = True, True, True


def features(column: pa.Array) -> np.ndarray:
    """One row of features for each text."""
    data, at = words.buffers(column)
    out = []
    for row, end, h, first in words.batch_hashes(column):
        for i in range(row, end):
            out.append(_of(data[at[i] : at[i + 1]], h[first[i - row] : first[i - row + 1]]))
    return np.array(out, np.float64).reshape(len(out), -1)


def _of(raw: np.ndarray, h: np.ndarray) -> list[float]:
    n, w = max(len(raw), 1), max(len(h), 1)
    count = np.bincount(raw, minlength=256)
    signs = count[np.frombuffer(_SIGNS, np.uint8)] / w
    _, each = np.unique(h, return_counts=True) if len(h) else (None, np.zeros(1, int))
    lines = raw.tobytes().split(b"\n")
    full = [x for x in lines if x.strip()]
    once = len(set(full)) / max(len(full), 1)
    same = float((h[1:] == h[:-1]).mean()) if len(h) > 1 else 0.0
    shares = [*signs, count[_UPPER].sum() / n, count[_DIGIT].sum() / n, count[_HIGH].sum() / n]
    base = [len(each) / w, each.max() / w, same, once, np.log1p(w), np.log1p(len(full)), np.log1p(w / max(len(full), 1)), n / w]
    # a share matters most near nothing; presence and amount are told apart
    return [*shares, *(np.log1p(20 * x) for x in shares), *base, float(len(h) == 0), np.log1p(20 * same), (1 - once) ** 0.5]


class Ranking:
    """Bradley-Terry weights, the quantile threshold, and the scale of the scores."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 5) -> None:
        self.ready = len(y) > 0 and 0 < y.sum() < len(y)
        if not self.ready:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = self._z(x)
        rng = np.random.default_rng(seed)
        low, high = np.flatnonzero(y == 0), np.flatnonzero(y == 1)
        low = np.repeat(low, pairs)
        d = z[rng.choice(high, len(low))] - z[low]
        w = np.zeros(d.shape[1])
        for _ in range(25):  # Newton steps on the mean logistic loss
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            grad = d.T @ (p - 1) / len(d) + RIDGE * w
            hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w
        s = z @ w
        self.cut = float(np.quantile(s, (y == 0).mean()))
        self.unit = float(s.std() + 1e-9)

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready or not len(x):
            return np.ones(len(x))
        s = np.clip((self._z(x) @ self.w - self.cut) / self.unit, -30, 30)
        return 1 / (1 + np.exp(-s) * (1 - THRESHOLD) / THRESHOLD)


def score_quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id and score (0 to 1; THRESHOLD and more: high) of each row."""
    own = only(docs, doc_id=id, text=text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    kind = own.schema["doc_id"].dataType.simpleString()
    rows = stage(labelled(own, labels, label, sample).select("doc_id", "text", "label").mapInArrow(measure, f"doc_id {kind}, label int, x array<double>"), "measured")
    rows = rows.orderBy("doc_id", "x").collect()  # about SAMPLE rows
    ranking = Ranking(np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ranking.score(features(batch["text"])))], ["doc_id", "score"])

    return own.mapInArrow(of, f"doc_id {kind}, score double")
