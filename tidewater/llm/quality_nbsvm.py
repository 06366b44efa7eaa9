"""Quality classifier: support vectors on naive-Bayes-scaled n-grams (operator 3).

A text's features are indicators of its token and token-shape 1- and 2-grams (hashed).  Each is
scaled by the log ratio of the classes' smoothed counts, the vector is normalised, and a linear
hinge-loss model is fitted by dual coordinate descent.  A logistic curve fitted on margins of
training rows that were left out of the descent turns margins into scores.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import held_out, lowest_ids, map_batches, pick

FEATURES = 1 << 18
#: Training bound: labelled documents a class, each at most FEATURES / 8 bytes on the driver; every fifth
#: of them fits the curve.
TRAIN_DOCS, CURVE = 3000, 5
SMOOTHING, COST, EPOCHS, TOKEN_CACHE = 1.0, 1.0, 15, 300_000

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+|\n+")
_tokens: dict[str, tuple[int, int]] = {}


def _shape(token: str) -> str:
    s = re.sub(r"[^\W\d_]", "x", re.sub(r"\d", "9", token)) if not token.isalpha() else "x" * len(token)
    case = "U" if token.isupper() else "T" if token[:1].isupper() else "l"
    return f"{case}{re.sub(r'(.)(?=\1\1)', '', s)}{min(len(token), 8)}"


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    tokens = _TOKEN.findall(text)
    if not tokens:
        return np.array([], dtype=np.int64)
    if len(_tokens) > TOKEN_CACHE:
        _tokens.clear()
    for t in set(tokens).difference(_tokens):
        _tokens[t] = (xxhash.xxh3_64_intdigest(t.lower()), xxhash.xxh3_64_intdigest(_shape(t), seed=1))
    h = np.array([_tokens[t] for t in tokens], dtype=np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
    pairs ^= pairs >> np.uint64(31)
    mixed = np.concatenate([h.reshape(-1), pairs.reshape(-1)]) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed >> np.uint64(64 - 18)).astype(np.int64)


def packed(found: np.ndarray) -> bytes:
    """Sorted feature numbers as a list or, where that is no longer, as a bitmap of FEATURES / 8 bytes."""
    if 4 * len(found) < FEATURES // 8:
        return found.astype(np.int32).tobytes()
    bits = np.zeros(FEATURES, np.uint8)
    bits[found] = 1
    return np.packbits(bits).tobytes()


def unpacked(found: bytes) -> np.ndarray:
    if len(found) < FEATURES // 8:
        return np.frombuffer(found, np.int32)
    return np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8)))


class Made(Sequence):
    """Items that are made each time they are asked for, so that none of them is held."""

    def __init__(self, n: int, make: Callable[[int], np.ndarray]):
        self.n, self.make = n, make

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return self.make(i)


@dataclass
class NbSvm:
    """Score of a text: logistic(slope * w.x + shift), x the normalised scaled indicators."""
    ratio: np.ndarray
    scaled: np.ndarray  # ratio * weight
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(np.sqrt(np.square(self.ratio[found]).sum())) if len(found) else 0.0
        return (float(self.scaled[found].sum()) / norm if norm else 0.0) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -500, 500))))


def log_count_ratio(rows: Sequence[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = []
    for label in (1, -1):
        c = np.full(FEATURES, SMOOTHING)
        for i in np.flatnonzero(y == label):
            c[rows[i]] += 1
        counts.append(c / c.sum())
    return np.log(counts[0] / counts[1])


def dual_descent(rows: Sequence[np.ndarray], values: Sequence[np.ndarray], y: np.ndarray, cost: float = COST,
                 epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model: one dual variable at a time is set to the
    best value in [0, cost], the weights following."""
    rng = np.random.default_rng(seed)
    w, bias, dual = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    curvature = np.array([float(v @ v) + 1.0 for v in values])  # the bias is a feature of value 1
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, value = rows[i], values[i]
            slope = y[i] * (w[at] @ value + bias) - 1
            new = min(max(dual[i] - slope / curvature[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                w[at] += step * value
                bias += step
                dual[i] = new
    return w, bias


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift by Newton steps on the smoothed log loss."""
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - target)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        theta = theta - np.linalg.solve(hess, grad)
    return max(float(theta[0]), 1e-3), float(theta[1])


def train(rows: Sequence[np.ndarray], labels: list[int]) -> NbSvm:
    y = np.where(np.array(labels) == 1, 1, -1)
    if len(set(y.tolist())) < 2:  # one class only: its label for every text
        return NbSvm(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0, 3.0 if len(y) and y[0] > 0 else -3.0)
    fit_on = np.arange(len(rows)) % CURVE != 0
    if len(set(y[fit_on].tolist())) < 2 or len(set(y[~fit_on].tolist())) < 2:
        fit_on = np.ones(len(rows), bool)
    fitted = np.flatnonzero(fit_on)
    some = Made(len(fitted), lambda i: rows[fitted[i]])
    ratio = log_count_ratio(some, y[fit_on])
    values = Made(len(fitted), lambda i: (v := ratio[some[i]]) / (np.sqrt(v @ v) or 1.0))
    w, bias = dual_descent(some, values, y[fit_on])
    model = NbSvm(ratio.astype(np.float32), (ratio * w).astype(np.float32), bias, 1.0, 0.0)
    on = ~fit_on if not fit_on.all() else fit_on
    model.slope, model.shift = logistic_curve(np.array([model.margin(rows[i]) for i in np.flatnonzero(on)]), y[on])
    return model


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[Sequence[np.ndarray], list[int]]:
    """Features and labels of the bounded sample: per class the TRAIN_DOCS labelled ids outside the held-out
    fold that hash lowest, the whole text of each.  The driver holds them packed (see :func:`packed`)."""
    known = pick(labels, id_col, label_col).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = lowest_ids(known, "label", TRAIN_DOCS)
    src = pick(docs, id_col, text_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = src.join(F.broadcast(chosen), "id")  # TRAIN_DOCS ids a class
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "label", "text")  # one text of a repeated id

    def run(batches):
        for batch in batches:
            found = [packed(features(t or "")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["id", "label", "found"])

    id_type = src.schema["id"].dataType.simpleString()
    got = sorted((xxhash.xxh3_64_intdigest(str(r.id)), bytes(r.found), r.label)
                 for r in map_batches(rows, run, f"id {id_type}, label int, found binary").collect())
    return Made(len(got), lambda i: unpacked(got[i][1])), [label for _, _, label in got]


def predict(docs: DataFrame, model: NbSvm, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``score`` (higher: label 1 likelier) and ``predicted``.  Null and empty texts have
    no feature and get the score of the bias; repeated rows and null ids are scored like others."""
    src = pick(docs, id_col, text_col)
    id_type = src.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            score = [model.score(features(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32())],
                                             names=[id_col, "score", "predicted"])
    return map_batches(src, run, f"`{id_col}` {id_type}, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Train on ``labels`` (id, label 0 or 1) outside the held-out fold, score all rows: id,
    ``held_out``, ``score``, ``predicted``.  Null labels are left out; without any labelled row
    every score is low; an empty table gives an empty result; other columns are ignored."""
    model = train(*training_rows(docs, labels, id_col, text_col, label_col))
    out = predict(docs, model, id_col, text_col)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", "predicted")
