"""Quality scores by a linear hinge-loss model over byte n-grams scaled by naive Bayes.

A text's features say which runs of one to three bytes it holds, hashed to SLOTS. Each feature
is scaled by the log-ratio of its shares in the two classes; a linear model is then fit to the
scaled vectors (of length one) by dual coordinate descent, and its margins are turned to
probabilities on labelled rows that took no part in the fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import encoded

SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS

# At most this many labelled rows of each class are taken for the fit, those with the smallest
# hash of the id; of them every fifth is kept for the probabilities.
SAMPLE = 4000
HELD_BACK = 5

SMOOTHING = 1.0
COST = 1.0
EPOCHS = 30
TOLERANCE = 1e-3

THRESHOLD = 0.7

MODEL = "weights binary, bias double, slope double, shift double"


@dataclass(frozen=True)
class Model:
    """A text's margin is the sum of its features' weights by the root of ... and the bias."""

    weights: np.ndarray
    scales: np.ndarray
    bias: float
    slope: float
    shift: float


def features(text: bytes, seen: np.ndarray) -> np.ndarray:
    """Sorted distinct slots of the 1- to 3-byte runs; ``seen`` is scratch space of SLOTS falses."""
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64)
    two = codes[:-1] << np.uint32(8) | codes[1:]
    three = two[:-1] << np.uint32(8) | codes[2:]
    salted = (codes + np.uint32(1), two + np.uint32(1 << 9), three + np.uint32(1 << 17))
    slots = np.concatenate([(x * np.uint32(2654435761)) >> np.uint32(32 - SLOT_BITS) for x in salted])
    seen[slots] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def _descend(rows: list[np.ndarray], norms: np.ndarray, scale: np.ndarray, signs: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights (of the scaled features) and bias of the hinge-loss model."""
    weights, bias, alpha = np.zeros(SLOTS), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in order.permutation(len(rows)):
            x = scale[rows[i]] / norms[i]
            slope = signs[i] * (float(x @ weights[rows[i]]) + bias) - 1.0
            at_edge = (alpha[i] <= 0 and slope >= 0) or (alpha[i] >= costs[i] and slope <= 0)
            if at_edge:
                continue
            worst = max(worst, abs(slope))
            # The scaled vector has length one, and the bias is one more feature of value one.
            new = min(max(alpha[i] - slope / 2.0, 0.0), costs[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[rows[i]] += step * x
                bias += step
                alpha[i] = new
        if worst < TOLERANCE:
            break
    return weights, bias


def _calibrated(margins: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, by Newton steps; slope is not negative."""
    slope, shift = 1.0, 0.0
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        gradient = x @ (weight * (p - labels)) + 1e-3 * np.array([slope, shift])
        hessian = (x * (weight * p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(slope)), float(shift)


def fit(texts: list[bytes], labels: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """Feature weights, bias, slope and shift from labelled texts; ``shares`` are the true class shares."""
    seen = np.zeros(SLOTS, dtype=bool)
    rows = [features(t, seen) for t in texts]
    held = np.arange(len(rows)) % HELD_BACK == 0
    if len(set(labels[~held].tolist())) < 2 or len(set(labels[held].tolist())) < 2:
        # Too few rows of a class: every text gets the share of the good class.
        share = float(np.clip(shares[1], 0.01, 0.99)) if len(labels) else 0.5
        return np.zeros(SLOTS), 0.0, 0.0, float(np.log(share / (1 - share)))
    counts = np.full((2, SLOTS), SMOOTHING)
    for row, label in zip([r for r, h in zip(rows, held, strict=True) if not h], labels[~held], strict=True):
        counts[label, row] += 1
    totals = np.bincount(labels[~held], minlength=2) + 2 * SMOOTHING
    scale = np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])
    norms = np.array([max(1e-9, float(np.sqrt((scale[r] ** 2).sum()))) for r in rows])
    train = np.flatnonzero(~held)
    signs = np.where(labels == 1, 1.0, -1.0)
    weights, bias = _descend([rows[i] for i in train], norms[train], scale, signs[train], np.full(len(train), COST))
    margins = np.array([float((scale[r] * weights[r]).sum()) / n + bias for r, n in zip(rows, norms, strict=True)])
    sampled = np.bincount(labels[held], minlength=2)
    weight = (shares / np.maximum(sampled, 1))[labels[held]] * held.sum()
    slope, shift = _calibrated(margins[held], labels[held].astype(float), weight)
    return np.stack([scale * weights, scale**2]).astype(np.float32), bias, slope, shift


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Fit on labelled documents (``quality`` 0 or 1 of ``labels``) where ``usable`` holds.

    The fit runs in one task on at most 2 * SAMPLE whole texts. Labels other than 0 and 1, null
    ids and labels without a document are left out; an id with both labels counts for each. Of rows
    that share an id, the text with the smallest hash is the one that is learnt from.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & usable).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = max(1, sum(counts.values()))
    shares = np.array([counts.get(0, 0) / total, counts.get(1, 0) / total])
    order = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("label") == k).orderBy(order, "doc_id").limit(SAMPLE) for k in (0, 1)]
    # At most 2 * SAMPLE rows of two numbers.
    chosen = F.broadcast(chosen[0].union(chosen[1]).select(F.col("doc_id").alias("labelled"), "label"))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = sample.join(chosen, F.col("doc_id") == F.col("labelled"))
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    sample = sample.groupBy("doc_id", "label").agg(one).select("doc_id", "text", "label")

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(frames)
        rows = pd.concat(parts).sort_values(["label", "doc_id", "text"], ignore_index=True) if parts else None
        texts = encoded(rows["text"]) if rows is not None else []
        own = rows["label"].to_numpy(dtype=np.int64) if rows is not None else np.zeros(0, np.int64)
        weights, bias, slope, shift = fit(texts, own, shares)
        stacked = np.broadcast_to(weights, (2, SLOTS)).astype("<f4") if weights.ndim == 1 else weights.astype("<f4")
        yield pd.DataFrame([(stacked.tobytes(), bias, slope, shift)], columns=["weights", "bias", "slope", "shift"])

    row = sample.repartition(1).mapInPandas(learn, MODEL).collect()
    if not row:
        return Model(np.zeros(SLOTS, np.float32), np.ones(SLOTS, np.float32), 0.0, 0.0, 0.0)
    both = np.frombuffer(row[0]["weights"], dtype="<f4").reshape(2, SLOTS)
    return Model(both[0], both[1], row[0]["bias"], row[0]["slope"], row[0]["shift"])


def probability(model: Model, text: bytes, seen: np.ndarray) -> float:
    found = features(text, seen)
    norm = max(1e-9, float(np.sqrt(model.scales[found].sum(dtype=np.float64))))
    margin = float(model.weights[found].sum(dtype=np.float64)) / norm + model.bias
    return float(1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30))))


def with_quality(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of each whole text; null and empty texts too.

    Only the text goes into a score. Every row is scored where it lies; a column called ``name``
    is replaced, other columns and repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = np.zeros(SLOTS, dtype=bool)
        for batch in batches:
            yield pd.Series([probability(shared.value, t, seen) for t in encoded(batch)], dtype="float64")

    return docs.withColumn(name, scored(F.coalesce(F.col("text"), F.lit(""))))
