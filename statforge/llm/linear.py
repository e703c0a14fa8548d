"""Linear classifiers over hashed indicator features, fitted by dual coordinate descent.

A fit reads a bounded sample of documents, reduced to their features and dealt out to shards. Each shard solves its own problem in
a task, and the weights are averaged. One more part of the sample is not fitted on but turns margins into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.shared import arrow_schema

SHARDS = 4


def in_shards(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with a column ``shard``: 0 to SHARDS - 1 are fitted on, SHARDS is for the probabilities."""
    return rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(SHARDS + 1)).cast("int"))


def bucket_counts(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many rows (features, target) have each feature, weighted by target and by 1 - target.

    Each task adds up its own rows; the sums are at most ``size`` rows.
    """
    target = arrow_schema(rows.sparkSession, "bucket int, positive double, negative double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positive, negative = np.zeros(size), np.zeros(size)
        for batch in batches:
            for features, p in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = features.values.to_numpy()
                positive[own] += p
                negative[own] += 1 - p
        used = np.flatnonzero(positive + negative)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(positive[used]), pa.array(negative[used])], schema=target)

    sums = rows.select("features", "target").mapInArrow(run, "bucket int, positive double, negative double")
    table = sums.groupBy("bucket").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative")).toArrow()
    out = np.zeros(size), np.zeros(size)
    for column, values in zip(("positive", "negative"), out, strict=True):
        values[table["bucket"].to_numpy()] = table[column].to_numpy()
    return out


@dataclass(frozen=True)
class Model:
    """Weights by bucket (the features' scale included), the squared scale, bias, and how margins become probabilities."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, features: np.ndarray) -> float:
        """Features are scaled to unit length, so that long documents don't outweigh short ones."""
        length = float(self.squares[features].sum())
        return float(self.weights[features].sum()) / length**0.5 + self.bias if length > 0 else self.bias

    def probability(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.shift, -50, 50))))


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], sides: np.ndarray, most: np.ndarray, size: int, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 plus the hinge losses, row i's weighted by ``most[i]``.

    Coordinate descent on the dual: each step moves one row's multiplier, between 0 and ``most[i]``, to its optimum.
    """
    weights, bias, held = np.zeros(size), 0.0, np.zeros(len(rows))
    norms = [float(values @ values) + 1 for _, values in rows]
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            features, values = rows[i]
            slope = sides[i] * (weights[features] @ values + bias) - 1
            new = min(max(held[i] - slope / norms[i], 0.0), most[i])
            if new != held[i]:
                move = (new - held[i]) * sides[i]
                weights[features] += move * values
                bias += move
                held[i] = new
    return weights, bias


def fit(rows: DataFrame, scale: np.ndarray, cost: float = 1.0, epochs: int = 10, seed: int = 3) -> Model:
    """A model for rows (features, target, shard) with features scaled by ``scale``; targets may be probabilities."""
    size = len(scale)
    shared = rows.sparkSession.sparkContext.broadcast(scale.astype("float32"))

    def solve(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        own, kept = [], []
        for i, features in enumerate(part["features"]):
            features = np.asarray(features, "int64")
            features = features[shared.value[features] != 0]
            values = shared.value[features].astype("float64")
            length = np.sqrt(values @ values)
            own.append((features, values / length if length else values))
            kept.append(i)
        p = part["target"].to_numpy()
        # Common and rare class weigh alike.
        sides, certain = np.where(p >= 0.5, 1.0, -1.0), np.abs(2 * p - 1)
        share = min(max(float((sides > 0).mean()), 0.02), 0.98)
        most = cost * certain * np.where(sides > 0, 0.5 / share, 0.5 / (1 - share))
        weights, bias = dual_descent(own, sides, most, size, epochs, seed + int(key[0]))
        used = np.flatnonzero(weights)
        return pd.DataFrame({"bucket": np.append(used, -1).astype("int32"), "weight": np.append(weights[used], bias)})

    solved = rows.where(F.col("shard") < SHARDS).select("features", "target", "shard").groupBy("shard").applyInPandas(solve, "bucket int, weight double")
    table = solved.groupBy("bucket").agg(F.sum("weight").alias("weight")).toArrow()
    buckets, sums = table["bucket"].to_numpy(), table["weight"].to_numpy() / SHARDS
    weights = np.zeros(size)
    weights[buckets[buckets >= 0]] = sums[buckets >= 0]
    model = Model((weights * scale).astype("float32"), (scale**2).astype("float32"), float(sums[buckets < 0].sum()))
    aside = rows.where(F.col("shard") == SHARDS).select("features", "target").toArrow()
    margins = np.array([model.margin(f.values.to_numpy()) for f in aside["features"]])
    slope, shift = probabilities(margins, aside["target"].to_numpy())
    return Model(model.weights, model.squares, model.bias, slope, shift)


def probabilities(margins: np.ndarray, targets: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (margin, target), by Newton's method; targets are kept off 0 and 1."""
    if not len(margins):
        return 2.0, 0.0
    positive = targets.sum()
    high, low = (positive + 1) / (positive + 2), 1 / (len(targets) - positive + 2)
    wanted = low + (high - low) * targets
    x = np.stack([margins, np.ones(len(margins))], 1)
    at = np.array([2.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - wanted) + 1e-3 * at
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), slope)
        at = at - np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)
