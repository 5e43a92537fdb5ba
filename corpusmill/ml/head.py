"""A classifier's head over embeddings, trained by gradients that the tasks add up.

The layers go to the tasks as a broadcast. A task sends one row, the sum of its rows' gradients, whatever they are; some of
these rows are added up in tasks again, so the driver gets about the square root of the number of partitions.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.ml import evaluation
from corpusmill.ml.kmeans import matrix
from corpusmill.ml.linear import forward

Layers = list[tuple[np.ndarray, np.ndarray]]
_SUMS = "gradient array<double>, loss double, n long"


def fresh(sizes: tuple[int, ...], seed: int = 42) -> Layers:
    rng = np.random.default_rng(seed)
    return [(rng.normal(0, math.sqrt(2 / a), (b, a)), np.zeros(b)) for a, b in zip(sizes, sizes[1:], strict=False)]


def _flat(layers: Layers) -> np.ndarray:
    return np.concatenate([x.ravel() for layer in layers for x in layer])


def _shaped(flat: np.ndarray, layers: Layers) -> Layers:
    out, at = [], 0
    for w, b in layers:
        out.append((flat[at : at + w.size].reshape(w.shape), flat[at + w.size : at + w.size + b.size]))
        at += w.size + b.size
    return out


def gradient(layers: Layers, x: np.ndarray, y: np.ndarray, alpha: float = 0.25, gamma: float = 2.0) -> tuple[np.ndarray, float]:
    """Sums over rows of the gradient of the focal loss, flat, and of the loss."""
    seen = [x]
    for w, b in layers[:-1]:
        seen.append(np.maximum(seen[-1] @ w.T + b, 0))
    w, b = layers[-1]
    z = (seen[-1] @ w.T + b)[:, 0]
    sign = np.where(y == 1, 1.0, -1.0)
    log_right = -np.logaddexp(0, -sign * z)
    right, wrong = np.exp(log_right), np.exp(-np.logaddexp(0, sign * z))
    loss = float(-(alpha * wrong**gamma * log_right).sum())
    error = (alpha * sign * (gamma * wrong**gamma * right * log_right - wrong ** (gamma + 1)))[:, None]
    out = []
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        out[:0] = [(error.T @ seen[i]).ravel(), error.sum(axis=0)]
        error = (error @ w) * (seen[i] > 0)
    return np.concatenate(out), loss


def summed_gradient(rows: DataFrame, layers: Layers, label: str = "label", feature: str = "feature", alpha: float = 0.25, gamma: float = 2.0) -> tuple[np.ndarray, float, int]:
    """Sums of gradient and loss over rows (label, feature), and how many rows there are; rows with a null are left out."""
    dim, size = layers[0][0].shape[1], len(_flat(layers))
    shared = rows.sparkSession.sparkContext.broadcast(layers)

    def row(total: np.ndarray, loss: float, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64())), pa.array([loss]), pa.array([n], pa.int64())], ["gradient", "loss", "n"])

    def parts(batches):
        total, loss, n = np.zeros(size), 0.0, 0
        for batch in batches:
            found = gradient(shared.value, matrix(batch.column("x"), dim), batch.column("y").to_numpy(), alpha, gamma)
            total, loss, n = total + found[0], loss + found[1], n + batch.num_rows
        if n:
            yield row(total, loss, n)

    def together(batches):
        total, loss, n = np.zeros(size), 0.0, 0
        for batch in batches:
            total += matrix(batch.column("gradient"), size).sum(axis=0)
            loss, n = loss + sum(batch.column("loss").to_pylist()), n + sum(batch.column("n").to_pylist())
        if n:
            yield row(total, loss, n)

    own = rows.select(F.col(feature).alias("x"), F.col(label).cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    few = max(1, math.isqrt(own.rdd.getNumPartitions()))
    found = own.mapInArrow(parts, _SUMS).repartition(few).mapInArrow(together, _SUMS).collect()
    return sum((np.array(r["gradient"]) for r in found), np.zeros(size)), sum(r["loss"] for r in found), sum(r["n"] for r in found)


@dataclass
class Head:
    """layers: (weights, biases), ReLU between them; history: what each epoch of the training gave."""

    layers: Layers
    history: list[dict] = field(default_factory=list)

    def predict(self, df: DataFrame, feature: str = "feature", threshold: float = 0.5) -> DataFrame:
        """df with probability and predicted, null where feature is null; columns of these names are replaced."""
        df = df.drop("probability", "predicted")
        shared, dim = df.sparkSession.sparkContext.broadcast(self.layers), self.layers[0][0].shape[1]

        def run(batches):
            for batch in batches:
                column = batch.column(feature)
                valid = column.is_valid().to_numpy(zero_copy_only=False)
                found = np.zeros(batch.num_rows)
                found[valid] = forward(matrix(column.drop_null(), dim), shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, mask=~valid)], [*batch.schema.names, "probability"])

        out = df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("probability", T.DoubleType())]))
        return out.withColumn("predicted", evaluation.predict(F.col("probability"), threshold))

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps([[w.tolist(), b.tolist()] for w, b in self.layers]))

    @staticmethod
    def load(path: str) -> Head:
        return Head([(np.array(w), np.array(b)) for w, b in json.loads(Path(path).read_text())])


@dataclass
class HeadTrainer:
    """AdamW on the focal loss, with a linear warm-up and a cosine rate; the state of best F1 on the validation rows is kept.

    Each epoch has `steps` steps, and each of them a part of the rows by a hash of their id, so a row is seen once an epoch.
    Training ends after `patience` epochs without a better F1 (of equal ones, a lower loss). There is no dropout and no
    batch norm.
    """

    hidden: tuple[int, ...] = (512, 128)
    epochs: int = 30
    steps: int = 1
    rate: float = 1e-2
    decay: float = 1e-4
    warmup: int = 2
    alpha: float = 0.25
    gamma: float = 2.0
    patience: int = 5
    validation: float = 0.2
    seed: int = 42

    def rate_at(self, step: int) -> float:
        first, all_ = self.warmup * self.steps, self.epochs * self.steps
        if step < first:
            return self.rate * (step + 1) / first
        return self.rate * 0.5 * (1 + math.cos(math.pi * (step - first) / max(1, all_ - first)))

    def train(self, df: DataFrame, id_field: str = "id", feature: str = "feature", label: str = "label") -> Head:
        """A head from rows with a label of 0 or 1; without usable rows, an error."""
        rows = df.where(F.col(feature).isNotNull() & F.col(label).isNotNull()).select(id_field, feature, label).persist()
        try:
            first = rows.select(F.size(feature).alias("n")).first()
            if first is None:
                raise ValueError("no rows with an embedding and a label")
            train, held = evaluation.hash_split(rows, id_field, self.validation, self.seed)
            layers = fresh((first["n"], *self.hidden, 1), self.seed)
            flat = _flat(layers)
            mean, square = np.zeros_like(flat), np.zeros_like(flat)
            weights = np.concatenate([np.full(x.size, float(x.ndim == 2)) for layer in layers for x in layer])  # biases don't decay
            best, head, since, step = None, Head(layers), 0, 0
            for epoch in range(self.epochs):
                loss = n = 0
                for part in range(self.steps):
                    own = train if self.steps == 1 else train.where(F.pmod(F.xxhash64(F.lit(epoch), F.col(id_field)), F.lit(self.steps)) == part)
                    total, cost, count = summed_gradient(own, _shaped(flat, layers), label, feature, self.alpha, self.gamma)
                    loss, n = loss + cost, n + count
                    if not count:
                        continue
                    rate, g = self.rate_at(step), total / count
                    step += 1
                    mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
                    flat = flat - rate * (mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8) + self.decay * weights * flat)
                now = Head(_shaped(flat, layers))
                _, cost, count = summed_gradient(held, now.layers, label, feature, self.alpha, self.gamma)
                f1 = evaluation.binary_metrics(now.predict(held, feature), label).first()["f1"] if count else 0.0
                head.history.append({"epoch": epoch, "rate": self.rate_at(max(0, step - 1)), "train_loss": loss / n if n else None, "loss": cost / count if count else None, "f1": f1})
                score = (f1, -cost / count if count else -loss)
                if best is None or score > best:
                    best, head.layers, since = score, now.layers, 0
                elif (since := since + 1) >= self.patience:
                    break
            return head
        finally:
            rows.unpersist()
