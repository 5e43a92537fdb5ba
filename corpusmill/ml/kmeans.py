"""Lloyd's k-means over array columns, by matrix products within each task.

Centroids reach the tasks as a broadcast of k times dimension numbers. A task adds up its rows by cluster and sends one row
for each cluster it met, whatever its rows; those of a cluster are added up in turn, so the driver gets k rows. assign() and
cluster_sums() are the same as column expressions, for centroids few enough to be literals of a plan.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import vector


def _centroids(centroids: np.ndarray) -> Column:
    return F.array(*(vector.literal(c) for c in centroids))


def nearest(feature: Column, centroids: np.ndarray) -> Column:
    """struct(distance, cluster) of the nearest centroid; the lowest number on a tie."""
    pairs = F.transform(_centroids(centroids), lambda c, i: F.struct(vector.distance(feature, c).alias("distance"), i.alias("cluster")))
    return F.array_min(pairs)


def assign(df: DataFrame, centroids: np.ndarray, feature: str = "feature") -> DataFrame:
    found = df.withColumn("_nearest", nearest(F.col(feature), centroids))
    return found.withColumns({"cluster": F.col("_nearest.cluster"), "distance": F.col("_nearest.distance")}).drop("_nearest")


def cluster_sums(assigned: DataFrame, feature: str = "feature") -> DataFrame:
    """(cluster, dim, total, members)."""
    parts = assigned.select("cluster", F.posexplode(feature).alias("dim", "value"))
    return parts.groupBy("cluster", "dim").agg(F.sum(F.col("value").cast("double")).alias("total"), F.count("*").alias("members"))


# ---- by blocks -----------------------------------------------------------------------------------------------------
#: Rows whose distances to all centroids are worked out at once, in elements of the matrix of distances.
CELLS = 1 << 22
_SUMS = "cluster int, total array<double>, cost double, members long"


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a list column without nulls, as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(values) != len(column) * dim or values.dtype == object or (pa.compute.list_value_length(column).to_numpy() != dim).any():
        raise ValueError(f"vectors must have {dim} elements, none of them null")
    return values.reshape(len(column), dim).astype(np.float64)


def nearest_rows(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the lowest number on a tie, and its squared distance.

    A matrix product finds the centroids that may be nearest; where rounding leaves several, differences decide.
    """
    cluster, square = np.empty(len(x), np.int32), np.empty(len(x))
    norms = (centroids * centroids).sum(axis=1)
    step = max(1, CELLS // len(centroids))
    for at in range(0, len(x), step):
        own = x[at : at + step]
        size = (own * own).sum(axis=1)
        found = norms - 2 * (own @ centroids.T)
        low = found.min(axis=1)
        slack = 1e-9 * (size + norms.max() + 1)
        near = found <= (low + slack)[:, None]
        best = near.argmax(axis=1)
        for i in np.flatnonzero(near.sum(axis=1) > 1):
            tied = np.flatnonzero(near[i])
            best[i] = tied[((own[i] - centroids[tied]) ** 2).sum(axis=1).argmin()]
        cluster[at : at + step] = best
        square[at : at + step] = ((own - centroids[best]) ** 2).sum(axis=1)
    return cluster, square


def _shared(df: DataFrame, centroids: np.ndarray):
    return df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(centroids, np.float64))


def assign_blocks(df: DataFrame, centroids: np.ndarray, feature: str = "feature") -> DataFrame:
    """df with cluster and distance of its rows, null where feature is null; a column of these names is replaced."""
    df = df.drop("cluster", "distance")
    shared = _shared(df, centroids)

    def run(batches):
        own = shared.value
        for batch in batches:
            column = batch.column(feature)
            there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            cluster, square = nearest_rows(matrix(column.drop_null(), own.shape[1]), own)
            numbers, far, gone = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            numbers[there], far[there], gone[there] = cluster, np.sqrt(square), False
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, mask=gone), pa.array(far, mask=gone)], [*batch.schema.names, "cluster", "distance"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.DoubleType())]))


def _sums_batch(total: np.ndarray, cost: np.ndarray, members: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    flat = pa.array(total.ravel())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1, dtype=np.int32) * total.shape[1], pa.int32()), flat)
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), lists, pa.array(cost), pa.array(members, pa.int64())], ["cluster", "total", "cost", "members"])


def block_sums(df: DataFrame, centroids: np.ndarray, feature: str = "feature") -> DataFrame:
    """(cluster, total, cost, members): the sum of the vectors of each cluster that has some, and of their squared distances."""
    shared = _shared(df, centroids)
    dim = centroids.shape[1]

    def parts(batches):
        own = shared.value
        total, cost, members = np.zeros(own.shape), np.zeros(len(own)), np.zeros(len(own), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dim)
            cluster, square = nearest_rows(x, own)
            order = np.argsort(cluster, kind="stable")
            there, begins = np.unique(cluster[order], return_index=True)
            if len(there):
                total[there] += np.add.reduceat(x[order], begins, axis=0)
                cost += np.bincount(cluster, square, len(own))
                members += np.bincount(cluster, minlength=len(own))
        met = np.flatnonzero(members)
        if len(met):
            yield _sums_batch(total[met], cost[met], members[met], met)

    def together(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for number, vector_, cost, n in zip(batch.column("cluster").to_pylist(), matrix(batch.column("total"), dim), batch.column("cost").to_pylist(), batch.column("members").to_pylist(), strict=True):
                own = sums.setdefault(number, [np.zeros(dim), 0.0, 0])
                own[0] += vector_
                own[1] += cost
                own[2] += n
        if sums:
            yield _sums_batch(np.stack([s[0] for s in sums.values()]), np.array([s[1] for s in sums.values()]), np.array([s[2] for s in sums.values()]), np.array(list(sums)))

    rows = df.where(F.col(feature).isNotNull()).select(feature)
    return rows.mapInArrow(parts, _SUMS).repartition("cluster").mapInArrow(together, _SUMS)


def seeds(df: DataFrame, k: int, id_field: str, feature: str, seed: int, rounds: int = 5) -> np.ndarray:
    """k starting centroids by k-means||: in each round a row is taken with a probability of 2k times its share of the cost.

    The rows taken, some 2k a round whatever the table, are weighted by the rows next to them, and k-means++ over them on
    the driver leaves k. Draws are hashes of the id and the round, so the result does not depend on the partitions.
    """
    rows = df.where(F.col(feature).isNotNull()).select(id_field, feature)
    first = rows.orderBy(F.xxhash64(F.lit(seed), id_field), id_field).limit(1).collect()
    if not first:
        return np.empty((0, 1))
    taken = np.array([first[0][feature]], np.float64)
    for i in range(rounds):
        cost = block_sums(rows, taken, feature).agg(F.sum("cost")).first()[0] or 0.0
        if cost <= 0:
            break
        draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(i + 1), id_field), F.lit(1 << 52)) / F.lit(float(1 << 52))
        near = assign_blocks(rows, taken, feature)
        new = near.where(draw < F.lit(2.0 * k / cost) * F.col("distance") * F.col("distance")).select(id_field, feature).orderBy(F.xxhash64(F.lit(i), id_field), id_field).limit(20 * k).collect()
        taken = np.concatenate((taken, np.array([r[feature] for r in new], np.float64).reshape(-1, taken.shape[1])))
    taken = np.unique(taken, axis=0)
    weight = np.zeros(len(taken))
    for r in block_sums(rows, taken, feature).select("cluster", "members").collect():
        weight[r["cluster"]] = r["members"]
    return _plus_plus(taken, weight, k, seed)


def _plus_plus(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    chosen = [int(weight.argmax())]
    far = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(points)):
        share = weight * far
        if share.sum() <= 0:
            share = (far > 0).astype(float)
        if share.sum() <= 0:
            break
        # the best of some draws
        draws = rng.choice(len(points), size=2 + int(np.log(k + 1)), p=share / share.sum())
        costs = [(weight * np.minimum(far, ((points - points[d]) ** 2).sum(axis=1))).sum() for d in draws]
        chosen.append(int(draws[int(np.argmin(costs))]))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


@dataclass
class KMeansModel:
    centroids: np.ndarray
    iterations: int = 0
    converged: bool = False

    def predict(self, df: DataFrame, feature: str = "feature") -> DataFrame:
        return assign_blocks(df, self.centroids, feature)

    predict_clusters = predict_batch = predict

    def inertia(self, df: DataFrame, feature: str = "feature") -> float:
        return float(block_sums(df, self.centroids, feature).agg(F.sum("cost")).first()[0] or 0.0)

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps({"centroids": self.centroids.tolist(), "iterations": self.iterations, "converged": self.converged}))

    @staticmethod
    def load(path: str) -> KMeansModel:
        body = json.loads(Path(path).read_text())
        return KMeansModel(np.asarray(body["centroids"]), body["iterations"], body["converged"])


class KMeansTrainer:
    """Lloyd's iterations until the centroids move by less than tolerance; a cluster without rows keeps its centroid.

    init: "k-means||", "sample" (rows by hashed id), both the same for every partitioning, or a matrix. n_init runs with other
    seeds and keeps the one of least inertia. Only k * dimension sums come to the driver in an iteration.
    """

    def __init__(self, n_clusters: int = 100, random_state: int = 42, n_init: int = 1, max_iterations: int = 100, tolerance: float = 1e-4, init="k-means||"):
        self.n_clusters, self.random_state, self.n_init = n_clusters, random_state, n_init
        self.max_iterations, self.tolerance, self.init = max_iterations, tolerance, init

    def _start(self, df: DataFrame, id_field: str, feature: str, seed: int) -> np.ndarray:
        if not isinstance(self.init, str):
            return np.asarray(self.init, np.float64)
        if self.init == "k-means||":
            found = seeds(df, self.n_clusters, id_field, feature, seed)
        elif self.init == "sample":
            rows = df.select(id_field, feature).orderBy(F.xxhash64(F.lit(seed), id_field), id_field).limit(self.n_clusters).collect()
            found = np.array([r[feature] for r in rows], np.float64)
        else:
            raise ValueError(f"no such way to begin: {self.init}")
        if len(found) < self.n_clusters:
            dim = found.shape[1] if len(found) else 1
            found = np.concatenate((found.reshape(-1, dim), np.random.default_rng(seed).normal(size=(self.n_clusters - len(found), dim))))
        return found

    def step(self, df: DataFrame, centroids: np.ndarray, feature: str = "feature") -> np.ndarray:
        out = centroids.copy()
        for r in block_sums(df, centroids, feature).collect():
            out[r["cluster"]] = np.array(r["total"]) / r["members"]
        return out

    def train(self, df: DataFrame, id_field: str = "id", feature: str = "feature") -> KMeansModel:
        missing = [c for c in (id_field, feature) if c not in df.columns]
        if missing:
            raise ValueError(f"k-means needs the columns {missing}; there are {df.columns}")
        df = df.where(F.col(feature).isNotNull()).select(id_field, feature).persist()
        try:
            models = []
            for run in range(self.n_init):
                centroids = self._start(df, id_field, feature, self.random_state + run)
                model = KMeansModel(centroids)
                for i in range(self.max_iterations):
                    after = self.step(df, model.centroids, feature)
                    shift = float(np.linalg.norm(after - model.centroids))
                    model = KMeansModel(after, i + 1, shift < self.tolerance)
                    if model.converged:
                        break
                models.append(model)
            return models[0] if len(models) == 1 else min(models, key=lambda m: m.inertia(df, feature))
        finally:
            df.unpersist()
