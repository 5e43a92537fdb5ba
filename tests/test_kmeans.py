"""k-means by blocks against numpy, seeding, ties and edge rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.ml import kmeans
from corpusmill.ml.kmeans import KMeansModel, KMeansTrainer


def _blobs(n=40, k=6, dim=5, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(k, dim)) * 20
    return np.concatenate([c + rng.normal(size=(n, dim)) * 0.3 for c in centres]), centres


@pytest.fixture
def blobs(spark):
    x, centres = _blobs()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9999, None)], "id long, feature array<double>")
    return df, x, centres


def test_blocks_are_like_expressions(blobs, monkeypatch):
    df, x, centres = blobs
    monkeypatch.setattr(kmeans, "CELLS", 50)
    start = centres[[0, 0, 1, 2]] + 0.5
    got = {r["id"]: (r["cluster"], r["distance"]) for r in kmeans.assign_blocks(df.withColumn("cluster", F.lit("x")).repartition(7), start).collect()}
    far = np.sqrt(((x[:, None] - start[None]) ** 2).sum(axis=2))
    assert got[9999] == (None, None) and [got[i][0] for i in range(len(x))] == far.argmin(axis=1).tolist()  # 0 before 1 on a tie
    assert [got[i][1] for i in range(len(x))] == pytest.approx(far.min(axis=1))
    for parts in (1, 5):
        sums = {r["cluster"]: r for r in kmeans.block_sums(df.repartition(parts), start).collect()}
        assert set(sums) == set(far.argmin(axis=1)) and sums[0]["members"] == (far.argmin(axis=1) == 0).sum()
        assert sums[2]["total"] == pytest.approx(x[far.argmin(axis=1) == 2].sum(axis=0).tolist()) and sums[2]["cost"] == pytest.approx((far.min(axis=1) ** 2)[far.argmin(axis=1) == 2].sum())
    plan = kmeans.block_sums(df, start)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Generate", plan) and len(plan) < 5000  # no centroid in it
    assert kmeans.block_sums(df.limit(0), start).count() == 0


def test_near_ties_go_by_exact_distances():
    c = np.array([[1e6, 1e6], [1e6, 1e6 + 2e-6], [0.0, 0.0]])
    x = np.array([[1e6, 1e6 + 1.5e-6], [1e6, 1e6 + 0.5e-6], [1e6, 1e6]])
    assert kmeans.nearest_rows(x, c)[0].tolist() == [1, 0, 0]


def test_vectors_of_unlike_length(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id long, feature array<double>")
    with pytest.raises(Exception, match="must have 2 elements"):
        kmeans.block_sums(df, np.zeros((1, 2))).collect()


def test_seeding_finds_every_blob(blobs):
    df, x, centres = blobs
    for seed in (1, 2, 3):
        found = kmeans.seeds(df, 6, "id", "feature", seed)
        near = ((found[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert sorted(near.tolist()) == list(range(6))
    assert np.array_equal(kmeans.seeds(df.repartition(5), 6, "id", "feature", 3), found)
    model = KMeansTrainer(6).train(df)
    assert model.converged and model.inertia(df) < 0.3**2 * x.size * 1.2
    assert kmeans.seeds(df.where("id < 2"), 6, "id", "feature", 1).shape == (2, 5) and len(kmeans.seeds(df.limit(0), 6, "id", "feature", 1)) == 0
    alike = df.select("id", F.lit(x[0].tolist()).alias("feature"))
    assert KMeansTrainer(3, max_iterations=2).train(alike).centroids.shape == (3, 5)
    with pytest.raises(ValueError, match="begin"):
        KMeansTrainer(3, init="none").train(df)


def test_model_of_many_centroids(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, feature array<float>")
    model = KMeansModel(rng.normal(size=(200, 64)))
    want = ((x.astype(np.float32).astype(float)[:, None] - model.centroids[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert [r["cluster"] for r in model.predict(df).orderBy("id").collect()] == want.tolist()
