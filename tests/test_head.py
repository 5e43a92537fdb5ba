"""Training of a head: gradients against differences, sums over partitions, F1 and the kept state."""

import numpy as np
import pytest

from corpusmill.ml import head
from corpusmill.ml.evaluation import binary_metrics, hash_split
from corpusmill.ml.head import Head, HeadTrainer


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    layers, x, y = head.fresh((5, 4, 3, 1), 2), rng.normal(size=(30, 5)), rng.integers(0, 2, 30)
    flat = head._flat(layers)
    found, loss = head.gradient(layers, x, y, 0.3, 1.5)
    for i in range(0, len(flat), 3):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        up, down = (head.gradient(head._shaped(flat + d, layers), x, y, 0.3, 1.5)[1] for d in (step, -step))
        assert found[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-6)
    p = head.forward(x, layers)
    right = np.where(y == 1, p, 1 - p)
    assert loss == pytest.approx((-0.3 * (1 - right) ** 1.5 * np.log(right)).sum())


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6))
    y = ((x[:, 0] * x[:, 1] > 0) & (x[:, 2] > -1)).astype(int)
    return spark.createDataFrame([(i, v.tolist(), int(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))] + [(9000, None, 1), (9001, x[0].tolist(), None)], "id long, feature array<double>, label int").repartition(5), x, y


def test_sums_do_not_depend_on_partitions(rows):
    df, x, y = rows
    layers = head.fresh((6, 8, 1))
    want, loss = head.gradient(layers, x, y)
    for parts in (1, 9):
        got = head.summed_gradient(df.repartition(parts), layers)
        assert got[0] == pytest.approx(want) and got[1] == pytest.approx(loss) and got[2] == 600
    assert head.summed_gradient(df.limit(0), layers)[2] == 0


def test_a_trained_head(rows, tmp_path):
    df, _, _ = rows
    trainer = HeadTrainer(hidden=(32,), epochs=20, steps=2, rate=0.1, warmup=1, patience=20)
    found = trainer.train(df)
    held = hash_split(df.where("feature IS NOT NULL AND label IS NOT NULL"), "id", trainer.validation, trainer.seed)[1]
    f1 = binary_metrics(found.predict(held)).first()["f1"]
    assert f1 > 0.85 and f1 == pytest.approx(max(h["f1"] for h in found.history))  # the best state is kept
    assert found.history[-1]["train_loss"] < found.history[0]["train_loss"] and trainer.rate_at(0) < trainer.rate_at(1) > trainer.rate_at(39) > 0
    out = found.predict(df)
    assert out.where("feature IS NULL AND probability IS NULL AND predicted IS NULL").count() == 1 and out.count() == 602
    found.save(str(tmp_path / "head.json"))
    again = Head.load(str(tmp_path / "head.json"))
    assert all((a == b).all() for x, y in zip(again.layers, found.layers, strict=True) for a, b in zip(x, y, strict=True))


def test_training_stops_early_and_needs_rows(rows):
    df, _, _ = rows
    assert len(HeadTrainer(hidden=(4,), epochs=20, rate=0.0, patience=2).train(df).history) == 3
    with pytest.raises(ValueError, match="no rows"):
        HeadTrainer().train(df.limit(0))
