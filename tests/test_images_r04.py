"""Findings F5 to F9 of round 4: what a task's Python holds of its images."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from corpusmill import queries
from corpusmill.image import codec, udfs
from corpusmill.operators import images


def _functions():
    """The Arrow functions of the operators, with the finding that names each."""
    taken = []

    class Taken(images._Image):
        def _spread(self, df, function, kind):
            taken.append(function)

    class Degradations(Taken, images.ImageVisualDegradationsRefiner):
        pass

    Degradations(lambda: lambda d: [len(d)] * 5).refine(None)
    return {"F5": udfs.technical, "F6": udfs.metadata, "F7": taken[0], "phash": udfs.phash()}


@pytest.mark.parametrize("finding", ["F5", "F6", "F7", "phash"])
def test_one_image_at_a_time_is_copied(spark, finding):
    noise = codec.encode_png(np.random.default_rng(4).integers(0, 256, (184, 184, 3)))
    data = pa.array([noise] * 200)  # 20 MB
    function = _functions()[finding].func
    tracemalloc.start()
    try:
        found = function(data).to_pylist()
        assert tracemalloc.get_traced_memory()[1] < 8_000_000
        values = {"F5": {"image_information_entropy": pytest.approx(8, abs=0.02)}, "F6": {"image_width": 184}, "F7": {"img_vd_noise": len(noise)}}.get(finding, {})
        assert len(found) == 200 and all(r and all(r[k] == v for k, v in values.items()) for r in found)
    finally:
        tracemalloc.stop()


def test_a_model_gets_its_own_batch_of_images_only(spark):
    """of the images that Spark hands over, the inference batch alone is copied."""
    peaks = []

    def backend():
        tracemalloc.start()

        def run(some):
            peaks.append((len(some), tracemalloc.get_traced_memory()[1]))
            return [np.ones(4)] * len(some)

        return run

    class Frame:
        columns = ["image"]
        schema = {"image": spark.createDataFrame([], "image struct<bytes: binary>").schema["image"]}

        def withColumn(self, name, column):  # noqa: N802
            return column

    made = []
    plain = images.F.arrow_udf
    images.F.arrow_udf = lambda f, kind: made.append(f) or plain(f, kind)
    try:
        images.ImageSigLIPEmbeddingRefiner(backend=backend, dim=4, inference_batch_size=8).refine(Frame())
    finally:
        images.F.arrow_udf = plain
    try:
        assert made[0](pa.array([b"x" * 100_000] * 200)).to_pylist() == [[0.5] * 4] * 200
    finally:
        tracemalloc.stop()
    assert {n for n, _ in peaks} == {8} and max(m for _, m in peaks) < 3_000_000


def test_filter_reads_each_image_once(spark):
    """F8: the filter over the measures was pushed below them, so a second step took and decoded all images again."""
    plan = queries.image_quality_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("MapInArrow") == 1


def test_odd_images(spark):
    flat = codec.encode_png(np.full((8, 8, 3), 7, np.uint8))
    rows = [(k, (d,)) for k, d in enumerate([flat, b"", None, b"xx"])] + [(4, None)]
    df = spark.createDataFrame(rows, "id int, image struct<bytes: binary>").coalesce(1)

    def found(op):
        return [tuple(r)[2:] for r in sorted(op.transform(df).collect())]

    none = (0, 0, 0, "ERROR")
    assert found(images.ImageMetadataRefiner()) == [(8, 8, len(flat), "PNG"), none, none, (0, 0, 2, "ERROR"), none]
    assert [r == (0.0, 0.0) for r in found(images.ImageTechnicalQualityRefiner())] == [False, True, True, True, True]
    model = images.ImageVisualDegradationsRefiner(lambda: lambda d: None if d == b"xx" else [0.5, float("nan"), None, 1, len(d)])
    some, nulls = (0.5, None, None, 1.0, float(len(flat))), (None,) * 5
    assert found(model) == [some, nulls, nulls, nulls, nulls]
    embedder = images.ImageSigLIPEmbeddingRefiner(backend=lambda: lambda some: [None if d == b"xx" else [3, 4] for d in some], dim=2)
    unit = [pytest.approx(0.6), pytest.approx(0.8)]
    assert [r[0] for r in found(embedder)] == [unit, [0, 0], [0, 0], [0, 0], [0, 0]]
