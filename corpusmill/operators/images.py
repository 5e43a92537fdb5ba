"""Refiners of images: metadata, technical quality, model outputs and scores of embeddings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import vector
from corpusmill.image import udfs
from corpusmill.ml.linear import collapse
from corpusmill.operators.base import Refiner

#: Heads of the visual degradation model.
DEGRADATIONS = ("color_cast", "blurriness", "watermark", "noise", "overall_quality")


def _bytes(df: DataFrame, field: str):
    kind = df.schema[field].dataType if field in df.columns else None
    if isinstance(kind, T.StructType) and "bytes" in kind.names:
        return F.col(f"{field}.bytes")
    return F.lit(None).cast("binary")


class _Image(Refiner):
    def __init__(self, image_field: str = "image"):
        self.image_field = image_field

    def _spread(self, df: DataFrame, function, kind: T.StructType) -> DataFrame:
        out = df.withColumn("_found", function(_bytes(df, self.image_field)))
        return out.withColumns({c: F.col(f"_found.{c}") for c in kind.names}).drop("_found")


class ImageMetadataRefiner(_Image):
    """image_width, image_height, image_file_size_bytes, image_format; 0, 0, size and ERROR for what has no known header."""

    def refine(self, df: DataFrame) -> DataFrame:
        return self._spread(df, udfs.metadata, udfs.METADATA)


class ImageTechnicalQualityRefiner(_Image):
    """image_compression_artifacts and image_information_entropy; 0 and 0 for what can't be decoded."""

    def refine(self, df: DataFrame) -> DataFrame:
        return self._spread(df, udfs.technical, udfs.TECHNICAL)


class ImageVisualDegradationsRefiner(_Image):
    """img_vd_* of a model: a factory, called once in each worker, of a function from image bytes to five numbers.

    Without a model, and for bytes that it can't read, the columns are null.
    """

    def __init__(self, model: Callable[[], Callable[[bytes], Sequence[float] | None]] | None = None, image_field: str = "image", **_):
        super().__init__(image_field)
        self.model = model

    def refine(self, df: DataFrame) -> DataFrame:
        names = [f"img_vd_{d}" for d in DEGRADATIONS]
        if self.model is None:
            return df.withColumns({c: F.lit(None).cast("float") for c in names})
        make, kind = self.model, T.StructType([T.StructField(c, T.FloatType()) for c in names])
        cache: list = []

        def run(data: pa.Array) -> pa.Array:
            if not cache:
                cache.append(make())
            return udfs.floats(names, [(cache[0](d) if d else None) or (None,) * len(names) for d in udfs.each(data)])

        return self._spread(df, F.arrow_udf(run, kind), kind)


class _Embedding(_Image):
    """A column of embeddings by a backend: a factory of a function from a list of image bytes to a matrix.

    Images that can't be read (the backend gives None) and missing ones get the zero vector.
    """

    prefix = ""

    def __init__(self, backend: Callable[[], Callable[[list[bytes]], Sequence]] | None = None, dim: int = 512, normalize: bool = True, feature_field_name: str | None = None, inference_batch_size: int = 32, image_field: str = "image", **_):
        super().__init__(image_field)
        self.backend, self.dim, self.normalize, self.batch = backend, dim, normalize, inference_batch_size
        self.feature_field_name = feature_field_name

    def default_name(self) -> str:
        raise NotImplementedError

    def refine(self, df: DataFrame) -> DataFrame:
        if self.backend is None:
            raise ValueError(f"{self.name} needs a backend; no pretrained weights come with this package")
        make, dim, size, unit = self.backend, self.dim, self.batch, self.normalize
        cache: list = []

        def run(data: pa.Array) -> pa.Array:
            if not cache:
                cache.append(make())
            out = np.zeros((len(data), dim), np.float32)
            real = [i for i, n in enumerate(pc.binary_length(data).to_pylist()) if n]
            for at in range(0, len(real), size):
                some = real[at : at + size]
                for i, v in zip(some, cache[0]([data[i].as_py() for i in some]), strict=True):
                    if v is not None:
                        out[i] = v
            if unit:
                length = np.linalg.norm(out, axis=1, keepdims=True)
                out = np.divide(out, length, out=out, where=length > 0)
            ends = pa.array(np.arange(len(data) + 1, dtype=np.int32) * np.int32(dim))
            return pa.ListArray.from_arrays(ends, pa.array(out.ravel()), type=pa.list_(pa.field("element", pa.float32(), False)))

        function = F.arrow_udf(run, T.ArrayType(T.FloatType(), False))
        return df.withColumn(self.feature_field_name or self.default_name(), function(_bytes(df, self.image_field)))


class ImageClipEmbeddingRefiner(_Embedding):
    def __init__(self, model_name: str = "ViT-B-32", **options):
        super().__init__(**options)
        self.model_name = model_name

    def default_name(self) -> str:
        return "image_clip_emb_" + self.model_name.lower().replace("-", "_").replace("/", "_").replace(" ", "_")


class ImageSigLIPEmbeddingRefiner(_Embedding):
    def __init__(self, model_name: str = "google/siglip2-so400m-patch14-384", **options):
        super().__init__(**options)
        self.model_name = model_name

    def default_name(self) -> str:
        return "image_siglip_emb_" + self.model_name.split("/")[-1].lower().replace("-", "_").removeprefix("siglip2_")


class ImageAestheticQualityRefiner(Refiner):
    """image_aesthetic_score: a stack of linear layers is one linear map, so the score is an expression without Python.

    layers: [(weight [out, in], bias [out]), ...]. Null embeddings and those of another length score 0.
    """

    def __init__(self, embedding_field: str, layers: Sequence[tuple]):
        self.required_columns = (embedding_field,)
        self.embedding_field = embedding_field
        self.weight, self.bias = collapse(layers)

    def refine(self, df: DataFrame) -> DataFrame:
        e = F.col(self.embedding_field)
        value = vector.dot(e, vector.literal(self.weight)) + F.lit(float(self.bias))
        fits = F.coalesce(F.size(e) == len(self.weight), F.lit(False))
        return df.withColumn("image_aesthetic_score", F.when(fits, value).otherwise(F.lit(0.0)).cast("float"))


class ImageAIGCDetectorRefiner(Refiner):
    """image_aigc_score and image_is_aigc (score > threshold) of a small network over an embedding.

    layers: [(weight, bias), ...] with ReLU between them and a sigmoid at the end; batch norms are folded in before.
    Null embeddings and those of another length give 0 and false.
    """

    def __init__(self, embedding_field: str, layers: Sequence[tuple], threshold: float = 0.5):
        self.required_columns = (embedding_field,)
        self.embedding_field, self.threshold = embedding_field, threshold
        self.layers = [(np.asarray(w, np.float64), np.asarray(b, np.float64)) for w, b in layers]

    def refine(self, df: DataFrame) -> DataFrame:
        """Layer by layer as columns, so each unit is worked out once; no Python on the way."""
        e = F.col(self.embedding_field)
        fits = F.coalesce(F.size(e) == self.layers[0][0].shape[1], F.lit(False))
        out = df.withColumn("_layer0", F.when(fits, F.transform(e, lambda v: v.cast("double"))))
        for i, (weight, bias) in enumerate(self.layers[:-1]):
            units = [F.greatest(vector.dot(F.col(f"_layer{i}"), vector.literal(w)) + F.lit(float(b)), F.lit(0.0)) for w, b in zip(weight, bias, strict=True)]
            out = out.withColumn(f"_layer{i + 1}", F.when(F.col(f"_layer{i}").isNotNull(), F.array(*units)))
        last = F.col(f"_layer{len(self.layers) - 1}")
        score = vector.sigmoid(vector.dot(last, vector.literal(self.layers[-1][0][0])) + F.lit(float(self.layers[-1][1][0])))
        out = out.withColumn("image_aigc_score", F.coalesce(F.when(last.isNotNull(), score), F.lit(0.0)).cast("float"))
        return out.withColumn("image_is_aigc", F.col("image_aigc_score") > F.lit(self.threshold).cast("float")).drop(*(f"_layer{i}" for i in range(len(self.layers))))
