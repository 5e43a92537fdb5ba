"""Arrow functions over image bytes: each batch is decoded once, and of its images one at a time is copied for Python."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.image import codec, quality

METADATA = T.StructType([T.StructField("image_width", T.IntegerType()), T.StructField("image_height", T.IntegerType()), T.StructField("image_file_size_bytes", T.LongType()), T.StructField("image_format", T.StringType())])
TECHNICAL = T.StructType([T.StructField("image_compression_artifacts", T.FloatType()), T.StructField("image_information_entropy", T.FloatType())])


def each(data: pa.Array) -> Iterator[bytes | None]:
    return (d.as_py() for d in data)


def floats(names: Sequence[str], rows: list[Sequence[float | None]]) -> pa.Array:
    """A struct of float columns; NaN is null."""
    columns = np.array(rows, np.float32).reshape(len(rows), len(names)).T.copy()
    return pa.StructArray.from_arrays([pa.array(c, from_pandas=True) for c in columns], names=list(names))


def _metadata(data: pa.Array) -> pa.Array:
    rows = [(*(codec.header(d) or (0, 0, "ERROR")), len(d or b"")) for d in each(data)]
    width, height, kind, size = zip(*rows, strict=True) if rows else ((),) * 4
    columns = [pa.array(width, pa.int32()), pa.array(height, pa.int32()), pa.array(size, pa.int64()), pa.array(kind, pa.string())]
    return pa.StructArray.from_arrays(columns, names=METADATA.names)


def _technical(data: pa.Array) -> pa.Array:
    rows = []
    for d in each(data):
        found = codec.decode(d)
        rows.append((quality.artifacts(found[0], len(d)), quality.entropy(found[0])) if found else (0.0, 0.0))
    return floats(TECHNICAL.names, rows)


metadata = F.arrow_udf(_metadata, METADATA)
#: Called non-deterministic, so that a filter over its results is not pushed below it and decodes the images again.
technical = F.arrow_udf(_technical, TECHNICAL).asNondeterministic()


def phash(hash_size: int = 16, kind: str = "dct"):
    """A function of image bytes to their hash, null for bytes that can't be decoded."""

    def hashed(data: pa.Array) -> pa.Array:
        make = quality.phash if kind == "dct" else quality.gradient_hash
        return pa.array([make(found[0], hash_size) if (found := codec.decode(d)) else None for d in each(data)], pa.string())

    return F.arrow_udf(hashed, T.StringType())
