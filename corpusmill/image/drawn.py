"""Images for the queries, drawn from embeddings, and a stand-in for an image model.

Tasks import this module by name, so it imports only what they need.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from corpusmill.image import codec


def drawn(i: int, e) -> bytes:
    """A PNG for an embedding: noise of its values, of several sizes and grains; some ids repeat the image before them."""
    seed = i - 1 if i % 10 == 1 else i
    rng = np.random.default_rng(seed)
    side = 64 + 32 * (seed % 9)
    base = rng.random((4, 4, 3)) * 200 if seed % 10 == 0 else np.abs(np.asarray(e, np.float64)[:48].reshape(4, 4, 3)) * 400
    big = np.kron(base, np.ones((side // 4, side // 4, 1)))
    noise = rng.integers(0, 1 + 8 * (seed % 7), big.shape)
    return b"not an image" if i % 50 == 7 else codec.encode_png((big + noise).clip(0, 255).astype(np.uint8))


#: Images of a batch that leaves a task's Python; a batch of embeddings is some thousand times smaller than its images.
DRAWN = 16


def drawings(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, DRAWN):
            ids, embeddings = batch.slice(at, DRAWN).columns
            data = pa.array(map(drawn, ids.to_pylist(), embeddings.to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.StructArray.from_arrays([data], ["bytes"])], ["id", "image"])


def backend():
    """A stand-in for an image model: colour histograms."""

    def run(images):
        found = [codec.decode(d) for d in images]
        return [None if f is None else np.histogram(f[0], 64, (0, 256))[0] for f in found]

    return run
