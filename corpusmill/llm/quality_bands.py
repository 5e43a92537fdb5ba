"""Quality rules: word statistics, and compression bands of whole texts and of fixed chunks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.hashing import _SEPARATOR, shingle_hashes, word_hashes
from corpusmill.llm.storage import discard, materialize

LEVEL, CHUNK = 3, 2048
#: The share of chunks outside of their band from which a text is rejected.
CHUNK_SHARE = 0.2
#: Parts of the labelled texts that may lie below and above a band, what is added to it, and the texts of a bin of lengths
#: (half an octave) at least.
TAIL, SLACK, LEAST = 0.002, 0.004, 20
#: Bands are fitted to counts of texts by length (so many cells an octave, a multiple of 2) and ratio (so many cells a unit).
LENGTHS, RATIOS = 32, 4096


@dataclass(frozen=True)
class Bands:
    """Ratios (compressed to plain bytes) that texts may have by length, linear in log2 of the bytes between the points, and
    that fixed chunks may have. Texts under 128 bytes have no upper limit: a compressor's frame makes up too much of them."""

    lowest: dict[int, float]
    highest: dict[int, float]
    chunks: tuple[float, float]

    def limits(self, size: int) -> tuple[float, float]:
        at = np.log2(max(size, 1))
        low, high = (float(np.interp(at, np.log2(list(x)), list(x.values()))) for x in (self.lowest, self.highest))
        return low, high if size >= 128 else float("inf")


#: Without labelled texts: set with room below and above prose in English (public licence texts have 0.53 to 0.56 at 1,000
#: bytes, 0.40 to 0.45 at 4,000, 0.37 to 0.38 at 16,000 and 0.36 at 32,000; their chunks 0.41 to 0.58).
PROSE = Bands({128: 0.5, 512: 0.48, 1024: 0.44, 4096: 0.36, 16384: 0.33, 32768: 0.31, 131072: 0.28}, {128: 1.0, 256: 0.85, 512: 0.78, 1024: 0.7, 4096: 0.62, 16384: 0.58}, (0.37, 0.66))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = b" \t\n\r\x0b\x0c"
_COLUMNS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("ratio", pa.float64()), ("chunks_low", pa.float64()), ("chunks_high", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]


def repeated_words(words: np.ndarray) -> int:
    """Words in 5-word windows that are in the text twice or more, the first such window included."""
    if len(words) < 6:
        return 0
    windows = shingle_hashes(words, 5)
    order = np.argsort(windows)
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    often = np.zeros(len(windows), bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int32)
    at = np.flatnonzero(often)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + 5, -1)
    return int((np.cumsum(covered) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


def chunk_ratios(text: bytes, press) -> list[float]:
    """Ratios of the fixed chunks; a last chunk of under half the size counts with the one before it."""
    cuts = list(range(0, len(text), CHUNK))
    if len(cuts) > 1 and len(text) - cuts[-1] < CHUNK // 2:
        cuts.pop()
    ends = [*cuts[1:], len(text)]
    return [len(press(text[a:b])) / (b - a) for a, b in zip(cuts, ends, strict=True)]


def _measure(bands: Bands):
    def run(batches):
        press = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.binary())]
            rows = [()] * len(texts)
            for i, words in word_hashes(texts):
                text, n = texts[i], len(words)
                letters = symbols = 0
                for at in range(0, len(text), 1 << 20):
                    buffer = np.frombuffer(text[at : at + (1 << 20)], np.uint8)
                    letters += int((((buffer & 0xC0) != 0x80) & ~_SEPARATOR[buffer]).sum())
                    symbols += int(_SYMBOL[buffer].sum())
                repeats = repeated_words(words)
                failed = n < 10 or 100 * repeats > 20 * n
                ratio, low, high = (len(press(text)) / len(text), *bands.limits(len(text))) if text else (0.0, 0.0, 0.0)
                chunks = chunk_ratios(text, press) if len(text) > CHUNK * 3 // 2 else []
                under = sum(r < bands.chunks[0] for r in chunks) / max(1, len(chunks))
                over = sum(r > bands.chunks[1] for r in chunks) / max(1, len(chunks))
                rows[i] = (n, letters, symbols, duplicate_lines(text), repeats, ratio, under, over, failed, not failed and low <= ratio <= high and under <= CHUNK_SHARE and over <= CHUNK_SHARE)
            columns = [pa.array([r[j] for r in rows], kind) for j, (_, kind) in enumerate(_COLUMNS)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], ["doc_id", *(c for c, _ in _COLUMNS)])

    return run


def _cells(batches):
    """Of each text its cell of length and of ratio, and those of its chunks' ratios."""
    press = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        lengths, ratios, chunks = [], [], []
        for text in batch.column("text").cast(pa.binary()):
            text = text.as_py()
            lengths.append(int(np.floor(LENGTHS * np.log2(len(text)))))
            ratios.append(round(RATIOS * len(press(text)) / len(text)))
            chunks.append([round(RATIOS * r) for r in chunk_ratios(text, press)] if len(text) > CHUNK * 3 // 2 else [])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int32()), pa.array(ratios, pa.int32()), pa.array(chunks, pa.list_(pa.int32()))], ["doc_id", "length", "ratio", "chunks"])


def _ends(values: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """The quantiles TAIL and 1 - TAIL of values that occur so many times each, as numpy has them."""
    order = np.argsort(values, kind="stable")
    values, upto = values[order], np.cumsum(counts[order])

    def quantile(q: float) -> float:
        place = q * (int(upto[-1]) - 1)
        low, high = (float(values[np.searchsorted(upto, i, side="right")]) for i in (np.floor(place), np.ceil(place)))
        return low + (high - low) * (place - np.floor(place))

    return quantile(TAIL), quantile(1 - TAIL)


def bands_of(texts, chunks, default: Bands = PROSE) -> Bands:
    """Bands that hold all but a part TAIL of the ratios on either side, and SLACK more; default where there are too few.

    texts: (cell of length, cell of ratio, count); chunks: (cell of ratio, count). A parabola over log2 of the bytes takes
    out how ratios fall with length; the rest has its own quantiles in each bin of lengths, or those of all where a bin has
    under LEAST texts. Beyond the lengths seen, limits go on like default's.
    """
    texts = np.array(sorted(texts), np.int64).reshape(-1, 3)  # sums don't depend on the order of the rows
    chunks = np.array(sorted(chunks), np.int64).reshape(-1, 2)
    band = default.chunks
    if chunks[:, 1].sum() >= LEAST:
        down, up = _ends(chunks[:, 0] / RATIOS, chunks[:, 1])
        band = (down - SLACK, up + SLACK)
    texts = texts[texts[:, 0] >= 7 * LENGTHS]
    if texts[:, 2].sum() < LEAST:
        return Bands(default.lowest, default.highest, band)
    at, ratios, counts = (texts[:, 0] + 0.5) / LENGTHS, texts[:, 1] / RATIOS, texts[:, 2]
    curve = np.polyfit(at, ratios, 2, w=np.sqrt(counts))
    rest = ratios - np.polyval(curve, at)
    bins = 2 * texts[:, 0] // LENGTHS
    low, high = {}, {}
    for b in range(bins.min(), bins.max() + 1):
        own = bins == b
        down, up = _ends(rest[own], counts[own]) if counts[own].sum() >= LEAST else _ends(rest, counts)
        for edge in (b, b + 1):
            size, middle = round(2 ** (edge / 2)), float(np.polyval(curve, edge / 2))
            low[size] = min(low.get(size, 2.0), middle + down - SLACK)
            high[size] = max(high.get(size, 0.0), middle + up + SLACK)
    short, long = min(low), max(low)
    for size in default.lowest:
        if size > long:
            low[size] = low[long] + default.limits(size)[0] - default.limits(long)[0]
    for size in default.highest:
        if size < short:
            high[size] = high[short] + default.limits(size)[1] - default.limits(short)[1]
    return Bands(dict(sorted(low.items())), dict(sorted(high.items())), band)


def fit(docs: DataFrame, labels: DataFrame) -> Bands:
    """Bands of all texts whose quality is labelled 1: labels (doc_id, quality).

    Every text is compressed where it is, and only its cells of length and ratios are joined with the labels and counted;
    the driver gets the counts, whose number is bounded by the cells. Null ids and texts, empty texts and unlabelled ones
    are left out; of labels of one doc_id the least counts. Too few texts give PROSE.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & (F.octet_length("text") > 0))
    cells = texts.mapInArrow(_cells, "doc_id long, length int, ratio int, chunks array<int>")
    cells = materialize(cells.join(marked.where("quality = 1").select("doc_id"), "doc_id").drop("doc_id"), "cells")
    chunks = cells.select(F.explode("chunks").alias("ratio")).groupBy("ratio").count().collect()
    bands = bands_of(map(tuple, cells.groupBy("length", "ratio").count().collect()), map(tuple, chunks))
    discard(cells)
    return bands


def quality(docs: DataFrame, bands: Bands = PROSE) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio, chunks_low, chunks_high, base_failed, kept.

    base_failed: under 10 words, or over 20 % of the words in repeated 5-word windows. kept: not base_failed, and the
    zstandard ratio is in the band for the text's length, and at most CHUNK_SHARE of the 2048-byte chunks are too
    repetitive, or too hard to compress. One map over the texts, without a shuffle; a text is read whole.

    Null or empty text: all counts 0, base_failed. Null and repeated doc_ids: a result for each row; equal texts get
    equal results, and a ratio that ties with a limit is inside. Other columns are not read. An empty table gives an
    empty result.
    """
    kinds = {"int64": "long", "double": "double", "bool": "boolean"}
    schema = ", ".join(["doc_id long", *(f"{c} {kinds[str(k)]}" for c, k in _COLUMNS)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measure(bands), schema)
