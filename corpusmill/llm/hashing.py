"""Vectorised hashing of words and byte windows over concatenated texts.

A prefix sum of random byte values times powers of an odd base gives the 64-bit hash of any slice in O(1); all
arithmetic is modulo 2**64.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = (np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, 256, dtype=np.uint64) << U(1)) | U(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_powers: dict[int, np.ndarray] = {}
#: Bytes hashed at once: the arrays of one block take about 60 times as much.
BLOCK = 1 << 20


def _table(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(BLOCK + 4096, n)
        out = np.empty(size, U)
        out[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            np.multiply(out[:step], U(pow(base, done, 1 << 64)), out=out[done : done + step])
            done += step
        _powers[base] = have = out
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def prefix(buffer: np.ndarray) -> np.ndarray:
    """Prefix sums of which slice_hash takes differences."""
    out = np.empty(len(buffer) + 1, U)
    out[0] = 0
    values = _VALUES[buffer]
    values *= _table(_BASE, len(buffer))[: len(buffer)]
    np.cumsum(values, out=out[1:])
    return out


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = sums[end] - sums[start]
    out *= _table(_INVERSE, len(sums))[start]
    return out


def window_hash(sums: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of that many bytes."""
    n = len(sums) - width
    if n <= 0:
        return np.empty(0, U)
    out = sums[width:] - sums[:n]
    out *= _table(_INVERSE, n)[:n]
    return out


def word_bounds(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+."""
    inside = np.empty(len(buffer) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SEPARATOR[buffer], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def _words(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buffer = np.frombuffer(block, np.uint8)
    start, end = word_bounds(buffer)
    if not len(start):
        return np.empty(0, U), start, end
    sums = prefix(buffer)
    return mix(slice_hash(sums, start, end) + (end - start).astype(U)), start, end


def _pieces(text: bytes):
    """Parts of a long text, cut at separators, so that no array grows with the text."""
    at = 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        if end < len(text):
            cut = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:  # one word fills the block: go on to its end
                found = [p for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := text.find(c, end)) >= 0]
                cut = min(found, default=len(text))
            end = max(cut, at + 1)
        yield text[at:end]
        at = end


def word_hashes(texts: list[bytes | None], lower: bool = False):
    """Yield (index of a text, hashes of its words in order) for each text; null counts as empty."""
    group: list[int] = []
    size = 0

    def flush():
        block = b"\n".join(texts[i] or b"" for i in group)
        if lower:
            block = block.translate(_LOWER)
        hashes, start, _ = _words(block)
        ends = np.cumsum([len(texts[i] or b"") + 1 for i in group])
        cuts = np.searchsorted(start, ends)
        low = 0
        for i, high in zip(group, cuts.tolist(), strict=True):
            yield i, hashes[low:high]
            low = high

    for i, text in enumerate(texts):
        n = len(text or b"")
        if n > BLOCK:
            parts = [_words(p.translate(_LOWER) if lower else p)[0] for p in _pieces(text)]
            yield i, np.concatenate(parts)
            continue
        if group and size + n > BLOCK:
            yield from flush()
            group, size = [], 0
        group.append(i)
        size += n + 1
    if group:
        yield from flush()


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of width words in order, repeated ones included; of fewer words, of the whole sequence."""
    n = len(words)
    if n == 0:
        return np.empty(0, U)
    width_here = min(n, width)
    out = words[: n - width_here + 1] + U(width_here)
    for j in range(1, width_here):
        out = (out ^ (out >> U(29))) * U(0xBF58476D1CE4E5B9) + words[j : n - width_here + 1 + j]
    return mix(out)


def distinct(values: np.ndarray) -> np.ndarray:
    out = np.sort(values)
    return out[np.concatenate(([True], out[1:] != out[:-1]))] if len(out) else out
