"""Exact substring deduplication by a depth-limited radix sort of byte suffixes.

Suffixes are compared through the threshold only, most significant digit first, and whatever is alone after a digit
is done. The first digit of a suffix is the smallest of the 37-byte strings in its first 100 bytes: equal windows have
equal digits, and as neighbouring suffixes mostly share the digit, one record stands for a run of about 30 of them. The
second digit is all bytes of the run: runs that agree in it are repeated windows. Of runs that agree in the first digit
only, one of each kind goes on: 32 bytes more to one side of the first digit part them again, so that a phrase of very
many documents is spread by what surrounds it, and the last digit is all 100 bytes of each of their suffixes; equal groups
are exactly the repeated windows.

Bytes are compared by 96-bit BLAKE2b digests, the first digits and the parts of open runs by weak hashes: where these
agree by chance, runs go on to the next digit, and nothing else. Equal runs of one batch meet before the shuffle.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from corpusmill.llm.hashing import BLOCK, U, mix, prefix, slice_hash, window_hash
from corpusmill.llm.storage import materialize

LENGTH, DIGIT, SIDE = 100, 37, 32
#: Suffixes that a task of the last pass holds at once.
SUFFIXES = 400_000
#: Bytes of text that a task works on at once: the arrays take some ten times as much.
LOT = 8 << 20
#: Parts of open runs after which a task sends them on.
PARTS = 100_000
#: Kinds of runs with one first digit in a lot up to which they are dealt out by it: a phrase of a tenth of the rows. More
#: are known to share the digit and go on at once, and a mark says so to those of other batches. So a lot adds a bounded
#: number to any bucket; a lower bound would send more runs on that the first digit's bucket settles.
KINDS = 1000
_STEPS = (1, 2, 4, 8, 16, 32)
assert sum(_STEPS) + 1 + DIGIT == LENGTH + 1
_RUNS, _COVERED, _OPEN = 0, 1, 2
#: The shape of a run: its windows less 1, and 256 times the place of the first digit in its first window; and a mark.
_MARK = 1 << 15
_DIGEST = np.dtype([("a", "<u8"), ("b", "<u4")])
_PACKED = "bucket int, kind byte, body binary"
_SPANS = "kind byte, k long, part long, los array<long>, ends array<long>"
_SPAN_SCHEMA = pa.schema([("kind", pa.int8()), ("k", pa.int64()), ("part", pa.int64()), ("los", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def digests(buffer: memoryview, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The digest of each slice."""
    return np.frombuffer(b"".join([blake2b(buffer[a:b], digest_size=12).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]), _DIGEST)


def runs_of(buffer: np.ndarray, valid: np.ndarray):
    """Runs of windows with one first digit: (digit, its place in the first window, first start, last start)."""
    low = mix(window_hash(prefix(buffer), DIGIT))
    at = np.arange(len(low), dtype=np.int32)
    for d in _STEPS:
        left = low[:-d] <= low[d:]
        at = np.where(left, at[:-d], at[d:])
        low = np.minimum(low[:-d], low[d:])
    change = np.flatnonzero((at[1:] != at[:-1]) | (valid[1:] != valid[:-1])) + 1
    start = np.concatenate(([0], change))
    end = np.concatenate((change, [len(at)])) - 1
    keep = valid[start]
    start, end = start[keep], end[keep]
    return low[start], at[start] - start, start, end


def _pieces(texts: list[bytes]):
    """Groups of (index, offset, bytes) of about BLOCK bytes; parts of a long text overlap by a window less one byte."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), BLOCK):
            part = text[at : at + BLOCK + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            group.append((i, at, part))
            size += len(part)
            if size >= BLOCK:
                yield group
                group, size = [], 0
    if group:
        yield group


def _records(texts: list[bytes]):
    """Columns (row, start, shape, first digit, digest of the bytes) of all runs, in the order of the texts."""
    out = []
    for group in _pieces(texts):
        whole = b"".join(p for _, _, p in group)
        ends = np.cumsum([len(p) for _, _, p in group])
        begins = np.concatenate(([0], ends[:-1]))
        windows = len(whole) - LENGTH + 1
        valid = np.ones(windows, bool)
        for a, e in zip(begins.tolist(), ends.tolist(), strict=True):
            valid[max(a, e - LENGTH + 1) : e] = False
        digit, place, start, end = runs_of(np.frombuffer(whole, np.uint8), valid)
        piece = np.searchsorted(ends, start, side="right")
        rows = np.array([i for i, _, _ in group])[piece]
        offsets = np.array([o for _, o, _ in group])[piece]
        out.append((rows, start - begins[piece] + offsets, end - start + 256 * place, digit, digests(memoryview(whole), start, end + LENGTH)))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, U, _DIGEST))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pack(*columns: np.ndarray) -> bytes:
    """Length, then the columns' bytes; the width of each is fixed by its place."""
    body = np.int64(len(columns[0])).tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(body: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * width
    return out


def _six(values: np.ndarray) -> np.ndarray:
    """The upper 48 bits in six bytes each."""
    return np.ascontiguousarray((values >> U(16)).view(np.uint8).reshape(-1, 8)[:, :6]).view("V6").ravel()


def _wide(values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), 8), np.uint8)
    out[:, :6] = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 6)
    return out.view(np.int64).ravel()


def _first_of_group(key: np.ndarray) -> np.ndarray:
    """For each digest the index of the first that is equal."""
    a, b = key["a"], key["b"]
    order = np.argsort(a, kind="stable")
    same = a[order][1:] == a[order][:-1]
    if (same & (b[order][1:] != b[order][:-1])).any():
        order = np.lexsort((b, a))
        same = a[order][1:] == a[order][:-1]
    new = np.concatenate(([True], ~same | (b[order][1:] != b[order][:-1])))
    first = np.empty(len(key), np.int64)
    first[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return first


def _merged(k, part, lo, end):
    """Union of intervals, which come in order of their starts, per document."""
    if not len(lo):
        return k, part, lo, end
    other = np.concatenate(([False], (k[1:] != k[:-1]) | (part[1:] != part[:-1])))
    base = np.cumsum(other) << 40  # ends of later documents are above all of those before
    end = np.maximum.accumulate(end + base) - base
    new = np.concatenate(([True], other[1:] | (lo[1:] > end[:-1])))
    begin = np.flatnonzero(new)
    return k[begin], part[begin], lo[begin], end[np.concatenate((begin[1:], [len(lo)])) - 1]


def _dealt(bucket: np.ndarray, kind: int, columns: list[np.ndarray], out: tuple[list, list, list]) -> None:
    """Pack columns by bucket into the lists of out: buckets, kinds, bodies."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for pick in np.split(order, edges):
        out[0].append(int(bucket[pick[0]]))
        out[1].append(kind)
        out[2].append(_pack(*(c[pick] for c in columns)))


def _packed_batch(out: tuple[list, list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int8()), pa.array(out[2], pa.binary())], ["bucket", "kind", "body"])


def _share(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _lots(batch: pa.RecordBatch):
    """(k, part, texts) of a batch's rows in order of k and part, LOT bytes at a time."""
    k, part = batch.column("k").to_numpy(), batch.column("part").to_numpy()
    raw, own, size = batch.column("text").cast(pa.binary()), [], 0
    for i in np.lexsort((part, k)).tolist():
        own.append(i)
        size += len(raw[i].as_buffer() or b"") if raw[i].is_valid else 0
        if size >= LOT:
            yield k[own], part[own], [raw[j].as_py() or b"" for j in own]
            own, size = [], 0
    if own:
        yield k[own], part[own], [raw[j].as_py() or b"" for j in own]


def _scan(buckets: int):
    """First pass over the texts: runs that recur within a lot are settled at once, one of each kind is dealt out."""

    def run(batches):
        for k, part, texts in (lot for batch in batches for lot in _lots(batch)):
            row, lo, n, digit, rest = _records(texts)
            if not len(row):
                continue
            first = _first_of_group(rest)
            own = first == np.arange(len(first))
            same = (k[row] == k[row[first]]) & (part[row] == part[row[first]]) & (lo == lo[first])
            late = ~own & ~same
            out = ([], [], [])
            found = _merged(k[row[late]], part[row[late]], lo[late], lo[late] + n[late] % 256 + LENGTH)
            _dealt(_share(mix(found[0].astype(np.int64).view(U)), buckets), _COVERED, list(found), out)
            row, lo, n, digit, rest = row[own], lo[own], n[own], digit[own], rest[own]
            _, group, sizes = np.unique(digit, return_inverse=True, return_counts=True)
            many = sizes[group] > KINDS
            _dealt(_share(rest["a"][many], buckets), _OPEN, [k[row[many]], part[row[many]], lo[many], n[many]], out)
            marks = np.flatnonzero(many)[np.unique(group[many], return_index=True)[1]] if many.any() else np.empty(0, np.int64)
            some = np.concatenate((np.flatnonzero(~many), marks))
            n = n.astype(np.uint16)
            n[marks] |= _MARK
            # first digits are minima, so nearly all are small numbers: mixed again, they fill all buckets alike
            _dealt(_share(mix(digit[some]), buckets), _RUNS, [k[row[some]], part[row[some]], lo[some], n[some], _six(digit[some]), rest[some]], out)
            yield _packed_batch(out)

    return run


def _spans(kind: int, k: np.ndarray, part: np.ndarray, lo: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """A row for each document, with its spans in order; of open runs, ends has the shapes."""
    order = np.lexsort((lo, part, k))
    k, part, lo, end = (np.asarray(x, np.int64)[order] for x in (k, part, lo, end))
    if kind == _COVERED:
        k, part, lo, end = _merged(k, part, lo, end)
    at = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (part[1:] != part[:-1])))) if len(k) else np.empty(0, np.int64)
    offsets = pa.array(np.append(at, len(k)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int8)), pa.array(k[at]), pa.array(part[at]), pa.ListArray.from_arrays(offsets, pa.array(lo)), pa.ListArray.from_arrays(offsets, pa.array(end))], schema=_SPAN_SCHEMA)


def _first_digits(table: pa.Table) -> pa.Table:
    """One bucket of first digits: runs with an equal one before them are covered; kinds that share the digit stay open."""
    done: dict[int, list] = {_COVERED: [], _OPEN: []}
    parts = []
    for kind, body in zip(table.column("kind").to_pylist(), table.column("body"), strict=True):
        if kind == _RUNS:
            parts.append(_unpack(body.as_py(), np.int64, np.int64, np.int64, np.uint16, "V6", _DIGEST))
        else:
            done[kind].append(_unpack(body.as_py(), np.int64, np.int64, np.int64, np.int64))
    if parts:
        k, part, lo, n, key, rest = (np.concatenate(x) for x in zip(*parts, strict=True))
        key, n = _wide(key), n.astype(np.int64)
        order = np.lexsort((lo, part, k, rest["b"], rest["a"], key))
        k, part, lo, n, key, rest = (x[order] for x in (k, part, lo, n, key, rest))
        digit = np.concatenate(([True], key[1:] != key[:-1]))
        kind = digit | np.concatenate(([True], rest[1:] != rest[:-1]))
        head = np.flatnonzero(kind)[np.cumsum(kind) - 1]
        group = np.cumsum(digit) - 1
        marked = np.bincount(group, weights=n >= _MARK)[group] > 0
        late = ~kind & ~marked & ~((k == k[head]) & (part == part[head]) & (lo == lo[head]))
        still = np.where(marked, n < _MARK, kind & (np.bincount(group, weights=kind) > 1)[group])
        done[_COVERED].append((k[late], part[late], lo[late], lo[late] + n[late] % 256 + LENGTH))
        done[_OPEN].append((k[still], part[still], lo[still], n[still]))
    out = [_spans(kind, *(np.concatenate(x) for x in zip(*found, strict=True))) for kind, found in done.items() if found]
    return pa.Table.from_batches(out, _SPAN_SCHEMA)


def _halves(text: bytes, lo: int, shape: int):
    """The open run's windows in two parts with the next digit of each: (first window, windows less 1, digit)."""
    n, place = shape % 256, shape // 256
    at = lo + place
    if place >= SIDE:
        yield lo, min(n, place - SIDE), xxh64_intdigest(text[at - SIDE : at + DIGIT])
    skip = max(0, place - SIDE + 1)
    if n >= skip:
        yield lo + skip, n - skip, xxh64_intdigest(text[at : at + DIGIT + SIDE], 1)


def _fetch(buckets: int):
    """Bytes of the open runs, dealt out by the next digit, PARTS parts at a time."""

    def packed(keys: list, lo: list, n: list, digits: list, spans: list) -> pa.RecordBatch:
        (ks, parts), lo, n, digit = np.array(keys, np.int64).T, np.array(lo, np.int64), np.array(n, np.uint8), np.array(digits, U)
        bucket = _share(digit, buckets)
        order = np.argsort(bucket, kind="stable")
        out = ([], [], [])
        for pick in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            head = _pack(ks[pick], parts[pick], lo[pick], n[pick], digit[pick])
            out[0].append(int(bucket[pick[0]]))
            out[1].append(_OPEN)
            out[2].append(len(head).to_bytes(8, "little") + head + zstandard.ZstdCompressor(level=1).compress(b"".join([spans[i] for i in pick.tolist()])))
        return _packed_batch(out)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found: tuple[list, ...] = ([], [], [], [], [])
            for i, key in enumerate(zip(batch.column("k").to_pylist(), batch.column("part").to_pylist(), strict=True)):
                text = texts[i].as_py()
                shapes = zip(batch.column("los")[i].as_py(), batch.column("ends")[i].as_py(), strict=True)
                for begin, shape in dict.fromkeys(shapes):
                    for first, length, digit in _halves(text, begin, shape):
                        for column, value in zip(found, (key, first, length, digit, text[first : first + length + LENGTH]), strict=True):
                            column.append(value)
                if len(found[0]) >= PARTS:
                    yield packed(*found)
                    found = ([], [], [], [], [])
            if found[0]:
                yield packed(*found)

    return run


def _last_digits(table: pa.Table) -> pa.Table:
    """One bucket of open runs: each of their suffixes is compared through all its bytes, SUFFIXES at a time.

    A weak hash tells which suffixes may be repeated; these are compared by the digests of their bytes.
    """
    parts, texts = [], []
    for body in table.column("body"):
        body = body.as_py()
        size = int.from_bytes(body[:8], "little")
        parts.append(_unpack(body[8 : 8 + size], np.int64, np.int64, np.int64, np.uint8, U))
        texts.append(zstandard.ZstdDecompressor().decompress(body[8 + size :]))
    k, part, lo, n, key = (np.concatenate(x) for x in zip(*parts, strict=True))
    n = n.astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(n + LENGTH)[:-1]))
    whole = b"".join(texts)
    del parts, texts
    # a part whose digit no other has is alone
    _, kinds, sizes = np.unique(key, return_inverse=True, return_counts=True)
    order = np.lexsort((lo, part, k))
    order = order[sizes[kinds[order]] > 1]
    k, part, lo, n, begin = (x[order] for x in (k, part, lo, n, begin))
    none = [np.empty(0, np.int64)] * 4
    if not len(k):
        return pa.Table.from_batches([_spans(_COVERED, *none)], _SPAN_SCHEMA)
    sums, view = prefix(np.frombuffer(whole, np.uint8)), memoryview(whole)
    starts = np.concatenate(([0], np.cumsum(n + 1)))
    repeated = np.zeros(starts[-1], bool)
    passes = int(-(-starts[-1] // SUFFIXES))
    chunks = np.searchsorted(starts, np.arange(0, starts[-1], SUFFIXES), side="left").tolist() + [len(n)]
    for number in range(passes):
        found = []
        for a, b in zip(chunks, chunks[1:], strict=False):
            run = np.repeat(np.arange(a, b), n[a:b] + 1)
            step = np.arange(starts[a], starts[b]) - starts[run]
            at = begin[run] + step
            weak = mix(slice_hash(sums, at, at + LENGTH))
            own = np.flatnonzero(weak % U(passes) == number) if passes > 1 else slice(None)
            found.append((weak[own], run[own], step[own]))
        weak, run, step = (np.concatenate(x) for x in zip(*found, strict=True))
        _, which, many = np.unique(weak, return_inverse=True, return_counts=True)
        again = many[which] > 1
        run, step = run[again], step[again]
        if not len(run):
            continue
        at = begin[run] + step
        first = _first_of_group(digests(view, at, at + LENGTH))
        same = (k[run] == k[run[first]]) & (part[run] == part[run[first]]) & (lo[run] + step == lo[run[first]] + step[first])
        repeated[(starts[run] + step)[~same]] = True
    late = np.flatnonzero(repeated)
    run = np.searchsorted(starts, late, side="right") - 1
    at = lo[run] + late - starts[run]
    order = np.lexsort((at, part[run], k[run]))
    found = _merged(k[run][order], part[run][order], at[order], at[order] + LENGTH) if len(late) else none
    return pa.Table.from_batches([_spans(_COVERED, *found)], _SPAN_SCHEMA)


def _cut(batches):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        kept, offsets, starts, ends = [], [0], [], []
        for i, (lows, highs) in enumerate(zip(batch.column("los"), batch.column("ends"), strict=True)):
            text = texts[i].as_py() or b""
            if lows.is_valid and len(lows.values):
                a, b = lows.values.to_numpy(), highs.values.to_numpy()
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.concatenate(([True], a[1:] > b[:-1]))
                a, b = a[new], b[np.concatenate((np.flatnonzero(new)[1:], [len(b)])) - 1]
                edges = zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)
                text = b"".join([text[x:y] for x, y in edges])
                starts.append(a)
                ends.append(b)
                offsets.append(offsets[-1] + len(a))
            else:
                offsets.append(offsets[-1])
            kept.append(text)
        values = pa.StructArray.from_arrays([pa.array(np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64)) for x in (starts, ends)], ["start", "end"])
        spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).cast(span)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text"), pa.array(kept, pa.binary()), spans], ["doc_id", "text", "kept", "spans"])


def remove_repeats(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, text, kept (binary: the bytes that stay), spans (removed, maximal).

    Each byte goes that lies in a 100-byte string which also starts earlier: in a document of smaller doc_id, or in the
    same one. Matches are of bytes, never cross documents, and are judged on the input.

    Null text: empty. Null doc_id: after all others. Rows with equal doc_id and text are one document, and each gets
    its result; equal doc_id and other texts are in a fixed order of their hashes. Texts under 100 bytes stay. Other
    columns are not read. An empty table gives an empty result. Kept bytes may break a character, so they are binary.

    A task holds one of `buckets` at once: by default 4 times spark.sql.shuffle.partitions, which grows with the input.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("k"), F.xxhash64("text").alias("part"))
    joined = lambda c: F.flatten(F.collect_list(c)).alias(c)
    dealt = docs.select("k", "part", "text").mapInArrow(_scan(buckets), _PACKED)
    settled = materialize(dealt.groupBy("bucket").applyInArrow(_first_digits, _SPANS), "runs")
    still = settled.where(F.col("kind") == _OPEN).groupBy("k", "part").agg(joined("los"), joined("ends"))
    open_ = docs.select("k", "part", "text").join(still, ["k", "part"])
    last = open_.mapInArrow(_fetch(buckets), _PACKED).groupBy("bucket").applyInArrow(_last_digits, _SPANS)
    covered = settled.where(F.col("kind") == _COVERED).union(last).groupBy("k", "part").agg(joined("los"), joined("ends"))
    out = docs.join(covered, ["k", "part"], "left").select("doc_id", "text", "los", "ends")
    return out.mapInArrow(_cut, "doc_id long, text string, kept binary, spans array<struct<start:long,end:long>>")
