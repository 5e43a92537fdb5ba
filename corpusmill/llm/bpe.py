"""Byte-level BPE by a global shuffle of distinct words.

Texts are split into pre-tokens block by block. Some blocks of a task together send their distinct words to the partitions
of the words' hashes, where each distinct word of the corpus is encoded once, and their positions (the code of the word at
each position) to the place where the ids come back. So a frequent word is one entry of such a group of blocks, never one
row of each occurrence. Words and positions leave in one exchange, which both further steps read, so every text is split
once.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.storage import frugal

#: Characters of text after which a block ends, and from which a text is split without a list of all its pre-tokens.
BLOCK, LONG = 1 << 20, 1 << 20
#: Distinct words whose ids a task remembers; a word that is met again later is encoded again.
KNOWN = 300_000
#: Blocks that share a list of words, which is sent once for them; UTF-8 bytes of the corpus for each bucket of words;
#: buckets for each shuffle partition, so that they fill evenly, up to so many of that kind; word rows of an Arrow batch.
GROUP, BUCKET_BYTES, EVEN, EVEN_MOST, ROWS_AT_ONCE = 4, 64 << 20, 6, 2048, 64
#: Tokens of a vocabulary at most: the token-byte table is broadcast.
VOCABULARY = 1 << 22
#: A pattern whose matches have a blank at their start only, unless they are white space as a whole. A text can be cut in
#: front of each single blank between other characters, and each distinct piece be split once. Fixed value.
PIECEWISE = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"
_WORDS, _POSITIONS = 0, 1
_PACKED = "key long, kind byte, block long, n_words long, bodies array<binary>, ids array<long>, counts array<long>"


@cache
def ranks_of(path: str) -> dict[bytes, int]:
    """The rank of each token in a rank file: base64 token, space, rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


@cache
def _encoder(path: str):
    """Merges one word by the ranks: the library's, with a pattern that takes the word as a whole."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str="(?s:.+)", mergeable_ranks=ranks_of(path), special_tokens={}).encode_ordinary


def token_table(spark: SparkSession, ranks: str) -> DataFrame:
    """The token-byte table of a rank file: id, bytes."""
    found = ranks_of(ranks)
    return spark.createDataFrame(pa.table({"id": pa.array(found.values(), pa.int64()), "bytes": pa.array(found.keys(), pa.binary())}))


@cache
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Those of this process: for short rows a new one costs more than its work."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _press(array: np.ndarray) -> bytes:
    return _codec()[0].compress(array.tobytes())


def _loose(body: bytes, kind) -> np.ndarray:
    return np.frombuffer(_codec()[1].decompress(body), kind)


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices values[start : start + size], joined."""
    total = int(size.sum())
    ends = np.cumsum(size)
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(start - (ends - size), size)
    return values[index]


class _Block:
    """Texts of one block, first as ids of distinct pieces, at the end as codes of distinct words."""

    def __init__(self, pattern: str):
        import regex

        compiled = regex.compile(pattern)
        self.find, self.scan, self.piecewise = compiled.findall, compiled.finditer, pattern == PIECEWISE
        self.rows: list[int | None] = []
        self.pieces: list[np.ndarray] = []
        self.size = 0
        self.known: defaultdict[str, int] = defaultdict(itertools.count().__next__)

    def add(self, doc: int | None, text: str) -> None:
        self.rows.append(doc)
        parts = text.split(" ") if self.piecewise else [text]
        self.pieces.append(np.fromiter(map(self.known.__getitem__, parts), np.int32, len(parts)))
        self.size += len(text) + 1

    def _whole_pieces(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Strings of the distinct pieces, the pieces in order, and how many each text has."""
        parts, stream = list(self.known), np.concatenate(self.pieces)
        counts = np.array([len(p) for p in self.pieces])
        first = np.zeros(len(stream), bool)
        first[np.cumsum(counts) - counts] = True
        # a cut is safe between characters that are no white space
        opens = np.fromiter((bool(p) and not p[0].isspace() for p in parts), bool, len(parts))
        closes = np.fromiter((bool(p) and not p[-1].isspace() for p in parts), bool, len(parts))
        begin = first.copy()
        begin[1:] |= closes[stream[:-1]] & opens[stream[1:]]
        at = np.flatnonzero(begin)
        sizes = np.diff(np.append(at, len(stream)))
        out = stream[at]
        strings = [" " + p for p in parts]
        other: dict[str, int] = {}
        for i in np.flatnonzero(first[at] | (sizes > 1)).tolist():
            a, n = int(at[i]), int(sizes[i])
            piece = ("" if first[a] else " ") + " ".join([parts[j] for j in stream[a : a + n].tolist()])
            out[i] = other.setdefault(piece, len(parts) + len(other))
        strings += other
        return strings, out, np.add.reduceat(begin.astype(np.int64), np.cumsum(counts) - counts)

    def words(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, the frequent ones first, their codes in order, and how many each text has."""
        pieces, stream, counts = self._whole_pieces()
        words: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        used = np.zeros(len(pieces), bool)
        used[stream] = True
        flat, sizes, code = [], [0] * len(pieces), words.__getitem__
        for i in np.flatnonzero(used).tolist():
            before, piece = len(flat), pieces[i]
            flat.extend(map(code, self.find(piece)) if len(piece) < LONG else (code(m.group()) for m in self.scan(piece)))
            sizes[i] = len(flat) - before
        flat, sizes = np.array(flat, np.int32), np.array(sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        ends = np.concatenate(([0], np.cumsum(sizes[stream])))
        edges = np.concatenate(([0], np.cumsum(counts)))
        stream = gather(flat, starts[stream], sizes[stream])
        order = np.argsort(-np.bincount(stream, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        names = list(words)
        return [names[i] for i in order.tolist()], rank[stream], np.diff(ends[edges])


def _planes(values: np.ndarray, n: int) -> list[bytes]:
    return [_press((values >> np.uint32(8 * p)).astype(np.uint8)) for p in range(n)]


class _Group:
    """Blocks with one list of words: each distinct word of all of them leaves once."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.words: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.blocks: list[tuple[list[int | None], list[int], np.ndarray]] = []
        self.content = hashlib.blake2b(digest_size=8)

    def add(self, block: _Block) -> None:
        names, stream, counts = block.words()
        codes = np.fromiter(map(self.words.__getitem__, names), np.uint32, len(names))
        stream = codes[stream] if len(names) else stream
        self.content.update(repr(block.rows).encode())
        self.content.update(counts.astype(np.int64).tobytes())
        self.content.update(stream.tobytes())
        self.blocks.append((block.rows, counts.tolist(), _planes(stream, 3 if len(self.words) < 1 << 24 else 4)))

    def packed(self) -> pa.RecordBatch:
        from xxhash import xxh64_intdigest

        raw = [w.encode() for w in self.words]
        self.content.update(np.array([len(w) for w in raw], np.int64).tobytes())
        self.content.update(b"".join(raw))
        key = int.from_bytes(self.content.digest(), "little") >> 1
        bucket = np.fromiter((xxh64_intdigest(w) % self.buckets for w in raw), np.int64, len(raw))
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        keys, bodies = [], []
        for own in np.split(order, edges[1:]) if len(order) else ():
            chosen = [raw[i] for i in own.tolist()]
            keys.append(int(bucket[own[0]]))
            bodies.append([_press(own.astype(np.uint32)), _press(np.array([len(w) for w in chosen], np.uint32)), _codec()[0].compress(b"".join(chosen))])
        n, m, docs = len(keys), len(self.blocks), pa.list_(pa.int64())
        rows, counts, planes = zip(*self.blocks, strict=True)
        return pa.RecordBatch.from_arrays([
            pa.array(keys + [key] * m, pa.int64()), pa.array([_WORDS] * n + [_POSITIONS] * m, pa.int8()), pa.array([key] * (n + m), pa.int64()), pa.array([len(raw)] * (n + m), pa.int64()),
            pa.array([*bodies, *planes], pa.list_(pa.binary())), pa.array([None] * n + list(rows), docs), pa.array([None] * n + list(counts), docs)],
            [f.split()[0] for f in _PACKED.split(", ")])


def _pretokens(pattern: str, buckets: int):
    """Blocks of documents become rows of distinct words by bucket, for a group of blocks at once, and a row of positions each."""

    def run(batches):
        block, group = _Block(pattern), _Group(buckets)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc, text.as_py() or "")
                if block.size >= BLOCK:
                    group.add(block)
                    block = _Block(pattern)
                    if len(group.blocks) == GROUP:
                        yield group.packed()
                        group = _Group(buckets)
        if block.rows:
            group.add(block)
        if group.blocks:
            yield group.packed()

    return run


def _word_ids(path: str):
    """Rows of words: each distinct word is encoded once; every block gets the ids of its words back, with their codes."""

    def run(batches):
        encode = _encoder(path)
        known: dict[bytes, bytes] = {}
        for batch in batches:
            bodies = []
            for i in range(batch.num_rows):
                codes, sizes, raw = batch.column("bodies")[i].as_py()
                raw = _codec()[1].decompress(raw)
                ids, lengths, start = [], [], 0
                for end in np.cumsum(_loose(sizes, np.uint32)).tolist():
                    word = raw[start:end]
                    start = end
                    found = known.get(word)
                    if found is None:
                        if len(known) >= KNOWN:
                            known.clear()
                        known[word] = found = np.array(encode(word.decode()), np.uint32).tobytes()
                    ids.append(found)
                    lengths.append(len(found) >> 2)
                bodies.append([codes, _press(np.array(lengths, np.uint32)), *_planes(np.frombuffer(b"".join(ids), np.uint32), 4)])
                if len(bodies) == ROWS_AT_ONCE or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column("block").slice(i + 1 - len(bodies), len(bodies)), pa.array(bodies, pa.list_(pa.binary()))], ["block", "ids"])
                    bodies = []

    return run


def _join_planes(planes: list[bytes]) -> np.ndarray:
    out = None
    for p, body in enumerate(planes):
        part = _loose(body, np.uint8).astype(np.uint32) << np.uint32(8 * p)
        out = part if out is None else out | part
    return out


def _reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
    """One group of blocks: positions meet the ids of its words, and the ids of each document come out in order."""
    if left.num_rows == 0:
        raise RuntimeError("words without the positions of their block: its texts changed between two runs of a task")
    words = left.column("n_words")[0].as_py()
    start, size = np.zeros(words, np.int64), np.full(words, -1, np.int64)
    flat, done = [np.empty(0, np.uint32)], 0
    for body in right.column("ids"):
        codes, lengths, *planes = body.as_py()
        codes, lengths, own = _loose(codes, np.uint32), _loose(lengths, np.uint32).astype(np.int64), _join_planes(planes)
        start[codes], size[codes] = done + np.cumsum(lengths) - lengths, lengths  # equal blocks send equal words
        flat.append(own)
        done += len(own)
    if words and size.min() < 0:
        raise RuntimeError("a block's words are not whole: its texts changed between two runs of a task")
    flat = np.concatenate(flat)
    docs, out, tokens = [], [], []
    for i in range(left.num_rows):
        codes = _join_planes(left.column("bodies")[i].as_py())
        at = 0
        for doc, count in zip(left.column("ids")[i].as_py(), left.column("counts")[i].as_py(), strict=True):
            own = codes[at : at + count]
            at += count
            docs.append(doc)
            found = gather(flat, start[own], size[own])
            out.append(found.astype("<u4").tobytes())
            tokens.append(len(found))
    return pa.table({"doc_id": pa.array(docs, pa.int64()), "n_tokens": pa.array(tokens, pa.int64()), "ids": pa.array(out, pa.binary())})


def _of(kind: int) -> Column:
    """True for rows of that kind; not deterministic to the optimizer, so that it filters behind the exchange, not before
    it: else there would be two exchanges, and two scans of the texts."""
    return F.col("kind") == F.lit(kind) + F.least(F.spark_partition_id(), F.lit(0))


def default_buckets(docs: DataFrame) -> int:
    """Buckets of words for docs (text): one for BUCKET_BYTES of them, or enough to fill the shuffle partitions evenly.

    They grow with the texts, so a task's words don't; reading the lengths is one scan.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-size // BUCKET_BYTES), min(EVEN * partitions, EVEN_MOST))


def encode(docs: DataFrame, ranks: str, pattern: str, buckets: int | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit integers).

    Each match of pattern is encoded by itself with the ranks of the file, without special tokens. Null and empty texts
    have no ids. Null and repeated doc_ids are kept, a result for each row. Other columns are not read. An empty table
    gives an empty result.

    GROUP blocks have one row of words for each of `buckets` hash values at most (by default as default_buckets() says, so
    their number follows the size of the texts); a task streams them, so no bucket has to fit into memory. What is held
    at once is a block, or one longer text, and the words and packed positions of its group.
    """
    buckets = buckets or default_buckets(docs)
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(_pretokens(pattern, buckets)), _PACKED).repartition("key")
    back = blocks.where(_of(_WORDS)).mapInArrow(frugal(_word_ids(ranks)), "block long, ids array<binary>")
    return blocks.where(_of(_POSITIONS)).groupBy("key").cogroup(back.groupBy("block")).applyInArrow(_reassemble, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokens: DataFrame) -> DataFrame:
    """encoded (with a column ids as encode() gives it) and the column decoded: the bytes of its ids.

    A map-side join with tokens (id, bytes), the token-byte table: it is counted and broadcast, and may have VOCABULARY
    rows. Null ids give null; an id that the table lacks is an error.
    """
    rows = tokens.limit(VOCABULARY + 1).collect()
    if len(rows) > VOCABULARY:
        raise ValueError(f"the table has over {VOCABULARY} tokens")
    by_id = {r["id"]: bytes(r["bytes"]) for r in rows}
    top = max(by_id, default=-1) + 1
    sizes = np.array([len(by_id[i]) if i in by_id else -1 for i in range(top)], np.int64)
    start = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    shared = encoded.sparkSession.sparkContext.broadcast((b"".join(by_id.get(i, b"") for i in range(top)), start, sizes))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def run(batches):
        body, start, sizes = shared.value
        table = np.frombuffer(body, np.uint8)
        for batch in batches:
            out = []
            for ids in batch.column("ids"):
                ids = ids.as_py()
                if ids is None:
                    out.append(None)
                    continue
                row = np.frombuffer(ids, "<u4").astype(np.int64)
                if len(row) and (row.max() >= len(sizes) or sizes[row].min() < 0):
                    raise ValueError(f"tokens lack one of the ids up to {row.max()}")
                out.append(gather(table, start[row], sizes[row]).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(frugal(run), f"{kinds}, `decoded` binary")
