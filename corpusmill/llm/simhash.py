"""SimHash near-duplicates, found by the anchor points of a covering code.

The 64 bits of a fingerprint are cut into bands. Of a pair within the distance, one band differs in distance // bands bits
at most. In each band the anchors are a code of covering radius one: the Hamming code of length 15, and all values of the
bits behind. A fingerprint is sent to all anchors that may be nearest to one of its neighbours, which are within the
radius and the threshold; it is compared at an anchor with those that have it as their nearest.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from corpusmill.llm.graph import components
from corpusmill.llm.hashing import _LOWER, BLOCK, U, _pieces
from corpusmill.llm.storage import arrow_batches, frugal, materialize

SEED, DISTANCE, BANDS = 42, 4, 3
#: Rows of an anchor on each side that are compared in one task; more of them are dealt to several groups.
ROWS = 1 << 16
#: Pairs that are compared at once, and texts and fingerprints of an Arrow batch.
PAIRS_AT_ONCE, TEXTS_AT_ONCE, PRINTS_AT_ONCE = 1 << 18, 1000, 4096
#: Length of the code's blocks, and for each bit of a block's syndrome the places that it sums. Fixed values.
_LENGTH = 15
_CHECKS = [U(sum(1 << (place - 1) for place in range(1, 16) if place >> bit & 1)) for bit in range(4)]
_EDGES = "a long, b long"


# ---- fingerprints --------------------------------------------------------------------------------------------------
def _votes(words: list[bytes], width: int, seed: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of the runs of width words, and how many runs there are."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    runs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.fromiter((xxh64_intdigest(joined[i:j], seed) for i, j in runs), U)
    votes = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 14):
        some = hashes[low : low + (1 << 14)].view(np.uint8)
        votes += np.unpackbits(some, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return votes, len(hashes)


def fingerprint(text: bytes | None, width: int = 4, seed: int = SEED) -> int:
    """The bits that are set in over half of the shingles' hashes; zero without words. A long text is read in pieces."""
    votes, n, carried = np.zeros(64, np.int64), 0, []
    for piece in [text or b""] if len(text or b"") <= BLOCK else _pieces(text):
        words = carried + piece.translate(_LOWER).split()
        if len(words) >= width:
            found, runs = _votes(words, width, seed)
            votes, n = votes + found, n + runs
            words = words[len(words) - width + 1 :]
        carried = words
    if carried and not n:
        votes, n = _votes(carried, len(carried), seed)
    return int((np.flatnonzero(2 * votes > n).astype(U)[:, None] == np.arange(64, dtype=U)).any(axis=0) @ (U(1) << np.arange(64, dtype=U))) if n else 0


def _printer(width: int, seed: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([fingerprint(t.as_py(), width, seed) for t in texts], U)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, width: int = 4, seed: int = SEED) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id and print, the 64 bits as a long."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with arrow_batches(docs.sparkSession, TEXTS_AT_ONCE):
        return materialize(docs.mapInArrow(frugal(_printer(width, seed)), "doc_id long, print long"), "prints")


# ---- anchors -------------------------------------------------------------------------------------------------------
def cuts(bands: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each band."""
    sizes = [64 // bands + (i < 64 % bands) for i in range(bands)]
    return [(sum(sizes[:i]), size) for i, size in enumerate(sizes)]


def nearest(values: np.ndarray) -> np.ndarray:
    """The anchor next to each value of a band: its first 15 bits are corrected to a word of the Hamming code."""
    place = np.zeros(values.shape, U)
    for bit, check in enumerate(_CHECKS):
        place |= (np.bitwise_count(values & check) & 1).astype(U) << U(bit)
    return values ^ np.where(place > 0, U(1) << (np.maximum(place, U(1)) - U(1)), U(0))


def anchors(values: np.ndarray, size: int, flips: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest anchors of all values that differ in so many bits at most: index of the value, and anchor, each once.

    They are within flips and the covering radius; anchors of that distance that are next to no such value are left out.
    """
    masks = [sum(1 << i for i in some) for k in range(flips + 1) for some in combinations(range(size), k)]
    found = np.sort(nearest(values[:, None] ^ np.array(masks, U)), axis=1)
    first = np.concatenate((np.ones((len(found), 1), bool), found[:, 1:] != found[:, :-1]), axis=1)
    return np.nonzero(first)[0], found[first]


def _coded(values: np.ndarray, band: int) -> np.ndarray:
    """Anchors of a band, told from those of others; a band has under 58 bits."""
    return (values | U(band) << U(58)).view(np.int64)


def _replicas(distance: int, bands: int):
    """Batches of (print, at): a row for each anchor of a fingerprint, home where it is the nearest."""

    def run(batches):
        for batch in batches:
            prints = batch.column("print").to_numpy().view(U)
            for band, (low, size) in enumerate(cuts(bands)):
                values = (prints >> U(low)) & U((1 << size) - 1)
                row, found = anchors(values, size, distance // bands)
                home = found == nearest(values)[row]
                yield pa.RecordBatch.from_arrays([pa.array(prints[row].view(np.int64)), pa.array(_coded(found, band)), pa.array(home)], ["print", "at", "home"])

    return run


def _weights(distance: int, bands: int):
    """Batches of (at, n, homes) from those of (band, value, n): how many rows an anchor gets, and how many have it as home."""

    def run(batches):
        parts = cuts(bands)
        for batch in batches:
            of, values, n = (batch.column(c).to_numpy() for c in ("band", "value", "n"))
            for band, (_, size) in enumerate(parts):
                own = values[of == band].view(U)
                row, found = anchors(own, size, distance // bands)
                count = n[of == band][row]
                homes = np.where(found == nearest(own)[row], count, 0)
                yield pa.RecordBatch.from_arrays([pa.array(_coded(found, band)), pa.array(count), pa.array(homes)], ["at", "n", "homes"])

    return run


def _crowded(prints: DataFrame, distance: int, bands: int) -> DataFrame:
    """Anchors of over ROWS rows: at, parts and home_parts, into how many their rows are dealt.

    Fingerprints are counted by the values of their bands first, so what is shuffled is bounded by the number of those
    values, however many fingerprints there are.
    """
    value = lambda low, size: F.shiftrightunsigned("print", low).bitwiseAND(F.lit((1 << size) - 1))
    bits = F.explode(F.array(*(F.struct(F.lit(i).alias("band"), value(*cut).alias("value")) for i, cut in enumerate(cuts(bands))))).alias("v")
    counts = prints.select(bits).groupBy("v.band", "v.value").agg(F.count("*").alias("n"))
    sums = counts.mapInArrow(_weights(distance, bands), "at long, n long, homes long").groupBy("at").agg(F.sum("n").alias("n"), F.sum("homes").alias("homes"))
    parts = lambda c: F.ceil(F.col(c) / ROWS).cast("int")
    return sums.where(F.col("n") > ROWS).select("at", parts("n").alias("parts"), parts("homes").alias("home_parts"))


# ---- comparison ----------------------------------------------------------------------------------------------------
def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all nodes that pairs (a, b) join the least label; label points from each node to one not above it."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def _spanning(prints: np.ndarray, homes: np.ndarray, begin: np.ndarray, size: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs within distance join: of each place in homes with the places begin to begin + size.

    Pairs are compared some at a time and leave a label for each place only, so a crowd of like fingerprints gives one
    link each.
    """
    label, at = np.arange(len(prints)), 0
    ends = np.cumsum(size)
    while at < len(homes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        n = size[at:to]
        left = np.repeat(homes[at:to], n)
        right = np.arange(int(n.sum())) + np.repeat(begin[at:to] - (np.cumsum(n) - n), n)
        near = np.flatnonzero(np.bitwise_count(prints[left] ^ prints[right]) <= distance)
        _hook(label, left[near], right[near])
        at = to
    moved = np.flatnonzero(label != np.arange(len(label)))
    return prints[moved], prints[label[moved]]


def _comparer(distance: int, many: int):
    """Links from rows (slot, at, print, home), sorted by slot and at: whole groups are gathered until they are many rows."""

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        slot, at, prints, home = (np.concatenate([r.column(c).to_numpy(zero_copy_only=False) for r in rows]) for c in ("slot", "at", "print", "home"))
        new = np.append(True, (at[1:] != at[:-1]) | (slot[1:] != slot[:-1]))
        begin = np.flatnonzero(new)
        size, group = np.diff(np.append(begin, len(at))), np.cumsum(new) - 1
        homes = np.flatnonzero(home)
        homes = homes[size[group[homes]] > 1]
        own = group[homes]
        a, b = _spanning(prints.view(U), homes, begin[own], size[own], distance)
        other = a != b  # a fingerprint of a dealt anchor may be there twice
        found = np.unique(np.stack((a[other], b[other])), axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            slot, at = batch.column("slot").to_numpy(), batch.column("at").to_numpy()
            if rows >= many:  # the group at the end of what is held may go on
                same = (slot == last[0]) & (at == last[1])
                if not same.all():
                    cut = int(np.argmin(same))
                    yield links([*held, batch.slice(0, cut)])
                    held, rows, batch = [], 0, batch.slice(cut)
            held.append(batch)
            rows += batch.num_rows
            last = (slot[-1], at[-1])
        if held:
            yield links(held)

    return run


def links(prints: DataFrame, distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """Of distinct fingerprints (print): pairs (a, b) that join all those within distance, few for each of a crowd.

    Every pair within distance is compared. The rows of an anchor that has over ROWS are dealt by hash, homes and all, and
    each part of the homes meets each part of all in a group of its own, so a group is bounded.
    """
    if not 0 <= distance <= 8 or not 2 <= bands <= 4:
        raise ValueError("a distance of 0 to 8 and 2 to 4 bands")
    with arrow_batches(prints.sparkSession, PRINTS_AT_ONCE):
        crowded = materialize(_crowded(prints, distance, bands), "crowded")
        rows = prints.mapInArrow(_replicas(distance, bands), "print long, at long, home boolean")
        # at most one row for each anchor; Spark broadcasts them if they are few
        dealt = rows.join(crowded, "at", "left")
        some = lambda c: F.coalesce(c, F.lit(1))
        part = lambda c: F.pmod(F.xxhash64("print"), some(c)).cast("int")
        every = lambda c: F.sequence(F.lit(0), some(c) - 1)
        as_home = dealt.where("home").select("at", "print", F.lit(True).alias("home"), part("home_parts").alias("x"), F.explode(every("parts")).alias("y"), some("parts").alias("parts"))
        met = dealt.where(some("home_parts") > 0).select("at", "print", "home", "parts", part("parts").alias("y"), F.explode(every("home_parts")).alias("x"))
        several = F.coalesce(F.col("parts"), F.lit(1)) > 1
        # in an anchor that is not dealt the homes are among all its rows
        groups = met.select("at", "print", (F.col("home") & ~several).alias("home"), (F.col("x") * some("parts") + F.col("y")).alias("slot"))
        groups = groups.union(as_home.where("parts > 1").select("at", "print", "home", (F.col("x") * F.col("parts") + F.col("y")).alias("slot")))
        groups = groups.repartition("at", "slot").sortWithinPartitions("slot", "at")
        return materialize(groups.select("slot", "at", "print", "home").mapInArrow(frugal(_comparer(distance, ROWS)), _EDGES).distinct(), "links")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = DISTANCE, bands: int = BANDS, seed: int = SEED) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, print (the fingerprint as a long) and component_id.

    A fingerprint has a bit if over half of the XXH64 of the text's shingles of width words have it (lower-cased A-Z,
    split at ASCII white space, repeats included; fewer words are one shingle). Fingerprints that differ in distance bits at
    most are linked; component_id is the smallest doc_id that links lead to.

    Null texts and texts without words: fingerprint zero, linked like any other. Null doc_id: linked with nothing,
    component_id null. Repeated rows get the same result each; rows that repeat a doc_id with another text go with their own
    fingerprint. Equal fingerprints are one node, by an aggregate that is combined before the shuffle, so copies never
    meet. Texts of any length are read whole. Other columns are not read, whatever their names. An empty table gives
    an empty result.
    """
    prints = fingerprints(docs, width, seed)
    nodes = materialize(prints.where("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("first")), "nodes")
    labels = components(links(nodes.select("print"), distance, bands)).select(F.col("node").alias("print"), "component")
    linked = materialize(labels.join(nodes, "print"), "linked")
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    label = linked.join(least, "component").select("print", "component_id")
    label = nodes.join(label, "print", "left").select("print", F.coalesce("component_id", "first").alias("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return prints.join(materialize(label, "labels"), "print", "left").select("doc_id", "print", own)


def hexadecimal(column: str):
    """16 lower-case digits of a long."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
