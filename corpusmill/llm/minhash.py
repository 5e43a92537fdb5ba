"""MinHash near-duplicates: bands over full minima, b-bit signatures for the estimate, full sets for the verdict."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.graph import components
from corpusmill.llm.hashing import U, distinct, mix, shingle_hashes, word_hashes
from corpusmill.llm.storage import arrow_batches, frugal, give_back_driver, materialize

#: Hash functions, low bits kept of each minimum, and bands of ROWS minima from the first of them. A pair at the
#: threshold 0.8 shares no band with probability (1 - 0.8 ** 4) ** 32, about 5e-8.
HASHES, BITS, BANDS, ROWS = 768, 2, 32, 4
#: The estimate from the packed bits may be this far below the threshold (4.3 standard deviations at 0.8). Members of
#: one bucket in different components are compared in falling tiers of the estimate, as most links show in the first.
MARGIN, TIERS = 0.075, (0.05, -0.02)
_LONGS = HASHES // 64
_SIGNS = [f"s{j}" for j in range(BITS * _LONGS)]
_BANDS = [f"b{j}" for j in range(BANDS)]
_SKETCH = "doc_id long, part long, n_shingles long, set_key binary, " + ", ".join(f"{c} long" for c in [*_SIGNS, *_BANDS])
#: Pairs of texts that an Arrow batch carries to be verified, and texts to be sketched.
PAIRS_AT_ONCE, TEXTS_AT_ONCE = 256, 1000
_rng = np.random.Generator(np.random.PCG64(77))
_FACTOR = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_MASK = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each of the hash functions over a set of 64-bit shingle hashes."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> U(32)).astype(np.uint32)
    for at in range(0, len(short), 256):
        values = (short[None, at : at + 256] ^ _MASK) * _FACTOR
        values ^= values >> np.uint32(15)
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature[: BANDS * ROWS].reshape(BANDS, ROWS).astype(U)
    out = np.arange(1, BANDS + 1, dtype=U)
    for j in range(rows.shape[1]):
        out = mix(out * U(0x9E3779B97F4A7C15) + rows[:, j])
    return out.view(np.int64)


def packed(signature: np.ndarray) -> np.ndarray:
    """Bit planes of the low bits, in 64-bit words."""
    planes = [np.packbits(((signature >> np.uint32(p)) & 1).astype(np.uint8)) for p in range(BITS)]
    return np.concatenate(planes).view(np.int64)


def _sets(texts: list[bytes | None], width: int):
    for i, words in word_hashes(texts, lower=True):
        yield i, distinct(shingle_hashes(words, width))


def _sketcher(width: int):
    def run(batches):
        names = [*_SIGNS, *_BANDS]
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            n = len(texts)
            sizes, keys, numbers = [0] * n, [None] * n, np.zeros((len(names), n), np.int64)
            for i, found in _sets(texts, width):
                sizes[i] = len(found)
                if len(found):
                    keys[i] = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    signature = minima(found)
                    numbers[: len(_SIGNS), i], numbers[len(_SIGNS) :, i] = packed(signature), band_keys(signature)
            head = [batch.column("doc_id"), batch.column("part"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays([*head, *(pa.array(row) for row in numbers)], ["doc_id", "part", "n_shingles", "set_key", *names])

    return run


def _set_of_each(column: pa.Array, width: int) -> list[np.ndarray]:
    """The set of every text of a column; a text that repeats, as a bucket's pivot does, is hashed once."""
    coded = column.cast(pa.binary()).dictionary_encode()
    found = dict(_sets(coded.dictionary.to_pylist(), width))
    return [found[i] for i in coded.indices.to_pylist()]


def _verifier(width: int, percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(_set_of_each(batch.column("ta"), width), _set_of_each(batch.column("tb"), width), strict=True):
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _matches(x: str, y: str) -> Column:
    out = F.lit(HASHES)
    for j in range(_LONGS):
        differ = [F.col(f"{x}{j + p * _LONGS}").bitwiseXOR(F.col(f"{y}{j + p * _LONGS}")) for p in range(BITS)]
        out = out - F.bit_count(differ[0].bitwiseOR(differ[1]))
    return out


def estimate(x: str, y: str) -> Column:
    """Similarity from equal b-bit values, corrected for those equal by chance; x, y: prefixes of the packed columns."""
    chance = 2.0**-BITS
    return (_matches(x, y) / F.lit(HASHES) - chance) / (1 - chance)


def _signed(signs: DataFrame, node: str, prefix: str) -> DataFrame:
    return signs.select(F.col("node").alias(node), *(F.col(c).alias(f"{prefix}{j}") for j, c in enumerate(_SIGNS)))


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are similar by their full sets."""
    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    with_both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    with arrow_batches(pairs.sparkSession, PAIRS_AT_ONCE):
        return materialize(with_both.select("a", "b", "ta", "tb").mapInArrow(frugal(_verifier(width, percent)), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept, group_id, part.

    Documents are linked if 100 * |intersection| >= percent * |union| of their distinct shingles of width words
    (lower-cased A-Z, split at ASCII white space; fewer words are one shingle). component_id is the smallest doc_id
    that links lead to, kept marks that document. group_id is the same in the rows of one group only, also where
    two groups have a smallest doc_id in common (rows of one doc_id with several texts); part is xxhash64 of the text.

    Equal sets are one node from the start, by one aggregate that is combined before the shuffle, so copies never meet
    in pairs and never in one task. A band bucket first links each member to its smallest one. Members of a bucket that
    are still in different components are then compared with each other, the likeliest first, with components in
    between, so no link that a band shows is lost and few pairs become rows. Estimates from the packed signatures select
    the pairs whose full sets are read.

    Null or blank texts: 0 shingles, linked with nothing, group_id null. Null doc_id: linked with nothing, component_id
    and group_id null, kept true. Repeated rows get the same result each; rows that repeat a doc_id with another text are placed each
    by its own text. Other columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("part"))
    give_back_driver(docs.sparkSession)  # what comes takes many small jobs
    with arrow_batches(docs.sparkSession, TEXTS_AT_ONCE):
        sketches = materialize(docs.mapInArrow(frugal(_sketcher(width)), _SKETCH), "sketches")
    own = sketches.select("doc_id", "part", "n_shingles", "set_key")
    usable = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    classes = _classes(sketches.where(usable))
    signs = classes.select("node", *_SIGNS)
    buckets = classes.select("node", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).where(F.col("members") > 1)
    members = materialize(buckets.join(shared, "band"), "buckets")
    # one text of each set that shares a band is shuffled, once for all rounds; without the hints small inputs would be broadcast
    wanted = classes.select("node", "set_key", F.col("first").alias("doc_id")).join(members.select("node").distinct().hint("merge"), "node", "left_semi")
    texts = materialize(_texts_of(docs, own.where(usable), wanted), "candidates")
    least = percent / 100 - MARGIN
    stars = members.where(F.col("node") != F.col("pivot")).select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = stars.join(_signed(signs, "a", "x"), "a").join(_signed(signs, "b", "y"), "b").where(estimate("x", "y") >= least)
    links = _confirmed(stars.select("a", "b"), texts, width, percent)
    labels = components(links)
    above = 2.0
    for tier in (*(percent / 100 + t for t in TIERS), least):
        rest = _across(members, labels, classes, tier, above)
        above = tier
        give_back_driver(docs.sparkSession)
        if not rest.isEmpty():
            links = links.union(_confirmed(rest, texts, width, percent))
            labels = components(links)
    # the smallest doc_id of a component, at each of its sets; a set without links is its own component
    rooted = labels.join(classes.select("node", "first"), "node")
    roots = rooted.groupBy("component").agg(F.min("first").alias("label"))
    linked = rooted.join(roots, "component").select("node", "component", "label")
    label = classes.select("node", "set_key", "first").join(linked, "node", "left").select("set_key", F.coalesce("label", "first").alias("component_id"), F.coalesce("component", "node").alias("group_id"))
    label = materialize(label, "labels")
    placed = own.where(usable).join(label, "set_key").select("doc_id", "n_shingles", "component_id", "group_id", "part")
    alone = own.where(~usable).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group_id"), "part")
    return placed.union(alone).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "group_id", "part")


def _classes(usable: DataFrame) -> DataFrame:
    """A row for each set: node, set_key, first (its smallest doc_id), signs and bands.

    Rows of a set have one sketch, so the least of each number is that of all, and the aggregate needs no sort. node is
    first; of sets that share it (rows of one doc_id with several texts), a hash of the set below all of them.
    """
    found = usable.groupBy("set_key").agg(F.min("doc_id").alias("first"), *(F.min(c).alias(c) for c in [*_SIGNS, *_BANDS]))
    found = materialize(found.select("set_key", "first", *_SIGNS, F.array(*_BANDS).alias("bands")), "classes")
    clash = materialize(found.groupBy("first").count().where("count > 1").select("first", F.lit(True).alias("clash")), "clashes")
    if clash.isEmpty():
        return found.withColumn("node", F.col("first"))
    node = F.when(F.col("clash"), F.least(F.xxhash64("set_key"), -F.xxhash64("set_key"))).otherwise(F.col("first"))
    return materialize(found.join(clash, "first", "left").withColumn("node", node).drop("clash"), "classes")


def _texts_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) for each of wanted (node, set_key, doc_id): a text of that document that has the set."""
    counts = rows.join(wanted.hint("merge"), ["doc_id", "set_key"]).groupBy("doc_id", "node", "part").count()
    picked = counts.groupBy("doc_id", "node").agg(F.min("part").alias("part"), F.min_by("count", "part").alias("n"))
    found = docs.join(picked.hint("merge"), ["doc_id", "part"])
    copies = found.where("n > 1").groupBy("node").agg(F.min("text").alias("text"))
    return found.where("n = 1").select("node", "text").union(copies)


def _across(members: DataFrame, labels: DataFrame, classes: DataFrame, least: float, above: float) -> DataFrame:
    """Pairs of a bucket's members in different components with an estimate in [least, above).

    Pairs with the pivot are compared already. Members outside the bucket's main component, usually few, meet the
    others; the estimate is part of the join, and so is that no earlier band has the pair, so only likely pairs become
    rows, and each but once.
    """
    several = members.where(F.col("members") > 2).join(labels, "node", "left")
    several = several.select("band", "node", "pivot", F.coalesce("component", "node").alias("component"))
    sizes = several.groupBy("band", "component").count()
    main = sizes.groupBy("band").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    mixed = materialize(several.join(main, "band").where(F.col("node") != F.col("pivot")).join(classes, "node"), "mixed")
    x = mixed.where(F.col("component") != F.col("main")).select("band", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("main"), F.col("bands").alias("xs"), *(F.col(c).alias(f"x{j}") for j, c in enumerate(_SIGNS)))
    y = mixed.select("band", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("bands").alias("ys"), *(F.col(c).alias(f"y{j}") for j, c in enumerate(_SIGNS)))
    score = estimate("x", "y")
    once = (F.col("cb") == F.col("main")) | (F.col("a") > F.col("b"))
    first = F.element_at(F.filter(F.zip_with("xs", "ys", lambda p, q: F.when(p == q, p)), lambda p: p.isNotNull()), 1) == x["band"]
    found = x.join(y, (x["band"] == y["band"]) & (F.col("ca") != F.col("cb")) & once & (score >= least) & (score < above) & first)
    return materialize(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "across")
