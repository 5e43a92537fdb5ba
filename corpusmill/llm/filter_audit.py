"""Filter interactions from a packed bitmap index: what each filter removes behind each set of others.

An index row holds, for some rows of one part, a bitset of each filter (set: the row fails it) and of each label. What a
filter removes depends on the set of filters before it, not on their order, so AND-NOT and popcount for every subset give
all orders; the counts of the index rows are summed.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
FILTERS, LABELS = ("A", "B", "C", "D", "E"), ("good", "toxic")
#: Filters of one audit at most: subsets are counted one by one, and orders listed.
MOST = 6
#: Parts whose counts a task holds; with more of them it sends on what it has and begins anew.
PARTS_AT_ONCE = 500
_COUNTS = ("kept", "removed", "redundant")

_FAIL = f"""d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
l AS (SELECT doc_id, coalesce(max(quality), 0) = 1 AS good, coalesce(max(toxic), 0) = 1 AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, CAST(len(words) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT) + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INT)
+ 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM d LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY part, fails)"""
ORACLE = f"""WITH {_FAIL},
b AS (SELECT unnest([1, 2, 4, 8, 16]) AS bit, unnest(['A', 'B', 'C', 'D', 'E']) AS name),
o AS (SELECT p.name || q.name || r.name || s.name || t.name AS filter_order, unnest([p.bit, q.bit, r.bit, s.bit, t.bit]) AS bit, unnest([0, p.bit, p.bit + q.bit, p.bit + q.bit + r.bit, 31 - t.bit]) AS before, unnest([1, 2, 3, 4, 5]) AS step
FROM b p, b q, b r, b s, b t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND p.bit | q.bit | r.bit | s.bit | t.bit = 31),
c AS (SELECT part, filter_order, step, any_value(bit) AS bit, CAST(coalesce(sum(n) FILTER (fails & (bit | before) = 0), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit > 0), 0) AS BIGINT) AS removed,
CAST(coalesce(sum(n) FILTER (fails & before > 0 AND fails & bit > 0), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (fails = bit), 0) AS BIGINT) AS unique_fails,
CAST(coalesce(sum(n_good) FILTER (fails & before = 0 AND fails & bit > 0), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(n_toxic) FILTER (fails & before = 0 AND fails & bit > 0), 0) AS BIGINT) AS toxic_lost
FROM g, o GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM c"""


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, lang): part, A to E (true: fails) and the labels good and toxic.

    Texts are read once, by built-in functions, and leave that pass as a digest of 256 bits, so rows of some 60 bytes
    are shuffled. E is settled by the smallest doc_id of each digest, an aggregate combined before the shuffle; rows meet
    it by digest and doc_id, so copies of one text are spread like others.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    n, of = F.size("words"), lambda x: x.cast("long")
    read = read.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), (n < 100).alias("A"), (100 * of(F.size(F.array_distinct("words"))) < 80 * of(n)).alias("B"),
        (100 * of(F.regexp_count("text", F.lit("[A-Z]"))) > 10 * of(F.length("text"))).alias("C"), F.rlike("text", F.lit("[#$%&*|]")).alias("D"),
    )
    read = materialize(read, "flags")
    first = read.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.coalesce(F.max("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic"))
    both = read.join(first, ["digest", "doc_id"], "left").join(marked, "doc_id", "left")
    return both.select("part", "A", "B", "C", "D", (F.col("first").isNull() & F.col("doc_id").isNotNull()).alias("E"), *(F.coalesce(c, F.lit(False)).alias(c) for c in LABELS))


def _packer(columns: tuple[str, ...]):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("part").dictionary_encode()
            owner = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(owner, kind="stable")
            ends = np.cumsum(np.bincount(owner, minlength=len(coded.dictionary)))
            bits = np.stack([batch.column(c).to_numpy(zero_copy_only=False)[order] for c in columns]).astype(bool)
            packed = [np.packbits(bits[:, low:high], axis=1) for low, high in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            sets = [pa.array([p[i].tobytes() for p in packed], pa.binary()) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(np.diff(ends, prepend=0), pa.int64()), *sets], ["part", "n", *columns])

    return run


def bitmap_index(flags: DataFrame, filters: tuple[str, ...] = FILTERS, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """Of flags (part, and a boolean column of each filter and label): part, n (rows) and a packed bitset of each column.

    A row of the index stands for the rows of one part in one batch of a partition. Nothing is shuffled. Null flags count
    as false (the row passes, or has no label).
    """
    columns = (*filters, *labels)
    clean = flags.select("part", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in columns))
    return clean.mapInArrow(_packer(columns), "part string, n long, " + ", ".join(f"`{c}` binary" for c in columns))


def _counter(filters: tuple[str, ...], labels: tuple[str, ...], parts_at_once: int):
    k, names = len(filters), [*_COUNTS, *(f"{c}_lost" for c in labels)]
    steps = [(before, i) for before in range(1 << k) for i in range(k) if not before >> i & 1]

    def words(packed: bytes) -> np.ndarray:
        return np.frombuffer(packed + bytes(-len(packed) % 8), np.uint64)

    def counts(n: int, fails: list[np.ndarray], marks: list[np.ndarray]) -> np.ndarray:
        ones = lambda x: int(np.bitwise_count(x).sum())
        union = [np.zeros_like(fails[0])]
        for mask in range(1, 1 << k):
            low = (mask & -mask).bit_length() - 1
            union.append(union[mask & (mask - 1)] | fails[low])
        gone, out = [ones(u) for u in union], np.empty((len(steps), len(names)), np.int64)
        for row, (before, i) in enumerate(steps):
            here = fails[i] & ~union[before]
            removed = gone[before | 1 << i] - gone[before]
            out[row] = (n - gone[before | 1 << i], removed, gone[1 << i] - removed, *(ones(here & m) for m in marks))
        return out

    def batch_of(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        table = np.concatenate(list(sums.values()))
        parts = [p for p in sums for _ in steps]
        places = [pa.array([s[j] for s in steps] * len(sums), pa.int32()) for j in range(2)]
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), *places, *(pa.array(table[:, j]) for j in range(len(names)))], ["part", "before", "filter", *names])

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                found = counts(row["n"], [words(row[c]) for c in filters], [words(row[c]) for c in labels])
                sums[row["part"]] = sums[row["part"]] + found if row["part"] in sums else found
                if len(sums) >= parts_at_once:
                    yield batch_of(sums)
                    sums = {}
        if sums:
            yield batch_of(sums)

    return run, "part string, before int, filter int, " + ", ".join(f"`{c}` long" for c in names), names


def subset_counts(index: DataFrame, filters: tuple[str, ...] = FILTERS, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """Per part, set of filters before (bits of their places) and filter behind it (its place): kept, removed, redundant, and a
    count of the removed rows of each label. Sums of a task are combined before the shuffle."""
    if not 1 <= len(filters) <= MOST:
        raise ValueError(f"1 to {MOST} filters")
    run, schema, names = _counter(tuple(filters), tuple(labels), PARTS_AT_ONCE)
    return index.mapInArrow(run, schema).groupBy("part", "before", "filter").agg(*(F.sum(c).alias(c) for c in names))


def audit(index: DataFrame, filters: tuple[str, ...] = FILTERS, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """Per part, order of the filters and step: the counts there, unique_fails, and shapley (removed at any step of all orders).

    The driver makes the list of orders (at most 720 times 6 rows, whatever the data), which is broadcast. A part has
    rows for all orders, zeros included; without rows there is no part, so an empty table gives an empty result.
    """
    k, spark = len(filters), index.sparkSession
    counts = subset_counts(index, filters, labels)
    full = (1 << k) - 1
    bit = F.expr("shiftleft(1, `filter`)")
    weights = F.create_map(*(F.lit(x) for j in range(k) for x in (j, factorial(j) * factorial(k - 1 - j))))
    alone = F.sum(F.when(F.col("before") == full - bit, F.col("removed")))
    worth = counts.groupBy("part", "filter").agg(F.sum(F.col("removed") * weights[F.bit_count("before")]).cast("long").alias("shapley"), alone.alias("unique_fails"))
    orders = []
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            orders.append(("".join(filters[j] for j in order), step, before, i))
            before |= 1 << i
    places = spark.createDataFrame(orders, "filter_order string, step int, before int, filter int")
    found = counts.join(worth, ["part", "filter"]).join(F.broadcast(places), ["before", "filter"])
    return found.select("part", "filter_order", "step", *_COUNTS, "unique_fails", *(f"{c}_lost" for c in labels), "shapley")


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """audit() of the five filters over docs (doc_id, text, lang) and labels (doc_id, quality, toxic), by lang.

    A: under 100 words; B: 100 * distinct words < 80 * words; C: 100 * capitals of A-Z > 10 * code points; D: any of #$%&*|;
    E: identical to the text of a smaller doc_id. Null texts count as empty, so they are copies of each other and of empty
    ones; null lang is the part of the empty string. Rows of null doc_id have no label, fail E never and make no other
    fail. Repeated rows count each, and don't fail E by each other. Labels that repeat count as the highest. Texts of any
    length are read whole. Other columns are not read, whatever their names. An empty table gives an empty result.
    """
    return audit(bitmap_index(flagged(docs, labels)))
