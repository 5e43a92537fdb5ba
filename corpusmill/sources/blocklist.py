"""Domain lists: one domain on a line, # starts a comment line."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_blocklist(path: str) -> DataFrame | None:
    """Lower-cased domains (suffix) of a text file that Spark can read, repeated ones included; a missing file is a warning and None."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    try:
        lines = spark.read.text(path)
    except Exception as problem:  # the reader raises several kinds for a path that is not there
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        warnings.warn(f"no blocklist at {path}", stacklevel=2)
        return None
    return lines.select(F.lower(F.trim("value")).alias("suffix")).where((F.col("suffix") != "") & ~F.col("suffix").startswith("#"))


#: 64-bit words of a Bloom filter at most (8 MB), words for each 4 domains below that, and bits that a domain sets. One in 200
#: other domains passes at five million; more of them at more, which costs time and changes nothing.
WORDS, BITS = 1 << 20, 4
#: Words up to which a filter is a literal of the plan.
FEW = 4096


def words_for(n: int) -> int:
    return min(WORDS, 1 << max(10, (n // 4).bit_length()))


def _places(value, words: int):
    """Place of each of a value's bits in the filter."""
    return [F.pmod(F.xxhash64(F.lit(i), value), F.lit(words * 64)) for i in range(BITS)]


def bloom(domains: DataFrame, words_: int):
    """A column of one array, the Bloom filter of domains (suffix) in so many words: a literal, or what Spark works out once and
    sends to all tasks."""
    spark = domains.sparkSession
    places = domains.select(F.explode(F.array(*_places(F.col("suffix"), words_))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = places.select(F.expr("place div 64").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    if words_ <= FEW:
        found = {r["word"]: r["bits"] for r in words.collect()}
        return F.expr(f"array({', '.join(f'{found.get(i, 0)}L' if found.get(i, 0) != -(1 << 63) else 'cast(-9223372036854775808 AS bigint)' for i in range(words_))})")
    dense = spark.range(words_).join(words, F.col("id") == F.col("word"), "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda w: w.bits)).scalar()


def may_hold(filter_, words: int, value):
    """False if value is none of the filter's domains; else it may be one."""
    bit = lambda place: F.getbit(F.get(filter_, F.call_function("div", place, F.lit(64)).cast("int")), (place % 64).cast("int")) == 1
    if words <= FEW:  # one mention of the literal
        return F.forall(F.array(*_places(value, words)), bit)
    out = F.lit(True)
    for place in _places(value, words):
        out &= bit(place)
    return out
