"""Benchmark decontamination by spaced seeds: hits of masked token windows, then aligned comparison around them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Masks over a window of tokens by the least length of the items they are for; a 0 is a position whose token may differ.
#: Wherever the differing tokens stand that WINDOW and AGREE accept, some mask of an item's length fits between them: all
#: placements of 3 in 15 tokens (so in any 16, too), of 2 in 12, of 2 in 10, of 1 in 8 and of 1 in 5; shorter items are
#: found whole. Tests go through all of them.
POOLS = {
    15: ("1101111", "11100010011", "11000101011"), 12: ("11001011", "1101001001"), 10: ("110111", "11001011", "110100011"),
    8: ("110111", "1101101"), 5: ("1111", "10111", "11011", "11101"), 4: ("1111",), 3: ("111",), 2: ("11",), 1: ("1",),
}
#: Around a hit, this part of WINDOW aligned tokens (of the whole item if it is shorter) must agree.
WINDOW, AGREE = 16, 0.8
#: Windows of the test set that are broadcast (some 40 bytes each), and its items too; larger sets are joined by a shuffle.
BROADCAST_ROWS = 400_000
_SPLIT = "[\\x20\\x09-\\x0D]+"


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPLIT), "")


def _windows(docs: DataFrame, masks: list[str]) -> DataFrame:
    """(k, part, n, at, mask, seed): for each mask and position the hash of the tokens that the mask keeps, of n tokens.

    Hashes of neighbours are made once and combined with themselves, shifted.
    """
    joined = lambda x, y: F.zip_with(x, y, lambda a, b: F.xxhash64(a, b))
    later = lambda x, n: F.slice(x, n + 1, F.greatest(F.size(x), F.lit(1))) if n else x
    hashed = docs.select("k", "part", F.transform(_tokens(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    pairs = hashed.select("k", "part", F.size("h").alias("n"), "h", joined("h", later("h", 1)).alias("p")).where("n > 0")

    def seeds(mask: str) -> Column:
        parts, i = [], 0
        while i < len(mask):
            two = mask[i : i + 2] == "11"
            if mask[i] == "1":
                parts.append(later(F.col("p" if two else "h"), i))
            i += 1 + two
        return reduce(joined, parts)

    # every array is as long as the text, so the place in their concatenation tells mask and position
    found = pairs.select("k", "part", "n", F.posexplode(F.concat(*(seeds(m) for m in masks))).alias("at", "seed"))
    found = found.select("k", "part", "n", F.pmod("at", "n").alias("at"), F.floor(F.col("at") / F.col("n")).cast("int").alias("mask"), "seed")
    fits = F.get(F.array(*(F.lit(len(m)) for m in masks)), F.col("mask"))
    return found.where(F.col("at") + fits <= F.col("n"))


def _pool(text: Column) -> Column:
    """The key of POOLS for an item; null: it has no tokens."""
    n = F.size(_tokens(text))
    return F.coalesce(*(F.when(n >= k, k) for k in sorted(POOLS, reverse=True)))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_tokens, n_agree, part) for each document and benchmark item that overlap.

    Tokens are lower-cased and split at ASCII white space. A pair counts if in some WINDOW consecutive aligned tokens (of
    an item with fewer tokens: in all of it) at least AGREE of them agree. Windows are hashed under the masks that POOLS
    has for the items' lengths, on both sides; equal hashes align document and item, and no pair that counts is without
    one. n_tokens: aligned tokens, n_agree: those that agree, of the best alignment that counts.

    part is xxhash64 of the document's text: with doc_id it tells rows apart, for those who remove them.

    Null texts and texts without tokens overlap with nothing. Null doc_ids are kept; rows with equal doc_id and text
    give one result, those with equal doc_id and other texts one each. Of alignments that tie, any has the same numbers.
    Repeated items: each is reported, equal (item_id, text) once. Texts are read whole, whatever their length. Other
    columns are not read, whatever their names. An empty side gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), F.xxhash64("text").alias("part"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("k"), F.xxhash64("text").alias("part"))
    pools = sorted(r["pool"] for r in items.select(_pool(F.col("text")).alias("pool")).distinct().collect() if r["pool"]) or [15]
    masks = sorted({m for p in pools for m in POOLS[p]})
    own = reduce(DataFrame.union, (_windows(items.where(_pool(F.col("text")) == p), list(POOLS[p])).withColumn("mask", F.get(F.array(*(F.lit(masks.index(m)) for m in POOLS[p])), F.col("mask"))) for p in pools))
    tested = items.select("item_id", F.col("k").alias("ik"), F.col("part").alias("ip"), _tokens(F.col("text")).alias("item")).dropDuplicates(["ik", "ip"])
    seeds = own.select(F.col("k").alias("ik"), F.col("part").alias("ip"), F.col("n").alias("m"), F.col("at").alias("q"), "mask", "seed").distinct()
    small = seeds.count() <= BROADCAST_ROWS  # no item has fewer windows than one, so the items are bounded, too
    of_items = F.broadcast if small else (lambda df: df)
    hits = _windows(docs, masks).drop("n").join(of_items(seeds), ["mask", "seed"]).select("k", "part", "ik", "ip", "m", (F.col("at") - F.col("q")).alias("shift")).distinct()
    # a document meets its hits once; each cuts the words that stand beside its item, and only these go on
    aligned = hits.groupBy("k", "part").agg(F.collect_list(F.struct("ik", "ip", "m", "shift")).alias("hits"))
    both = docs.join(aligned, ["k", "part"])

    def beside(words: Column, hit: Column) -> Column:
        shift = hit.getField("shift")
        first = F.greatest(F.lit(0), -shift)
        count = F.greatest(F.least(hit.getField("m"), F.size(words) - shift) - first, F.lit(0))
        return F.struct(hit.getField("ik").alias("ik"), hit.getField("ip").alias("ip"), first.alias("first"), F.slice(words, first + shift + 1, count).alias("words"))

    # the array of one element binds the words, so that a text is split once for all its hits
    cut = F.flatten(F.transform(F.array(_tokens(F.col("text"))), lambda words: F.transform("hits", lambda hit: beside(words, hit))))
    rows = both.select("doc_id", "part", F.explode(cut).alias("t")).select("doc_id", "part", "t.*").join(of_items(tested), ["ik", "ip"])
    equal = F.zip_with(F.slice("item", F.col("first") + 1, F.size("words")), "words", lambda x, y: (x == y).cast("int"))
    scored = rows.select("doc_id", "part", "item_id", equal.alias("equal"), F.least(F.lit(WINDOW), F.size("item")).alias("width"))
    spans = F.transform(F.sequence(F.lit(1), F.size("equal") - F.col("width") + 1), lambda i: F.aggregate(F.slice("equal", i, F.col("width")), F.lit(0), lambda a, x: a + x))
    good = scored.where(F.size("equal") >= F.col("width")).where(F.array_max(spans) >= AGREE * F.col("width"))
    total = F.aggregate("equal", F.lit(0), lambda a, x: a + x)
    best = good.select("doc_id", "part", "item_id", F.struct(total.cast("long").alias("n_agree"), F.size("equal").cast("long").alias("n_tokens")).alias("best"))
    best = best.groupBy("doc_id", "part", "item_id").agg(F.max("best").alias("best"))
    return best.select("doc_id", "item_id", "best.n_tokens", "best.n_agree", "part")


def _sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _sql_seeds(table: str, own_pool: bool) -> str:
    """Seeds of a table (key, w) under all masks; of the items under those for their length."""
    longer = sorted(POOLS)
    parts = []
    for pool, masks in POOLS.items():
        above = next((f" AND len(w) < {k}" for k in longer if k > pool), "")
        for mask in masks:
            size = f"len(w) >= {pool}{above}" if own_pool else f"len(w) >= {len(mask)}"
            kept = ", ".join(f"w[g + {j}]" for j, b in enumerate(mask) if b == "1")
            parts.append(f"SELECT key, g AS at, '{mask}' AS mask, concat_ws(chr(1), {kept}) AS seed FROM (SELECT key, w, unnest(generate_series(1, len(w) - {len(mask) - 1})) AS g FROM {table} WHERE {size})")
    return " UNION ALL ".join(parts)


ORACLE = f"""
WITH d AS (SELECT doc_id AS key, {_sql('text')} AS w FROM documents), b AS (SELECT item_id AS key, {_sql('text')} AS w FROM benchmark),
bs AS ({_sql_seeds('b', True)}), ds AS ({_sql_seeds('d', False)}),
hits AS (SELECT DISTINCT ds.key AS doc_id, bs.key AS item_id, ds.at - bs.at AS shift FROM ds JOIN bs ON ds.mask = bs.mask AND ds.seed = bs.seed),
cells AS (SELECT h.doc_id, h.item_id, h.shift, len(b.w) AS m, unnest(generate_series(greatest(1, 1 - h.shift), least(len(b.w), len(d.w) - h.shift))) AS i, d.w AS dw, b.w AS bw FROM hits h JOIN d ON d.key = h.doc_id JOIN b ON b.key = h.item_id),
eq AS (SELECT doc_id, item_id, shift, m, i, CASE WHEN bw[i] = dw[i + shift] THEN 1 ELSE 0 END AS e FROM cells),
run AS (SELECT *, row_number() OVER w AS r, sum(e) OVER w AS s FROM eq WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY i)),
win AS (SELECT y.doc_id, y.item_id, y.shift, max((y.s - coalesce(x.s, 0)) / least({WINDOW}, y.m)) AS best FROM run y LEFT JOIN run x ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND x.shift = y.shift AND x.r = y.r - least({WINDOW}, y.m) WHERE y.r >= least({WINDOW}, y.m) GROUP BY ALL),
total AS (SELECT doc_id, item_id, shift, count(*) AS n_tokens, sum(e) AS n_agree FROM eq GROUP BY ALL),
ranked AS (SELECT t.*, row_number() OVER (PARTITION BY t.doc_id, t.item_id ORDER BY n_agree DESC, n_tokens DESC) AS k FROM total t JOIN win USING (doc_id, item_id, shift) WHERE best >= {AGREE})
SELECT doc_id, item_id, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_agree AS BIGINT) AS n_agree FROM ranked WHERE k = 1
"""
