"""Shards as leaves of a k-d tree over document metadata, cut at weighted medians that are found by histograms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.storage import materialize

#: Bins of one histogram step for each node; the driver gets at most nodes * BINS sums, whatever the size of the table.
BINS = 1024
#: Parts of a shard's target bytes: a cut may miss its median by the first, and a group of copies larger than the second
#: is dealt out in several pieces.
TOLERANCE, PIECE = 0.0005, 0.01
#: Bits of a cut key below the coordinate; they order what has equal coordinates by group.
LOW = 31
_SLOT_ROWS = 50_000


@dataclass
class _Node:
    leaves: int
    first: int
    dim: int = 0
    cut: int = 0
    left: _Node | None = None
    right: _Node | None = None


def _route(node: _Node, value) -> Column:
    """The value of the leaf that a row falls into, as one expression of its cut keys."""
    if node.left is None:
        return F.lit(value(node))
    return F.when(F.col(f"key{node.dim}") >= F.lit(node.cut), _route(node.right, value)).otherwise(_route(node.left, value))


def _leaves(node: _Node) -> list[_Node]:
    return [node] if node.left is None else _leaves(node.left) + _leaves(node.right)


def _points(docs: DataFrame, shards: int) -> DataFrame:
    """A row per document: size, checksum, and for each dimension a cut key that all copies of a piece share."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("copy"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang")))
    rows = materialize(rows, "metadata")
    total = rows.agg(F.sum("size")).first()[0] or 0
    # written, so that the join below has both sides from the disk and Spark can split a text of very many copies
    groups = materialize(rows.groupBy("copy").agg(F.sum("size").alias("weight"), F.min("source").alias("s"), F.min("lang").alias("l")), "copies")
    # sources and languages have no measure: their hashes keep equal ones together
    coordinates = [F.col("size"), F.shiftrightunsigned(F.xxhash64("s"), 64 - LOW), F.shiftrightunsigned(F.xxhash64("l"), 64 - LOW)]
    pieces = F.ceil(F.col("weight") / F.lit(max(1.0, PIECE * total / shards)))
    # rows without doc_id are told apart by their place, which is fixed once the points are written
    own = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text_crc32")).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    piece = F.pmod(own, pieces)
    low = F.shiftrightunsigned(F.xxhash64("copy", piece), 64 - LOW)
    keys = [(F.shiftleft(F.least(c, F.lit((1 << LOW) - 1)).cast("long"), LOW).bitwiseOR(low)).alias(f"key{d}") for d, c in enumerate(coordinates)]
    return materialize(rows.join(groups, "copy").select("doc_id", "size", "text_crc32", own.alias("own"), *keys), "points")


def _spread(dim: int, low: int, high: int, whole: list[tuple[int, int]]) -> float:
    a, b = whole[dim]
    return ((high >> LOW) - (low >> LOW)) / max(1, (b >> LOW) - (a >> LOW))


def _cuts(points: DataFrame, root: _Node, open_: list[_Node], goal: float) -> None:
    """Split every open node along its widest dimension at the weighted quantile that its leaves ask for."""
    at = {id(n): i for i, n in enumerate(open_)}
    placed = points.withColumn("node", _route(root, lambda n: at.get(id(n), -1))).where("node >= 0")
    ends = [f(f"key{d}").alias(f"{name}{d}") for d in range(3) for name, f in (("low", F.min), ("high", F.max))]
    seen = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("size").alias("weight"), *ends).collect()}
    if not seen:
        return
    whole = [(min(r[f"low{d}"] for r in seen.values()), max(r[f"high{d}"] for r in seen.values())) for d in range(3)]
    search = {}
    for i, node in enumerate(open_):
        if r := seen.get(i):
            node.dim = max(range(3), key=lambda d: (_spread(d, r[f"low{d}"], r[f"high{d}"], whole), -d))
            search[i] = {"from": r[f"low{node.dim}"], "to": r[f"high{node.dim}"] + 1, "before": 0, "want": r["weight"] * (node.leaves // 2) / node.leaves}
    waiting = dict(search)
    while waiting:
        pick = lambda what: F.create_map(*(F.lit(x) for i in waiting for x in (i, what(i))))[F.col("node")]  # noqa: B023, E731
        step = {i: max(1, -(-(s["to"] - s["from"]) // BINS)) for i, s in waiting.items()}
        key = F.coalesce(*(F.when(F.col("node").isin([i for i in waiting if open_[i].dim == d]), F.col(f"key{d}")) for d in range(3)))
        inside = placed.where(F.col("node").isin(list(waiting))).withColumn("key", key)
        inside = inside.where((F.col("key") >= pick(lambda i: waiting[i]["from"])) & (F.col("key") < pick(lambda i: waiting[i]["to"])))
        bin_ = F.expr("(key - start) div step").alias("bin")
        inside = inside.withColumns({"start": pick(lambda i: waiting[i]["from"]), "step": pick(lambda i: step[i])})
        sums: dict[int, dict[int, int]] = {}
        for r in inside.groupBy("node", bin_).agg(F.sum("size").alias("w")).collect():
            sums.setdefault(r["node"], {})[r["bin"]] = r["w"]
        for i, s in list(waiting.items()):
            below = s["before"]
            for b, w in sorted(sums.get(i, {}).items()):
                if below + w >= s["want"]:
                    break
                below += w
            low, high = s["from"] + b * step[i], s["from"] + (b + 1) * step[i]
            if step[i] == 1 or w <= TOLERANCE * goal:
                open_[i].cut = low if s["want"] - below <= below + w - s["want"] else high
                del waiting[i]
            else:
                s |= {"from": low, "to": high, "before": below}
    for i in search:
        node = open_[i]
        half = node.leaves // 2
        node.left, node.right = _Node(half, node.first), _Node(node.leaves - half, node.first + half)


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per row of docs (doc_id, text, source, lang): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 bytes of the text and 16 more. A tree over (size, source, lang) is cut into so many leaves: each
    node along its widest dimension (range, as a part of the level's), at the weighted median, or the quantile for an
    odd number of leaves. So the shards' sizes are near equal (law `bytes`), and similar documents lie together. Copies
    of a text share their coordinates and stay in one shard, but for a cut through them and for groups over PIECE of a
    shard, which are spread where balance needs it. slot numbers the rows of a shard from 0 without gaps, by hashes of doc_id
    and text, so that many rows of one doc_id, or of none, are no single task. grown_shard is null: another number of
    shards means another tree.

    Null text: empty. Null doc_id, source, lang: values like any other. Repeated rows: each has a slot. Ties in a
    dimension are ordered by the text's hash. Other columns are not read. An empty table gives an empty result.
    """
    points = _points(docs, shards)
    count, total = points.agg(F.count("*"), F.sum("size")).first()
    root = _Node(shards, 0)
    while open_ := [n for n in _leaves(root) if n.leaves > 1]:
        _cuts(points, root, open_, (total or 0) / shards)
        if all(n.left is None for n in open_):
            break
    placed = points.withColumn("shard", _route(root, lambda n: n.first).cast("int"))
    lots = max(1, -(-count // (_SLOT_ROWS * shards // 8)))
    placed = placed.withColumn("lot", F.pmod("own", F.lit(lots)).cast("int"))
    sizes = placed.groupBy("shard", "lot").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("shard", "lot", before.alias("start"))
    own = F.row_number().over(Window.partitionBy("shard", "lot").orderBy("doc_id", "text_crc32"))
    out = placed.withColumn("own", own).join(starts, ["shard", "lot"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("own") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
