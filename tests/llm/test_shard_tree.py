"""Shards against a plain k-d tree, at the query's 40 shards and with groups of equal texts."""

import collections
import random
import zlib

import pytest

from corpusmill.llm import kd_shards, queries


def _rows():
    rng = random.Random(40)
    some = ["copy of one text " * 30, "another " * 200, ""]
    out = [(i, rng.choice(some) if i % 3 == 0 else " ".join(str(rng.randrange(10**6)) for _ in range(rng.randrange(1, 300))), rng.choice(["de", "en", None]), f"site-{int(rng.paretovariate(0.7)) % 30}") for i in range(1500)]
    return out + [out[0], out[0], (None, "x y", "en", None), (None, None, None, None), (7, "second text of an id " * 9, "de", "site-1")]


def _tree(points, shards):
    """Shard of each point (size, (key of each dimension)) by cutting sorted lists at the weighted quantile."""
    nodes, done = [(shards, 0, list(range(len(points))))], {}
    while nodes:
        alive = [n for n in nodes if n[0] > 1 and n[2]]
        for leaves, first, own in nodes:
            if leaves == 1:
                done |= dict.fromkeys(own, first)
        ends = {id(n): [(min(points[i][1][d] for i in n[2]), max(points[i][1][d] for i in n[2])) for d in range(3)] for n in alive}
        whole = [(min(e[d][0] for e in ends.values()), max(e[d][1] for e in ends.values())) for d in range(3)] if alive else []
        nodes = []
        for node in alive:
            leaves, first, own = node
            wide = lambda d: ((ends[id(node)][d][1] >> kd_shards.LOW) - (ends[id(node)][d][0] >> kd_shards.LOW)) / max(1, (whole[d][1] >> kd_shards.LOW) - (whole[d][0] >> kd_shards.LOW))  # noqa: B023, E731
            d = max(range(3), key=lambda d: (wide(d), -d))
            want, below = sum(points[i][0] for i in own) * (leaves // 2) / leaves, 0
            weight = collections.Counter()
            for i in own:
                weight[points[i][1][d]] += points[i][0]
            for key in sorted(weight):
                if below + weight[key] >= want:
                    break
                below += weight[key]
            cut = key if want - below <= below + weight[key] - want else key + 1
            nodes += [(leaves // 2, first, [i for i in own if points[i][1][d] < cut]), (leaves - leaves // 2, first + leaves // 2, [i for i in own if points[i][1][d] >= cut])]
    return done


@pytest.mark.parametrize("shards", [40, 7])
def test_shards_are_the_leaves_of_a_plain_tree(spark, monkeypatch, shards):
    monkeypatch.setattr(kd_shards, "TOLERANCE", 0)
    docs = spark.createDataFrame(_rows(), "doc_id long, text string, lang string, source string").repartition(4)
    kept = []
    real = kd_shards._points
    monkeypatch.setattr(kd_shards, "_points", lambda *a: kept.append(real(*a)) or kept[-1])
    got = kd_shards.shard(docs, shards).collect()
    points = kept[0].collect()
    place = _tree([(p["size"], (p["key0"], p["key1"], p["key2"])) for p in points], shards)
    want = collections.Counter((p["doc_id"], p["text_crc32"], place[i]) for i, p in enumerate(points))
    assert collections.Counter((r["doc_id"], r["text_crc32"], r["shard"]) for r in got) == want
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in _rows())
    # coordinates are those of the text's copies, but for pieces of large groups
    sizes = {p["text_crc32"]: p["size"] for p in points}
    assert all(p["key0"] >> kd_shards.LOW == sizes[p["text_crc32"]] for p in points)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_are_near_equal_in_forty_shards(spark):
    docs = spark.createDataFrame(_rows(), "doc_id long, text string, lang string, source string")
    got = kd_shards.shard(docs, 40).collect()
    size = collections.Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    goal, largest = sum(size.values()) / 40, max(r["size"] for r in got)
    assert len(size) == 40 and max(abs(s - goal) for s in size.values()) <= largest + 0.02 * goal
    query = queries.op7_kd_tree_sharding(spark, "/root/testdata/sf0.01").collect()
    assert {r["shard"] for r in query} == set(range(40)) and {r["law"] for r in query} == {"bytes"} and len(query) == 1000
