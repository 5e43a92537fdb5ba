"""Every overlap that the rule of decontamination accepts has a seed and is found."""

import math
import random
from itertools import combinations

from corpusmill.llm import decontaminate


def _pool(n):
    return decontaminate.POOLS[max(k for k in decontaminate.POOLS if k <= n)]


def test_a_seed_for_all_placements():
    for n in range(1, 17):
        views = [{i + j for j, b in enumerate(m) if b == "1"} for m in _pool(n) for i in range(n - len(m) + 1)]
        for k in range(n - math.ceil(decontaminate.AGREE * n) + 1):
            assert all(any(v.isdisjoint(e) for v in views) for e in combinations(range(n), k)), (n, k)


def _brute(docs, items):
    found = {}
    for d, text in docs:
        for i, item in items:
            a, b = text.split(), item.split()
            width = min(16, len(b))
            for shift in range(-len(b), len(a)):
                equal = [int(b[q] == a[q + shift]) for q in range(max(0, -shift), min(len(b), len(a) - shift))]
                if len(equal) >= width and max(sum(equal[j : j + width]) for j in range(len(equal) - width + 1)) >= decontaminate.AGREE * width:
                    found[d, i] = max(found.get((d, i), (0, 0)), (sum(equal), len(equal)))
    return found


def test_overlaps_are_those_of_brute_force(spark):
    rng = random.Random(8)
    word = lambda: f"t{rng.randrange(3000)}"
    items = [(n, " ".join(word() for _ in range(n))) for n in (*range(1, 21), 40)]
    docs = []
    for n, item in items:
        size = min(n, 16)
        most = size - math.ceil(decontaminate.AGREE * size)
        places = list(combinations(range(size), most)) + list(combinations(range(size), most + 1))
        for gone in rng.sample(places, min(60, len(places))):
            at = rng.randrange(n - size + 1)
            copy = ["other" if i in gone else w for i, w in enumerate(item.split()[at : at + size])]
            docs.append((len(docs), " ".join([word() for _ in range(5)] + copy + [word() for _ in range(5)])))
    want = _brute(docs, items)
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): (r["n_agree"], r["n_tokens"]) for r in got.collect()} == want
