"""Operators 11 to 13 against brute force, SQL and on edge cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from compare import twin
from pyspark.sql import functions as F

from corpusmill.llm import filter_audit, fim, queries, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, output string, n long, print long, part string, digest string, home int, A int"


def _edges():
    rng = random.Random(4)
    prose = " ".join(rng.choice(["alpha", "Beta", "gamma", "Über", "naïve"]) + str(rng.randrange(60)) for _ in range(200))
    longest = "\n".join(str(rng.randrange(10**5)) for _ in range(250_000))  # over a block of a megabyte
    texts = [(1, prose), (2, prose), (3, prose.upper()), (4, prose + " more"), (5, None), (6, ""), (7, " \n\t"), (8, "one two"), (9, "one two"), (10, " One  Two\n"), (11, "aaaa" * 200), (12, longest), (None, prose), (13, "b"), (13, "b"), (13, prose), (14, "é\x1c 日本語 😀 " * 40), (None, None), (15, "a <P> b"), (16, "<S"), (17, "LOUD #1 " * 50), (18, "  x  ")]
    texts += [(20 + i, f"{prose} {'y' * (i % 3)} tail {i} <M" + " z" * i) for i in range(30)]
    return [(i, t, [None, "", "en", "de"][(i or 0) % 4], "o", 1, 2, "p", "d", 3, 4) for i, t in texts]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(_edges(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- simhash -------------------------------------------------------------------------------------------------------
def _print(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    width = min(4, len(words))
    found = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), seed=42) for i in range(len(words) - width + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def _plain_components(prints):
    """prints: list of (doc_id, fingerprint); smallest doc_id of each component, by all pairs."""
    known = sorted({p for i, p in prints if i is not None})
    parent = {p: p for p in known}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in itertools.combinations(known, 2):
        if (a ^ b).bit_count() <= 4:
            parent[root(a)] = root(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root(p)] = min(least.get(root(p), i), i)
    return sorted((repr(i), f"{p:016x}", None if i is None else least[root(p)]) for i, p in prints)


def _got(df):
    return sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in df.select("doc_id", simhash.hexadecimal("print").alias("fingerprint"), "component_id").collect())


def test_simhash_of_edge_rows(edges, empty):
    got = _got(simhash.near_duplicates(edges))
    assert got == _plain_components([(r[0], _print(r[1])) for r in _edges()])
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_of_documents(spark):
    got = queries.op11_simhash_near_dedup(spark, SF)
    want = _plain_components([(r["doc_id"], _print(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    assert sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got.collect()) == want
    assert len({w[2] for w in want}) < len(want)


def test_the_code_covers_with_radius_one():
    every = np.arange(1 << 17, dtype=np.uint64)
    home = simhash.nearest(every)
    assert np.bitwise_count(every ^ home).max() == 1 and (simhash.nearest(home) == home).all() and len(np.unique(home)) == 1 << 13
    row, found = simhash.anchors(every[:500], 17, 1)
    assert np.bitwise_count(every[row] ^ found).max() == 2  # radius and threshold
    want = {(i, int(simhash.nearest(np.array([i ^ e], np.uint64))[0])) for i in range(500) for e in [0, *(1 << k for k in range(17))]}
    assert set(zip(row.tolist(), found.tolist(), strict=True)) == want and len(row) == len(want)


@pytest.mark.parametrize(("distance", "bands", "rows_at_once"), [(4, 3, 1 << 16), (4, 3, 40), (4, 2, 40), (3, 4, 25), (6, 4, 1 << 16)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, distance, bands, rows_at_once):
    rng = random.Random(distance * bands)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = {0, (1 << 64) - 1, *seeds}
    for s in seeds:
        for _ in range(25):
            p = rng.choice([s, rng.choice(sorted(prints))])
            for _ in range(rng.randrange(1, 7)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    crowd = seeds[0]
    prints |= {crowd ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)}  # over ROWS at one anchor
    known = sorted(prints)
    monkeypatch.setattr(simhash, "ROWS", rows_at_once)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 100)
    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in known], "print long").repartition(4)
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(table, distance, bands).collect()]
    assert all((a ^ b).bit_count() > 0 for a, b in found)

    def roots(pairs):
        parent = {p: p for p in known}

        def root(p):
            while parent[p] != p:
                p = parent[p]
            return p

        for a, b in pairs:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        return {p: root(p) for p in known}

    near = [(a, b) for a, b in itertools.combinations(known, 2) if (a ^ b).bit_count() <= distance]
    assert roots(found) == roots(near) and len(found) < len(near)
    with pytest.raises(ValueError, match="bands"):
        simhash.links(table, 4, 1)


# ---- fill in the middle --------------------------------------------------------------------------------------------
def _plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return (repr(doc_id), len(units), form, None if form == "plain" else len(p), None if form == "plain" else len(m), out, text)


def test_fill_in_middle(edges, empty):
    many = edges.union(edges.withColumn("doc_id", F.col("doc_id") + 100)).union(edges.withColumn("doc_id", F.col("doc_id") + 1000))
    got = fim.rearranged(many).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = [_plain_fim(None if r[0] is None else r[0] + more, r[1]) for more in (0, 100, 1000) for r in _edges()]
    assert sorted((repr(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got) == sorted(want, key=lambda w: (w[0], w[1], w[2], w[3] or 0, w[4] or 0, w[5]))
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fim.rearranged(empty).count() == 0


def test_sentinels(spark):
    for bad in (("", "a", "b"), ("<P>", "<P>", "x"), ("aba", "c", "d"), ("xy", "yz", "q")):
        with pytest.raises(ValueError, match="sentinels"):
            fim.rearranged(spark.range(0).selectExpr("id AS doc_id", "'' AS text"), sentinels=bad)
    marks = ("[pre]", "[suf]", "[mid]")
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('w ', id, ' <P> tail [', id) AS text")
    got = fim.rearranged(docs, seed=7, rate=90, spm=50, sentinels=marks).withColumn("back", fim.restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r["back"] == r["text"] for r in got) and {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_plan_is_native(spark):
    plan = queries.op12_fill_in_middle(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


# ---- filter audit --------------------------------------------------------------------------------------------------
def _plain_audit(docs, labels):
    quality, toxic = {}, {}
    for i, q, t in labels:
        if i is not None:
            quality[i], toxic[i] = max(quality.get(i, 0), q or 0), max(toxic.get(i, 0), t or 0)
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(smallest.get(t or "", i), i)
    parts = {}
    for i, t, lang in docs:
        t = t or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and smallest[t] < i}
        parts.setdefault(lang or "", []).append((frozenset(f for f in fails if fails[f]), quality.get(i) == 1, toxic.get(i) == 1))
    out = []
    for part, found in parts.items():
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = found
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                fail = [r for r in found if f in r[0]]
                steps.append((part, "".join(order), step, len(left), len(gone), len(fail) - len(gone), sum(r[0] == {f} for r in fail), sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def test_filter_audit(spark, edges, empty):
    labels = [(i, i % 2, i % 3 == 0) for i in range(1, 40)] + [(2, 1, 1), (2, None, None), (None, 1, 1), (99, 1, 1), (8, 1, 1)]
    table = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    got = filter_audit.audited(edges, table)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == _plain_audit([r[:3] for r in _edges()], labels)
    assert filter_audit.audited(empty, table).count() == 0
    assert filter_audit.audited(edges, table.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_bitmap_index_of_other_filters(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PARTS_AT_ONCE", 2)
    rng = random.Random(3)
    found = [(f"p{rng.randrange(7)}", *(rng.choice([True, False, None]) for _ in range(4))) for _ in range(500)]
    flags = spark.createDataFrame(found, "part string, x boolean, y boolean, z boolean, seen boolean").repartition(3)
    index = filter_audit.bitmap_index(flags, ("x", "y", "z"), ("seen",))
    assert index.agg(F.sum("n")).first()[0] == 500 and all(len(r["x"]) == -(-r["n"] // 8) for r in index.collect())
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["seen_lost"]) for r in filter_audit.audit(index, ("x", "y", "z"), ("seen",)).collect()}
    for part in {f[0] for f in found}:
        for order in itertools.permutations(range(3)):
            left = [f for f in found if f[0] == part]
            for step, i in enumerate(order, 1):
                gone = [f for f in left if f[1 + i]]
                left = [f for f in left if not f[1 + i]]
                assert got[part, "".join("xyz"[j] for j in order), step] == (len(left), len(gone), sum(bool(f[4]) for f in gone))
    with pytest.raises(ValueError, match="filters"):
        filter_audit.subset_counts(index, tuple("abcdefg"))


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_filter_audit"])
def test_sql(spark, name):
    got, want = queries.QUERIES[name](spark, SF), twin(queries.ORACLES[name], SF)
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda rows: sorted(repr(tuple(None if v is None or v is pd.NA or v != v else int(v) if isinstance(v, float) else v for v in r)) for r in rows)
    assert plain(got.collect()) == plain(want[got.columns].astype(object).itertuples(index=False, name=None))
