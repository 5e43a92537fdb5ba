"""The ten operators and the pipeline against brute force, and on nulls, blanks, long texts, ties and empty tables."""

import collections
import datetime
import hashlib
import math
import pathlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import pytest
import tiktoken
import zstandard
from compare import rows, twin
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import bpe, decontaminate, graph, hashing, kd_shards, line_dedup, minhash, pii, quality_bands, queries, secret_scan, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, k string, part long, seed string, row long"


def _edges():
    rng = random.Random(9)
    prose = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Über", "naïve", "x1"]) + str(rng.randrange(90)) for _ in range(300))
    longest = " ".join(str(rng.randrange(10**6)) for _ in range(180_000))  # over a block of a megabyte
    texts = [(1, prose), (2, prose), (3, prose.replace("alpha", "ALPHA")), (4, prose + " more"), (5, None), (6, ""), (7, " \n\t"), (8, "one two"), (9, "one two"), (10, "One  Two\n"), (11, "aaaa" * 200), (12, longest), (None, prose), (13, "aaaa" * 200), (13, "aaaa" * 200), (14, "é\x1c 日本語 " * 40), (15, longest[:400] + longest), (None, None)]
    return [(i, t, None if i == 8 else "en", None if i == 9 else "s", None if i == 4 else len(t or ""), "kept", "k", 1, "seed", 2) for i, t in texts]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(_edges(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


# ---- near-duplicates -----------------------------------------------------------------------------------------------
def _components(texts, width=4, percent=80):
    sets = {i: ({tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))} if (w := WORD.findall(_lower(t))) else set()) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_near_duplicates(spark, docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(160)]
    made = []
    for i in range(1000, 1160):  # versions of one text, from alike to clearly different
        copy = list(base)
        for _ in range(rng.randrange(0, 14)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        made.append((i, " ".join(copy)))
    table = docs.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(table).collect()}
    assert got == _components({r["doc_id"]: r["text"] for r in table.collect()})


def test_near_duplicate_edges(edges, empty):
    got = [tuple(r)[:4] for r in minhash.near_duplicates(edges).collect()]
    by = collections.defaultdict(list)
    for i, *rest in got:
        by[i].append(tuple(rest))
    assert len(got) == len(_edges())
    assert [by[i][0][1] for i in (1, 2, 3, 4)] == [1, 1, 1, 1] and by[1][0][2] and not by[4][0][2]
    assert [by[i][0][0] for i in (5, 6, 7)] == [0, 0, 0]
    assert [by[i][0][1] for i in (5, 6, 7)] == [5, 6, 7]
    assert [by[i][0][:2] for i in (8, 9, 10)] == [(1, 8)] * 3
    assert by[13] == [(1, 11, False)] * 2
    assert {(c, k) for _, c, k in by[None]} == {(None, True)}
    assert minhash.near_duplicates(empty).count() == 0


def test_rows_of_one_id_are_placed_by_their_texts(spark):
    a, b = ("".join(f"{w}{i} " for i in range(60)) for w in "ab")
    rows_ = [(5, a), (5, b), (6, a.replace("a59", "z")), (7, b), (7, b), (8, a), (9, "other text"), (9, "other text"), (5, a)]
    got = sorted((r["doc_id"], r["component_id"], r["n_shingles"], r["part"]) for r in minhash.near_duplicates(spark.createDataFrame(rows_, "doc_id long, text string")).collect())
    assert [g[:2] for g in got] == [(5, 5)] * 3 + [(6, 5), (7, 5), (7, 5), (8, 5), (9, 9), (9, 9)]
    # two classes of document 5 are two sets, not one: without 5 they have other labels
    apart = minhash.near_duplicates(spark.createDataFrame(rows_ + [(1, b)], "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in apart} == {(1, 1), (5, 5), (5, 1), (6, 5), (7, 1), (8, 5), (9, 9)}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(5, 5)]
    parent = {x: x for p in pairs for x in p if p[0] != p[1]}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in pairs:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = graph.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {x: root(x) for x in parent}


def test_estimate_and_packing(spark):
    rng = np.random.default_rng(0)
    for shared in (200, 700, 950):
        a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        b = np.concatenate((a[:shared], rng.integers(0, 1 << 63, 1000 - shared, dtype=np.uint64)))
        packed = [minhash.packed(minhash.minima(x)).tolist() for x in (a, b)]
        df = spark.createDataFrame([tuple(packed[0] + packed[1])], ", ".join(f"{p}{j} long" for p in "xy" for j in range(len(packed[0]))))
        assert df.select(minhash.estimate("x", "y")).first()[0] == pytest.approx(shared / (2000 - shared), abs=0.09)


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = [None if t is None else t.encode() for _, t, *_ in _edges()]
    whole = {i: h.tolist() for i, h in hashing.word_hashes(texts)}
    assert [len(whole[i]) for i in range(len(texts))] == [len(WORD.findall((t or b"").decode())) for t in texts]
    monkeypatch.setattr(hashing, "BLOCK", 5000)
    assert {i: h.tolist() for i, h in hashing.word_hashes(texts)} == whole


# ---- byte-level BPE ------------------------------------------------------------------------------------------------
def test_bpe_is_that_of_the_library(spark, docs, edges, empty):
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(RANKS), special_tokens={})
    table = docs.select("doc_id", "text").union(edges.select("doc_id", "text"))
    want = collections.Counter()
    for r in table.collect():
        ids = exact.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), (r["text"] or "").encode()] += 1
    for n in (1, 5):
        out = bpe.decode(bpe.encode(table.repartition(n), RANKS, public_tokenizers.PATTERN), bpe.token_table(spark, RANKS))
        assert collections.Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in out.collect()) == want
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def _codes(texts, pattern=public_tokenizers.PATTERN):
    block = bpe._Block(pattern)
    for i, text in enumerate(texts):
        block.add(i, text)
    words, stream, counts = block.words()
    out, at = [], 0
    for n in counts.tolist():
        out.append([words[c] for c in stream[at : at + n].tolist()])
        at += n
    return out


def test_pretokens_of_every_character(monkeypatch):
    """Every character beside others, blanks of all kinds in runs, and pieces that are cut or not."""
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(RANKS), special_tokens={})
    assert bpe.PIECEWISE == public_tokenizers.PATTERN
    encode = bpe._encoder(RANKS)
    texts = [" ".join(f"a{chr(c)} {chr(c)}1" for c in range(low, low + 64) if not 0xD800 <= c < 0xE000) for low in range(0, 0x20000, 64)]
    rng = random.Random(12)
    texts += ["".join(rng.choice([" ", " ", "  ", "\n", "\t", "\x1c", "\u00a0", "\u2003", "a", "b'll", "'s", "7", "#", "é", "日"]) for _ in range(rng.randrange(40))) for _ in range(4000)]
    for size in (1 << 20, 3):
        monkeypatch.setattr(bpe, "LONG", size)
        for text, words in zip(texts, _codes(texts), strict=True):
            assert "".join(words) == text
            assert [t for w in words for t in encode(w)] == exact.encode_ordinary(text)
    assert _codes(["x y", ""], "[a-z]") == [["x", "y"], []]


def test_words_are_encoded_alike_with_a_small_memory(spark, docs, monkeypatch):
    run = bpe._word_ids(RANKS)
    monkeypatch.setattr(bpe, "BLOCK", 20_000)
    monkeypatch.setattr(bpe, "GROUP", 1)
    table = docs.select("doc_id", "text").toArrow()
    rows = [b for b in bpe._pretokens(public_tokenizers.PATTERN, 8)(table.to_batches())]
    words = [b.filter(pa.compute.equal(b.column("kind"), 0)) for b in rows]
    whole = [b.to_pydict() for b in run(words)]
    monkeypatch.setattr(bpe, "KNOWN", 5)
    assert [b.to_pydict() for b in run(words)] == whole and sum(len(b["block"]) for b in whole) > 50


def test_texts_are_split_once(spark, docs):
    """Words and positions come from one exchange: the second one is reused."""
    out = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert len(out.collect()) == docs.count()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


# ---- secrets -------------------------------------------------------------------------------------------------------
def test_secret_forest_on_held_out_findings(spark, docs, edges, empty):
    labelled = secret_scan.labelled_findings(spark, 3000)
    model = secret_scan.fit(labelled.where(F.crc32(F.col("candidate").cast("binary")) % 3 != 1), secret_scan.language_of(docs))
    held = labelled.where(F.crc32(F.col("candidate").cast("binary")) % 3 == 1)
    text = F.concat(F.lit("some words "), "before", "candidate", "after")
    found = secret_scan.scan(held.select(F.monotonically_increasing_id().alias("doc_id"), text.alias("text"), F.col("path").alias("source"), "label"), model)
    truth = {r[0]: r[1] for r in held.select(F.sha2("candidate", 256), "label").collect()}
    marks = [(truth[r["fingerprint"]], r["is_secret"]) for r in found.collect() if r["fingerprint"] in truth]
    assert len(marks) > 500 and sum((y == 1) == p for y, p in marks) / len(marks) > 0.93
    table = spark.createDataFrame([(1, 'x token = "a5a6b8714a59bfca3cab47224b862a3bee98dc2b" La', "src0"), (2, "call 2675131828899234 now", "src0"), (3, None, None), (None, "api_key=Zx81kQ9fLm27TtYw03Bv1111", "s"), (4, "incomprehensibilities only", "s")], "doc_id long, text string, source string")
    got = {(r["doc_id"], r["place"]): r["is_secret"] for r in secret_scan.scan(table, model).collect()}
    assert got == {(1, 0): True, (2, 0): False, (None, 0): True}
    assert secret_scan.scan(edges, model).columns == ["doc_id", "place", "kind", "fingerprint", "n_chars", "score", "is_secret"]
    assert secret_scan.scan(edges, model).count() >= 0 and secret_scan.scan(empty, model).count() == 0
    plan = secret_scan.scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- suffix dedup --------------------------------------------------------------------------------------------------
def _removed(table):
    """(kept, spans) by a set of all windows; rows of one (doc_id, text) are one document."""
    seen, out = set(), {}
    for key in sorted(table, key=lambda x: (x[0] is None, x[0] or 0)):
        text = (key[1] or "").encode()
        if key in out:
            continue
        covered = np.zeros(len(text), bool)
        for p in range(len(text) - 99):
            w = text[p : p + 100]
            if w in seen:
                covered[p : p + 100] = True
            seen.add(w)
        bounds = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
        out[key] = (bytes(np.frombuffer(text, np.uint8)[~covered]), [tuple(b) for b in bounds.reshape(-1, 2).tolist()])
    return out


def _with_passages(table):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcde fghij") for _ in range(260))
    made = [(2000 + i, "".join(rng.choice("klmno pq") for _ in range(rng.randrange(0, 150))) + passage[rng.randrange(60) : 200 + rng.randrange(60)] + str(i)) for i in range(60)]
    made += [(2100 + i, "".join(rng.choice("klmno pq") for _ in range(80)) + passage[:70] + "".join(rng.choice("rstu v") for _ in range(80))) for i in range(60)]
    made += [(3000, "ab" * 300), (3001, "ab" * 299), (3002, "z" * 99), (3003, "z" * 100), (3004, "z" * 101), (3005, None), (3006, ""), (None, passage), (None, "é" * 120), (3007, passage), (3007, passage), (3007, passage[5:])]
    return [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()] + made


@pytest.mark.parametrize(("kinds", "bits", "rows"), [(8, 64, 50), (0, 64, 400), (2, 64, 30), (2, 8, 30), (0, 8, 400), (1000, 8, 30)])
def test_digits_in_one_process(docs, monkeypatch, kinds, bits, rows):
    """All passes without Spark, also if every first digit goes on at once, or most of them are equal by chance."""
    monkeypatch.setattr(suffix_dedup, "KINDS", kinds)
    monkeypatch.setattr(suffix_dedup, "SUFFIXES", 300 * rows)
    monkeypatch.setattr(suffix_dedup, "PARTS", 20 * rows)
    whole = suffix_dedup.mix
    if bits == 8:
        monkeypatch.setattr(suffix_dedup, "mix", lambda x: whole(x) & np.uint64(255))
    table = _with_passages(docs.where("doc_id < 120"))
    keyed = [((1 << 63) - 1 if i is None else i, zlib.crc32((t or "").encode()), t) for i, t in table]
    random.Random(4).shuffle(keyed)

    def grouped(batches, run):
        packed = pa.Table.from_batches(batches)
        return [pa.Table.from_pylist([r for r in packed.to_pylist() if r["bucket"] == b], packed.schema) for b in sorted(set(packed.column("bucket").to_pylist()))]

    batches = [pa.RecordBatch.from_pylist([dict(zip(("k", "part", "text"), r, strict=True)) for r in keyed[at : at + rows]], pa.schema([("k", pa.int64()), ("part", pa.int64()), ("text", pa.string())])) for at in range(0, len(keyed), rows)]
    settled = pa.concat_tables([suffix_dedup._first_digits(g) for g in grouped(suffix_dedup._scan(5)(batches), None)]).to_pylist()
    joined = collections.defaultdict(lambda: ([], []))
    for r in settled:
        joined[r["kind"], r["k"], r["part"]][0].extend(r["los"])
        joined[r["kind"], r["k"], r["part"]][1].extend(r["ends"])
    open_ = [(k, p, t, *joined[2, k, p]) for k, p, t in dict.fromkeys(keyed) if (2, k, p) in joined]
    names = ("k", "part", "text", "los", "ends")
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in open_[at : at + rows]]) for at in range(0, len(open_), rows)]
    for g in grouped(suffix_dedup._fetch(5)(batches), None):
        for r in suffix_dedup._last_digits(g).to_pylist():
            joined[1, r["k"], r["part"]][0].extend(r["los"])
            joined[1, r["k"], r["part"]][1].extend(r["ends"])
    seen, want = set(), {}
    for k, p, t in sorted(set(keyed), key=lambda x: x[:2]):
        text = (t or "").encode()
        covered = set()
        for at in range(len(text) - 99):
            if text[at : at + 100] in seen:
                covered |= set(range(at, at + 100))
            seen.add(text[at : at + 100])
        want[k, p] = covered
    got = {(k, p): {i for a, b in zip(*joined[1, k, p], strict=True) for i in range(a, b)} for k, p, _ in keyed}
    assert {x: (sorted(got[x] - want[x]), sorted(want[x] - got[x])) for x in want if got[x] != want[x]} == {}
    assert sum(map(len, want.values())) > 5000


def test_repeats_are_removed(spark, docs):
    table = spark.createDataFrame(_with_passages(docs), "doc_id long, text string")
    plain = [(r["doc_id"], r["text"]) for r in table.collect() if r["doc_id"] != 3007]
    want = _removed(plain)
    for parts in (1, 6):
        for r in suffix_dedup.remove_repeats(table.where("doc_id IS NULL OR doc_id <> 3007").repartition(parts), buckets=16).collect():
            assert (bytes(r["kept"]), [tuple(s) for s in r["spans"]]) == want[r["doc_id"], r["text"]], r["doc_id"]


def test_repeat_edges(edges, empty):
    out = suffix_dedup.remove_repeats(edges).collect()
    assert len(out) == len(_edges())
    by = collections.defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
    assert len(by[1][0]["kept"]) == len(by[1][0]["text"].encode()) and len(by[2][0]["kept"]) == 0
    assert all(len(r["kept"]) == 0 for r in by[13]) and len(by[11][0]["kept"]) == 1
    assert len(by[12][0]["kept"]) == len(by[12][0]["text"]) and len(by[15][0]["kept"]) < 500
    assert suffix_dedup.remove_repeats(empty).count() == 0


# ---- line dedup ----------------------------------------------------------------------------------------------------
def test_lines(spark, edges, empty):
    made = [(i, f"head\nown {i}\n\nfoot {i % 2}\nhead", "a" if i < 60 else "b", i) for i in range(100)] + [(200, None, "a", 0), (201, "head", None, 0), (None, "head\nx", "a", 0)]
    out = line_dedup.drop_boilerplate(spark.createDataFrame(made, "doc_id long, text string, source string, row long"), ratio=0.5, least=10).collect()
    by = {r["doc_id"]: r for r in out}
    assert by[3]["text"] == "own 3\n\nfoot 1" and (by[3]["n_lines"], by[3]["n_dropped"], by[3]["row"]) == (5, 2, 3)
    assert by[200]["text"] is None and by[200]["n_lines"] == 0
    assert by[201]["text"] == "head" and by[None]["text"] == "x"
    got = line_dedup.drop_boilerplate(edges)
    assert got.count() == len(_edges()) and set(got.columns) == {*edges.columns, "n_lines", "n_dropped"}
    assert line_dedup.drop_boilerplate(empty).count() == 0


# ---- quality rules -------------------------------------------------------------------------------------------------
def _base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = collections.Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, edges, empty):
    for table in (docs.select("doc_id", "text"), edges):
        texts = collections.defaultdict(list)
        for r in table.collect():
            texts[r["doc_id"]].append(_base(r["text"]))
        for r in quality_bands.quality(table).collect():
            own = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert own in texts[r["doc_id"]]
            assert r["base_failed"] == (own[0] < 10 or 100 * own[4] > 20 * own[0])
            assert not (r["kept"] and r["base_failed"])
    assert quality_bands.quality(empty).count() == 0


def _verdict(text, bands):
    """kept, without the operator's vectors."""
    raw, own = (text or "").encode(), _base(text)
    if own[0] < 10 or 100 * own[4] > 20 * own[0]:
        return False
    ratio = lambda x: len(zstandard.ZstdCompressor(level=3).compress(x)) / len(x)

    def line(points):
        xs = sorted(points)
        for x, y in zip(xs, xs[1:], strict=False):
            if x <= len(raw) <= y:
                part = (math.log2(len(raw)) - math.log2(x)) / (math.log2(y) - math.log2(x))
                return points[x] + part * (points[y] - points[x])
        return points[xs[0] if len(raw) < xs[0] else xs[-1]]

    if ratio(raw) < line(bands.lowest) - 1e-12 or len(raw) >= 128 and ratio(raw) > line(bands.highest) + 1e-12:
        return False
    if len(raw) <= 3072:
        return True
    starts = list(range(0, len(raw), 2048))
    if len(raw) - starts[-1] < 1024:
        starts.pop()
    chunks = [ratio(raw[a:b]) for a, b in zip(starts, [*starts[1:], len(raw)], strict=True)]
    return all(sum(f(c) for c in chunks) <= 0.2 * len(chunks) for f in (lambda c: c < bands.chunks[0], lambda c: c > bands.chunks[1]))


def test_compression_bands(spark):
    rng = random.Random(5)
    noise = "".join(chr(rng.randrange(33, 126)) + (" " if i % 9 == 0 else "") for i in range(6000))
    pattern = " ".join(f"row{i % 7}x{i % 11}" for i in range(900))
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    table = base.union(spark.createDataFrame([(-1, noise), (-2, pattern), (-3, None), (-4, "")], "doc_id long, text string"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fitted = quality_bands.fit(table, labels)
    assert len(fitted.lowest) > 3 and fitted == quality_bands.fit(table.repartition(5), labels)
    for bands in (fitted, quality_bands.PROSE):
        kept = {r["doc_id"]: r["kept"] for r in quality_bands.quality(table, bands).collect()}
        want = {r["doc_id"]: _verdict(r["text"], bands) for r in table.collect()}
        assert {i: k for i, k in kept.items() if k != want[i]} == {}
        assert not any(kept[i] for i in (-1, -2, -3, -4))
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    own = [r["kept"] for r in quality_bands.quality(table, fitted).where("NOT base_failed").collect() if r["doc_id"] in good]
    assert sum(own) >= 0.97 * len(own)
    assert quality_bands.fit(table.limit(0), labels) == quality_bands.PROSE


def test_prose_bands_keep_prose():
    """Zstandard ratios of public licence texts, at any cut, and their chunks."""
    paths = [p for p in map(pathlib.Path, ("/usr/share/common-licenses/GPL-3", "/usr/share/common-licenses/Apache-2.0", "/usr/share/common-licenses/LGPL-2.1")) if p.exists()]
    press = zstandard.ZstdCompressor(level=3).compress
    for raw in (p.read_bytes() for p in paths):
        for n in range(500, len(raw), 500):
            low, high = quality_bands.PROSE.limits(n)
            assert low < len(press(raw[:n])) / n < high
        low, high = quality_bands.PROSE.chunks
        assert sum(not low < r < high for r in quality_bands.chunk_ratios(raw, press)) == 0


# ---- shards --------------------------------------------------------------------------------------------------------
def test_shards(spark, docs, edges, empty):
    sizes = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = kd_shards.shard(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 8).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in out} == {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in sizes.items()}
    by = collections.defaultdict(list)
    for r in out:
        by[r["shard"]].append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert sorted(by) == list(range(8))
    total, largest = sum(r["size"] for r in out), max(r["size"] for r in out)
    for group in by.values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
        assert abs(sum(r["size"] for r in group) - total / 8) <= max(0.02 * total / 8, largest)
    got = kd_shards.shard(edges, 3).collect()
    assert len(got) == len(_edges()) and kd_shards.shard(empty, 3).count() == 0


# ---- toxicity ------------------------------------------------------------------------------------------------------
def test_gradients_of_the_network():
    words = [b"alpha", b"bad", b"ok", b"worst"]
    model = toxicity.Model.fresh({b"bad": 0, b"ok": 1}, 3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    features = model.features(words)
    view = np.array([[0, 1, 2, 3] + [4] * (toxicity.WINDOW - 4), [2, 2, 1] + [4] * (toxicity.WINDOW - 3)], np.int32)
    error = np.array([0.7, -0.4])
    inputs = model.embedded(features).astype(np.float64)
    logit, kept = model.forward(model.projected(inputs), view, keep=True)
    grads, d_inputs = model.gradient(model.projected(inputs), inputs, view, error, kept)
    loss = lambda x: float(model.forward(model.projected(x), view) @ error)
    for name, where in (("wx", (0, 1, 2)), ("u", (1, 2, 5)), ("b", (0, 0, 3)), ("wa", (3, 2)), ("ba", (1,)), ("va", (2,)), ("wo", (4,)), ("bo", (0,))):
        old = model.p[name][where]
        model.p[name][where] = old + 1e-3
        up = loss(inputs)
        model.p[name][where] = old - 1e-3
        down = loss(inputs)
        model.p[name][where] = old
        assert grads[name][where] == pytest.approx((up - down) / 2e-3, rel=2e-2, abs=2e-4), name
    moved = inputs.copy()
    moved[1, 3] += 1e-3
    assert d_inputs[1, 3] == pytest.approx((loss(moved) - loss(inputs)) / 1e-3, rel=2e-2, abs=2e-4)


def test_windows_cover_all_words():
    for n in (0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 500):
        found = toxicity.windows(np.arange(n, dtype=np.int32), n)
        assert set(found.ravel().tolist()) - {n} == set(range(n))
        if n > toxicity.WINDOW:
            assert found[0][toxicity.TRAIN_STRIDE] == found[1][0]


def test_toxicity_on_held_out_documents(spark, edges, empty):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.01")
    marked = out.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    assert out.count() == base.count()
    bad, good = ([r["score"] for r in marked if r["toxic"] == y] for y in (1, 0))
    auc = np.mean([(x > y) + 0.5 * (x == y) for x in bad for y in good])
    assert auc > 0.8
    assert sum(s >= 0.7 for s in good) <= 0.05 * len(good)
    model = toxicity.train(["you idiot clown", "fine day here", "stupid idiot", "a fine book"] * 20, [1, 0, 1, 0] * 20)
    scored = toxicity.score(edges, model).collect()
    assert len(scored) == len(_edges()) and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.keep_clean(edges, model).columns == edges.columns
    assert toxicity.score(empty, model).count() == 0 and toxicity.keep_clean(empty, model).count() == 0
    assert toxicity.scores(model, ["what an idiot", "a fine day", None, ""])[0] > 0.7
    none = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.scores(none, ["a"]).shape == (1,)


# ---- decontamination -----------------------------------------------------------------------------------------------
def test_overlaps_tolerate_substitutions(spark, edges, empty):
    rng = random.Random(6)
    words = [f"t{i}" for i in range(5000)]
    item = [rng.choice(words) for _ in range(40)]
    changed = list(item)
    for i in (5, 17, 29):
        changed[i] = "other"
    pad = lambda: [rng.choice(words) for _ in range(50)]
    table = [(1, " ".join(pad() + item + pad())), (2, " ".join(pad() + changed + pad()).upper()), (3, " ".join(pad() + item[10:30] + pad())), (4, " ".join(pad() * 3)), (5, " ".join(pad() + item[:8] + pad())), (6, None), (7, ""), (None, " ".join(item)), (8, " ".join(item)), (8, " ".join(item))]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, " ".join(pad())), (1, " ".join(item))], "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"], r["n_agree"]) for r in decontaminate.overlaps(spark.createDataFrame(table, "doc_id long, text string"), bench).collect())
    assert [g[:2] for g in got] == [(0, 1), (1, 1), (2, 1), (3, 1), (8, 1)]
    assert dict((g[0], g[2]) for g in got)[2] == 37
    assert decontaminate.overlaps(edges, bench).count() == 0
    assert decontaminate.overlaps(empty, bench).count() == 0 and decontaminate.overlaps(edges, bench.where("false")).count() == 0


# ---- pseudonyms ----------------------------------------------------------------------------------------------------
def _luhn(digits):
    return sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_permutations(spark):
    four = spark.range(10_000).select(pii.permuted_digits(F.lpad(F.col("id").cast("string"), 4, "0"), "k", F.lit("t")).alias("p"))
    assert four.distinct().count() == 10_000
    texts = spark.range(2600).select(F.concat(F.char(F.pmod("id", F.lit(26)) + 97), F.lpad(F.floor(F.col("id") / 26).cast("string"), 2, "0")).alias("v"))
    found = texts.select("v", pii.permuted_text(F.col("v"), "k").alias("p"))
    assert found.select("p").distinct().count() == 2600 and found.where("NOT p RLIKE '^[a-z][0-9]{2}$'").count() == 0
    days = spark.range(73049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("v"))
    assert days.select(pii.pseudonym(F.col("v"), F.lit("date"), "k").alias("p")).distinct().count() == 73049


def test_pseudonyms(spark, edges, empty):
    text = "a.b1@x.com 4111111111111111, 4111111111111112 and 4111-1111-1111-1111 on 1999-12-31, 2001-02-30; 12/25/2020 31.01.1999 GB82 WEST 1234 5698 7654 32 10.0.0.256 1.2.3.4. +1 (980) 555-6268 123-45-6789, 000-45-6789 end"
    out = pii.pseudonymize(spark.createDataFrame([(1, text, "z"), (2, "again 4111111111111111", "z"), (3, None, "z"), (None, "", "z")], "doc_id long, text string, found string"), "k")
    by = {r["doc_id"]: r for r in out.collect()}
    r = by[1]
    assert r["pii_kinds"] == ["email", "card", "card", "date", "date", "date", "iban", "ip", "phone", "ssn"]
    assert r["found"] == "z" and re.sub(r"[A-Za-z0-9]", "x", r["text"])[:60] == re.sub(r"[A-Za-z0-9]", "x", text)[:60]
    assert all(v not in r["text"] for v in ("4111111111111111", "1.2.3.4", "555-6268", "123-45-6789", "a.b1@"))
    assert all(v in r["text"] for v in ("4111111111111112", "2001-02-30", "10.0.0.256", "000-45-6789"))
    card, dashed = r["pii_values"][1], r["pii_values"][2]
    assert _luhn(card) and dashed.replace("-", "") == card == by[2]["pii_values"][0]
    datetime.date.fromisoformat(r["pii_values"][3])
    iban = r["pii_values"][6].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert by[3]["text"] is None and by[None]["text"] == "" and by[3]["pii_kinds"] == []
    assert pii.pseudonymize(edges, "k").count() == len(_edges()) and pii.pseudonymize(empty, "k").count() == 0
    plan = pii.pseudonymize(edges, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("ExistingRDD", "") and "ArrowEval" not in plan


# ---- registered queries and the pipeline ---------------------------------------------------------------------------
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, name):
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(twin(queries.ORACLES[name], SF))


def test_contract_columns(spark):
    want = {
        "op1_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"], "op2_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "op4_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op7_kd_tree_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    }
    for name in ("op2_byte_bpe", "op4_suffix_array_dedup"):
        out = queries.QUERIES[name](spark, SF)
        assert out.columns == want[name] and out.count() == 200
    r = queries.QUERIES["op2_byte_bpe"](spark, SF).orderBy("doc_id").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") == r["doc_id"]).first()["text"]
    assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline_stages(spark, edges, docs, tmp_path):
    for name in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    table = docs.union(edges.withColumn("doc_id", F.col("doc_id") + 10_000).select(docs.columns))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, str(tmp_path))
        assert out.columns == table.columns, name
        got, had = out.select("doc_id", "text").collect(), table.select("doc_id", "text").collect()
        assert len(got) <= len(had)
        if name != "line_dedup":
            assert not collections.Counter(map(tuple, got)) - collections.Counter(map(tuple, had))
        if name == "near_dedup":
            want = _components({r["doc_id"]: r["text"] for r in had if r["doc_id"] is not None}, 5)
            assert sum(r["doc_id"] is None for r in got) == sum(r["doc_id"] is None for r in had)
            blank = [r["doc_id"] for r in had if r["doc_id"] is not None and not WORD.search(r["text"] or "")]  # each such row stays
            assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(blank + [i for i, (n, _, kept) in want.items() if kept and n])
        table = out
    final = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).collect()
    assert collections.Counter(r["decoded_sha256"] for r in final) == collections.Counter(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in table.collect())
