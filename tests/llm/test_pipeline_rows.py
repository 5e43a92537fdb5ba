"""Stages decide by row: null and repeated ids, equal rows, empty tables and columns with clashing names."""

import collections
import random

import pytest

import corpus_pipeline
from corpusmill.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, part string, k string, row long, group_id long"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "own", "p", "k", 7, 8) for i, t, s in rows], SCHEMA).repartition(3)


def _text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, _text(100, 30)), (2, "what is the capital of atlantis ? poseidonis"), (3, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_contaminated_rows_go_whatever_their_id(spark, folder):
    item, short = _text(100, 30), "what is the capital of atlantis ? poseidonis"
    rows = [(None, f"{_text(1)} {item}", "s"), (None, _text(2), "s"), (5, f"{item} {_text(3)}", "s"), (5, _text(4), "s"), (6, f"{_text(5)} {short} {_text(6)}", "s"), (7, None, "s"), (8, "", "s"), (9, _text(7), "s"), (9, _text(7), "s")]
    out = corpus_pipeline.decontamination(spark, _table(spark, rows), folder)
    want = [(None, rows[1][1]), (5, rows[3][1]), (7, None), (8, ""), (9, rows[7][1]), (9, rows[8][1])]
    assert collections.Counter((r["doc_id"], r["text"]) for r in out.collect()) == collections.Counter(want)
    assert {tuple(r)[5:] for r in out.collect()} == {("own", "p", "k", 7, 8)}


def test_one_row_of_each_group_stays(spark, folder):
    a, b, c = _text(11), _text(12), _text(13)
    near = a.replace(a.split()[-1], "changed")
    rows = [(5, a, "s"), (5, a, "s"), (5, b, "s"), (6, near, "s"), (7, b.upper(), "s"), (8, c, "s"), (8, c.replace(c.split()[0], "x"), "s"), (9, None, "s"), (9, " ", "s"), (9, " ", "s"), (None, a, "s"), (None, a, "s")]
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, _table(spark, rows), folder).collect()]
    got = collections.Counter(out)
    assert got[5, a] == 1 and got[5, b] == 1 and (6, near) not in got and (7, b.upper()) not in got
    assert sum(n for (i, _), n in got.items() if i == 8) == 1
    assert got[9, None] == 1 and got[9, " "] == 2 and got[None, a] == 2 and len(out) == 8


def test_lines_of_blanks_stay_and_columns_pass(spark, folder):
    rows = [(i, f"head\r\n\r\n\t\nown {i}", "a") for i in range(100)] + [(200, "lone", "b"), (201, None, None), (None, "", "b"), (202, "twice", "c"), (203, "twice", "c")]
    out = {r["doc_id"]: r for r in corpus_pipeline.line_dedup_stage(spark, _table(spark, rows), folder).collect()}
    assert out[3]["text"] == "\r\n\t\nown 3" and out[3]["n_chars"] == len(out[3]["text"])
    assert out[200]["text"] == "lone" and out[201]["text"] is None and out[None]["text"] == "" and out[202]["text"] == ""
    assert {r["n_lines"] for r in out.values()} == {"own"}


def test_lines_against_plain_counts(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", " ", "\t\r", "", f"own {i}", f"of {i % 7}"]) for _ in range(rng.randrange(12))), rng.choice(["x", "x", "x", "y", "z", None])) for i in range(300)]
    pages = collections.Counter(s for *_, s in rows)
    seen = collections.Counter((s, line) for _, t, s in rows for line in set(t.split("\n")))
    bad = lambda s, line: line.strip(" \t\r\x0b\x0c") and seen[s, line] >= 2 and seen[s, line] > pages[s] * 0.1
    out = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(_table(spark, rows).drop("n_lines"), ratio=0.1).collect()}
    for i, t, s in rows:
        kept = [line for line in t.split("\n") if not bad(s, line)]
        assert (out[i]["text"], out[i]["n_dropped"]) == ("\n".join(kept), len(t.split("\n")) - len(kept))


def test_stages_of_empty_tables(spark, folder):
    empty = _table(spark, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, folder)
        assert out.columns == empty.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, folder).count() == 0
