"""Long lists of domains: they stay tables, and few rows meet them."""

import re

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import UrlFilter, filters
from corpusmill.operators.base import DETAILS
from corpusmill.sources import blocklist
from corpusmill.sources.blocklist import bloom, may_hold, words_for


def _urls(spark):
    hosts = [f"www.site-{i}.example" for i in range(300)] + ["a.blocked-7.example", "blocked-8.example", "notblocked-8.example", "BLOCKED-9.example", "x.y.blocked-10.example", "example", "u@blocked-3.example:80"]
    return spark.createDataFrame([(i, f"https://{h}/page") for i, h in enumerate(hosts)] + [(1000, None), (1001, ""), (1002, "https://blocked-8.example/porn"), (1003, "https://ok.example/porn")], "id long, url string")


@pytest.mark.parametrize("few", [4096, 0])
def test_files_of_many_domains(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(filters, "LITERAL_DOMAINS", 50)
    monkeypatch.setattr(filters, "FEW", few)  # 0: a subquery instead of a literal
    monkeypatch.setattr(blocklist, "FEW", few)
    (tmp_path / "list.txt").write_text("# list\n\n" + "\n".join(f" Blocked-{i}.example" for i in range(100)) + "\n" + "blocked-8.example\n")
    gone = {300, 301, 303, 304, 1002, 1003}
    op = UrlFilter(blocklist_paths=str(tmp_path / "list.txt"), blocklist_domains=["other.test"])
    assert op.files is not None and op.blocked == {"other.test"}
    df = _urls(spark).repartition(3)
    assert {r["id"] for r in df.collect()} - {r["id"] for r in op.transform(df).collect()} == gone
    marked = op.annotate(df).collect()
    assert {r["id"] for r in marked if r[DETAILS]} == gone and len(marked) == df.count() and marked[0].__fields__ == ["id", "url", DETAILS]
    exact = UrlFilter(blocklist_paths=[str(tmp_path / "list.txt")], check_subdomains=False, normalize_host=True)
    assert {r["id"] for r in df.collect()} - {r["id"] for r in exact.transform(df).collect()} == {301, 303, 306, 1002, 1003}
    short = UrlFilter(blocklist_domains=["blocked-8.example"], score_threshold=2.0)
    assert short._short and df.count() - short.transform(df).count() == 2


def test_a_filter_of_five_million_domains(spark):
    domains = spark.range(5_000_000).select(F.concat(F.lit("d"), "id", F.lit(".example")).alias("suffix"))
    probe = spark.range(100_000).select((F.col("id") * 97).alias("id"), F.concat(F.lit("d"), F.col("id") * 97, F.lit(".example")).alias("suffix"))
    found = probe.select("id", may_hold(bloom(domains, words_for(5_000_000)), words_for(5_000_000), F.col("suffix")).alias("hit"))
    r = found.agg(F.count_if((F.col("id") < 5_000_000) & ~F.col("hit")).alias("missed"), F.count_if((F.col("id") >= 5_000_000) & F.col("hit")).alias("wrong")).first()
    assert r["missed"] == 0 and r["wrong"] < 0.01 * 48_454


def test_rows_that_no_domain_may_hold_are_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filters, "LITERAL_DOMAINS", 50)
    (tmp_path / "list.txt").write_text("\n".join(f"blocked-{i}.example" for i in range(100)))
    plan = UrlFilter(blocklist_paths=str(tmp_path / "list.txt")).transform(_urls(spark))._jdf.queryExecution().optimizedPlan().toString()
    free = plan.split("Join LeftAnti")[0]
    assert plan.startswith("Union") and "Aggregate" not in re.split(r"\n", free)[1]
