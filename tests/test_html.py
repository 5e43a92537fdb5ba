"""Text of pages by scores of blocks."""

import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import html
from corpusmill.operators.html import HtmlTextRefiner


@pytest.fixture
def read(spark):
    def run(*pages):
        df = spark.createDataFrame([(i, p, "T") for i, p in enumerate(pages)], "page_id long, html string, title string")
        out = HtmlTextRefiner().transform(df).orderBy("page_id").collect()
        table = pd.DataFrame({"page_id": range(len(pages)), "html": pages})
        con = duckdb.connect()
        con.register("pages", table)
        twin = con.execute(f"SELECT page_id, title, text, text_length FROM ({html.oracle()}) ORDER BY page_id").fetchall()
        assert [(r["page_id"], r["title"], r["text"], r["text_length"]) for r in out] == twin
        return [(r["title"], r["text"], r["text_length"]) for r in out]

    return run


PROSE = "The quick fox, whose name nobody knew, ran over the hill and was not seen again until the evening came."


def test_elements(read):
    page = "<html><head><title> A  b </title><style>x</style></head><body><script>no</script><p>" + "word " * 12 + "</p><div>é &amp; end</div></body></html>"
    body = "".join(f"<p>sentence number {i} of the page</p>" for i in range(20))
    got = read(
        page, *(f"<{tag}><a>menu</a>{body}" for tag in ("nav", "form", "aside", "head")), *(f"<{tag}><a>menu</a></{tag}>{body}" for tag in ("nav", "form", "aside", "head")),
        f"<html><head><title>t</title>x<body>{body}", f"{body}<script>var a = 1", "<p>short</p>", None, "", "no tags " * 10, f"<!-- <p>{PROSE}</p> --><p>a < b and c > d, {PROSE}</p>",
    )
    title, text, size = got[0]
    assert title == "A b" and text.endswith("é & end") and "no" not in text.split() and size == len(text.encode())
    lines = "\n".join(f"sentence number {i} of the page" for i in range(20))
    assert all(g[1] == lines for g in got[1:11]) and got[9][0] == "t"
    assert got[11:14] == [(None, None, None)] * 3
    assert got[14][1] == ("no tags " * 10).strip() and got[15][1] == f"a < b and c > d, {PROSE}"


def test_boilerplate_goes(read):
    menu = "<ul>" + "".join(f'<li><a href="/{i}">Menu entry number {i} of this site</a></li>' for i in range(10)) + "</ul>"
    ad = '<div class="box ad wide">Buy now, the best offer of the whole year is here, only today, only with us, hurry up now.</div>'
    plain_ad = "<div>Buy one of these today.</div>"
    article = f"<article><h1>Short title</h1><p>{PROSE}</p><p>Yes.</p><p>{PROSE}</p><ul><li>One of the things that were seen there</li><li>Another of the things that were seen</li></ul><p>{PROSE}</p></article>"
    links = "<div>" + " | ".join(f'<a href="/{i}">Related story number {i}, with a long name</a>' for i in range(6)) + "</div>"
    comments = f'<section id="comments"><p>{PROSE}</p></section>'
    got = read(f"<body>{menu}{ad}{plain_ad}{article}{links}{comments}<footer>{PROSE}</footer></body>")[0][1]
    assert got == "\n".join(["Short title", PROSE, "Yes.", PROSE, "One of the things that were seen there", "Another of the things that were seen", PROSE])
    # a class that only holds such a word within another one is no sign
    assert read(f'<div class="shadow-head loading"><p>{PROSE}</p><p>{PROSE}</p></div>')[0][1] == f"{PROSE}\n{PROSE}"


def test_character_references(read):
    got = read(f"<p>{PROSE} &lt;b&gt; &amp;lt; &eacute;&nbsp;x &#233;&#xE9; &#x1F600; &apos;&quot; &nosuch; AT&T &#0; &#xD800; &#99999999; a&b;</p><p>{PROSE}</p>")[0][1]
    assert got.split("\n")[0] == f"{PROSE} <b> &lt; é x éé 😀 '\" &nosuch; AT&T &#0; &#xD800; &#99999999; a&b;"


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = HtmlTextRefiner().transform(pages)
    assert not re.search("Python|Arrow", out._jdf.queryExecution().executedPlan().toString())
    ads = pages.select("page_id", F.regexp_extract("html", '<div class="ad">([^<]*)</div>', 1).alias("ad"), F.regexp_extract("html", "<article>(.*)</article>", 1).alias("article"))
    both = out.join(ads, "page_id").where("text IS NOT NULL")
    assert both.count() > 0 and both.where("ad != '' AND contains(text, ad) AND NOT contains(article, ad)").count() == 0
