"""Site-relative line frequency: lines that stand on too many pages of one host are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.storage import materialize


#: Characters of which a line that consists of them alone is blank.
BLANKS = " \\t\\r\\x0B\\x0C"


def _key(line: Column) -> Column:
    """128 bits of a line, so that no text is shuffled to count it."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = 0.02, least: int = 2, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """docs (doc_id, text, host and any more columns) with its text cut, and the columns of counts: n_lines, n_dropped.

    A line (between line feeds, compared exactly) goes from the pages of a host if it is on at least `least` of them
    (two: one page is no repetition) and on more than ratio of all the host's pages; a page counts once for a line.
    Lines of white space alone (BLANKS) stay. Lines are counted by host and line after a map-side sum, so a host that
    holds most pages is spread over all tasks.

    Null text: null, no lines. Null host: a host of its own. Null and repeated doc_ids: rows with equal doc_id, host
    and text are counted as pages each and cut alike. Other columns pass through, whatever their names, but for
    those that counts names, which are replaced. An empty table gives an empty result.
    """
    docs = docs.drop(*counts)
    site = F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))
    base = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), F.xxhash64("text", site).alias("part"), site.alias("site"), "text")
    lines = base.select("k", "part", "site", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")).where(F.col("line").rlike(f"[^{BLANKS}]"))
    lines = lines.select("k", "part", "site", _key(F.col("line")).alias("key"))
    often = lines.groupBy("site", "key").count().where(F.col("count") >= least)
    pages = base.groupBy("site").agg(F.count("*").alias("pages"))
    common = materialize(often.join(pages, "site").where(F.col("count") > F.col("pages") * ratio).select("site", "key"), "boilerplate")
    found = lines.join(common, ["site", "key"]).groupBy("k", "part").agg(F.collect_set("key").alias("bad"))
    cut = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("bad", _key(x))), "\n")
    joined = base.join(found, ["k", "part"], "left").withColumn("cut", F.when(F.col("bad").isNull(), F.col("text")).otherwise(cut))
    count = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    left = F.when(F.col("bad").isNull(), F.lit(0).cast("long")).otherwise(F.size(F.filter(F.split("text", "\n"), lambda x: F.array_contains("bad", _key(x)))).cast("long"))
    columns = [(F.col("cut") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns]
    return joined.select(*columns, F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(count).alias(counts[0]), left.alias(counts[1]))


ORACLE = r"""
WITH base AS (SELECT doc_id, source, text, row_number() OVER () AS r FROM documents),
lines AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM base),
counts AS (SELECT source, line, count(DISTINCT r) AS n FROM lines WHERE regexp_matches(line, '[^ \t\r\x0B\x0C]') GROUP BY ALL HAVING count(DISTINCT r) >= 2),
bad AS (SELECT c.source, c.line FROM counts c JOIN (SELECT source, count(*) AS pages FROM documents GROUP BY source) p ON c.source = p.source WHERE c.n > p.pages * CAST(0.02 AS DOUBLE)),
kept AS (SELECT l.r, count(*) AS n_lines, count(b.line) AS n_dropped, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE b.line IS NULL) AS text FROM lines l LEFT JOIN bad b ON l.source = b.source AND l.line = b.line GROUP BY l.r)
SELECT d.doc_id, k.n_lines, k.n_dropped, coalesce(k.text, '') AS text FROM base d JOIN kept k ON d.r = k.r
"""
