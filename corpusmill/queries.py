"""The queries that are registered for the driver, and their SQL twins for DuckDB."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import records, text, url, vector
from corpusmill.image.drawn import backend
from corpusmill.image.drawn import drawings as _drawings
from corpusmill.metrics import rollups
from corpusmill.metrics.report import duplicate_groups, preview, samples
from corpusmill.ml import evaluation, head, kmeans
from corpusmill.ml.linear import collapse
from corpusmill.operators import Combined, ImagePhashDeduplicator, ImageQualityFilter, SemanticDeduplicator, TextExactDeduplicator, TextLengthFilter, UrlFilter
from corpusmill.operators.base import DETAILS
from corpusmill.operators import html
from corpusmill.operators.html import HtmlTextRefiner, coarse_text
from corpusmill.operators.images import ImageAestheticQualityRefiner, ImageAIGCDetectorRefiner, ImageClipEmbeddingRefiner, ImageMetadataRefiner, ImageSigLIPEmbeddingRefiner, ImageTechnicalQualityRefiner, ImageVisualDegradationsRefiner
from corpusmill.streaming import dedup as stream_dedup

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- text lengths -------------------------------------------------------------------------------------------------
_DOC = "doc_id, lang, source, n_chars"


@query(f"SELECT {_DOC} FROM documents WHERE length(text) BETWEEN 100 AND 10000")
def text_length_filter(spark, sf_dir):
    return TextLengthFilter(100, 10000).transform(_table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


@query(f"SELECT {_DOC} FROM documents WHERE length(text) >= 1000")
def text_length_min_only(spark, sf_dir):
    return TextLengthFilter(1000).transform(_table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


@query(f"SELECT {_DOC} FROM documents WHERE n_chars BETWEEN 200 AND 5000")
def text_length_precomputed(spark, sf_dir):
    return TextLengthFilter(200, 5000, text_length_field="n_chars").transform(_table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


@query("SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes FROM documents WHERE octet_length(encode(text)) >= 2000")
def text_length_bytes(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("text", F.col("text").cast("binary"))
    return TextLengthFilter(2000).transform(docs).select("doc_id", F.length("text").cast("long").alias("n_bytes"))


# ---- exact deduplication -------------------------------------------------------------------------------------------
_WS = text.WHITE_SPACE
_NORMAL = f"lower(trim(regexp_replace(text, '{_WS}', ' ', 'g')))"


def _first(key: str, columns: str = "doc_id, lang, source, n_chars") -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"


@query(f"SELECT doc_id, {_NORMAL} AS normal FROM documents")
def text_normalize(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.normalize(F.col("text")).alias("normal"))


@query(f"SELECT doc_id, md5({_NORMAL}) AS key FROM documents")
def text_hash_md5(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.content_key(F.col("text"), F.col("doc_id")).alias("key"))


@query(f"SELECT doc_id, sha256({_NORMAL}) AS key FROM documents")
def text_hash_sha256(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.content_key(F.col("text"), F.col("doc_id"), algorithm="sha256").alias("key"))


def _dedup(spark, sf_dir, **options):
    return TextExactDeduplicator(**options).transform(_table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


@query(_first(f"md5({_NORMAL})"))
def text_exact_dedup(spark, sf_dir):
    return _dedup(spark, sf_dir)


@query(_first(f"trim(regexp_replace(text, '{_WS}', ' ', 'g'))"))
def text_exact_dedup_no_lowercase(spark, sf_dir):
    return _dedup(spark, sf_dir, lowercase=False)


@query(_first("text"))
def text_exact_dedup_raw(spark, sf_dir):
    return _dedup(spark, sf_dir, lowercase=False, normalize_whitespace=False)


@query(_first(f"source || '|' || {_NORMAL}"))
def text_exact_dedup_with_url(spark, sf_dir):
    return _dedup(spark, sf_dir, include_url=True, url_field="source")


@query(_first(f"{_NORMAL}"))
def text_exact_dedup_xxhash(spark, sf_dir):
    return _dedup(spark, sf_dir, hash_algorithm="xxhash")


@query(f"""WITH r AS (SELECT doc_id, md5({_NORMAL}) AS dedup_key, row_number() OVER w AS rn, first_value(doc_id) OVER w AS rep FROM documents WINDOW w AS (PARTITION BY md5({_NORMAL}) ORDER BY doc_id))
SELECT doc_id, 'duplicate' AS reason, 'TextExactDeduplicator' AS operator, dedup_key, CAST(rep AS VARCHAR) AS representative_id FROM r WHERE rn > 1""")
def dedup_rejected_with_representative(spark, sf_dir):
    op = TextExactDeduplicator(representative_id_field="doc_id")
    return op.annotate(_table(spark, sf_dir, "documents")).where(F.col(DETAILS).isNotNull()).select("doc_id", f"{DETAILS}.*")


@query(f"SELECT md5({_NORMAL}) AS key, count(*) AS members, min(doc_id) AS representative FROM documents GROUP BY 1 ORDER BY members DESC, representative LIMIT 20")
def dedup_groups_topn(spark, sf_dir):
    keyed = _table(spark, sf_dir, "documents").select("doc_id", text.content_key(F.col("text"), F.col("doc_id")).alias("key"))
    groups = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min("doc_id").alias("representative"))
    return groups.orderBy(F.desc("members"), "representative").limit(20)


_BLANKED = "(SELECT CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN '' ELSE text END AS text, doc_id, doc_id // 100 AS grp FROM documents)"


@query(f"SELECT doc_id, grp FROM (SELECT doc_id, grp, row_number() OVER (PARTITION BY CASE WHEN coalesce(length(text), 0) > 0 THEN md5({_NORMAL}) ELSE CAST(grp AS VARCHAR) END ORDER BY doc_id) AS rn FROM {_BLANKED}) WHERE rn = 1")
def dedup_null_text_fallback_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    blank = F.when(F.col("doc_id") % 10 == 0, F.lit(None)).when(F.col("doc_id") % 10 == 1, F.lit("")).otherwise(F.col("text"))
    docs = docs.select(blank.alias("text"), "doc_id", F.floor(F.col("doc_id") / 100).alias("grp"))
    return TextExactDeduplicator(id_field="grp", order_by="doc_id").transform(docs).select("doc_id", "grp")


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY " + _NORMAL + " ORDER BY conv_id * 1000 + turn) AS rn FROM conversations) WHERE rn = 1")
def conversation_exact_dedup(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return TextExactDeduplicator().transform(turns).select("conv_id", "turn", "role")


# ---- URLs ----------------------------------------------------------------------------------------------------------
_DOMAIN = "lower(regexp_extract(CASE WHEN starts_with(url, 'http://') OR starts_with(url, 'https://') THEN url ELSE 'http://' || url END, '^[^:]+://([^/?#]*)', 1))"
_ALTERNATION = "(" + "|".join(sorted(url.WORD_WEIGHTS, key=lambda w: (-len(w), w))) + ")"
_WEIGHT = "CASE x " + " ".join(f"WHEN '{w}' THEN CAST({v} AS DOUBLE)" for w, v in url.WORD_WEIGHTS.items()) + " END"
_FOUND = f"list_transform(regexp_extract_all(lower(url), '{_ALTERNATION}', 1), lambda x: {_WEIGHT})"
_SCORE = f"CASE WHEN len({_FOUND}) > 0 THEN least(CAST(1 AS DOUBLE), list_max({_FOUND}) * CAST(0.8 AS DOUBLE) + least(list_sum({_FOUND}) / CAST(3 AS DOUBLE), CAST(0.2 AS DOUBLE))) ELSE CAST(0 AS DOUBLE) END"


def _under(domains) -> str:
    return "(" + " OR ".join(f"{_DOMAIN} = '{d}' OR ends_with({_DOMAIN}, '.{d}')" for d in domains) + ")"


@query(f"SELECT page_id, {_DOMAIN} AS domain FROM pages")
def url_domain(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", url.domain(F.col("url")).alias("domain"))


@query(f"WITH p AS (SELECT page_id, string_split({_DOMAIN}, '.') AS parts FROM pages), s AS (SELECT page_id, parts, unnest(generate_series(1, len(parts))) AS i FROM p) SELECT page_id, array_to_string(parts[i:], '.') AS suffix FROM s")
def url_domain_suffixes(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", F.explode(url.suffixes(url.domain(F.col("url")))).alias("suffix"))


@query(f"SELECT page_id, round({_SCORE}, 9) AS score FROM pages")
def url_score(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", F.round(url.word_score(F.col("url"), url.WORD_WEIGHTS), 9).alias("score"))


@query(f"SELECT page_id, w.unnest AS word FROM pages, unnest(regexp_extract_all(lower(url), '{_ALTERNATION}', 1)) AS w")
def url_word_matches(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", F.explode(url.word_matches(F.col("url"), url.WORD_WEIGHTS)).alias("word"))


def _urls(spark, sf_dir, **options):
    return UrlFilter(**options).transform(_table(spark, sf_dir, "pages")).select("page_id", "url")


@query(f"SELECT page_id, url FROM pages WHERE NOT ({_SCORE} >= 0.5)")
def url_filter_default(spark, sf_dir):
    return _urls(spark, sf_dir)


@query(f"SELECT page_id, url FROM pages WHERE NOT ({_under(['example.org'])} OR {_SCORE} >= 0.5)")
def url_filter_blocklist(spark, sf_dir):
    return _urls(spark, sf_dir, blocklist_domains=["Example.org "])


@query(f"SELECT page_id, url FROM pages WHERE NOT ({_SCORE} >= 0.5 OR {_under(['example.net'])})")
def url_filter_quality_sources(spark, sf_dir):
    return _urls(spark, sf_dir, exclude_quality_sources=True, quality_source_domains=["example.net"])


@query(f"SELECT page_id, url FROM pages WHERE NOT ({_SCORE} >= 0.7)")
def url_filter_threshold(spark, sf_dir):
    return _urls(spark, sf_dir, score_threshold=0.7)


_CUSTOM = "list_transform(regexp_extract_all(lower(url), '(item|post|en)', 1), lambda x: CASE x WHEN 'item' THEN CAST(0.9 AS DOUBLE) WHEN 'post' THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.4 AS DOUBLE) END)"


@query(f"SELECT page_id, url FROM pages WHERE NOT (len({_CUSTOM}) > 0 AND least(CAST(1 AS DOUBLE), list_max({_CUSTOM}) * CAST(0.8 AS DOUBLE) + least(list_sum({_CUSTOM}) / CAST(3 AS DOUBLE), CAST(0.2 AS DOUBLE))) >= 0.5)")
def url_filter_custom_words(spark, sf_dir):
    return _urls(spark, sf_dir, word_weights={"item": 0.9, "Post": 0.6, "en": 0.4}, use_default_words=False)


_MANY = [f"blocked-{i}.example" for i in range(3000)]


@query(f"SELECT page_id, url FROM pages WHERE NOT ({_under(['example.org', 'com'])} OR {_SCORE} >= 0.5)")
def url_blocklist_antijoin(spark, sf_dir):
    return _urls(spark, sf_dir, blocklist_domains=[*_MANY, "example.org", "com"])


@query("SELECT page_id, url FROM pages WHERE NOT (false)")
def url_filter_disabled_rules(spark, sf_dir):
    return _urls(spark, sf_dir, use_default_words=False)


# ---- HTML ----------------------------------------------------------------------------------------------------------
@query(f"SELECT page_id, title, text, coalesce(text_length, 0) AS text_length FROM ({html.oracle()})")
def html_extract(spark, sf_dir):
    out = HtmlTextRefiner().transform(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "title", "text", F.coalesce("text_length", F.lit(0)).cast("long").alias("text_length"))


_PLAIN = "regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<noscript\\b.*?</noscript>|<head\\b.*?</head>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"


@query(f"SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace({_PLAIN}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '[\\x{{9}}-\\x{{d}}\\x{{20}}]+', ' ', 'g')) AS text FROM pages")
def html_coarse_text(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", coarse_text(F.col("html")).alias("text"))


# ---- pipelines and rejected rows -----------------------------------------------------------------------------------
def _crawl(spark, sf_dir) -> DataFrame:
    """Pages as a crawl loader gives them, with the raw page as text."""
    return _table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("text"))


_CRAWL = f"SELECT page_id, url, html AS text, {_SCORE} AS score FROM pages"
_CRAWL_KEY = "md5(lower(trim(regexp_replace(text, '" + _WS + "', ' ', 'g'))))"


@query(f"SELECT page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY {_CRAWL_KEY} ORDER BY page_id) AS rn FROM ({_CRAWL}) WHERE score < 0.5 AND length(text) BETWEEN 100 AND 100000) WHERE rn = 1")
def pipeline_commoncrawl(spark, sf_dir):
    return Combined([UrlFilter(), TextLengthFilter(100, 100000), TextExactDeduplicator()]).transform(_crawl(spark, sf_dir)).select("page_id", "url")


def _rejected(spark, sf_dir) -> DataFrame:
    ops = Combined([TextLengthFilter(100, 100000, text_length_field=""), TextExactDeduplicator(representative_id_field="doc_id")])
    return ops.annotate(_table(spark, sf_dir, "documents"))


_REJECTED = f"""(WITH live AS (SELECT doc_id, text, {_NORMAL} AS k, length(text) BETWEEN 100 AND 100000 AS ok FROM documents),
ranked AS (SELECT doc_id, md5(k) AS dedup_key, row_number() OVER w AS rn, first_value(doc_id) OVER w AS rep FROM live WHERE ok WINDOW w AS (PARTITION BY md5(k) ORDER BY doc_id))
SELECT doc_id, 'filtered' AS reason, 'TextLengthFilter' AS operator, NULL AS dedup_key, NULL AS representative_id FROM live WHERE NOT ok
UNION ALL SELECT doc_id, 'duplicate', 'TextExactDeduplicator', dedup_key, CAST(rep AS VARCHAR) FROM ranked WHERE rn > 1)"""


@query(f"SELECT * FROM {_REJECTED}")
def pipeline_rejected(spark, sf_dir):
    return _rejected(spark, sf_dir).where(F.col(DETAILS).isNotNull()).select("doc_id", f"{DETAILS}.*")


@query(f"SELECT coalesce(operator, 'passed') AS operator, count(*) AS records FROM documents d LEFT JOIN {_REJECTED} r ON d.doc_id = r.doc_id GROUP BY 1")
def pipeline_funnel(spark, sf_dir):
    return _rejected(spark, sf_dir).groupBy(F.coalesce(f"{DETAILS}.operator", F.lit("passed")).alias("operator")).agg(F.count("*").alias("records"))


@query(f"SELECT operator, least(count(*), 20) AS samples FROM {_REJECTED} GROUP BY operator")
def samples_per_operator(spark, sf_dir):
    rejected = _rejected(spark, sf_dir).where(F.col(DETAILS).isNotNull())
    return samples(rejected.select("doc_id", DETAILS), 20).groupBy("operator").agg(F.count("*").alias("samples"))


@query(f"SELECT d.doc_id, '{{\"doc_id\":' || d.doc_id || ',\"lang\":\"' || d.lang || '\",\"long\":\"' || repeat(d.lang, 250) || '...\",\"hash\":\"<binary: 16 bytes>\"}}' AS record FROM documents d JOIN {_REJECTED} r ON d.doc_id = r.doc_id WHERE length(d.lang) = 2")
def rejected_json_preview(spark, sf_dir):
    rows = _rejected(spark, sf_dir).where(F.col(DETAILS).isNotNull() & (F.length("lang") == 2))
    rows = rows.select("doc_id", "lang", F.repeat("lang", F.lit(300)).alias("long"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("hash"), DETAILS)
    return rows.select("doc_id", preview(rows).alias("record"))


@query(f"""WITH r AS (SELECT * FROM {_REJECTED} WHERE length(dedup_key) > 0), s AS (SELECT operator, dedup_key, count(*) AS duplicates, min(representative_id) AS representative_id FROM r GROUP BY 1, 2),
t AS (SELECT operator, CAST(sum(duplicates) AS BIGINT) AS total_duplicates, count(*) AS total_groups FROM s GROUP BY 1), n AS (SELECT *, row_number() OVER (PARTITION BY operator ORDER BY duplicates DESC, dedup_key) AS place FROM s)
SELECT operator, dedup_key, duplicates, representative_id, total_duplicates, total_groups, CAST(least(duplicates, 5) AS INTEGER) AS shown FROM n JOIN t USING (operator) WHERE place <= 10""")
def duplicate_groups_report(spark, sf_dir):
    found = duplicate_groups(_rejected(spark, sf_dir).where(F.col(DETAILS).isNotNull()).select("doc_id", "lang", DETAILS))
    return found.select("operator", "dedup_key", "duplicates", "representative_id", "total_duplicates", "total_groups", F.size("samples").alias("shown"))


@query(r"SELECT event_id, regexp_replace(coalesce(nullif(json_extract_string(props, '$.ref'), ''), 'unknown'), '[^\p{L}\p{N}_-]', '_', 'g') AS key FROM events")
def rejected_partition_key(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", records.partition_key(events, "props.ref").alias("key"))


@query(r"SELECT doc_id, regexp_replace(lang || '/' || source || ' x', '[^\p{L}\p{N}_-]', '_', 'g') AS key FROM documents")
def partition_key_sanitised(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", records.safe_key(F.concat("lang", F.lit("/"), "source", F.lit(" x"))).alias("key"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def limit_max_samples(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy("doc_id").limit(100)


# ---- metrics -------------------------------------------------------------------------------------------------------
def _facts(spark, sf_dir) -> DataFrame:
    """events as operator metrics: an operator for each type, three stages, four workers."""
    e, v, i = _table(spark, sf_dir, "events"), F.col("value").cast("double"), F.col("event_id")
    out = F.pmod(i * 7, F.lit(100))
    return e.select(F.lit("run_0").alias("run_id"), F.concat(F.lit("stage_"), F.pmod("user_id", F.lit(3)).cast("string")).alias("stage_name"), F.col("event_type").alias("operator_name"), F.concat(F.lit("worker_"), F.pmod("user_id", F.lit(4)).cast("string")).alias("worker_id"), F.col("ts").alias("timestamp"), F.lit(100).cast("long").alias("input_records"), out.cast("long").alias("output_records"), out.cast("double").alias("pass_rate"), (v + 1.0).alias("total_time"), *((v * k).alias(f"{n}_latency") for n, k in (("avg", 1.0), ("min", 0.5), ("max", 2.0), ("p50", 1.0), ("p95", 1.5), ("p99", 1.75))), (F.lit(100.0) / (v + 1.0)).alias("throughput"), F.pmod(i, F.lit(2)).cast("long").alias("error_count"))


_FACTS = """facts AS (SELECT 'stage_' || (user_id % 3) AS stage_name, event_type AS operator_name, 'worker_' || (user_id % 4) AS worker_id, ts AS timestamp, CAST(100 AS BIGINT) AS input_records, CAST((event_id * 7) % 100 AS BIGINT) AS output_records,
CAST((event_id * 7) % 100 AS DOUBLE) AS pass_rate, value + CAST(1 AS DOUBLE) AS total_time, value AS avg_latency, value * CAST(0.5 AS DOUBLE) AS min_latency, value * CAST(2 AS DOUBLE) AS max_latency, value AS p50_latency, value * CAST(1.5 AS DOUBLE) AS p95_latency, value * CAST(1.75 AS DOUBLE) AS p99_latency,
CAST(100 AS DOUBLE) / (value + CAST(1 AS DOUBLE)) AS throughput, CAST(event_id % 2 AS BIGINT) AS error_count, event_id FROM events)"""


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*(F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query(f"""WITH {_FACTS} SELECT stage_name, operator_name, count(*) AS num_workers, CAST(sum(input_records) AS BIGINT) AS input_records, CAST(sum(output_records) AS BIGINT) AS output_records, round(avg(pass_rate), 6) AS pass_rate, round(max(total_time), 6) AS total_time, round(avg(avg_latency), 6) AS avg_latency,
round(avg(throughput), 6) AS avg_throughput, round(min(throughput), 6) AS min_throughput, round(max(throughput), 6) AS max_throughput, CAST(sum(error_count) AS BIGINT) AS error_count, min(timestamp) AS first_seen, round(sum(input_records) / max(total_time), 6) AS overall_throughput FROM facts GROUP BY 1, 2""")
def metrics_operator_rollup(spark, sf_dir):
    return _rounded(rollups.operator_rollup(_facts(spark, sf_dir)))


_STAGES = f"""{_FACTS}, parts AS (SELECT stage_name, operator_name, sum(input_records) AS i, sum(output_records) AS o, min(timestamp) AS t FROM facts GROUP BY 1, 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY stage_name ORDER BY t, operator_name) AS a, row_number() OVER (PARTITION BY stage_name ORDER BY t DESC, operator_name DESC) AS z FROM parts),
flow AS (SELECT stage_name, max(CASE WHEN a = 1 THEN i END) AS input_records, max(CASE WHEN z = 1 THEN o END) AS output_records FROM placed GROUP BY 1),
rest AS (SELECT stage_name, count(DISTINCT worker_id) AS num_workers, max(total_time) AS total_time, avg(throughput) AS avg_throughput, min(throughput) AS min_throughput, max(throughput) AS max_throughput, sum(error_count) AS error_count, min(timestamp) AS timestamp FROM facts GROUP BY 1),
stages AS (SELECT f.stage_name, CAST(f.input_records AS BIGINT) AS input_records, CAST(f.output_records AS BIGINT) AS output_records, r.num_workers, r.total_time, r.avg_throughput, r.min_throughput, r.max_throughput, CAST(r.error_count AS BIGINT) AS error_count, r.timestamp, f.output_records * CAST(100 AS DOUBLE) / f.input_records AS pass_rate FROM flow f JOIN rest r ON f.stage_name = r.stage_name)"""


def _stages(spark, sf_dir) -> DataFrame:
    return rollups.stage_rollup(_facts(spark, sf_dir))


@query(f"WITH {_STAGES} SELECT stage_name, input_records, output_records, num_workers, round(total_time, 6) AS total_time, round(avg_throughput, 6) AS avg_throughput, round(min_throughput, 6) AS min_throughput, round(max_throughput, 6) AS max_throughput, error_count, timestamp, round(pass_rate, 6) AS pass_rate FROM stages")
def metrics_stage_rollup(spark, sf_dir):
    return _rounded(_stages(spark, sf_dir))


@query(f"""WITH {_STAGES}, o AS (SELECT *, row_number() OVER (ORDER BY timestamp, stage_name) AS a, row_number() OVER (ORDER BY timestamp DESC, stage_name DESC) AS z FROM stages),
r AS (SELECT count(*) AS num_stages, max(CASE WHEN a = 1 THEN input_records END) AS i, max(CASE WHEN z = 1 THEN output_records END) AS o, sum(total_time) AS d, sum(error_count) AS e FROM o)
SELECT num_stages, i AS total_input_records, o AS total_output_records, round(d, 6) AS duration, CAST(e AS BIGINT) AS total_errors, round(o * CAST(100 AS DOUBLE) / i, 6) AS overall_pass_rate, round(i / d, 6) AS avg_throughput FROM r""")
def metrics_run_rollup(spark, sf_dir):
    return _rounded(rollups.run_rollup(_stages(spark, sf_dir)))


@query("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, max(n) AS n, max(CASE WHEN r = floor(n * CAST(0.5 AS DOUBLE)) + 1 THEN value END) AS p50, max(CASE WHEN r = floor(n * CAST(0.95 AS DOUBLE)) + 1 THEN value END) AS p95, max(CASE WHEN r = floor(n * CAST(0.99 AS DOUBLE)) + 1 THEN value END) AS p99 FROM r GROUP BY 1""")
def metrics_percentile_nearest_rank(spark, sf_dir):
    return rollups.nearest_rank_percentiles(_table(spark, sf_dir, "events"), "event_type", "value")


@query(f"WITH {_STAGES} SELECT stage_name, round(coalesce(sum(total_time) OVER (ORDER BY timestamp, stage_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS start_time, round(sum(total_time) OVER (ORDER BY timestamp, stage_name ROWS UNBOUNDED PRECEDING), 6) AS end_time FROM stages")
def metrics_timeline(spark, sf_dir):
    return _rounded(rollups.timeline(_stages(spark, sf_dir)))


@query(f"""WITH {_STAGES}, o AS (SELECT operator_name, avg(throughput) AS t FROM facts GROUP BY 1)
SELECT a.stage_name AS slowest_stage, round(a.total_time, 6) AS stage_time, b.operator_name AS slowest_operator, round(b.t, 6) AS operator_throughput FROM (SELECT * FROM stages ORDER BY total_time DESC, stage_name DESC LIMIT 1) a, (SELECT * FROM o ORDER BY t, operator_name LIMIT 1) b""")
def metrics_bottleneck(spark, sf_dir):
    return _rounded(rollups.bottleneck(_stages(spark, sf_dir), _facts(spark, sf_dir)))


@query(f"WITH {_STAGES} SELECT stage_name, round(total_time, 6) AS total_time FROM stages UNION ALL SELECT 'TOTAL', round(sum(total_time), 6) FROM stages")
def metrics_waterfall(spark, sf_dir):
    return _rounded(rollups.waterfall(_stages(spark, sf_dir)))


@query(f"""WITH {_FACTS}, p AS (SELECT stage_name, operator_name, sum(input_records) AS i, sum(output_records) AS o, min(timestamp) AS t FROM facts GROUP BY 1, 2),
n AS (SELECT *, coalesce(lead(operator_name) OVER (PARTITION BY stage_name ORDER BY t, operator_name), 'output') AS nxt FROM p)
SELECT stage_name, operator_name AS source, nxt AS target, CAST(o AS BIGINT) AS records FROM n WHERE o > 0 UNION ALL SELECT stage_name, operator_name, 'filtered', CAST(i - o AS BIGINT) FROM n WHERE i - o > 0""")
def metrics_funnel(spark, sf_dir):
    return rollups.funnel(_facts(spark, sf_dir))


@query(f"""WITH {_FACTS}, f AS (SELECT *, row_number() OVER (PARTITION BY operator_name ORDER BY timestamp, worker_id) AS rn FROM facts)
SELECT operator_name, m.measure, round(CASE m.measure WHEN 'min' THEN min_latency WHEN 'p50' THEN p50_latency WHEN 'p95' THEN p95_latency WHEN 'p99' THEN p99_latency ELSE max_latency END, 6) AS latency FROM f, (VALUES ('min'), ('p50'), ('p95'), ('p99'), ('max')) AS m(measure) WHERE rn = 1""")
def metrics_latency_heatmap(spark, sf_dir):
    return _rounded(rollups.latency_heatmap(_facts(spark, sf_dir)))


@query(f"WITH {_FACTS} SELECT date_trunc('hour', timestamp) AS hour, operator_name, round(avg(throughput), 6) AS avg_throughput, CAST(sum(input_records) AS BIGINT) AS total_input FROM facts GROUP BY 1, 2")
def metrics_hourly_trend(spark, sf_dir):
    return _rounded(spark.sql(rollups.HOURLY_TREND.replace("FROM operators", "FROM {operators}"), operators=_facts(spark, sf_dir)))


@query(f"WITH {_FACTS} SELECT operator_name, stage_name, round(avg(throughput), 6) AS avg_throughput, round(avg(p95_latency), 6) AS avg_p95_latency FROM facts GROUP BY 1, 2 ORDER BY avg(throughput), operator_name, stage_name LIMIT 10")
def metrics_slow_operators(spark, sf_dir):
    return _rounded(spark.sql(rollups.SLOW_OPERATORS.replace("FROM operators", "FROM {operators}"), operators=_facts(spark, sf_dir)))


@query(f"WITH {_STAGES} SELECT stage_name, round(avg(pass_rate), 6) AS avg_pass_rate, CAST(sum(input_records) AS BIGINT) AS total_input FROM stages GROUP BY 1")
def metrics_lowest_pass_rate(spark, sf_dir):
    return _rounded(spark.sql(rollups.LOWEST_PASS_RATE.replace("FROM stages", "FROM {stages}"), stages=_stages(spark, sf_dir)))


@query("SELECT event_id, printf('%.2f%%', value) AS percent, printf('%.2fms', value * 1000) AS latency, format('{:,}', CAST(trunc(value) AS BIGINT)) AS whole FROM events")
def metrics_value_formats(spark, sf_dir):
    v = F.col("value")
    return _table(spark, sf_dir, "events").select("event_id", records.formatted(v, "percent").alias("percent"), records.formatted(v, "latency").alias("latency"), records.formatted(v, "integer").alias("whole"))


# ---- vectors and models --------------------------------------------------------------------------------------------
_E, _K = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))", 8


@query(f"SELECT vec_id, round(sqrt(list_sum(list_transform({_E}, lambda x: x * x))), 6) AS norm FROM embeddings")
def emb_l2_norm(spark, sf_dir):
    return _rounded(_table(spark, sf_dir, "embeddings").select("vec_id", vector.norm(F.col("embedding")).alias("norm")))


@query(f"WITH e AS (SELECT vec_id, {_E} AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM e) SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round(v[i] / norm, 6) AS value FROM (SELECT *, unnest(generate_series(1, 64)) AS i FROM n)")
def emb_normalize(spark, sf_dir):
    return _rounded(_table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(vector.normalize(F.col("embedding"))).alias("dim", "value")))


def _starts(spark, sf_dir) -> np.ndarray:
    rows = _table(spark, sf_dir, "embeddings").orderBy("vec_id").select("embedding").limit(_K).collect()
    return np.array([r["embedding"] for r in rows], np.float64)


_NEAREST = f"""e AS (SELECT vec_id, {_E} AS v FROM embeddings), c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cid, v AS cv FROM (SELECT * FROM e ORDER BY vec_id LIMIT {_K})),
d AS (SELECT vec_id, v, cid, sqrt(list_sum(list_transform(list_zip(v, cv), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist FROM e, c),
n AS (SELECT vec_id, v, cid, dist FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rn FROM d) WHERE rn = 1)"""


@query(f"WITH {_NEAREST} SELECT vec_id, CAST(cid AS INTEGER) AS cluster, round(dist, 6) AS distance FROM n")
def emb_nearest_centroid(spark, sf_dir):
    return _rounded(kmeans.assign(_table(spark, sf_dir, "embeddings"), _starts(spark, sf_dir), "embedding").select("vec_id", "cluster", "distance"))


@query(f"WITH {_NEAREST}, x AS (SELECT cid, v, unnest(generate_series(1, 64)) AS i FROM n) SELECT CAST(cid AS INTEGER) AS cluster, CAST(i - 1 AS INTEGER) AS dim, round(sum(v[i]), 5) AS total, count(*) AS members FROM x GROUP BY 1, 2")
def emb_cluster_sums(spark, sf_dir):
    return _rounded(kmeans.cluster_sums(kmeans.assign(_table(spark, sf_dir, "embeddings"), _starts(spark, sf_dir), "embedding"), "embedding"), 5)


@query(f"WITH {_NEAREST} SELECT round(sum(dist * dist), 5) AS inertia FROM n")
def emb_inertia(spark, sf_dir):
    found = kmeans.assign(_table(spark, sf_dir, "embeddings"), _starts(spark, sf_dir), "embedding")
    return _rounded(found.agg(F.sum(F.col("distance") * F.col("distance")).alias("inertia")), 5)


def _lloyd_sql(steps: int) -> str:
    """Lloyd's steps one by one; a cluster without rows keeps its centroid."""
    far = "sqrt(list_sum(list_transform(list_zip(v, cv), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"
    out = [f"e AS MATERIALIZED (SELECT vec_id, {_E} AS v FROM embeddings)", f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cid, v AS cv FROM (SELECT * FROM e ORDER BY vec_id LIMIT {_K}))"]
    near = lambda i: f"n{i} AS MATERIALIZED (SELECT vec_id, v, cid, dist FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rn FROM (SELECT vec_id, v, cid, {far} AS dist FROM e, c{i})) WHERE rn = 1)"
    for i in range(steps):
        out += [near(i), f"m{i} AS (SELECT cid, list(mean ORDER BY i) AS cv FROM (SELECT cid, i, avg(v[i]) AS mean FROM (SELECT cid, v, unnest(generate_series(1, 64)) AS i FROM n{i}) GROUP BY cid, i) GROUP BY cid)"]
        out.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.cid, coalesce(m{i}.cv, c{i}.cv) AS cv FROM c{i} LEFT JOIN m{i} ON c{i}.cid = m{i}.cid)")
    return f"WITH {', '.join([*out, near(steps)])} SELECT vec_id, CAST(cid AS INTEGER) AS cluster, round(dist, 6) AS distance FROM n{steps}"


@query(_lloyd_sql(10))
def kmeans_lloyd_fixed_init(spark, sf_dir):
    e = _table(spark, sf_dir, "embeddings")
    model = kmeans.KMeansTrainer(_K, init=_starts(spark, sf_dir), max_iterations=10, tolerance=0).train(e, "vec_id", "embedding")
    return model.predict(e, "embedding").select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


def _layers(*sizes: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Fixed weights for the scorers, as no pretrained ones come with this package."""
    rng = np.random.default_rng(3)
    return [(rng.normal(0, a**-0.5, (b, a)), rng.normal(0, 0.1, b)) for a, b in zip(sizes, sizes[1:], strict=False)]


_AESTHETIC = _layers(64, 32, 16, 1)
_W, _B = collapse(_AESTHETIC)
_LINEAR = f"list_sum(list_transform(list_zip({_E}, [{', '.join(f'CAST({float(w)!r} AS DOUBLE)' for w in _W)}]), lambda p: p[1] * p[2])) + CAST({float(_B)!r} AS DOUBLE)"


@query(f"SELECT vec_id, round({_LINEAR}, 6) AS score FROM embeddings")
def emb_linear_score(spark, sf_dir):
    return _rounded(_table(spark, sf_dir, "embeddings").select("vec_id", (vector.dot(F.col("embedding"), vector.literal(_W)) + F.lit(_B)).alias("score")))


@query(f"SELECT vec_id, round(1 / (1 + exp(-({_LINEAR}))), 6) AS probability, CAST(1 / (1 + exp(-({_LINEAR}))) > 0.5 AS INTEGER) AS predicted FROM embeddings")
def emb_sigmoid_threshold(spark, sf_dir):
    p = vector.sigmoid(vector.dot(F.col("embedding"), vector.literal(_W)) + F.lit(_B))
    return _rounded(_table(spark, sf_dir, "embeddings").select("vec_id", p.alias("probability"), evaluation.predict(p).alias("predicted")))


@query(f"SELECT vec_id, round(CAST({_LINEAR} AS DOUBLE), 4) AS score FROM embeddings")
def aesthetic_score(spark, sf_dir):
    scored = ImageAestheticQualityRefiner("embedding", _AESTHETIC).transform(_table(spark, sf_dir, "embeddings"))
    return scored.select("vec_id", F.round(F.col("image_aesthetic_score").cast("double"), 4).alias("score"))


_AIGC = _layers(64, 16, 8, 1)


def _layer_sql(x: str, layer, last: bool = False) -> str:
    """A layer over the list x as a SQL list, with ReLU unless it is the last."""
    cast = lambda v: f"CAST({float(v)!r} AS DOUBLE)"
    units = [f"list_sum(list_transform(list_zip({x}, [{', '.join(map(cast, w))}]), lambda p: p[1] * p[2])) + {cast(b)}" for w, b in zip(*layer, strict=True)]
    return units[0] if last else "[" + ", ".join(f"greatest({u}, CAST(0 AS DOUBLE))" for u in units) + "]"


@query(f"WITH e AS (SELECT vec_id, {_E} AS v FROM embeddings), a AS (SELECT vec_id, {_layer_sql('v', _AIGC[0])} AS h FROM e), b AS (SELECT vec_id, {_layer_sql('h', _AIGC[1])} AS g FROM a), c AS (SELECT vec_id, 1 / (1 + exp(-({_layer_sql('g', _AIGC[2], True)}))) AS p FROM b) SELECT vec_id, round(p, 4) AS score, p > 0.5 AS image_is_aigc FROM c")
def aigc_detector(spark, sf_dir):
    scored = ImageAIGCDetectorRefiner("embedding", _AIGC).transform(_table(spark, sf_dir, "embeddings"))
    return scored.select("vec_id", F.round(F.col("image_aigc_score").cast("double"), 4).alias("score"), "image_is_aigc")


#: Below what is usual, as the table's vectors are hardly alike.
_ALIKE = 0.3
_COSINES = f"""{_NEAREST}, p AS (SELECT a.vec_id AS early, b.vec_id AS late, list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2])) / sqrt(list_sum(list_transform(a.v, lambda x: x * x)) * list_sum(list_transform(b.v, lambda x: x * x))) AS cosine
FROM n a JOIN n b ON a.cid = b.cid AND a.vec_id < b.vec_id)"""


def _clustered(spark, sf_dir) -> DataFrame:
    return kmeans.assign(_table(spark, sf_dir, "embeddings"), _starts(spark, sf_dir), "embedding")


@query(f"WITH {_COSINES} SELECT late AS id, early AS representative_id, round(cosine, 6) AS cosine FROM p WHERE cosine >= {_ALIKE}")
def semantic_dedup_pairs(spark, sf_dir):
    return SemanticDeduplicator(threshold=_ALIKE).pairs(_clustered(spark, sf_dir)).select("id", "representative_id", F.round("cosine", 6).alias("cosine"))


@query(f"WITH {_COSINES} SELECT vec_id FROM n WHERE vec_id NOT IN (SELECT late FROM p WHERE cosine >= {_ALIKE})")
def semantic_dedup_survivors(spark, sf_dir):
    return SemanticDeduplicator(threshold=_ALIKE, order_by="vec_id").transform(_clustered(spark, sf_dir)).select("vec_id")


@query(f"WITH {_COSINES} SELECT count(*) AS pairs, 0 AS wrong, true AS enough FROM p WHERE cosine >= {_ALIKE}")
def semantic_lsh_recall(spark, sf_dir):
    """Pairs of like vectors by tables of planes, held against all pairs: none that is wrong, and nine of ten found."""
    rows = _clustered(spark, sf_dir)
    every = SemanticDeduplicator(threshold=_ALIKE).pairs(rows).select("id", "representative_id", F.lit(1).alias("true"))
    found = SemanticDeduplicator(threshold=_ALIKE, exact=False, bits=4).pairs(rows).select("id", "representative_id", F.lit(1).alias("found"))
    both = every.join(found, ["id", "representative_id"], "full")
    return both.agg(F.count("true").alias("pairs"), F.count_if(F.col("true").isNull()).cast("int").alias("wrong"), (F.count_if(F.col("true").isNotNull() & F.col("found").isNotNull()) >= 0.9 * F.count("true")).alias("enough"))


def _classified(spark, sf_dir) -> DataFrame:
    """labels with a probability that is a simple function of the length of the document."""
    p = F.least(F.lit(1.0), F.col("n_chars") / F.lit(4000.0))
    return _table(spark, sf_dir, "labels").join(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id").select("doc_id", F.col("quality").alias("label"), "toxic", p.alias("probability")).withColumn("predicted", evaluation.predict(F.col("probability")))


_CLASSIFIED = "c AS (SELECT l.doc_id, quality AS label, toxic, least(CAST(1 AS DOUBLE), n_chars / CAST(4000 AS DOUBLE)) AS probability, CAST(least(CAST(1 AS DOUBLE), n_chars / CAST(4000 AS DOUBLE)) > 0.5 AS INTEGER) AS predicted FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
_CELLS = "count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE label = 0 AND predicted = 1) AS fp, count(*) FILTER (WHERE label = 1 AND predicted = 0) AS fn, count(*) FILTER (WHERE label = 0 AND predicted = 0) AS tn"


_Z = "list_sum(list_transform(v, lambda x, i: x * (((i * 7) % 11) - 5) / 10)) + CAST(0.05 AS DOUBLE)"


@query(f"""WITH e AS (SELECT {_E} AS v, CASE WHEN label < 5 THEN 1 ELSE -1 END AS s FROM embeddings), z AS (SELECT v, s, 1 / (1 + exp(-s * ({_Z}))) AS q FROM e),
g AS (SELECT v, CAST(0.25 AS DOUBLE) * s * (2 * pow(1 - q, 2) * q * ln(q) - pow(1 - q, 3)) AS d FROM z)
SELECT CAST(i - 1 AS INTEGER) AS dim, round(sum(d * v[i]), 6) AS gradient FROM (SELECT v, d, unnest(generate_series(1, 64)) AS i FROM g) GROUP BY i""")
def head_gradient(spark, sf_dir):
    """The focal loss's gradient at given weights, summed over all embeddings."""
    weights = np.array([[((i * 7) % 11 - 5) / 10 for i in range(1, 65)]])
    rows = _table(spark, sf_dir, "embeddings").select("embedding", (F.col("label") < 5).cast("int").alias("label"))
    total, _, _ = head.summed_gradient(rows, [(weights, np.array([0.05]))], "label", "embedding")
    return _rounded(spark.createDataFrame([(i, float(g)) for i, g in enumerate(total[:64])], "dim int, gradient double"))


@query(f"WITH {_CLASSIFIED} SELECT toxic, {_CELLS} FROM c GROUP BY toxic")
def clf_confusion(spark, sf_dir):
    return evaluation.confusion(_classified(spark, sf_dir), "label", "predicted", "toxic")


@query(f"WITH {_CLASSIFIED}, m AS (SELECT {_CELLS} FROM c), r AS (SELECT *, (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) AS accuracy, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS precision, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS recall FROM m) SELECT tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1 FROM r")
def clf_f1(spark, sf_dir):
    return _rounded(evaluation.binary_metrics(_classified(spark, sf_dir)))


@query(f"WITH {_CLASSIFIED} SELECT doc_id, label, round(probability, 6) AS probability FROM c WHERE (label = 0 AND probability > 0.7) OR (label = 1 AND probability < 0.3) OR (probability > 0.3 AND probability < 0.7)")
def hard_negatives(spark, sf_dir):
    return _rounded(evaluation.hard_negatives(_classified(spark, sf_dir)).select("doc_id", "label", "probability"))


@query(f"WITH {_CLASSIFIED} SELECT round(avg((probability - label) * (probability - label)), 6) AS quality_mse, round(avg(abs(probability - label)), 6) AS quality_mae, round(avg((probability - toxic) * (probability - toxic)), 6) AS toxic_mse, round(avg(abs(probability - toxic)), 6) AS toxic_mae FROM c")
def head_mse_mae(spark, sf_dir):
    return _rounded(evaluation.errors(_classified(spark, sf_dir), {"quality": ("label", "probability"), "toxic": ("toxic", "probability")}))


@query(f"WITH {_CLASSIFIED}, p AS (SELECT doc_id, CASE WHEN label = 1 THEN probability ELSE 1 - probability END AS r FROM c) SELECT doc_id, round(CAST(0.25 AS DOUBLE) * pow(1 - r, 2) * abs(ln(greatest(r, CAST(1e-12 AS DOUBLE)))), 6) AS loss FROM p")
def focal_loss(spark, sf_dir):
    return _rounded(_classified(spark, sf_dir).select("doc_id", evaluation.focal_loss(F.col("label"), F.col("probability")).alias("loss")))


@query(f"WITH {_CLASSIFIED} SELECT doc_id, round(1 - probability * CAST(0.2 AS DOUBLE) - label * CAST(0.3 AS DOUBLE) - toxic * CAST(0.25 AS DOUBLE) - predicted * CAST(0.25 AS DOUBLE), 6) AS overall FROM c")
def overall_quality(spark, sf_dir):
    return _rounded(_classified(spark, sf_dir).select("doc_id", evaluation.overall_quality(F.col("probability"), F.col("label"), F.col("toxic"), F.col("predicted")).alias("overall")))


# ---- images --------------------------------------------------------------------------------------------------------
def _images(spark, sf_dir) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.mapInArrow(_drawings, "id long, image struct<bytes: binary>")


@query("SELECT vec_id AS id, CAST(CASE WHEN vec_id % 50 = 7 THEN 0 ELSE 64 + 32 * ((CASE WHEN vec_id % 10 = 1 THEN vec_id - 1 ELSE vec_id END) % 9) END AS INTEGER) AS image_width, CAST(CASE WHEN vec_id % 50 = 7 THEN 0 ELSE 64 + 32 * ((CASE WHEN vec_id % 10 = 1 THEN vec_id - 1 ELSE vec_id END) % 9) END AS INTEGER) AS image_height, CASE WHEN vec_id % 50 = 7 THEN 'ERROR' ELSE 'PNG' END AS image_format FROM embeddings")
def image_metadata(spark, sf_dir):
    return ImageMetadataRefiner().transform(_images(spark, sf_dir)).select("id", "image_width", "image_height", "image_format")


@query()
def image_quality(spark, sf_dir):
    return ImageTechnicalQualityRefiner().transform(_images(spark, sf_dir)).drop("image")


@query()
def image_quality_filter(spark, sf_dir):
    ops = Combined([ImageMetadataRefiner(), ImageTechnicalQualityRefiner(), ImageQualityFilter(128, 128, 0.8, 3.0)])
    return ops.transform(_images(spark, sf_dir)).drop("image")


@query()
def image_phash_dedup(spark, sf_dir):
    return ImagePhashDeduplicator().transform(_images(spark, sf_dir)).select("id")


@query()
def image_visual_degradations(spark, sf_dir):
    def model():
        return lambda data: [(len(data) % (k + 7)) / (k + 7) for k in range(5)]

    return ImageVisualDegradationsRefiner(model).transform(_images(spark, sf_dir)).drop("image")


@query()
def image_clip_embedding(spark, sf_dir):
    return ImageClipEmbeddingRefiner("ViT-B-32", backend=backend, dim=64).transform(_images(spark, sf_dir)).drop("image")


@query()
def image_siglip_embedding(spark, sf_dir):
    return ImageSigLIPEmbeddingRefiner(backend=backend, dim=64, normalize=False).transform(_images(spark, sf_dir)).drop("image")


_BINS = "list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 20) AS INTEGER))"


@query(f"WITH b AS (SELECT vec_id, unnest({_BINS}) AS bin FROM embeddings), c AS (SELECT vec_id, bin, count(*) AS n FROM b GROUP BY 1, 2) SELECT vec_id, round(-sum((n / CAST(64 AS DOUBLE)) * log2(n / CAST(64 AS DOUBLE))), 6) AS entropy FROM c GROUP BY 1")
def histogram_entropy(spark, sf_dir):
    bins = _table(spark, sf_dir, "embeddings").select("vec_id", F.explode(F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 20))).alias("bin"))
    p = F.col("count") / F.lit(64.0)
    return _rounded(bins.groupBy("vec_id", "bin").count().groupBy("vec_id").agg((-F.sum(p * F.log2(p))).alias("entropy")))


# ---- sinks and streams ---------------------------------------------------------------------------------------------
def _scratch(spark: SparkSession) -> str:
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    shared = shared or "file://" + tempfile.gettempdir()
    return f"{shared.rstrip('/')}/corpusmill-{uuid.uuid4().hex}"


@query("SELECT doc_id, lang, n_chars FROM documents")
def parquet_roundtrip(spark, sf_dir):
    from corpusmill.sources.writers import ParquetDataWriter

    writer = ParquetDataWriter(_scratch(spark), "docs")
    writer.write(_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"))
    return spark.read.parquet(writer.path)


@query("SELECT doc_id, source AS key FROM documents")
def partitioned_roundtrip(spark, sf_dir):
    from corpusmill.sources.writers import ParquetDataWriter

    writer = ParquetDataWriter(_scratch(spark), "docs", "key", "source")
    writer.write(_table(spark, sf_dir, "documents").select("doc_id", "source"))
    return spark.read.parquet(writer.path).select("doc_id", "key")


@query("SELECT url, 'response' AS record_type, 'text/html; charset=utf-8' AS mime, md5(html) AS html_md5, octet_length(encode(html)) AS n_bytes, count(*) AS pages FROM pages GROUP BY ALL")
def warc_roundtrip(spark, sf_dir):
    """Pages written as archives of gzip members and read in ranges, several to each file."""
    from corpusmill.sources.warc import read_warc, write_warc

    path = _scratch(spark)
    write_warc(_table(spark, sf_dir, "pages"), path)
    back = read_warc(spark, path, record_types="response", mime="text/html", range_bytes=1 << 16).where("error IS NULL")
    return back.groupBy("url", "record_type", "mime", F.md5("body").alias("html_md5"), F.octet_length("body").cast("long").alias("n_bytes")).agg(F.count("*").alias("pages"))


@query("SELECT doc_id, lang, n_chars, 1 AS loads FROM documents")
def resumed_load(spark, sf_dir):
    """Files of documents, loaded in batches by a first run that stops in one, and by a second one."""
    from corpusmill.sources.loaders import DatasetLoader
    from corpusmill.sources.resume import load_once

    path = _scratch(spark)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    docs.repartition(4, "doc_id").write.parquet(f"{path}/in")
    loader, calls = DatasetLoader(path=f"{path}/in", schema=docs.schema), []

    def stops(df: DataFrame) -> DataFrame:
        calls.append(df)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return df

    try:
        load_once(spark, loader, f"{path}/state", 1, stops)
    except Exception as stop:
        if "stopped" not in str(stop):
            raise
    return load_once(spark, loader, f"{path}/state", 1).groupBy("doc_id", "lang", "n_chars").agg(F.count("*").cast("int").alias("loads"))


@query(f"SELECT DISTINCT md5({_NORMAL}) AS dedup_key FROM documents")
def streaming_exact_dedup(spark, sf_dir):
    schema = _table(spark, sf_dir, "documents").schema
    folder, name = sf_dir.rstrip("/"), "documents.parquet"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    stream = stream.parquet(f"{folder}/{name}") if not _is_file(spark, f"{folder}/{name}") else spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    out = f"{_scratch(spark)}/keys"
    run = stream_dedup.start(stream_dedup.deduplicate(stream, id_field="doc_id").select("dedup_key"), out + "-state", lambda df, _: df.write.mode("append").parquet(out))
    run.awaitTermination()
    return spark.read.parquet(out)


@query(f"SELECT md5({_NORMAL}) AS dedup_key, count(*) AS members, 1 AS firsts, true AS named FROM documents GROUP BY 1")
def streaming_representatives(spark, sf_dir):
    """Documents as a stream of several batches: each key has one first row, and all its other rows name that one."""
    stream_dedup.use_key_state(spark)
    docs, path = _table(spark, sf_dir, "documents").select("doc_id", "text"), _scratch(spark)
    # a split of the input gives a file to each of three days, so files and tasks follow the input; a batch takes about a third of the files
    docs.withColumn("day", F.pmod(F.xxhash64("doc_id"), F.lit(3))).write.partitionBy("day").parquet(f"{path}/in")
    files = len(spark.read.parquet(f"{path}/in").inputFiles())
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", max(1, -(-files // 3))).parquet(f"{path}/in")
    marked = stream_dedup.annotate(stream, id_field="doc_id").select("doc_id", "dedup_key", "representative_id")
    stream_dedup.start(marked, f"{path}/state", lambda df, n: df.write.mode("overwrite").parquet(f"{path}/out/batch={n}")).awaitTermination()  # a batch that runs again replaces its rows
    first = F.min(F.when(F.col("representative_id").isNull(), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    out = spark.read.parquet(f"{path}/out").groupBy("dedup_key").agg(F.count("*").alias("members"), F.count_if(F.col("representative_id").isNull()).cast("int").alias("firsts"), first.alias("own"), F.min("representative_id").alias("a"), F.max("representative_id").alias("b"))
    return out.select("dedup_key", "members", "firsts", (F.coalesce("a", "own").eqNullSafe(F.col("own")) & F.coalesce("b", "own").eqNullSafe(F.col("own"))).alias("named"))


def _is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isFile()
