"""Filters on URLs, text lengths and image quality."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import text as text_functions
from corpusmill.functions import url as url_functions
from corpusmill.operators.base import DETAILS, Filter, details, with_details
from corpusmill.sources.blocklist import FEW, bloom, may_hold, read_blocklist, words_for

#: Blocked domains up to which they are literals of the plan; a longer list is joined. Labels of hosts that are looked up in
#: a list's Bloom filter.
LITERAL_DOMAINS, LABELS = 2000, 6


class UrlFilter(Filter):
    """Rejects URLs of blocked domains, with a word score of score_threshold or more, or of curated sources.

    Null and empty URLs are kept. Domains match with their subdomains unless check_subdomains is off.

    Lists of over LITERAL_DOMAINS domains, from files above all, stay tables. A Bloom filter of them lets most rows pass
    where they are; hosts that may be blocked are joined with the list exactly, and only their rows are shuffled.
    """

    def __init__(self, url_field: str = "url", blocklist_paths: Iterable[str] | None = None, blocklist_domains: Iterable[str] | None = None, word_weights: dict[str, float] | None = None, use_default_words: bool = True, score_threshold: float = 0.5, check_subdomains: bool = True, exclude_quality_sources: bool = False, quality_source_domains: Iterable[str] | None = None, use_default_quality_sources: bool = True, normalize_host: bool = False):
        self.url_field, self.score_threshold, self.check_subdomains, self.normalize_host = url_field, float(score_threshold), check_subdomains, normalize_host
        self.required_columns = (url_field,)
        self.weights = (dict(url_functions.WORD_WEIGHTS) if use_default_words else {}) | {k.lower(): float(v) for k, v in (word_weights or {}).items()}
        self.blocked = {d.lower().strip() for d in blocklist_domains or ()} - {""}
        lists = [read_blocklist(path) for path in ([blocklist_paths] if isinstance(blocklist_paths, str) else blocklist_paths or ())]
        self.files: DataFrame | None = reduce(DataFrame.union, [x for x in lists if x is not None]) if any(x is not None for x in lists) else None
        if self.files is not None:  # short files are literals, too
            some = self.files.limit(LITERAL_DOMAINS + 1).collect()
            if len(some) <= LITERAL_DOMAINS:
                self.blocked, self.files = self.blocked | {r["suffix"] for r in some}, None
        sources = set(url_functions.QUALITY_SOURCES) if use_default_quality_sources else set()
        self.quality = (sources | {d.lower().strip() for d in quality_source_domains or ()}) if exclude_quality_sources else set()

    def _rest(self, df: DataFrame) -> Column:
        url = F.col(self.url_field)
        host = url_functions.domain(url, self.normalize_host)
        return (url_functions.word_score(url, self.weights) >= self.score_threshold) | url_functions.in_domains(host, self.quality, self.check_subdomains)

    def _empty(self, df: DataFrame) -> Column:
        if not isinstance(df.schema[self.url_field].dataType, T.StringType):
            return F.lit(True)
        return F.coalesce(F.length(self.url_field), F.lit(0)) == 0

    def predicate(self, df: DataFrame) -> Column:
        host = url_functions.domain(F.col(self.url_field), self.normalize_host)
        return self._empty(df) | ~(url_functions.in_domains(host, self.blocked, self.check_subdomains) | self._rest(df))

    @property
    def _short(self) -> bool:
        return self.files is None and len(self.blocked) <= LITERAL_DOMAINS

    def _listed(self, spark) -> DataFrame:
        own = spark.createDataFrame([(d,) for d in sorted(self.blocked)], "suffix string")
        return own if self.files is None else own.union(self.files)

    def _parts(self, host: Column) -> Column:
        return url_functions.suffixes(host) if self.check_subdomains else F.array(host)

    def _split(self, df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows of df that the list has nothing of, rows that it may have something of, with _host, and the blocked ones of their hosts.

        Hosts are distinct before their suffixes are, so no URL is exploded.
        """
        listed = self._listed(df.sparkSession)
        words = words_for(len(self.blocked) + (0 if self.files is None else self.files.count()))
        filter_ = bloom(listed, words)
        rows = df.withColumn("_host", url_functions.domain(F.col(self.url_field), self.normalize_host))
        host = F.col("_host")
        if words <= FEW:
            likely = F.exists(self._parts(host), lambda s: may_hold(filter_, words, s))
        elif self.check_subdomains:  # a subquery can't stand in a lambda; hosts of more labels may always be listed
            likely = reduce(Column.__or__, [may_hold(filter_, words, F.substring_index(host, ".", -i)) for i in range(1, LABELS + 1)], F.size(F.split(host, "\\.")) > LABELS)
        else:
            likely = may_hold(filter_, words, host)
        likely = F.coalesce(likely, F.lit(False))
        some = rows.where(likely)
        hosts = some.select("_host").distinct()
        blocked = hosts.select("_host", F.explode(self._parts(F.col("_host"))).alias("suffix")).join(listed, "suffix", "left_semi").select("_host").distinct()
        return rows.where(~likely), some, blocked

    def transform(self, df: DataFrame) -> DataFrame:
        if self._short:
            return super().transform(df)
        self.check(df)
        free, some, blocked = self._split(df.where(self._empty(df) | ~self._rest(df)))
        return free.select(df.columns).union(some.join(blocked, "_host", "left_anti").select(df.columns))

    def annotate(self, df: DataFrame) -> DataFrame:
        if self._short:
            return super().annotate(df)
        self.check(df)
        df = with_details(df)
        free, some, blocked = self._split(df)
        some = some.join(blocked.withColumn("_blocked", F.lit(True)), "_host", "left")
        rows = free.withColumn("_blocked", F.lit(None).cast("boolean")).select(*df.columns, "_blocked").union(some.select(*df.columns, "_blocked"))
        drop = F.col(DETAILS).isNull() & ~self._empty(df) & (F.col("_blocked").isNotNull() | self._rest(df))
        return rows.withColumn(DETAILS, F.when(drop, details("filtered", self.name)).otherwise(F.col(DETAILS))).select(df.columns)


class TextLengthFilter(Filter):
    """Keeps texts of min_length to max_length characters, both included; a numeric text_length_field comes first."""

    def __init__(self, min_length: int = 0, max_length: int | None = None, text_field: str = "text", text_length_field: str = "text_length"):
        self.min_length, self.max_length, self.text_field, self.text_length_field = min_length, max_length, text_field, text_length_field

    def predicate(self, df: DataFrame) -> Column:
        known = None
        if self.text_length_field in df.columns:
            kind = df.schema[self.text_length_field].dataType
            if isinstance(kind, T.BooleanType):
                known = F.col(self.text_length_field).cast("int")
            elif isinstance(kind, T.NumericType):
                known = F.col(self.text_length_field)
        text = F.lit(None).cast("string")
        if self.text_field in df.columns and isinstance(df.schema[self.text_field].dataType, (T.StringType, T.BinaryType)):
            text = F.col(self.text_field)
        size = text_functions.size_of(text, known)
        within = size >= self.min_length
        return within if self.max_length is None else within & (size <= self.max_length)


class ImageQualityFilter(Filter):
    """Keeps images that are large enough, with few compression artifacts and enough entropy; absent or null counts 0."""

    def __init__(self, min_width: int = 256, min_height: int = 256, max_compression_artifacts: float = 0.8, min_information_entropy: float = 3.0, max_width: int | None = None, max_height: int | None = None):
        self.min_width, self.min_height, self.max_width, self.max_height = min_width, min_height, max_width, max_height
        self.max_compression_artifacts, self.min_information_entropy = max_compression_artifacts, min_information_entropy

    def predicate(self, df: DataFrame) -> Column:
        value = lambda c: F.coalesce(F.col(c), F.lit(0)) if c in df.columns else F.lit(0)
        keep = (value("image_width") >= self.min_width) & (value("image_height") >= self.min_height)
        keep &= value("image_compression_artifacts") <= F.lit(self.max_compression_artifacts).cast("float")
        keep &= value("image_information_entropy") >= F.lit(self.min_information_entropy).cast("float")
        for c, most in (("image_width", self.max_width), ("image_height", self.max_height)):
            keep = keep if most is None else keep & (value(c) <= most)
        return keep
