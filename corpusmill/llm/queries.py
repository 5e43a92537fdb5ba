"""The queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, decontaminate, filter_audit, fim, kd_shards, line_dedup, minhash, pii, quality_bands, secret_scan, simhash, suffix_dedup, toxicity
from corpusmill.llm.storage import documents

#: The key of the registered query only; whoever keeps a corpus passes a secret of their own.
PII_KEY = "registered-query"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = bpe.decode(bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), bpe.token_table(spark, ranks))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_bands.quality(docs, quality_bands.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")))


@query
def op7_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(documents(spark, sf_dir), shards=40)


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "text")


ORACLES["op5_line_dedup"] = line_dedup.ORACLE


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("part")


ORACLES["op9_decontamination"] = decontaminate.ORACLE


@query
def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf_dir), PII_KEY).select("doc_id", F.size("pii_kinds").cast("long").alias("n_values"), "pii_kinds", "pii_values", "text")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    language = secret_scan.language_of(docs)
    return secret_scan.scan(docs, secret_scan.fit(secret_scan.labelled_findings(spark, words=language.words), language))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out)
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), width=4, distance=4)
    return found.select("doc_id", simhash.hexadecimal("print").alias("fingerprint"), "component_id")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.rearranged(documents(spark, sf_dir))
    back = fim.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


ORACLES["op12_fill_in_middle"] = fim.ORACLE


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return filter_audit.audited(documents(spark, sf_dir), labels)


ORACLES["op13_filter_audit"] = filter_audit.ORACLE
