"""The corpus pipeline: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, decontaminate, line_dedup, minhash
from corpusmill.llm import toxicity as tox
from corpusmill.llm.storage import discard, documents, materialize, swept

#: A trained network, merges and full-set similarity are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a network trained on labelled ones scores as toxic go.

    The network learns from a bounded sample of all labelled documents, those that op8 holds out included. Every row is
    scored: null doc_ids and repeated rows by their text, null and empty texts as no evidence, so they stay. An empty
    table stays empty. Columns pass through.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = tox.fit(docs, labels)
    return tox.keep_clean(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a host go, and n_chars follows; a text of nothing else becomes empty.

    No row goes. Null texts stay null, rows of null source are a host of their own, repeated rows are cut alike; other
    columns, and n_chars of texts that keep all lines, pass through. An empty table stays empty.
    """
    cut = line_dedup.drop_boilerplate(docs, counts=("__n_lines", "__n_dropped"))
    size = F.when(F.col("__n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", size).select(docs.columns)


def _rows(docs: DataFrame) -> DataFrame:
    """docs as a struct, with what tells rows apart: doc_id and the hash of the text."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("part"))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """rows but those with an equal (doc_id, part) in gone; null doc_ids are equal."""
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["part"] == gone["part"])
    return rows.join(gone, same, "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: shingles of five words, similarity 0.8 or more.

    It is the row of the smallest doc_id, of several of that doc_id the one whose text has the least hash, and of equal
    ones (doc_id and text) one. Decisions are by row, so another text of the same doc_id is judged by itself. Rows of
    null doc_id, and blank and null texts, are in no group and stay. An empty table stays empty.
    """
    found = materialize(minhash.near_duplicates(docs, width=5, percent=80).where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)), "judged")
    counted = found.groupBy("doc_id", "part", "group_id", "kept").count()
    best = counted.where("kept").groupBy("group_id").agg(F.min("part").alias("part"))
    stays = counted.where("kept").join(best, ["group_id", "part"]).select("doc_id", "part", "count")
    gone = counted.join(stays, ["doc_id", "part"], "left_anti").select("doc_id", "part")
    left = _without(_rows(docs), gone)
    repeated = materialize(stays.where("count > 1").select("doc_id", "part"), "repeated")
    if repeated.isEmpty():
        return left.select("row.*")
    once = left.join(repeated, ["doc_id", "part"]).groupBy("doc_id", "part").agg(F.first("row").alias("row"))
    return _without(left, repeated).select("row.*").union(once.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with an item of the benchmark go.

    Decisions are by row: rows of null doc_id go if their own text overlaps, and another text of the same doc_id stays.
    Null and blank texts overlap with nothing. Without items, and for an empty table, all rows stay.
    """
    found = decontaminate.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "part").distinct()
    return _without(_rows(docs), found).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the check that they decode to its bytes: doc_id, n_tokens, ids, decoded_sha256.

    A result for each row, repeated and null doc_ids included; null texts have no ids. An empty table gives none.
    """
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), bpe.token_table(spark, ranks))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup), ("decontamination", decontamination), ("byte_bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read by the next stage.

    When a stage's result is written, its intermediate tables and the result before it go; the last written one stays, as what
    is returned reads it.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        before = docs
        with swept(spark) as keep:
            docs = materialize(stage(spark, docs, sf_dir), name)
            keep.add(docs.written_to)
        if hasattr(before, "written_to"):
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
