"""What the findings of round 2 were about."""

import hashlib

import public_tokenizers

from corpusmill.llm import bpe, quality_bands


def test_buckets_of_words_follow_the_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b é"), (2, None), (None, "x" * 100)], "doc_id long, text string")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3000")
        assert bpe.default_buckets(docs) == bpe.EVEN_MOST  # no square of the partitions
        spark.conf.set(key, "2")
        assert bpe.default_buckets(docs) == 2 * bpe.EVEN
        monkeypatch.setattr(bpe, "BUCKET_BYTES", 2)
        assert bpe.default_buckets(docs) == 53 and bpe.default_buckets(docs.limit(0)) == 12
    finally:
        spark.conf.set(key, before)


def test_blocks_of_a_group_send_their_words_once(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").toArrow()
    monkeypatch.setattr(bpe, "BLOCK", 20_000)

    def sent(group):
        monkeypatch.setattr(bpe, "GROUP", group)
        batches = list(bpe._pretokens(public_tokenizers.PATTERN, 50)(table.to_batches()))
        rows = [r for b in batches for r in b.to_pylist()]
        return sum(r["kind"] == 0 for r in rows), [r for r in rows if r["kind"] == 1], len(batches)

    (alone, blocks, groups), (together, same, fewer) = sent(1), sent(1000)
    assert len(blocks) == len(same) == groups > 10 and fewer == 1 and together <= 50 < alone <= 50 * groups
    assert [(r["ids"], r["counts"]) for r in blocks] == [(r["ids"], r["counts"]) for r in same]


def test_bands_are_fitted_to_every_labelled_text(spark):
    words = lambda i, n: " ".join(hashlib.md5(f"{i}-{j}".encode()).hexdigest()[: 3 + j % 5] for j in range(n))
    rows = [(i, words(i, 60)) for i in range(4500)] + [(5000 + i, "abc " * (20_000 + i)) for i in range(30)]  # longer than 64 KiB
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    bands = quality_bands.fit(docs, labels)
    kept = quality_bands.quality(docs, bands)
    assert max(bands.lowest) >= 80_000 and bands.limits(80_000)[0] < 0.01
    seen = []
    real, quality_bands.bands_of = quality_bands.bands_of, lambda texts, chunks: seen.extend(texts) or real(seen, chunks)
    try:
        quality_bands.fit(docs, labels)
    finally:
        quality_bands.bands_of = real
    assert sum(n for _, _, n in seen) == len(rows) == kept.count()
