"""Text normalisation and content keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split() knows it; the same pattern works in Java and in RE2.
WHITE_SPACE = "[\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def normalize(text: Column, whitespace: bool = True, lowercase: bool = True) -> Column:
    """White space collapsed to single blanks and trimmed, then lower case."""
    if whitespace:
        text = F.trim(F.regexp_replace(text, WHITE_SPACE, " "))
    return F.lower(text) if lowercase else text


def digest(text: Column, algorithm: str = "auto") -> Column:
    """Hex digest: auto and md5 are MD5, sha256 SHA-256, xxhash 64 bits of XXH64; unknown names mean MD5.

    The 64-bit digest is Spark's (seed 42): it groups like any other seed.
    """
    if algorithm == "sha256":
        return F.sha2(text, 256)
    if algorithm == "xxhash":
        return F.lpad(F.lower(F.hex(F.xxhash64(text))), 16, "0")
    return F.md5(text.cast("binary"))


def content_key(text: Column, fallback: Column, *, url: Column | None = None, algorithm: str = "auto", whitespace: bool = True, lowercase: bool = True) -> Column:
    """Key by which texts are the same: the digest of the normal form, with the url in front if there is one.

    An empty or null text has no content; its key is the fallback.
    """
    body = normalize(text, whitespace, lowercase)
    if url is not None:
        body = F.when(F.coalesce(F.length(url), F.lit(0)) > 0, F.concat(url, F.lit("|"), body)).otherwise(body)
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, digest(body, algorithm)).otherwise(F.coalesce(fallback.cast("string"), F.lit("")))


def size_of(text: Column, precomputed: Column | None = None) -> Column:
    """Code points of a text (bytes of a binary), or a precomputed number truncated towards zero; null counts 0."""
    own = F.coalesce(F.length(text), F.lit(0)).cast("long")
    return own if precomputed is None else F.coalesce(precomputed.cast("long"), own)
