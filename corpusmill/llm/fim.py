"""Fill-in-the-middle: a text's units, cut at two hashed places, in another order between sentinels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks in front of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: A word with the white space before it, or white space that ends a text; together the units are the text.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Percentage of the texts that are rearranged, and of these the percentage with the suffix in front.
RATE, SPM = 50, 80

ORACLE = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '{UNIT}') AS units, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """sentinels, if a text without them can be told from them wherever it is cut."""
    ends = {s[k:] for s in sentinels for k in range(1, len(s))}
    starts = {s[:k] for s in sentinels for k in range(1, len(s))}
    if not all(sentinels) or any(a in b for i, a in enumerate(sentinels) for j, b in enumerate(sentinels) if i != j) or ends & starts:
        raise ValueError("sentinels must not be empty, contain each other, or end as one of them begins")
    return sentinels


def rearranged(docs: DataFrame, seed: int = 42, rate: int = RATE, spm: int = SPM, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, text, n (units), form, prefix_chars, middle_chars, output.

    One projection of built-in functions over each text, without a shuffle; the hash of seed and doc_id decides form and
    cuts, so a repeated run, or one on other machines, gives the same rows. form is plain (output is the text; the
    lengths are null), psm (prefix, suffix, middle) or spm (suffix, prefix, middle).

    Null text: as an empty one, plain with no unit. Texts that hold a sentinel: plain. Null doc_id: hashed as no digits.
    Rows that repeat a doc_id are cut by the same hashes, each in its own text. A text of any length is one array of its
    units in one task. Other columns are not read, whatever their names. An empty table gives an empty result.
    """
    prefix_mark, suffix_mark, middle_mark = _checked(sentinels)
    text, key = F.coalesce("text", F.lit("")), F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)).alias("units"), F.sha2(key, 256).alias("hash"))
    h = [F.conv(F.substring("hash", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    n = F.size("units")
    first, second = ((x % (n + 1)).cast("int") for x in h[:2])
    plain = (F.col("text") == "") | (h[2] % 100 >= rate)
    for mark in sentinels:
        plain |= F.contains("text", F.lit(mark))
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    placed = cut.select("doc_id", "text", "units", n.alias("n"), F.least(first, second).alias("a"), F.greatest(first, second).alias("b"), form.alias("form"))
    moved = F.col("form") != "plain"
    a, b = F.col("a"), F.col("b")
    part = lambda start, length: F.when(moved, F.array_join(F.slice("units", start, length), ""))
    parts = placed.select("doc_id", "text", "n", "form", part(F.lit(1), a).alias("prefix"), part(a + 1, b - a).alias("middle"), part(b + 1, F.col("n") - b).alias("suffix"))
    psm = F.concat(F.lit(prefix_mark), "prefix", F.lit(suffix_mark), "suffix", F.lit(middle_mark), "middle")
    spm_ = F.concat(F.lit(suffix_mark), "suffix", F.lit(prefix_mark), "prefix", F.lit(middle_mark), "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm_).otherwise(F.col("text"))
    size = lambda name: F.length(name).cast("long")
    return parts.select("doc_id", "text", F.col("n").cast("long").alias("n"), "form", size("prefix").alias("prefix_chars"), size("middle").alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that output was made of, read from its sentinels; null if output or form is null, or form unknown."""
    prefix_mark, suffix_mark, middle_mark = _checked(sentinels)
    before = F.substring_index(output, middle_mark, 1)
    middle = F.substring_index(output, middle_mark, -1)
    ahead, behind = F.substring_index(before, suffix_mark, 1), F.substring_index(before, suffix_mark, -1)
    psm = F.concat(F.substring_index(ahead, prefix_mark, -1), middle, behind)
    spm = F.concat(F.substring_index(before, prefix_mark, -1), middle, F.substring_index(F.substring_index(before, prefix_mark, 1), suffix_mark, -1))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
