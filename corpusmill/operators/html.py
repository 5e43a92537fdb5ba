"""Readable text of web pages by scores of their blocks, in column expressions.

A page is cut into segments at its containers (div, section, lists, tables), and these into blocks (paragraphs, items,
headings). A block has a score from its length, its commas and the share of it that is links; some of it goes to the blocks
beside it, to all of its segment, and a little to the segments beside that. Blocks of enough score are the text.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.base import Refiner

MIN_BYTES = 50
EXTRACTED = ("title", "text", "text_length")
#: A block has a score from so many characters on, of so many at most, and COMMA for each comma. It is kept from ENOUGH on,
#: if links are DENSE percent of it at most. Of the scores of neighbours and segments go one of SIDE, PARENT and NEAR, of
#: neighbouring segments FAR at most.
SHORT, LONG, COMMA, ENOUGH, DENSE = 25, 300, 20, 100, 33
SIDE, PARENT, NEAR, FAR = 2, 4, 10, 40
#: Elements that are no text of a page: with their contents, to the page's end if they aren't closed; and if they are closed.
CODE, FRAME = ("script", "style", "noscript", "template", "svg", "iframe", "select", "textarea"), ("nav", "aside", "footer", "form", "button")
CONTAINERS = ("article", "aside", "body", "details", "div", "dl", "fieldset", "figure", "footer", "form", "header", "main", "menu", "nav", "ol", "section", "table", "td", "ul")
BLOCKS = ("blockquote", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "p", "pre", "summary", "th", "tr")
#: Words of a class, id or role that tell what is beside the text.
BESIDE = ("ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie", "footer", "menu", "nav", "navbar", "navigation", "newsletter", "pager", "popup", "promo", "related", "share", "sidebar", "social", "sponsor", "widget")

# patterns that Java and RE2 read alike; \x02 to \x05 stand for the start and end of a link, containers and blocks
_DROP = r"(?is)<!--.*?(?:-->|\z)|" + "|".join([rf"<{t}\b.*?(?:</{t}\s*>|\z)" for t in CODE] + [rf"<{t}\b.*?</{t}\s*>" for t in FRAME])
_HEAD, _TITLE = r"(?is)<head\b.*?(</head\s*>|<body\b)", r"(?is)<title\b[^>]*>(.*?)</title"
_MARKS = r"[\x00-\x08]"
_BESIDE = rf"(?is)<(?:{'|'.join(CONTAINERS)})\b[^>]*\b(?:class|id|role)\s*=\s*[\"']?(?:[^\"'>]*[^a-z\"'>])?(?:{'|'.join(BESIDE)})(?:[^a-z\"'>][^\"'>]*)?[\"'>][^>]*>?"
_CONTAINER, _BLOCK = rf"(?is)</?(?:{'|'.join(CONTAINERS)})\b[^>]*>", rf"(?is)</?(?:{'|'.join(BLOCKS)})\b[^>]*>"
_LINK, _LINK_END, _BR, _TAG = r"(?is)<a\b[^>]*>", r"(?is)</a\s*>", r"(?is)<br\b[^>]*>", r"(?s)<[!/?a-zA-Z][^>]*>"
_BLANK, _ENTITY = r"[\x{9}-\x{d}\x{20}\x{a0}]+", r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_NAMED = {**{k: chr(v) for k, v in name2codepoint.items()}, "apos": "'"}


def _decoded(text: Column) -> Column:
    """Named and numbered character references, each read once; unknown ones stay."""
    names = F.create_map(*(F.lit(x) for pair in _NAMED.items() for x in pair))

    def piece(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, _ENTITY, 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)).when(name.startswith("#"), F.substring(name, F.lit(2), F.length(name))).cast("int")
        valid = number.between(9, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.try_element_at(names, name))
        known = F.concat(char, F.substring(p, F.length(name) + 2, F.length(p)))
        return F.when(i == 0, p).otherwise(F.coalesce(known, F.concat(F.lit("&"), p)))

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(_decoded(text), _BLANK, " "))


def _int(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by)).cast("int")


def with_readable(df: DataFrame, html: Column, title: str = "title", text: str = "text", text_length: str = "text_length") -> DataFrame:
    """df with title, text and text_length (UTF-8 bytes) of its pages; null where under MIN_BYTES of text are found.

    A page none of whose blocks has enough score, as a list of short lines, gives all blocks that are not mostly links. One
    map over the table without Python. Null pages have no text; a page of any size is one row of one task.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    raw = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _MARKS, " "), _DROP, " "), _HEAD, "$1")
    for pattern, mark in ((_BESIDE, "\x04N"), (_CONTAINER, "\x04P"), (_BLOCK, "\x05"), (_LINK, "\x02"), (_LINK_END, "\x03"), (_BR, " "), (_TAG, "")):
        raw = F.regexp_replace(raw, pattern, mark)
    name = _plain(F.regexp_replace(F.regexp_extract(html, _TITLE, 1), _TAG, ""))
    segments = F.split(F.concat(F.lit("P"), raw), "\x04")
    base = df.select(row, name.alias("title"), F.transform(segments, lambda s: F.struct((F.substring(s, 1, 1) == "N").alias("beside"), F.split(F.substring(s, F.lit(2), F.length(s)), "\x05").alias("blocks"))).alias("segments"))

    def read(b: Column) -> Column:
        links = F.length(F.array_join(F.regexp_extract_all(b, F.lit("\x02([^\x03]*)"), F.lit(1)), ""))
        return F.struct(_plain(F.translate(b, "\x02\x03", "")).alias("t"), links.alias("links"))

    def scored(b: Column) -> Column:
        n = F.length(b.t)
        commas = n - F.length(F.translate(b.t, ",，、", ""))
        links = F.least(b.links, n)
        own = F.when(n >= SHORT, F.call_function("div", (F.least(n, F.lit(LONG)) + COMMA * commas) * (n - links).cast("long"), n).cast("int")).otherwise(0)
        return F.struct(b.t.alias("t"), own.alias("own"), (100 * links.cast("long") > DENSE * n.cast("long")).alias("dense"))

    blocks = lambda s: F.transform(F.filter(F.transform(s.blocks, read), lambda b: b.t != ""), scored)
    base = base.select("row", "title", F.filter(F.transform("segments", lambda s: F.struct(s.beside.alias("beside"), blocks(s).alias("blocks"))), lambda s: F.size(s.blocks) > 0).alias("segments"))
    parent = lambda s: F.when(s.beside, 0).otherwise(F.aggregate(s.blocks, F.lit(0), lambda a, b: a + b.own))
    base = base.select("row", "title", F.transform("segments", lambda s: F.struct(s.beside.alias("beside"), s.blocks.alias("blocks"), parent(s).alias("parent"))).alias("segments"))
    at = lambda xs, i, field: F.coalesce(F.when(i >= 0, F.get(xs, i).getField(field)), F.lit(0))

    def finished(s: Column, i: Column) -> Column:
        near = F.least(_int(at(F.col("segments"), i - 1, "parent") + at(F.col("segments"), i + 1, "parent"), NEAR), F.lit(FAR))
        score = lambda b, j: b.own + _int(at(s.blocks, j - 1, "own") + at(s.blocks, j + 1, "own"), SIDE) + _int(s.parent, PARENT) + near
        return F.transform(s.blocks, lambda b, j: F.struct(b.t.alias("t"), (~b.dense & ~s.beside).alias("open"), score(b, j).alias("score")))

    base = base.select("row", "title", F.filter(F.flatten(F.transform("segments", finished)), lambda b: b.open).alias("blocks"))
    joined = lambda xs: F.array_join(F.transform(xs, lambda b: b.t), "\n")
    best = joined(F.filter("blocks", lambda b: b.score >= ENOUGH))
    found = base.select("row", "title", F.when(F.octet_length(best) >= MIN_BYTES, best).otherwise(joined("blocks")).alias("text"))
    enough = F.octet_length("text") >= MIN_BYTES
    new = {title: F.when(enough, F.col("title")), text: F.when(enough, F.col("text")), text_length: F.when(enough, F.octet_length("text")).cast("long")}
    return found.select(*(F.col("row").getField(c).alias(c) for c in df.columns if c not in new), *(v.alias(k) for k, v in new.items()))


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_plain(text: str) -> str:
    name = f"regexp_extract(p, {_sql(_ENTITY)}, 1)"
    number = f"CASE WHEN regexp_matches({name}, '^#[xX]') THEN TRY_CAST('0x' || substr({name}, 3) AS INT) WHEN {name} LIKE '#%' THEN TRY_CAST(substr({name}, 2) AS INT) END"
    char = f"CASE WHEN {number} BETWEEN 9 AND 1114111 AND NOT {number} BETWEEN 55296 AND 57343 THEN chr({number}) ELSE m[{name}] END"
    decoded = f"array_to_string(list_transform(string_split({text}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE coalesce({char} || substr(p, length({name}) + 2), '&' || p) END), '')"
    return f"trim(regexp_replace({decoded}, {_sql(_BLANK)}, ' ', 'g'))"


def oracle(table: str = "pages", key: str = "page_id", html: str = "html") -> str:
    """The same by DuckDB's lists."""
    entities = "MAP {" + ", ".join(f"'{k}': chr({ord(v)})" for k, v in _NAMED.items()) + "}"
    raw = f"regexp_replace(regexp_replace(regexp_replace({html}, {_sql(_MARKS)}, ' ', 'g'), {_sql(_DROP)}, ' ', 'g'), {_sql(_HEAD)}, '\\1', 'g')"
    for pattern, mark in ((_BESIDE, "chr(4) || 'N'"), (_CONTAINER, "chr(4) || 'P'"), (_BLOCK, "chr(5)"), (_LINK, "chr(2)"), (_LINK_END, "chr(3)"), (_BR, "' '"), (_TAG, "''")):
        raw = f"regexp_replace({raw}, {_sql(pattern)}, {mark}, 'g')"
    n = "length(b.t)"
    links = f"least(b.links, {n})"
    own = f"CASE WHEN {n} >= {SHORT} THEN ((least({n}, {LONG}) + {COMMA} * ({n} - length(translate(b.t, ',，、', '')))) * ({n} - {links})) // {n} ELSE 0 END"
    text = _sql_plain("replace(replace(b, chr(2), ''), chr(3), '')")
    block = f"{{'t': {text}, 'links': length(array_to_string(regexp_extract_all(b, chr(2) || '([^' || chr(3) || ']*)', 1), ''))}}"
    title = _sql_plain(f"regexp_replace(regexp_extract({html}, {_sql(_TITLE)}, 1), {_sql(_TAG)}, '', 'g')")
    score = "b.own + (coalesce(s.blocks[j - 1].own, 0) + coalesce(s.blocks[j + 1].own, 0)) // " + f"{SIDE} + s.parent // {PARENT} + least((coalesce(segments[i - 1].parent, 0) + coalesce(segments[i + 1].parent, 0)) // {NEAR}, {FAR})"
    return f"""WITH z AS (SELECT {entities} AS m),
a AS (SELECT {key}, m, {title} AS title, string_split('P' || {raw}, chr(4)) AS segments FROM {table}, z),
b AS (SELECT {key}, title, list_transform(segments, lambda s: {{'beside': s[1] = 'N', 'blocks': list_filter(list_transform(string_split(substr(s, 2), chr(5)), lambda b: {block}), lambda b: b.t <> '')}}) AS segments FROM a),
c AS (SELECT {key}, title, list_filter(list_transform(segments, lambda s: {{'beside': s.beside, 'blocks': list_transform(s.blocks, lambda b: {{'t': b.t, 'own': {own}, 'dense': 100 * {links} > {DENSE} * {n}}})}}), lambda s: len(s.blocks) > 0) AS segments FROM b),
d AS (SELECT {key}, title, list_transform(segments, lambda s: {{'beside': s.beside, 'blocks': s.blocks, 'parent': CASE WHEN s.beside THEN 0 ELSE list_sum(list_transform(s.blocks, lambda b: b.own)) END}}) AS segments FROM c),
e AS (SELECT {key}, title, list_filter(flatten(list_transform(segments, lambda s, i: list_transform(s.blocks, lambda b, j: {{'t': b.t, 'open': NOT b.dense AND NOT s.beside, 'score': {score}}}))), lambda b: b.open) AS blocks FROM d),
f AS (SELECT {key}, title, array_to_string(list_transform(list_filter(blocks, lambda b: b.score >= {ENOUGH}), lambda b: b.t), chr(10)) AS best, array_to_string(list_transform(blocks, lambda b: b.t), chr(10)) AS whole FROM e),
g AS (SELECT {key}, title, CASE WHEN octet_length(encode(best)) >= {MIN_BYTES} THEN best ELSE whole END AS text FROM f)
SELECT {key}, CASE WHEN octet_length(encode(text)) >= {MIN_BYTES} THEN title END AS title, CASE WHEN octet_length(encode(text)) >= {MIN_BYTES} THEN text END AS text, CASE WHEN octet_length(encode(text)) >= {MIN_BYTES} THEN octet_length(encode(text)) END AS text_length FROM g"""


def coarse_text(html: Column) -> Column:
    """Text of a page by regular expressions alone: scripts, styles and tags go, a few entities are read."""
    plain = F.regexp_replace(html, "(?is)<(script|style|noscript|head)\\b.*?</\\1>", " ")
    plain = F.regexp_replace(plain, "(?s)<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(plain, "[\\x{9}-\\x{d}\\x{20}]+", " "))


class HtmlTextRefiner(Refiner):
    """title, text and text_length (bytes) from html; null where there is no readable text."""

    def __init__(self, html_field: str = "html"):
        self.required_columns = (html_field,)
        self.html_field = html_field

    def refine(self, df: DataFrame) -> DataFrame:
        return with_readable(df, F.col(f"`{self.html_field}`"))
