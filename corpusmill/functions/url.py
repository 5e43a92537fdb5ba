"""URL parts and the word score of URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark unwanted sites, with severities.
WORD_WEIGHTS = {
    "porn": 1.0, "xxx": 1.0, "sex": 0.8, "adult": 0.6, "nude": 0.9, "naked": 0.9, "erotic": 0.9, "nsfw": 1.0, "hentai": 1.0, "webcam": 0.5, "escort": 0.8, "fetish": 0.9,
    "casino": 0.9, "poker": 0.7, "gambling": 0.9, "betting": 0.8, "slot": 0.6, "jackpot": 0.7,
    "gore": 0.9, "hack": 0.5, "crack": 0.5, "warez": 0.9, "torrent": 0.6, "pirate": 0.6,
    "free-money": 0.8, "get-rich": 0.8, "click-here": 0.5, "buy-now": 0.4, "limited-offer": 0.5,
}
# Domains of curated sources.
QUALITY_SOURCES = (
    "wikipedia.org", "wikimedia.org", "wikidata.org", "wikisource.org", "wikibooks.org", "wikiquote.org", "wikinews.org", "wikivoyage.org", "wiktionary.org",
    "arxiv.org", "pubmed.gov", "ncbi.nlm.nih.gov", "scholar.google.com", "semanticscholar.org", "acm.org", "ieee.org", "springer.com", "sciencedirect.com", "nature.com", "plos.org",
    "github.com", "gitlab.com", "bitbucket.org", "sourceforge.net",
    "stackoverflow.com", "stackexchange.com", "superuser.com", "serverfault.com", "askubuntu.com", "mathoverflow.net",
    "gutenberg.org", "archive.org", "openlibrary.org", "britannica.com", "encyclopedia.com",
)


def domain(url: Column, normalize_host: bool = False) -> Column:
    """Lower-cased authority of a URL, null if there is none; with normalize_host without user and port.

    A URL that begins with neither http:// nor https:// (in lower case) counts as one without a scheme.
    """
    clean = F.translate(url, "\t\r\n", "")
    full = F.when(clean.startswith("http://") | clean.startswith("https://"), clean).otherwise(F.concat(F.lit("http://"), clean))
    host = F.lower(F.regexp_extract(full, "^[^:]+://([^/?#]*)", 1))
    if normalize_host:
        host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":\\d*$", "")
    return F.nullif(host, F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all its parent domains, the last label included."""
    labels = F.split(host, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def in_domains(host: Column, domains, subdomains: bool = True) -> Column:
    """Whether host, or with subdomains one of its parents, is one of the domains; false for null."""
    wanted = F.array(*(F.lit(d) for d in sorted(domains))).cast("array<string>")
    found = F.arrays_overlap(suffixes(host), wanted) if subdomains else F.array_contains(wanted, host)
    return F.coalesce(found, F.lit(False)) if domains else F.lit(False)


def word_matches(url: Column, weights: dict[str, float]) -> Column:
    """Words of weights found in the lower-cased URL from left to right, the longest first at each place."""
    if not weights:
        return F.array().cast("array<string>")
    pattern = "(" + "|".join(re.escape(w) for w in sorted(weights, key=lambda w: (-len(w), w))) + ")"
    return F.regexp_extract_all(F.lower(url), F.lit(pattern), F.lit(1))


def word_score(url: Column, weights: dict[str, float]) -> Column:
    """0.8 of the highest weight found and up to 0.2 for a third of their sum, at most 1; 0 without a match."""
    if not weights:
        return F.lit(0.0)
    weight = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair))
    found = F.transform(word_matches(url, weights), lambda w: F.try_element_at(weight, w))
    total = F.aggregate(found, F.lit(0.0), lambda a, x: a + x)
    score = F.least(F.lit(1.0), F.array_max(found) * 0.8 + F.least(total / 3.0, F.lit(0.2)))
    return F.when(F.size(found) > 0, score).otherwise(F.lit(0.0))
