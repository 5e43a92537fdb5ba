"""Operators: refiners add columns, filters keep rows, deduplicators keep the first row of each key."""

from corpusmill.operators.base import Combined, Deduplicator, Filter, Operator, Refiner
from corpusmill.operators.dedup import ImagePhashDeduplicator, SemanticDeduplicator, TextExactDeduplicator
from corpusmill.operators.filters import ImageQualityFilter, TextLengthFilter, UrlFilter

__all__ = ["Combined", "Deduplicator", "Filter", "ImagePhashDeduplicator", "ImageQualityFilter", "Operator", "Refiner", "SemanticDeduplicator", "TextExactDeduplicator", "TextLengthFilter", "UrlFilter"]
