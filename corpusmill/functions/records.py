"""Partition keys from nested fields and JSON strings, and value formats of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def partition_key(df: DataFrame, path: str) -> Column:
    """The value at a dotted path through structs, maps and JSON strings as a safe folder name; "unknown" if missing."""
    head, *rest = path.split(".")
    if head not in df.columns:
        return F.lit("unknown")
    value, kind = F.col(f"`{head}`"), df.schema[head].dataType
    while rest:
        if isinstance(kind, T.StringType):
            value, rest, kind = F.get_json_object(value, "$." + ".".join(rest)), [], T.StringType()
        elif isinstance(kind, T.StructType) and rest[0] in kind.names:
            value, kind, rest = value.getField(rest[0]), kind[rest[0]].dataType, rest[1:]
        elif isinstance(kind, T.MapType):
            value, kind, rest = F.try_element_at(value, F.lit(rest[0])), kind.valueType, rest[1:]
        else:
            return F.lit("unknown")
    return safe_key(value.cast("string"))


def safe_key(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(F.nullif(value, F.lit("")), F.lit("unknown")), "[^\\p{L}\\p{N}_-]", "_")


def formatted(value: Column, kind: str, precision: int = 2) -> Column:
    """percent, time, latency (seconds as milliseconds), number or integer as text; N/A for null and NaN."""
    number = value.cast("double")
    shape = f"%.{precision}f"
    text = {
        "percent": F.format_string(shape + "%%", number),
        "time": F.format_string(shape + "s", number),
        "latency": F.format_string(shape + "ms", number * 1000),
        "number": F.format_string(f"%,.{precision}f", number),
        "integer": F.format_string("%,d", number.cast("long")),
    }.get(kind, value.cast("string"))
    return F.when(number.isNull() | F.isnan(number), F.lit("N/A")).otherwise(text)
