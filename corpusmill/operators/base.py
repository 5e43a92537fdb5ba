"""Kinds of operators. Each is a DataFrame transformation; the annotated form also keeps the rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column that says why a row was rejected; null: it was not.
DETAILS = "_rejection_details"
DETAILS_TYPE = "struct<reason:string,operator:string,dedup_key:string,representative_id:string>"
_ORDERS = ("id", "doc_id", "page_id")
#: Keys of most rows whose first rows are broadcast, so that their many rows need not meet; equal rows listed by one row.
HEAVY, CHUNK = 1000, 1_000_000


def details(reason: str, operator: str, key: Column | None = None, representative: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(reason).alias("reason"), F.lit(operator).alias("operator"), (none if key is None else key.cast("string")).alias("dedup_key"), (none if representative is None else representative.cast("string")).alias("representative_id"))


def with_details(df: DataFrame) -> DataFrame:
    return df if DETAILS in df.columns else df.withColumn(DETAILS, F.lit(None).cast(DETAILS_TYPE))


def default_order(df: DataFrame) -> Column:
    """The first id column there is; without one, the order of the scan, which is not stable over runs."""
    found = next((c for c in _ORDERS if c in df.columns), None)
    return F.col(found) if found else F.monotonically_increasing_id()


def row_hash(df: DataFrame, *salt: Column) -> Column:
    """A hash of all columns of a row; maps, which have no hash of their own, by their text."""

    def has_map(kind: T.DataType) -> bool:
        return isinstance(kind, T.MapType) or any(has_map(k) for k in ([f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else [kind.elementType] if isinstance(kind, T.ArrayType) else []))

    columns = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if has_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*salt, *columns)


class Operator:
    """name: the class's own, as rejected rows and metrics carry it."""

    required_columns: Sequence[str] = ()

    @property
    def name(self) -> str:
        return type(self).__name__

    def check(self, df: DataFrame) -> None:
        missing = [c for c in self.required_columns if c not in df.columns]
        if missing:
            raise ValueError(f"{self.name} needs the columns {missing}; there are {df.columns}")

    def transform(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def annotate(self, df: DataFrame) -> DataFrame:
        """All rows, those that this operator rejects marked in DETAILS; rows marked before are left alone."""
        raise NotImplementedError

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.transform(df)


class Refiner(Operator):
    """Adds columns and keeps all rows."""

    def refine(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        self.check(df)
        return self.refine(df)

    def annotate(self, df: DataFrame) -> DataFrame:
        return self.transform(with_details(df))


class Filter(Operator):
    """Keeps the rows for which a predicate holds; it is a Column, so Catalyst may push it into the scan."""

    def predicate(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        self.check(df)
        return df.where(F.coalesce(self.predicate(df), F.lit(False)))

    def annotate(self, df: DataFrame) -> DataFrame:
        self.check(df)
        df = with_details(df)
        drop = F.col(DETAILS).isNull() & ~F.coalesce(self.predicate(df), F.lit(False))
        return df.withColumn(DETAILS, F.when(drop, details("filtered", self.name)).otherwise(F.col(DETAILS)))


class Deduplicator(Operator):
    """Keeps the first row of each key in the order of order_by, and the rest of the columns breaks no ties."""

    def __init__(self, order_by: str | None = None, representative_id_field: str = "id", track_representative: bool = True):
        self.order_by, self.representative_id_field, self.track_representative = order_by, representative_id_field, track_representative

    def key(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def _order(self, df: DataFrame) -> Column:
        return F.col(self.order_by) if self.order_by else default_order(df)

    def keyed(self, df: DataFrame) -> DataFrame:
        """df with the column _key."""
        return df.withColumn("_key", self.key(df))

    def transform(self, df: DataFrame) -> DataFrame:
        """Only survivors: a grouped minimum, combined before the shuffle, so a key of many rows meets as one row a task.

        Each column has an aggregate of its own, so columns that the query does not use are neither read nor shuffled;
        all of them follow the same row.
        """
        self.check(df)
        order = self._order(df)
        plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))]
        rank = F.struct(order.isNull(), order, F.xxhash64(*plain) if plain else F.lit(0))
        keyed = self.keyed(df).select("_key", rank.alias("_rank"), *(F.col(f"`{c}`") for c in df.columns))
        first = keyed.groupBy("_key").agg(*(F.min_by(F.col(f"`{c}`"), "_rank").alias(c) for c in df.columns))
        return first.select(*(F.col(f"`{c}`") for c in df.columns))

    def annotate(self, df: DataFrame) -> DataFrame:
        """All rows; those behind the first of their key are marked. Rows rejected before take no part.

        First rows and counts come from an aggregate that is combined before the shuffle. Rows find the first one of their
        key by a join; the keys of most rows by a broadcast of at most HEAVY first rows, and their rows are spread by
        their hash then, so no key is the work of one task. Rows that are equal in all columns are one row with a count
        where one of them is first, and are listed again behind it.
        """
        self.check(df)
        df = with_details(df)
        rep = self.representative_id_field if self.representative_id_field in df.columns else next((c for c in _ORDERS if c in df.columns), None)
        who = F.coalesce(F.col(rep).cast("string"), F.lit("")) if rep and self.track_representative else F.lit(None).cast("string")
        order, hash_ = self._order(df), row_hash(df)
        row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
        live = F.col(f"row.{DETAILS}").isNull()
        # k and a key, so that other values can stand beside the keys below; rows of null key have one, too
        group = F.when(F.col("_key").isNull(), "n").otherwise(F.concat(F.lit("k"), F.col("_key").cast("string")))
        rows = self.keyed(df).select(row.alias("row"), F.col("_key").alias("key"), group.alias("group"), F.struct(order.isNull().alias("none"), order.alias("at"), hash_.alias("hash")).alias("rank"), who.alias("who"))
        several = rows.where(live).groupBy("group").agg(F.min("rank").alias("first"), F.min_by("who", "rank").alias("by"), F.count("*").alias("n")).where("n > 1")
        heavy = several.orderBy(F.desc("n"), "group").limit(HEAVY).select("group", F.col("first").alias("heavy_first"), F.col("by").alias("heavy_by"))
        met = rows.join(F.broadcast(heavy), "group", "left")
        done = F.col("heavy_first").isNotNull() | ~live
        # rows that are done meet nothing and are dealt out by their hash
        met = met.withColumn("group", F.when(done, F.concat(F.lit("r"), F.col("rank.hash").cast("string"))).otherwise(F.col("group")))
        joined = met.join(several.select("group", "first", "by"), "group", "left")
        joined = joined.select("row", "key", "rank", F.when(live, F.coalesce("heavy_first", "first")).alias("first"), F.coalesce("heavy_by", "by").alias("by"))
        leads = F.coalesce(F.col("rank") == F.col("first"), F.lit(False))
        mark = F.when(F.col("first").isNotNull(), details("duplicate", self.name, F.col("key"), F.col("by"))).otherwise(F.col(f"row.{DETAILS}"))
        rest = joined.where(~leads).select("row", mark.alias("mark"))
        alike = joined.where(leads).groupBy("key").agg(F.first("row").alias("row"), F.first("by").alias("by"), F.count("*").alias("n"))
        flat = alike.select("key", "by", "n", *(F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)))
        chunks = flat.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("n") - 1, F.lit(CHUNK)))))
        each = F.sequence(F.col("chunk") * CHUNK, F.least((F.col("chunk") + 1) * CHUNK, F.col("n")) - 1)
        listed = chunks.withColumn("copy", F.explode(each))
        own = F.when(F.col("copy") > 0, details("duplicate", self.name, F.col("key"), F.col("by"))).otherwise(F.lit(None).cast(DETAILS_TYPE))
        first = listed.select(*((own if c == DETAILS else F.col(f"c{i}")).alias(c) for i, c in enumerate(df.columns)))
        return rest.select(*((F.col("mark") if c == DETAILS else F.col(f"row.`{c}`")).alias(c) for c in df.columns)).union(first)


class Combined(Operator):
    """Operators one after the other."""

    def __init__(self, operators: Sequence[Operator]):
        self.operators = list(operators)

    def transform(self, df: DataFrame) -> DataFrame:
        return reduce(lambda out, op: op.transform(out), self.operators, df)

    def annotate(self, df: DataFrame) -> DataFrame:
        return reduce(lambda out, op: op.annotate(out), self.operators, with_details(df))


def passed(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col(DETAILS).isNull()).drop(DETAILS)


def rejected(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col(DETAILS).isNotNull())
