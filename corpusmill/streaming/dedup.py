"""Exact deduplication of a stream, with or without the first row of each key, and micro-batches to sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusmill.functions.text import content_key


def deduplicate(stream: DataFrame, text_field: str = "text", id_field: str = "id", event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """First arrival of each content key. With an event time, keys are forgotten after delay; without, never."""
    own = F.col(id_field).cast("string") if id_field in stream.columns else F.lit("")
    keyed = stream.withColumn("dedup_key", content_key(F.col(text_field), own))
    if event_time:
        return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["dedup_key"])
    return keyed.dropDuplicates(["dedup_key"])


_STORE, _IDLE = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_OWN = "dedup_own_id"


class FirstArrival(StatefulProcessor):
    """Keeps the id of the first row of each key, for ttl after it or for ever, and names it in all later rows.

    The name is Spark's text of the id, in _OWN: pandas makes floats of whole numbers beside a null. Where whole, ids are such texts too.
    """

    def __init__(self, id_field: str, columns: list[str], ttl: timedelta | None, whole: bool = False):
        self.id_field, self.columns, self.ttl, self.whole = id_field, columns, ttl, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = None if self.ttl is None else max(1, int(self.ttl.total_seconds() * 1000))
        self.first = handle.getValueState("first", T.StructType([T.StructField("id", T.StringType())]), ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.first.get()[0] if self.first.exists() else None
        for part in rows:
            who = [known] * len(part)
            if known is None and len(part):
                ids = part[self.id_field].tolist()
                at = min((k for k, own in enumerate(ids) if not pd.isna(own)), key=lambda k: int(ids[k]) if self.whole else ids[k], default=0)
                known = part[_OWN].iloc[at]
                self.first.update((known,))
                who = [None if k == at else known for k in range(len(part))]
            yield part.assign(representative_id=pd.Series(who, index=part.index, dtype=object))[self.columns]

    def close(self) -> None:
        pass


def use_key_state(spark: SparkSession) -> None:
    """Settings of the session for streams begun from now on: the store that keeps named values, on disk, and no batches
    without data, which by the clock would go on for ever in a stream that is to end with what is there."""
    spark.conf.set(_STORE, _ROCKS)
    spark.conf.set(_IDLE, "false")


def annotate(stream: DataFrame, text_field: str = "text", id_field: str = "id", ttl: timedelta | None = None) -> DataFrame:
    """All rows of stream, with dedup_key and representative_id: the id of the first row of its key, null in that row itself.

    First means the first batch, and in it the first part of a key's rows to be read and there the smallest id. Over
    restarts from one checkpoint the id stays; with ttl it is forgotten so long after that row, by the clock of the
    tasks. A null id is named as the empty string. Rows of a key are read in parts, so none has to fit into memory; call
    use_key_state() before the stream starts.
    """
    own = F.col(id_field).cast("string")
    keyed = stream.withColumn("dedup_key", content_key(F.col(text_field), own))
    # whole numbers pass pandas as texts, as it has only floats for those beside a null
    longs = {f.name for f in keyed.schema if isinstance(f.dataType, T.LongType)}
    fields = [T.StructField(f.name, T.StringType()) if f.name in longs else f for f in keyed.schema]
    schema = T.StructType([*fields, T.StructField("representative_id", T.StringType())])
    passed = keyed.withColumns({c: F.col(c).cast("string") for c in longs} | {_OWN: F.coalesce(own, F.lit(""))})
    processor = FirstArrival(id_field, schema.names, ttl, id_field in longs)
    marked = passed.groupBy("dedup_key").transformWithStateInPandas(processor, schema, "Append", "None" if ttl is None else "ProcessingTime")
    return marked.select(*(F.col(c).cast("long").alias(c) if c in longs else F.col(c) for c in schema.names))


def start(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], once: bool = True):
    """Runs sink on every micro-batch; once ends with what is there now."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
