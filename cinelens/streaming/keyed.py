"""Incremental ingest whose history is keyed state, not the target table (ST1-ST3).

One value per key on the RocksDB state store tells whether a key came before;
with a lateness bound a timer per key clears it once the watermark has passed,
so the state stays bounded. Running totals per group (for the target cap) are a
small table written with every batch. A batch reads its own rows, the state of
its own keys and the totals of the batch before it; the target is only written.

State, totals and rows are all tied to the batch id: a batch that is repeated
after a failure starts from the same state and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.utils import AnalysisException

from ..operators.dedup import cap_new_per_group, row_hash
from .ingest import BATCH_COL, open_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
_ORDERED = ("bigint", "int", "smallint", "tinyint", "double", "float", "string", "date", "timestamp")


def _rank(row: Row):
    """Order of a key's rows: by place (those without one last), then by row hash."""
    place = row["place"]
    return (True, 0, row["tie"]) if place is None or place != place else (False, place, row["tie"])


class FirstPerKey(StatefulProcessor):
    """Lets the first row of a key pass; forgets a key ``keep_ms`` after its event time, if given.

    Most keys have one row, so rows are taken as they are: a data frame per key costs more than the state.
    """

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "yes boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = min(rows, key=_rank, default=None)
        if first is None or self.seen.exists():
            return
        self.seen.update((True,))
        if self.keep_ms is not None:
            self.handle.registerTimer(first["event_ms"] + self.keep_ms)
        yield Row(payload=first["payload"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, key: str, ord: str, group_col: str | None = None, event_time: str | None = None,
               lateness: str | None = None) -> DataFrame:
    """First row (smallest ``ord``) per key, over all batches of the stream; with ``group_col`` per group and key.

    With ``event_time`` and ``lateness`` rows later than the watermark are
    dropped and a key is forgotten once no row in time can repeat it; rows
    without event time then count as late. Null keys are one key.
    """
    if dict(stream.dtypes)[ord] not in _ORDERED:
        raise ValueError(f"{ord!r} must be a plain number, text or time")
    schema = stream.schema
    packed = stream.select(
        *[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate([*([group_col] if group_col else []), key])],
        F.col(ord).alias("place"), row_hash(stream).alias("tie"),
        *([F.col(event_time).alias("event_time"), F.unix_millis(F.col(event_time).cast("timestamp")).alias("event_ms")] if event_time else []),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), _JSON).alias("payload"))
    keep_ms = None
    if event_time:
        keep_ms = int(pd.Timedelta(lateness).total_seconds() * 1000)
        packed = packed.withWatermark("event_time", lateness).where("event_time is not null")
    out = packed.groupBy(*[c for c in packed.columns if c in ("k0", "k1")]).transformWithState(
        FirstPerKey(keep_ms), "payload string", "Append", "EventTime" if event_time else "None")
    return out.select(F.from_json("payload", schema, _JSON).alias("r")).select("r.*")


def _totals(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Totals per group after the last batch before ``batch_id`` (one partition is read)."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException:
        return None
    last = table.where(F.col(BATCH_COL) < batch_id).agg(F.max(BATCH_COL)).first()[0]
    return None if last is None else table.where(F.col(BATCH_COL) == last).drop(BATCH_COL)


def make_writer(target_path: str, group_col: str | None, target: int | None, ord: str, on_batch=None):
    """``foreachBatch``: cap by the running totals, replace the batch's own partition, write the new totals."""
    totals_path = target_path.rstrip("/") + "_totals"

    def replace(df: DataFrame, path: str, batch_id: int) -> None:
        (df.withColumn(BATCH_COL, F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(path))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if target is None:
            replace(batch, target_path, batch_id)
        else:
            before = _totals(spark, totals_path, batch_id)
            replace(cap_new_per_group(batch, before, target, group_col, ord), target_path, batch_id)
        try:
            mine = spark.read.parquet(target_path).where(F.col(BATCH_COL) == batch_id).drop(BATCH_COL)
        except AnalysisException:
            return              # nothing was ever written
        if target is not None:
            now = mine.groupBy(group_col).agg(F.count(F.lit(1)).alias("existing"))
            both = now if before is None else now.unionByName(before).groupBy(group_col).agg(F.sum("existing").alias("existing"))
            replace(both.coalesce(1), totals_path, batch_id)
        if on_batch is not None:
            on_batch(mine, batch_id)
    return write


def ingest_keyed(spark: SparkSession, source: str, target_path: str, ord: str, checkpoint: str | None = None, fmt: str = "csv",
                 schema=None, transform=None, key: str = "Unique_ID", group_col: str | None = None, target: int | None = None,
                 event_time: str | None = None, lateness: str | None = None, on_batch=None, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest: each key once (per ``group_col``), at most ``target`` rows per group, rows by batch in ``target_path``.

    ``ord`` orders the rows of a batch (rows of earlier batches come first).
    The checkpoint lies beside the target unless given; source, state and
    target then go on together after a restart.
    """
    if target is not None and group_col is None:
        raise ValueError("a target needs group_col")
    if (event_time is None) != (lateness is None):
        raise ValueError("event_time and lateness go together")
    stream = open_stream(spark, source, fmt, schema, max_files_per_trigger)
    if transform is not None:
        stream = transform(stream)
    rows = first_rows(stream.drop("__file"), key, ord, group_col, event_time, lateness)
    w = rows.writeStream.foreachBatch(make_writer(target_path, group_col, target, ord, on_batch)).option(
        "checkpointLocation", checkpoint or target_path.rstrip("/") + "_checkpoint")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    had = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)      # the query keeps the setting it starts with
    try:
        return w.start()
    finally:
        spark.conf.set(_PROVIDER, had)


def run_keyed(spark: SparkSession, source: str, target_path: str, ord: str, **kw) -> DataFrame | None:
    """Run an AvailableNow ingest to its end and return the target table (None if nothing was ever written)."""
    q = ingest_keyed(spark, source, target_path, ord, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    try:
        return spark.read.parquet(target_path).drop(BATCH_COL)
    except AnalysisException:
        return None
