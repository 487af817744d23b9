"""Incremental review ingest with exactly-once effect (ST1-ST5).

``readStream`` (file source, explicit schema) -> optional stateless
transform -> optional state-store dedup -> ``foreachBatch``. Each
micro-batch keeps the first row per key (by ``ord``), drops keys already in
the target table (F3), applies the target cap (F5) and appends. Because the
batch is compared with what the target already holds, a replayed batch
(after a failure between the write and the checkpoint commit) appends
nothing, so the target gets each key once. The checkpoint lives beside the
target unless given, so a restart goes on where the last run ended.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from ..operators.dedup import new_reviews
from ..session import scratch_path
from ..sources.csv import CSV_OPTIONS, RAW_SCHEMA, normalise_reviews

BATCH_COL = "ingest_batch"


def _read_target(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def open_stream(spark: SparkSession, source: str, fmt: str = "csv", schema=None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream with an explicit schema and the source file path attached.

    CSV files are read and normalised as by ``read_reviews``.
    """
    r = spark.readStream.format(fmt).schema(schema if schema is not None else RAW_SCHEMA)
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.load(source).withColumn("__file", F.col("_metadata.file_path"))
    return normalise_reviews(rows) if fmt == "csv" else rows


def make_batch_writer(target_path: str, key: str = "Unique_ID", target: int | None = None,
                      on_batch=None, group_col: str | None = None):
    """The ``foreachBatch`` function: F3 + D3 + F5, append, then ``on_batch``.

    The target is partitioned by the batch id, so the hook reads the batch's
    own files only. With ``group_col`` it is partitioned by that first;
    history, de-duplication and the target then apply per group, and the
    history is joined with the batch's groups (a partition column).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if "ord" not in rows.columns:
            rows = rows.withColumn("ord", F.struct(F.col("__file").alias("file"),
                                                   F.monotonically_increasing_id().alias("pos")))
        rows = rows.drop("__file")
        known = _read_target(spark, target_path)
        if known is not None and group_col:
            known = known.join(rows.select(group_col).distinct(), group_col, "left_semi")
        fresh = new_reviews(rows, known.drop(BATCH_COL) if known is not None else None, key, "ord", target,
                            group=group_col)
        parts = [*([group_col] if group_col else []), BATCH_COL]
        # whole groups to few files, large ones split
        (fresh.withColumn(BATCH_COL, F.lit(batch_id)).hint("rebalance", *parts)
         .write.mode("append").partitionBy(*parts).parquet(target_path))
        if on_batch is not None:
            appended = spark.read.parquet(target_path).where(F.col(BATCH_COL) == batch_id).drop(BATCH_COL)
            on_batch(appended, batch_id)
    return write


def ingest_stream(spark: SparkSession, source: str, target_path: str, checkpoint: str | None = None,
                  fmt: str = "csv", schema=None, transform=None, key: str = "Unique_ID",
                  target: int | None = None, dedup_state: str = "none", event_time: str | None = None,
                  lateness: str | None = None, on_batch=None, available_now: bool = True,
                  max_files_per_trigger: int | None = None, group_col: str | None = None) -> StreamingQuery:
    """ST1-ST5: start the ingest query (``awaitTermination()`` for AvailableNow runs).

    ``dedup_state``: ``"none"`` (dedup against the target table only),
    ``"all"`` (``dropDuplicates`` -- state grows with the key space) or
    ``"watermark"`` (``dropDuplicatesWithinWatermark`` on ``event_time`` with
    ``lateness`` -- bounded state). ``on_batch(rows, batch_id)`` receives the
    rows appended by the batch, e.g. to load the star schema (ST4) or to score
    them (ST5); it must be idempotent, since a batch may be replayed.
    """
    stream = open_stream(spark, source, fmt, schema, max_files_per_trigger)
    if transform is not None:
        stream = transform(stream)
    if dedup_state == "all":
        stream = stream.dropDuplicates([key])
    elif dedup_state == "watermark":
        if not (event_time and lateness):
            raise ValueError("watermark dedup needs event_time and lateness")
        stream = stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key])
    elif dedup_state != "none":
        raise ValueError(f"unknown dedup_state {dedup_state!r}")
    checkpoint = checkpoint or target_path.rstrip("/") + "_checkpoint"
    w = (stream.writeStream.foreachBatch(make_batch_writer(target_path, key, target, on_batch, group_col))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def run_ingest(spark: SparkSession, source: str, target_path: str, **kw) -> DataFrame:
    """Run an AvailableNow ingest to completion and return the target table."""
    q = ingest_stream(spark, source, target_path, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    out = _read_target(spark, target_path)
    return out.drop(BATCH_COL) if out is not None else None


def score_batches(score, out_path: str):
    """ST5: an ``on_batch`` that scores fresh rows; a replayed batch replaces its own partition."""

    def run(rows: DataFrame, batch_id: int) -> None:
        (score(rows).withColumn(BATCH_COL, F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(out_path))
    return run


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return os.path.join(scratch_path(spark, "streams"), f"{name}-{uuid.uuid4().hex}")
