"""Structured Streaming jobs (SRC-2 / STR-1..STR-5).

All sinks are checkpointed, so a restarted or re-run query resumes from its offsets
and a second ``availableNow`` run over the same files adds no rows. Checkpoints and
outputs belong under shared storage (``spark.checkpoint.dir`` on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.functions import fixed
from gamelake.functions.semantics import datediff_boundary
from gamelake.operators.incremental import merge_into_partitions


def read_event_stream(spark: SparkSession, src: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming NDJSON source: one bronze row per line, file path and load time captured."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(src).select(
        F.try_parse_json("value").alias("raw_data"),
        F.col("_metadata.file_path").alias("filename"),
        F.current_timestamp().cast("timestamp_ntz").alias("load_ts"))


def ingest(spark: SparkSession, src: str, dst: str, checkpoint: str, once: bool = True):
    """Continuously append new NDJSON files under ``src`` to a bronze parquet table (SRC-2).

    ``once=True`` processes everything available and stops (availableNow); otherwise
    the query keeps running and picks up files as they land. Returns the query.
    """
    w = (read_event_stream(spark, src).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start(dst)


def stream_dedup(sdf: DataFrame, key: str = "event_id", ts: str = "event_timestamp",
                 lateness_hours: int = fixed.MAX_LATENESS_HOURS) -> DataFrame:
    """Drop at-least-once duplicates by key within the lateness bound (STR-2).

    Keeps the FIRST arrival; state for a key is dropped once the watermark passes, so
    state stays bounded by the lateness window. Where the last load must win, use
    ``merge_batch`` instead.
    """
    # watermarks need TIMESTAMP (LTZ); the session clock is UTC so the cast keeps the instant
    wm = sdf.withColumn("_event_time", F.col(ts).cast("timestamp"))
    return (wm.withWatermark("_event_time", f"{lateness_hours} hours")
            .dropDuplicatesWithinWatermark([key]).drop("_event_time"))


def merge_batch(spark: SparkSession, target_path: str, key: str = "event_id", part_col: str = "event_date",
                transform=None):
    """A ``foreachBatch`` function: stage the micro-batch (optional ``transform``), keep the
    last load per key inside the batch (rows of one file and load time are told apart by a
    hash, not by their order), and upsert it into the touched date partitions
    of ``target_path`` (STR-3). Late events are picked up because batches are cut by
    load time, not event time. Re-running a batch id rewrites the same partitions with
    the same rows, so a retried batch is harmless."""
    from gamelake.operators.dedup import latest_by, load_order

    def run(batch: DataFrame, batch_id: int) -> None:
        b = transform(batch) if transform else batch
        b = latest_by(b.where(F.col(key).isNotNull()), key, load_order(b.columns))
        b = b.withColumn(part_col, F.to_date("event_timestamp"))
        merge_into_partitions(spark, b, target_path, key, part_col)
    return run


ACTIVITY_KEYS = ["player_id", "activity_date", "platform", "region"]


def stream_daily_activity(sdf: DataFrame, lateness_hours: int = fixed.MAX_LATENESS_HOURS) -> DataFrame:
    """Daily activity per player maintained by a stateful streaming aggregation (STR-5).

    Run in update mode: each trigger emits the current totals of the groups it touched;
    upserting them by (player, date, platform, region) keeps the table equal to the batch
    model over the events within ``lateness_hours`` of the newest one. The watermark bounds
    state to days that can still receive events; later events are not counted here and
    reach the table through the batch model, which reads them from staging.
    """
    a = F.col("action")
    g = (sdf.withColumn("_event_time", F.col("event_timestamp").cast("timestamp"))
         .withWatermark("_event_time", f"{lateness_hours} hours")
         .groupBy(F.window("_event_time", "1 day").alias("w"), "player_id", "platform", "region")
         .agg(F.count(F.lit(1)).alias("total_events"),
              F.count_if(a == "login").alias("login_count"),
              F.count_if(a == "match_start").alias("matches_started"),
              F.count_if(a == "match_end").alias("matches_ended"),
              F.count_if(a == "store_visit").alias("store_visits"),
              F.min("event_timestamp").alias("first_event_at"),
              F.max("event_timestamp").alias("last_event_at")))
    return g.select("player_id", F.to_date(F.col("w.start").cast("timestamp_ntz")).alias("activity_date"),
                    "platform", "region",
                    "total_events", "login_count", "matches_started", "matches_ended", "store_visits",
                    "first_event_at", "last_event_at",
                    datediff_boundary("minute", "first_event_at", "last_event_at").alias("active_minutes"))


def upsert_activity(spark: SparkSession, target_path: str):
    """``foreachBatch`` sink for ``stream_daily_activity``: replace touched groups."""
    def run(batch: DataFrame, batch_id: int) -> None:
        merge_into_partitions(spark, batch, target_path, ACTIVITY_KEYS, "activity_date")
    return run


SESSION_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("player_id", T.StringType()), T.StructField("session_id", T.StringType()),
    T.StructField("action", T.StringType()), T.StructField("platform", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("client_version", T.StringType()),
    T.StructField("filename", T.StringType()), T.StructField("load_ts", T.TimestampNTZType()),
])
