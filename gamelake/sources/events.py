"""Raw event files: NDJSON scan (SRC-1), bronze frame (SRC-3) and routed sink (SRC-5).

Bronze keeps the payload schemaless as VARIANT; typed columns are projected only in
staging. Malformed lines are kept with a NULL payload so that a quarantine check can
count them instead of the load silently dropping them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BRONZE_COLUMNS = ["raw_data", "filename", "load_ts"]


def bronze(df: DataFrame, payload: str = "raw_data") -> DataFrame:
    """Normalise a frame to the bronze contract: raw_data VARIANT, filename, load_ts.

    ``payload`` may be a VARIANT column or a JSON string column (parsed leniently).
    """
    dt = dict(df.dtypes)[payload]
    raw = F.col(payload) if dt == "variant" else F.try_parse_json(F.col(payload))
    return df.select(
        raw.alias("raw_data"),
        F.col("filename").cast("string").alias("filename"),
        F.col("load_ts").cast("timestamp_ntz").alias("load_ts"),
    )


def read_events(spark: SparkSession, path: str, event_type: str | None = None,
                glob: str | None = None, keep_bad_lines: bool = False) -> DataFrame:
    """Scan an NDJSON tree (``event_type/yyyy/mm/dd/hh/...``) into bronze rows.

    One JSON document per line, in files of any name unless ``glob`` says otherwise. File
    path and file modification time become ``filename`` and ``load_ts``. With
    ``event_type`` only that sub-tree is listed, so other event types are never opened;
    ``event_type=X`` folders, as ``write_events`` makes them, count as well.
    ``keep_bad_lines`` adds ``bad_line``: the text of a line that is no JSON.
    """
    src = path.rstrip("/") + (f"/{{{event_type},event_type={event_type}}}" if event_type else "")
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(src)
    raw = F.try_parse_json("value")
    bad = [F.when(raw.isNull(), F.col("value")).alias("bad_line")] if keep_bad_lines else []
    return df.select(
        raw.alias("raw_data"),
        F.col("_metadata.file_path").alias("filename"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("load_ts"), *bad,
    )


def event_hour_route(raw: Column, fallback_date: str | None = None) -> list[Column]:
    """Partition columns for the sink: event type and the hour of the event's own clock.

    The zone is dropped as staging drops it, so a row's folder and its staged date agree.
    An unparseable or missing timestamp falls back to ``fallback_date`` hour 00 when
    given, else to the literal partition ``unknown``.
    """
    ts = F.try_variant_get(raw, "$.timestamp", "timestamp_ntz")
    etype = F.coalesce(F.try_variant_get(raw, "$.event_type", "string"), F.lit("unknown"))
    if fallback_date:
        fb = F.lit(fallback_date).cast("timestamp_ntz")
        ts = F.coalesce(ts, fb)
        parts = [F.date_format(ts, p) for p in ("yyyy", "MM", "dd", "HH")]
    else:
        parts = [F.coalesce(F.date_format(ts, p), F.lit("unknown")) for p in ("yyyy", "MM", "dd", "HH")]
    return [etype.alias("event_type")] + [p.alias(n) for p, n in zip(parts, ("yyyy", "mm", "dd", "hh"))]


def write_events(df: DataFrame, path: str, max_rows: int = 5000,
                 fallback_date: str | None = None, mode: str = "append") -> None:
    """Write bronze payloads as NDJSON routed by event type and event hour (SRC-5).

    ``maxRecordsPerFile`` caps rows per output file, like the batch publisher's cap.
    Rows are clustered by the partition columns plus a small deterministic salt, so a
    hot hour is written by several tasks instead of one and a retried task rewrites
    exactly the same rows. A row without a payload is written as its ``bad_line`` where the
    frame has that column, and is left out otherwise.
    """
    line = F.to_json("raw_data")
    if "bad_line" in df.columns:
        line = F.coalesce(line, F.col("bad_line"))
    routed = df.where(line.isNotNull()).select(line.alias("value"),
                       *event_hour_route(F.col("raw_data"), fallback_date))
    keys = ["event_type", "yyyy", "mm", "dd", "hh"]
    salt = F.pmod(F.xxhash64("value"), F.lit(16))
    (routed.repartition(*keys, salt)
     .write.mode(mode).option("maxRecordsPerFile", max_rows)
     .partitionBy(*keys).text(path))


def read_routed_events(spark: SparkSession, path: str, event_type: str) -> DataFrame:
    """Read back a tree written by ``write_events`` for one event type."""
    return read_events(spark, path.rstrip("/") + f"/event_type={event_type}", glob=None)


def write_clustered(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                    sort_cols: list[str] | None = None, mode: str = "overwrite") -> None:
    """Physically cluster a table (SNK-2): directory partitions on low-cardinality
    columns (e.g. event_date) so date filters prune whole folders, and files that hold
    disjoint ranges of ``sort_cols``, sorted inside, so parquet min/max statistics skip
    files and row groups.

    Writers are ranges of (partition, sort columns), so a hot day falls to several; without
    sort columns Spark rebalances the partition values by size.
    """
    partition_cols = partition_cols or []
    sort_cols = sort_cols or []
    if sort_cols:
        df = df.repartitionByRange(*partition_cols, *sort_cols)
    elif partition_cols:
        df = df.hint("rebalance", *partition_cols)
    if sort_cols:
        df = df.sortWithinPartitions(*partition_cols, *sort_cols)
    w = df.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
