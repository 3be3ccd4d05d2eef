"""Landing streams: bronze by event type and load date, dead letters and late rows.

One micro-batch makes one write. Its rows go to ``stream=<event type>/load_date=<date>/
batch=<id>`` folders, and lines that no type can take to ``stream=dead_letter`` with their
text and the reason. The load time is the file's own, so a batch that is run again gets the
same folders and overwrites exactly its own files.

Late rows: the watermark of a batch is the newest event time of the committed batches
less the allowed lateness, as Spark defines it for stateful operators, which drop what is
behind it. Here such rows go to a table of their own and can be applied later.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gamelake.functions import fixed
from gamelake.operators.incremental import read_table
from gamelake.operators.keyed_table import KeyedTable, load_order, ntz

DEAD = "dead_letter"
LANDED = "raw_data variant, filename string, load_ts timestamp_ntz, bad_line string, reason string, load_date date, batch string"


def read_lines(spark: SparkSession, src: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming NDJSON lines with their file and its time."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(src).select("value", F.col("_metadata.file_path").alias("filename"),
                              F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("load_ts"))


def routed(lines: DataFrame, event_types: list[str]) -> DataFrame:
    """Lines with the stream they belong to; what has no place gets a reason."""
    raw = F.try_parse_json("value")
    kind = F.try_variant_get(F.col("raw_data"), "$.event_type", "string")
    reason = (F.when(F.col("raw_data").isNull(), "not JSON").when(kind.isNull(), "no event type")
              .when(~kind.isin(event_types), "unknown event type"))
    return lines.withColumn("raw_data", raw).withColumn("reason", reason).select(
        F.when(F.col("reason").isNull(), F.col("raw_data")).alias("raw_data"), "filename", "load_ts",
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("bad_line"), "reason",
        F.when(F.col("reason").isNull(), kind).otherwise(DEAD).alias("stream"), F.to_date("load_ts").alias("load_date"))


def batch_label(checkpoint: str, batch_id: int) -> str:
    """One id for a micro-batch of one checkpoint: another checkpoint's batches never meet it."""
    return f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:8]}-{batch_id:08d}"


def land(dst: str, checkpoint: str, event_types: list[str]):
    """A ``foreachBatch`` function that writes one micro-batch to all its streams at once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        (routed(batch, event_types).withColumn("batch", F.lit(batch_label(checkpoint, batch_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("stream", "load_date", "batch").parquet(dst))
    return run


def ingest_by_type(spark: SparkSession, src: str, dst: str, checkpoint: str, event_types: list[str],
                   once: bool = True, max_files_per_trigger: int | None = None):
    """Load new files under ``src`` into bronze by event type (SRC-2, STR-1). Returns the query."""
    w = (read_lines(spark, src, max_files_per_trigger).writeStream.foreachBatch(land(dst, checkpoint, event_types))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")).start()


def _landed(spark: SparkSession, dst: str, stream: str) -> DataFrame:
    found = read_table(spark, f"{dst.rstrip('/')}/stream={stream}", StructType.fromDDL(LANDED))
    return spark.createDataFrame([], LANDED) if found is None else found


def landed_events(spark: SparkSession, dst: str, event_type: str) -> DataFrame:
    """Bronze rows of one event type, with ``load_date``; other types' folders are not listed."""
    return _landed(spark, dst, event_type).select("raw_data", "filename", "load_ts", "load_date")


def dead_letters(spark: SparkSession, dst: str) -> DataFrame:
    """Lines that no event type could take: text, reason, file, time."""
    return _landed(spark, dst, DEAD).select("bad_line", "reason", "filename", "load_ts", "load_date")


def loaded_since(landed: DataFrame, mark: str | None, lookback_days: int) -> DataFrame:
    """Rows loaded after a stored mark less the look-back (FLT-6): literals, so folders are pruned at planning."""
    if mark is None:
        return landed
    since = dt.datetime.fromisoformat(mark) - dt.timedelta(days=lookback_days)
    return landed.where((F.col("load_date") >= F.lit(since.date())) & (F.col("load_ts") >= ntz(since)))


def load_increment(table: KeyedTable, landed: DataFrame, build, ts_col: str = "event_timestamp",
                   lookback_days: int = fixed.INCREMENTAL_LOOKBACK_DAYS) -> DataFrame | None:
    """One run of an incremental staging model over landed bronze (FLT-6, SNK-1).

    The mark is a row of the table's own commit, so neither the target nor older load-date
    folders are read to find it. Returns the touched dates.
    """
    news = loaded_since(landed, table.value("mark"), lookback_days)
    newest = news.agg(F.max("load_ts")).first()[0]
    rows = build(news.drop("load_date")).withColumn(table.part_col, F.to_date(ts_col))
    return table.merge(rows, load_order(table.schema.names), None if newest is None else newest.isoformat())


class LateSplit:
    """A ``foreachBatch`` sink: rows on time are merged into a table, late rows are kept apart (STR-2, STR-5).

    ``transform`` turns a micro-batch into typed rows. Rows behind the watermark go to
    ``late_path`` by batch; on-time rows are merged by key, the last load winning. A batch run
    again before its commit sees the same watermark and overwrites its own late rows; after its
    commit it changes nothing. ``apply_late`` merges all late rows, which makes the table equal
    to the batch model.
    """

    def __init__(self, table: KeyedTable, late_path: str, label: str, transform=None, ts_col: str = "event_timestamp",
                 lateness_hours: int = fixed.MAX_LATENESS_HOURS):
        self.table, self.late_path, self.label, self.transform = table, late_path, label, transform
        self.ts_col, self.lateness = ts_col, dt.timedelta(hours=lateness_hours)

    def _late(self, mark: str | None) -> Column:
        if mark is None:
            return F.lit(False)
        return F.coalesce(F.col(self.ts_col) < ntz(dt.datetime.fromisoformat(mark) - self.lateness), F.lit(False))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        label = batch_label(self.label, batch_id)
        if self.table.value("batch") == label:
            return
        rows = self.transform(batch) if self.transform else batch
        rows = rows.withColumn(self.table.part_col, F.to_date(self.ts_col)).persist()  # three jobs read it
        mark = self.table.value("mark")
        if mark is not None:
            (rows.where(self._late(mark)).withColumn("batch", F.lit(label)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.late_path))
        newest = rows.agg(F.max(self.ts_col)).first()[0]
        if newest is not None:
            newest = newest.isoformat() if mark is None else max(newest, dt.datetime.fromisoformat(mark)).isoformat()
        self.table.merge(rows.where(~self._late(mark)), load_order(self.table.schema.names), newest or mark, label)
        rows.unpersist()

    def late_rows(self) -> DataFrame | None:
        """All rows that came behind the watermark, with their batch."""
        return read_table(self.table.spark, self.late_path)

    def apply_late(self) -> DataFrame | None:
        """Merge the late rows into the table; returns the touched dates. Doing it again changes nothing."""
        late = self.late_rows()
        return None if late is None else self.table.merge(late.drop("batch"), load_order(self.table.schema.names))
