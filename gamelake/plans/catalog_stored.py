"""Keys of stored tables and streams that run more than once: each builds its table in several
commits or triggers and returns the stored result, which must equal the one-shot model."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from gamelake.functions import fixed
from gamelake.operators.incremental import maintain_mart, refresh_dau_mau_spans, within
from gamelake.operators.keyed_table import HistoryTable, KeyedTable
from gamelake.plans.catalog import models, register
from gamelake.plans.catalog_checks import ARRIVAL_COLS, SESSION_COLS, SNAP_FIRST_RUN, _sink_path
from gamelake.plans.intermediate import int_player_daily_activity
from gamelake.plans.player import fct_dau_mau
from gamelake.plans.snapshot import CHECK_COLS, mmr_state
from gamelake.plans.staging import stg_sessions
from gamelake.streaming import landing
from gamelake.streaming.ingest import SESSION_SCHEMA


def sessions_table(spark, root) -> KeyedTable:
    """Staged sessions by event id in event-date partitions."""
    schema = StructType([*SESSION_SCHEMA.fields, StructField("event_date", DateType())])
    return KeyedTable(spark, root, "event_id", "event_date", schema, n_buckets=16)


def _landed_sessions(spark, sf, base):
    """The session events as a bronze table in load-date folders."""
    raw = models(spark, sf).raw["session_event"]
    raw.withColumn("load_date", F.to_date("load_ts")).write.partitionBy("load_date").parquet(f"{base}/bronze")
    return spark.read.schema("raw_data variant, filename string, load_ts timestamp_ntz, load_date date").parquet(f"{base}/bronze")


def _cutoff(df, col, days):
    """``days`` before the newest value, as a Python value (one aggregate row)."""
    import datetime as dt
    return df.agg(F.max(col)).first()[0] - dt.timedelta(days=days)


@register("merge_commit")
def _merge_commit(spark, sf):
    """Three incremental loads of a keyed table by mark, index and commit; equals the full staging model."""
    base = _sink_path(spark, "merge-commit")
    landed = _landed_sessions(spark, sf, base)
    table = sessions_table(spark, base + "/sessions")
    for days in (10, 5, 0):
        landing.load_increment(table, landed.where(F.col("load_ts") <= F.lit(str(_cutoff(landed, "load_ts", days))).cast("timestamp_ntz")), stg_sessions)
    return table.read().select(*SESSION_COLS, "event_date")


@register("snap_player_mmr_stored")
def _snap_stored(spark, sf):
    """Two stored snapshot runs: closed versions appended, open ones replaced."""
    import datetime as dt
    mmr = models(spark, sf).stg_mmr_updates
    states = [dt.datetime.fromisoformat(SNAP_FIRST_RUN), _cutoff(mmr, "event_timestamp", 0)]
    table = HistoryTable(spark, _sink_path(spark, "snap-mmr"), "player_id", CHECK_COLS, mmr_state(mmr).schema)
    for when in states:
        table.run(mmr_state(mmr, F.lit(str(when)).cast("timestamp_ntz")), when)
    return table.read()


@register("ingest_by_type")
def _ingest_by_type(spark, sf):
    """Two runs of the landing stream over files of three types and broken lines; rows by stream and reason."""
    raw = models(spark, sf).raw
    base = _sink_path(spark, "ingest-types")
    kinds = ["session_event", "store_transaction"]
    text = F.to_json("raw_data")
    for kind in [*kinds, "progression_event"]:  # the last one is no stream of this run
        raw[kind].select(text.alias("value")).write.text(f"{base}/landing/{kind}")
    broken = raw["store_transaction"].select(F.explode(F.array(
        F.expr("substring(to_json(raw_data), 1, 20)"), F.concat(F.lit("["), text, F.lit("]")))).alias("value"))
    broken.write.text(f"{base}/landing/broken")
    for _ in range(2):  # the second run finds no new file and adds nothing
        landing.ingest_by_type(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_checkpoint", kinds).awaitTermination()
    good = None
    for kind in kinds:
        rows = landing.landed_events(spark, f"{base}/bronze", kind).select(
            F.lit(kind).alias("stream"), F.lit("").alias("reason"), F.try_variant_get("raw_data", "$.event_id", "string").alias("id"))
        good = rows if good is None else good.unionByName(rows)
    bad = landing.dead_letters(spark, f"{base}/bronze").select(F.lit(landing.DEAD).alias("stream"), "reason", F.col("bad_line").alias("id"))
    return good.unionByName(bad).groupBy("stream", "reason").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("id").isNull(), 1)).alias("without_id"))


def _late_run(spark, sf, base):
    """Two triggers of the splitting stream: newer days first, then older ones that come late."""
    stg_sessions(models(spark, sf).raw["session_event"]).write.parquet(f"{base}/staged")  # three jobs read it
    typed = spark.read.schema(SESSION_SCHEMA).parquet(f"{base}/staged")
    cut = _cutoff(typed, "event_timestamp", 1)
    literal = F.lit(str(cut)).cast("timestamp_ntz")
    table = sessions_table(spark, base + "/sessions")
    sink = landing.LateSplit(table, base + "/late", base + "/_checkpoint")
    for k, part in enumerate((F.col("event_timestamp") >= literal, F.col("event_timestamp") < literal)):
        typed.where(part).write.parquet(f"{base}/typed/{k}")
        stream = spark.readStream.schema(SESSION_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{base}/typed")
        (stream.writeStream.foreachBatch(sink).option("checkpointLocation", base + "/_checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    return table, sink


@register("stream_late_rows")
def _stream_late_rows(spark, sf):
    """Every event of two triggers: on time in the table, or late in an output of its own."""
    table, sink = _late_run(spark, sf, _sink_path(spark, "late"))
    on_time = table.read().select(*ARRIVAL_COLS, F.lit(False).alias("late"))
    late = sink.late_rows()
    return on_time if late is None else on_time.unionByName(late.select(*ARRIVAL_COLS, F.lit(True).alias("late")))


@register("stream_late_applied")
def _stream_late_applied(spark, sf):
    """Daily activity after the late rows were merged and the touched days recomputed: the batch model."""
    base = _sink_path(spark, "late-applied")
    table, sink = _late_run(spark, sf, base)
    schema = int_player_daily_activity(table.read()).schema
    days = KeyedTable(spark, base + "/activity", [f.name for f in schema.fields[:4]], "activity_date", schema, n_buckets=16)
    days.merge(int_player_daily_activity(table.read()))
    touched = [r["event_date"] for r in sink.apply_late().collect()]  # dates
    spans = [(d, d) for d in touched]
    days.replace(int_player_daily_activity(table.read().where(within("event_date", spans))), touched)
    return days.read().select(*schema.names)


@register("mart_lookback_spans")
def _mart_spans(spark, sf):
    """DAU/MAU stored without one early day and the newest week, then maintained for the touched dates only."""
    base = _sink_path(spark, "dau-spans")
    activity = models(spark, sf).int_player_daily_activity
    activity.write.partitionBy("activity_date").parquet(base + "/activity")
    stored = spark.read.parquet(base + "/activity").select(*activity.columns)
    newest, first = _cutoff(stored, "activity_date", 7), stored.agg(F.min("activity_date")).first()[0]
    held = (F.col("activity_date") > F.lit(newest)) | (F.col("activity_date") == F.lit(first))
    path = base + "/fct_dau_mau"
    full = fct_dau_mau(stored.where(~held))
    maintain_mart(spark, path, "metric_date", full, None, None)
    touched = stored.where(held).select(F.col("activity_date").alias("event_date")).distinct()
    return maintain_mart(spark, path, "metric_date", full, lambda target, spans: refresh_dau_mau_spans(target, stored, spans),
                         touched, days_after=fixed.MAU_DAYS - 1)


@register("match_survivor_payloads")
def _payloads(spark, sf):
    """Survivor rows with fields read from their own whole payload, which staging keeps on request."""
    e = models(spark, sf, complete=True).match_survivors("player_id", "score")
    return e.select("match_id", "survivor_player_id", "survivor_score",
                    F.try_variant_get("survivor_payload", "$.player_id", "string").alias("payload_player_id"),
                    F.try_variant_get("survivor_payload", "$.score", "bigint").alias("payload_score"))


@register("stored_marts")
def _stored_marts(spark, sf):
    """Every mart as a stored table: its number of rows."""
    m = models(spark, sf, materialize=True)
    out = None
    for name in ("fct_dau_mau", "fct_player_retention", "fct_player_lifetime", "dim_players", "fct_match_outcomes",
                 "fct_perk_performance", "fct_map_balance", "fct_mmr_distribution", "fct_daily_revenue", "fct_arpdau", "fct_store_conversion"):
        n = getattr(m, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("mart"), "rows")
        out = n if out is None else out.unionByName(n)
    return out
