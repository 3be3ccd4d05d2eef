"""Registered keys for quality checks, usage analytics, reports, sources/sinks,
incremental loads and streaming jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gamelake.functions import fixed
from gamelake.operators import quality as Q
from gamelake.plans import reports as RPT
from gamelake.plans import usage as U
from gamelake.plans.catalog import models, register, rounded
from gamelake.plans.models import RAW_KINDS
from gamelake.session import scratch_path
from gamelake.sources.adapters import WAREHOUSES


def _max(df, col):
    return df.select(F.max(col)).scalar()


SESSION_COLS = ["event_id", "event_timestamp", "player_id", "session_id", "action", "platform", "region",
                "client_version"]

# Near duplicates inside one file and load time differ in the region; which of them stays is
# decided by a hash of the payload (unit-tested), so these keys leave the region out.
ARRIVAL_COLS = [c for c in SESSION_COLS if c != "region"]

# ---- data quality ---------------------------------------------------------------------------
@register("dq_unique")
def _dq_unique(spark, sf):
    return Q.unique(models(spark, sf).stg_sessions, ["session_id", "action"])


@register("dq_not_null")
def _dq_not_null(spark, sf):
    return Q.not_null(models(spark, sf).stg_mmr_updates, ["event_id", "player_id", "role", "mmr_after", "match_id"],
                      severity="warn")


@register("dq_accepted_values")
def _dq_accepted(spark, sf):
    m = models(spark, sf).stg_matches
    return Q.accepted_values(m, "map_id", ["map_1", "map_2", "map_3"]).select("match_id", "map_id")


@register("dq_between")
def _dq_between(spark, sf):
    return Q.between(models(spark, sf).stg_mmr_updates, "mmr_after", 0, 2000).select("event_id", "mmr_after")


@register("dq_relationships")
def _dq_rel(spark, sf):
    mm = models(spark, sf)
    return Q.relationships(mm.stg_mmr_updates, mm.stg_players, "player_id").select("event_id", "player_id")


@register("dq_positive_revenue")
def _dq_pos(spark, sf):
    return rounded(Q.positive_revenue(models(spark, sf).stg_store_transactions), as_double=["amount_usd"])


@register("dq_retention_bounds")
def _dq_ret(spark, sf):
    return Q.retention_bounds(models(spark, sf).fct_player_retention)


@register("dq_kill_rate")
def _dq_kill(spark, sf):
    return Q.valid_kill_rate(models(spark, sf).fct_match_outcomes)


MONITORED = ["match_completed", "session_event", "store_transaction"]
FRESHNESS_SOURCES = ["session_event", "store_transaction", "mmr_update", "match_completed", "player_registration",
                     "progression_event"]


@register("dq_freshness")
def _dq_fresh(spark, sf):
    mm = models(spark, sf)
    as_of = _max(mm.raw["session_event"], "load_ts")
    out = None
    for s in FRESHNESS_SOURCES:
        warn, err = fixed.FRESHNESS_SLA[s]
        v = Q.freshness(mm.raw[s], s, "load_ts", warn, err, as_of)
        out = v if out is None else out.unionByName(v)
    return out


@register("dq_row_count")
def _dq_rows(spark, sf):
    return Q.min_rows_per_hour(models(spark, sf).stg_sessions, "event_timestamp", 10)


@register("dq_row_count_sources")
def _dq_rows_sources(spark, sf):
    """Thin hours of the last two days of each monitored source, silent hours at the edges included."""
    mm, out = models(spark, sf), None
    for s in MONITORED:
        raw = mm.raw[s]
        until = _max(raw, "load_ts")
        v = Q.min_rows_per_hour(raw, "load_ts", 10, F.timestamp_add("DAY", F.lit(-2), until), until).select(F.lit(s).alias("source"), "*")
        out = v if out is None else out.unionByName(v)
    return out


@register("near_duplicate_sources")
def _near_dup_sources(spark, sf):
    mm, out = models(spark, sf), None
    for s in MONITORED:
        v = Q.near_duplicates(mm.raw[s]).select(F.lit(s).alias("source"), "*")
        out = v if out is None else out.unionByName(v)
    return out


@register("dq_required_keys_sources")
def _dq_required_sources(spark, sf):
    """Required keys of every monitored source, and one that no payload has."""
    mm, out = models(spark, sf), None
    for s in MONITORED:
        v = Q.required_keys(mm.raw[s], [*fixed.EXPECTED_KEYS[s], "absent_key"]).select(F.lit(s).alias("source"), "*")
        out = v if out is None else out.unionByName(v)
    return out


@register("dq_required_keys")
def _dq_required(spark, sf):
    raw = models(spark, sf).raw["match_completed"]
    return Q.required_keys(raw, fixed.EXPECTED_KEYS["match_completed"])


@register("volume_anomaly")
def _volume(spark, sf):
    mm = models(spark, sf)
    out = None
    for s in MONITORED:
        raw = mm.raw[s]
        v = Q.volume_anomaly(raw, "load_ts", _max(raw, "load_ts")).select(F.lit(s).alias("source"), "*")
        out = v if out is None else out.unionByName(v)
    return out


@register("schema_drift")
def _drift(spark, sf):
    mm = models(spark, sf)
    out = None
    for s in MONITORED:
        raw = mm.raw[s]
        since = F.timestamp_add("HOUR", F.lit(-6), _max(raw, "load_ts"))
        v = Q.drift_status(Q.schema_drift(spark, raw, fixed.EXPECTED_KEYS[s], since)).select(F.lit(s).alias("source"), "*")
        out = v if out is None else out.unionByName(v)
    return out


@register("check_suite")
def _suite(spark, sf):
    from gamelake.plans.check_suite import run_suite
    return run_suite(models(spark, sf))


@register("identity_resolution")
def _identity(spark, sf):
    mm = models(spark, sf)
    players = mm.stg_sessions.select("player_id").distinct()
    return Q.resolve_identity(players, "player_id", mm.raw["player_registration"])


@register("identity_name_mismatch")
def _identity_names(spark, sf):
    return Q.identity_name_mismatches(models(spark, sf).raw["player_registration"])


@register("late_arrival_audit")
def _late(spark, sf):
    mm = models(spark, sf)
    parts = None
    for k in RAW_KINDS:
        r = mm.raw[k].select(F.lit(k).alias("event_type"),
                             F.try_variant_get("raw_data", "$.timestamp", "timestamp_ntz").alias("event_ts"), "load_ts")
        parts = r if parts is None else parts.unionByName(r)
    return Q.late_arrivals(parts, "event_ts", "load_ts")


@register("near_duplicate_audit")
def _near_dup(spark, sf):
    return Q.near_duplicates(models(spark, sf).raw["session_event"])


@register("malformed_nested_repair")
def _repair(spark, sf):
    m = Q.repair_nested(models(spark, sf).stg_matches.select("match_id", "killer_perks"))
    return m.select("match_id", F.size("killer_perks").alias("n_perks"))


@register("out_of_order_audit")
def _ooo(spark, sf):
    return Q.out_of_order(models(spark, sf).stg_sessions).select(
        "event_id", "session_id", "event_timestamp", "prev_event_timestamp", "seconds_early")


@register("mode_exclusion")
def _modes(spark, sf):
    return Q.exclude_modes(models(spark, sf).stg_matches, fixed.EXCLUDED_MODES).select("match_id", "game_mode")


# ---- usage analytics --------------------------------------------------------------------------
def _logs(spark, sf):
    t = models(spark, sf).driver
    return t.metering(), t.query_log(), t.storage()


@register("usage_daily")
def _usage_daily(spark, sf):
    met, _, _ = _logs(spark, sf)
    return rounded(U.usage_daily(met, _max(met, "start_time")),
                   {"credits_used": 6, "credits_compute": 6, "credits_cloud": 6})


@register("usage_month_to_date")
def _usage_mtd(spark, sf):
    met, _, _ = _logs(spark, sf)
    return rounded(U.usage_month_to_date(met, _max(met, "start_time")), {"credits_used": 6})


@register("usage_by_warehouse")
def _usage_by_wh(spark, sf):
    met, _, _ = _logs(spark, sf)
    return rounded(U.usage_by_warehouse(met), {"total_credits": 6})


@register("usage_rolling_avg")
def _usage_roll(spark, sf):
    met, _, _ = _logs(spark, sf)
    return rounded(U.usage_rolling_avg(met, _max(met, "start_time")), {"credits_used": 6, "credits_7d_avg": 6})


@register("warehouse_utilization")
def _wh_util(spark, sf):
    _, ql, _ = _logs(spark, sf)
    return rounded(U.warehouse_utilization(ql, _max(ql, "start_time")),
                   {"total_execution_seconds": 6, "avg_execution_seconds": 6, "max_execution_seconds": 6,
                    "total_gb_scanned": 6})


@register("expensive_queries_topk")
def _expensive(spark, sf):
    _, ql, _ = _logs(spark, sf)
    return rounded(U.expensive_queries(ql, _max(ql, "start_time")), {"gb_scanned": 6})


@register("budget_check")
def _budget(spark, sf):
    met, _, _ = _logs(spark, sf)
    return rounded(U.budget_check(met, _max(met, "start_time")), {"total_credits_used": 6})


@register("scan_threshold")
def _scan(spark, sf):
    _, ql, _ = _logs(spark, sf)
    return U.scan_threshold(ql, _max(ql, "start_time"), tb=0.25)


@register("usage_cumulative")
def _cumulative(spark, sf):
    met, _, _ = _logs(spark, sf)
    return rounded(U.usage_cumulative(met, _max(met, "start_time")), {"daily_credits": 6, "cumulative_credits": 6})


@register("usage_pivot")
def _pivot(spark, sf):
    met, _, _ = _logs(spark, sf)
    listed = WAREHOUSES[:2]  # the third one falls under "other"
    return rounded(U.usage_pivot(met, listed, _max(met, "start_time")), {w: 6 for w in [*listed, "other"]})


@register("storage_trend")
def _storage(spark, sf):
    _, _, st = _logs(spark, sf)
    return rounded(U.storage_trend(st), {"storage_gb": 6, "stage_gb": 6, "failsafe_gb": 6, "total_tb": 9})


@register("top_bytes_queries")
def _top_bytes(spark, sf):
    _, ql, _ = _logs(spark, sf)
    return U.top_bytes(ql, _max(ql, "start_time"), 10)


# ---- reports ----------------------------------------------------------------------------------
@register("rpt_dau_series")
def _r1(spark, sf):
    return RPT.dau_series(models(spark, sf).fct_dau_mau, days=90)


@register("rpt_retention_series")
def _r2(spark, sf):
    return RPT.retention_series(models(spark, sf).fct_player_retention)


@register("rpt_churn_counts")
def _r3(spark, sf):
    return RPT.churn_counts(models(spark, sf).fct_player_lifetime)


@register("rpt_ltv_buckets")
def _r4(spark, sf):
    return RPT.ltv_buckets(models(spark, sf).fct_player_lifetime)


@register("rpt_top_ltv")
def _r5(spark, sf):
    return rounded(RPT.top_ltv(models(spark, sf).fct_player_lifetime, 20), as_double=["lifetime_spend_usd"])


@register("rpt_spend_values")
def _r6(spark, sf):
    return rounded(RPT.spend_histogram(models(spark, sf).fct_player_lifetime, 30), {"bin_start": 6, "bin_end": 6})


@register("rpt_kpi_latest")
def _r7(spark, sf):
    mm = models(spark, sf)
    return rounded(RPT.kpi_latest(mm.fct_dau_mau, mm.fct_daily_revenue, mm.fct_arpdau, mm.dim_players), {"value": 6})


@register("rpt_match_global")
def _r8(spark, sf):
    mm = models(spark, sf)
    return rounded(RPT.match_global(mm.fct_match_outcomes, mm.fct_map_balance), {"value": 9})


@register("rpt_killer_rates")
def _r9(spark, sf):
    return rounded(RPT.killer_rates(models(spark, sf).fct_match_outcomes, support=10),
                   {"kill_rate": 9, "escape_rate": 9, "avg_kills": 9})


@register("rpt_map_balance")
def _r10(spark, sf):
    return rounded(RPT.map_rates(models(spark, sf).fct_map_balance, support=10), {"kill_rate": 9})


@register("rpt_perk_top20")
def _r11(spark, sf):
    return rounded(RPT.perk_top(models(spark, sf).fct_perk_performance, "survivor", support=50, k=20),
                   {"win_rate": 9})


@register("rpt_mmr_histogram")
def _r12(spark, sf):
    return RPT.mmr_histogram(models(spark, sf).fct_mmr_distribution)


@register("rpt_mmr_segment_totals")
def _r12b(spark, sf):
    return RPT.mmr_segment_totals(models(spark, sf).fct_mmr_distribution)


@register("rpt_revenue_series")
def _r13(spark, sf):
    r = RPT.revenue_series(models(spark, sf).fct_daily_revenue, days=30)
    money = ["total_revenue_usd", "cosmetic_revenue_usd", "dlc_revenue_usd", "rift_pass_revenue_usd",
             "auric_cells_revenue_usd", "total_revenue_usd_delta"]
    return rounded(r, {"revenue_7d_avg": 6, "revenue_7d_avg_delta": 4}, money)


@register("rpt_revenue_breakdown")
def _r14(spark, sf):
    return RPT.revenue_breakdown(models(spark, sf).fct_daily_revenue)


@register("rpt_arpdau_series")
def _r15(spark, sf):
    return RPT.arpdau_series(models(spark, sf).fct_arpdau)


@register("rpt_funnel")
def _r16(spark, sf):
    return RPT.funnel(models(spark, sf).fct_store_conversion, "latest")


@register("rpt_funnel_30d")
def _r16b(spark, sf):
    return rounded(RPT.funnel(models(spark, sf).fct_store_conversion, "mean", 30), {"users": 6})


# ---- sources, sinks, incremental --------------------------------------------------------------
@register("bronze_view")
def _bronze(spark, sf):
    mm = models(spark, sf)
    u = None
    for k in RAW_KINDS:
        r = mm.raw[k].select(F.lit(k).alias("event_type"), "filename", "load_ts",
                             F.col("raw_data").isNull().alias("bad"))
        u = r if u is None else u.unionByName(r)
    return u.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"),
                                       F.countDistinct("filename").alias("files"),
                                       F.min("load_ts").alias("first_load"), F.max("load_ts").alias("last_load"),
                                       F.count_if("bad").alias("unparsed_rows"))


@register("seed_dim")
def _seed_dim(spark, sf):
    mm = models(spark, sf)
    n = mm.stg_matches.groupBy(F.col("killer_character_id").alias("character_id")).agg(
        F.count(F.lit(1)).alias("matches"))
    return mm.seed("seed_killers").join(n, "character_id", "left").fillna(0, ["matches"])


def _sink_path(spark, name):
    return scratch_path(spark, "out", name + "-" + uuid.uuid4().hex[:8])


@register("ndjson_sink")
def _ndjson_sink(spark, sf):
    from gamelake.sources.events import write_events
    path = _sink_path(spark, "ndjson")
    write_events(models(spark, sf).raw["session_event"], path, max_rows=5000)
    back = spark.read.text(path)
    return back.groupBy(*[F.col(c).cast("int").alias(c) if c != "event_type" else F.col(c)
                          for c in ["event_type", "yyyy", "mm", "dd", "hh"]]).agg(F.count(F.lit(1)).alias("rows"))


@register("ndjson_scan")
def _ndjson_scan(spark, sf):
    from gamelake.plans.staging import stg_sessions
    from gamelake.sources.events import read_routed_events, write_events
    path = _sink_path(spark, "ndjson")
    write_events(models(spark, sf).raw["session_event"], path)
    return stg_sessions(read_routed_events(spark, path, "session_event")).select(*ARRIVAL_COLS)


@register("materialize")
def _materialize(spark, sf):
    """Two runs of the incremental staging load: rows loaded up to a cutoff, then a
    look-back run; the stored table must equal a full rebuild."""
    from gamelake.operators.incremental import incremental_load
    from gamelake.plans.staging import stg_sessions
    raw = models(spark, sf).raw["session_event"]
    cutoff = F.timestamp_add("DAY", F.lit(-5), _max(raw, "load_ts"))
    path = _sink_path(spark, "stg_sessions_incremental")
    incremental_load(spark, raw.where(F.col("load_ts") < cutoff), stg_sessions, path)
    return incremental_load(spark, raw, stg_sessions, path).select(*SESSION_COLS)


@register("clustered_write")
def _clustered(spark, sf):
    s = models(spark, sf).stg_sessions.withColumn("event_date", F.to_date("event_timestamp"))
    path = _sink_path(spark, "clustered")
    from gamelake.sources.events import write_clustered
    write_clustered(s, path, ["event_date"], ["player_id"])
    return spark.read.parquet(path).select(*SESSION_COLS, "event_date")


@register("incremental_merge")
def _incr_merge(spark, sf):
    from gamelake.operators.incremental import incremental_filter, merge_upsert
    from gamelake.plans.staging import stg_sessions
    raw = models(spark, sf).raw["session_event"]
    cutoff = F.timestamp_add("DAY", F.lit(-5), _max(raw, "load_ts"))
    target = stg_sessions(raw.where(F.col("load_ts") < cutoff))
    batch = stg_sessions(incremental_filter(raw, target, "load_ts", fixed.INCREMENTAL_LOOKBACK_DAYS))
    return merge_upsert(target, batch, "event_id")


@register("mart_lookback")
def _mart_lookback(spark, sf):
    from gamelake.operators.incremental import refresh_dau_mau
    from gamelake.plans.player import fct_dau_mau
    a = models(spark, sf).int_player_daily_activity
    cutoff = F.date_sub(_max(a, "activity_date"), 7)
    previous = fct_dau_mau(a.where(F.col("activity_date") < cutoff))
    return refresh_dau_mau(previous, a, F.date_sub(cutoff, fixed.INCREMENTAL_LOOKBACK_DAYS))


@register("revenue_lookback")
def _rev_lookback(spark, sf):
    from gamelake.operators.incremental import refresh_daily_revenue
    from gamelake.plans.revenue import fct_daily_revenue
    r = models(spark, sf).int_revenue_daily
    cutoff = F.date_sub(_max(r, "revenue_date"), 7)
    previous = fct_daily_revenue(r.where(F.col("revenue_date") < cutoff))
    out = refresh_daily_revenue(previous, r, F.date_sub(cutoff, fixed.INCREMENTAL_LOOKBACK_DAYS))
    money = ["total_revenue_usd", "cosmetic_revenue_usd", "dlc_revenue_usd", "rift_pass_revenue_usd",
             "auric_cells_revenue_usd"]
    return rounded(out, {"revenue_7d_avg": 6}, money)


SNAP_FIRST_RUN = "1998-06-01 00:00:00"


@register("snap_player_mmr")
def _snap(spark, sf):
    from gamelake.plans.snapshot import snap_player_mmr
    mmr = models(spark, sf).stg_mmr_updates
    t1 = F.lit(SNAP_FIRST_RUN).cast("timestamp_ntz")
    first = snap_player_mmr(None, mmr, t1)
    return snap_player_mmr(first, mmr, _max(mmr, "event_timestamp"))


@register("late_event_reprocess")
def _late_reprocess(spark, sf):
    from gamelake.plans.staging import stg_sessions
    from gamelake.streaming.ingest import merge_batch
    raw = models(spark, sf).raw["session_event"]
    cutoff = F.timestamp_add("DAY", F.lit(-5), _max(raw, "load_ts"))
    path = _sink_path(spark, "stg_sessions_merged")
    run = merge_batch(spark, path, transform=stg_sessions)
    run(raw.where(F.col("load_ts") < cutoff), 0)
    run(raw.where(F.col("load_ts") >= F.timestamp_add("DAY", F.lit(-fixed.INCREMENTAL_LOOKBACK_DAYS), cutoff)), 1)
    return spark.read.parquet(path).select(*SESSION_COLS)


# ---- streaming --------------------------------------------------------------------------------
@register("ingest_stream")
def _ingest(spark, sf):
    from gamelake.plans.staging import stg_sessions
    from gamelake.sources.events import write_events
    from gamelake.streaming.ingest import ingest
    base = _sink_path(spark, "ingest")
    write_events(models(spark, sf).raw["session_event"], base + "/landing")
    q = ingest(spark, base + "/landing", base + "/bronze", base + "/_checkpoint")
    q.awaitTermination()
    return stg_sessions(spark.read.parquet(base + "/bronze")).select(*ARRIVAL_COLS)


def _typed_session_source(spark, sf, base, dedup=True):
    from gamelake.plans.staging import stg_sessions
    src = base + "/typed"
    # parsed rows, landed as files for the stream to pick up
    stg_sessions(models(spark, sf).raw["session_event"], dedup).write.parquet(src)
    from gamelake.streaming.ingest import SESSION_SCHEMA
    return spark.readStream.schema(SESSION_SCHEMA).parquet(src)


@register("stream_dedup")
def _stream_dedup(spark, sf):
    from gamelake.streaming.ingest import stream_dedup
    base = _sink_path(spark, "stream-dedup")
    sdf = stream_dedup(_typed_session_source(spark, sf, base, dedup=False))
    q = (sdf.writeStream.format("parquet").option("checkpointLocation", base + "/_checkpoint")
         .trigger(availableNow=True).start(base + "/out"))
    q.awaitTermination()
    return spark.read.parquet(base + "/out").select(*ARRIVAL_COLS)


@register("stream_activity")
def _stream_activity(spark, sf):
    from gamelake.streaming.ingest import stream_daily_activity, upsert_activity
    base = _sink_path(spark, "stream-activity")
    sdf = stream_daily_activity(_typed_session_source(spark, sf, base))
    q = (sdf.writeStream.outputMode("update").foreachBatch(upsert_activity(spark, base + "/activity"))
         .option("checkpointLocation", base + "/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/activity")


PROFILE_FIRST_RUN = "2024-01-15 00:00:00"


@register("scd2_merge")
def _scd2_merge(spark, sf):
    """Check-strategy SCD2 of player profiles: the latest registration per player as of
    a first run, then as of the end of the data, merged with ``scd2_apply``."""
    from gamelake.operators.incremental import scd2_apply
    from gamelake.plans.staging import stg_players
    raw = models(spark, sf).raw["player_registration"]

    def state(as_of=None):
        r = raw if as_of is None else raw.where(F.col("load_ts") <= as_of)
        return stg_players(r).select("player_id", "username", "platform", "region")

    t1 = F.lit(PROFILE_FIRST_RUN).cast("timestamp_ntz")
    first = scd2_apply(None, state(t1), "player_id", ["username", "region"], t1)
    return scd2_apply(first, state(), "player_id", ["username", "region"], _max(raw, "load_ts"))
