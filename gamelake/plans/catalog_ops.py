"""Registered keys for single operators, checks, usage analytics and reports.

Each builds the models it needs over the driver tables and then runs the operator
under test through the library function that implements it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gamelake.functions import fixed
from gamelake.functions.classify import bucket, churn_segment, item_category, ltv_bucket, mmr_segment
from gamelake.functions.semantics import cents_to_dollars, safe_ratio, to_array
from gamelake.operators import quality as Q
from gamelake.operators.dedup import latest_by
from gamelake.operators.joins import date_spine, flatten, retention_flags, spine_parts, with_dim
from gamelake.operators.rolling import period_delta, rolling_avg, rolling_distinct, running_total, share_of_total
from gamelake.operators.stats import exact_percentile_spread
from gamelake.plans import reports as RPT
from gamelake.plans import usage as U
from gamelake.plans.catalog import models, register, rounded
from gamelake.plans.player import latest_mmr, retention_cohort
from gamelake.plans.revenue import daily_unique_buyers
from gamelake.plans.staging import extract
from gamelake.sources.adapters import WAREHOUSES


def _max(df, col):
    return df.select(F.max(col)).scalar()


# ---- projection ---------------------------------------------------------------------------
@register("json_extract")
def _json_extract(spark, sf):
    raw = models(spark, sf).raw["store_transaction"]
    return rounded(extract(raw, {"event_id": ("$.event_id", "string"), "currency": ("$.currency", "string"),
                                 "amount": ("$.amount", "bigint"), "amount_usd": ("$.amount_usd", "decimal(10,2)")}),
                   as_double=["amount_usd"])


@register("nested_path")
def _nested_path(spark, sf):
    raw = models(spark, sf).raw["match_completed"]
    return extract(raw, {"match_id": ("$.match_id", "string"),
                         "killer_character_id": ("$.killer.character_id", "string"),
                         "killer_platform": ("$.killer.platform", "string"),
                         "killer_kills": ("$.killer.kills", "int")})


@register("array_index")
def _array_index(spark, sf):
    raw = models(spark, sf).raw["player_registration"]
    return extract(raw, {"event_id": ("$.event_id", "string"),
                         "first_account_id": ("$.platform_accounts[0].platform_player_id", "string"),
                         "second_account_id": ("$.platform_accounts[1].platform_player_id", "string"),
                         "second_account_name": ("$.platform_accounts[1].display_name", "string"),
                         "third_account_id": ("$.platform_accounts[2].platform_player_id", "string")})


@register("to_array_coerce")
def _to_array(spark, sf):
    raw = models(spark, sf).raw["match_completed"]
    v = lambda p: F.variant_get("raw_data", p, "variant")
    return raw.select(F.try_variant_get("raw_data", "$.match_id", "string").alias("match_id"),
                      F.coalesce(F.size(to_array(v("$.survivors"))), F.lit(0)).alias("survivors_n"),
                      F.size(to_array(v("$.killer.perks"))).alias("perks_n"),
                      F.size(to_array(v("$.killer.character_id"))).alias("scalar_wrapped_n"),
                      to_array(v("$.no_such_key")).isNull().alias("missing_is_null"))


@register("derived_delta")
def _derived_delta(spark, sf):
    return models(spark, sf).stg_mmr_updates.select("event_id", "mmr_before", "mmr_after", "mmr_change")


@register("item_category")
def _item_category(spark, sf):
    return models(spark, sf).stg_store_transactions.select(
        "event_id", "item_type", item_category("item_type").alias("item_category"))


@register("churn_segment")
def _churn_segment(spark, sf):
    return models(spark, sf).int_player_first_last.select(
        "player_id", "days_since_last_seen", churn_segment("days_since_last_seen").alias("churn_segment"))


@register("mmr_segment")
def _mmr_segment(spark, sf):
    lm = latest_mmr(models(spark, sf).stg_mmr_updates)
    return lm.select("player_id", "mmr_after", mmr_segment("mmr_after").alias("segment_null_top"),
                     mmr_segment("mmr_after", null_as=0).alias("segment_null_zero"))


@register("balance_rating")
def _balance_rating(spark, sf):
    return rounded(models(spark, sf).fct_map_balance.select("map_id", "kill_rate", "balance_rating"), {"kill_rate": 9})


@register("ltv_bucket")
def _ltv_bucket(spark, sf):
    lt = models(spark, sf).fct_player_lifetime
    return rounded(lt.select("player_id", "lifetime_spend_usd", ltv_bucket("lifetime_spend_usd").alias("ltv_bucket")),
                   as_double=["lifetime_spend_usd"])


@register("histogram_bucket")
def _histogram_bucket(spark, sf):
    return models(spark, sf).stg_mmr_updates.select("event_id", "mmr_after", bucket("mmr_after", 100).alias("mmr_bucket"))


@register("bool_flags")
def _bool_flags(spark, sf):
    m = models(spark, sf).stg_matches
    k = F.col("killer_kills")
    return m.select("match_id", "killer_kills", F.coalesce(k == 4, F.lit(False)).alias("is_4k"),
                    F.coalesce(k == 0, F.lit(False)).alias("is_0k"))


@register("safe_ratio")
def _safe_ratio(spark, sf):
    a = models(spark, sf).int_player_daily_activity
    return a.select("player_id", "activity_date", "platform", "region",
                    safe_ratio("matches_started", "login_count", 4).alias("matches_per_login"),
                    safe_ratio("store_visits", "login_count", 4, null_to_zero=True).alias("visits_per_login"))


@register("coalesce_default")
def _coalesce_default(spark, sf):
    o = models(spark, sf).fct_match_outcomes
    return o.select("killer_character_id",
                    F.coalesce("killer_name", "killer_character_id", F.lit("unknown")).alias("killer_display"),
                    F.coalesce("killer_power", F.lit("n/a")).alias("power_display"))


@register("typed_null")
def _typed_null(spark, sf):
    p = models(spark, sf).fct_perk_performance
    return rounded(p.select("perk_id", "role", "avg_kills"), {"avg_kills": 9})


@register("star_plus")
def _star_plus(spark, sf):
    m = models(spark, sf).stg_mmr_updates.alias("m")
    return m.select("m.*", mmr_segment(F.col("m.mmr_after")).alias("mmr_segment"))


@register("cents_to_dollars")
def _cents(spark, sf):
    s = models(spark, sf).stg_store_transactions
    return rounded(s.select("event_id", "amount", cents_to_dollars("amount").alias("amount_dollars")),
                   as_double=["amount_dollars"])


# ---- filters ------------------------------------------------------------------------------
@register("not_null_filter")
def _not_null(spark, sf):
    s = models(spark, sf).stg_mmr_updates
    return s.where(F.col("mmr_after").isNotNull()).select("event_id", "player_id", "mmr_after")


@register("equality_filter")
def _equality(spark, sf):
    s = models(spark, sf).stg_sessions
    return s.where(F.col("action") == "login").select("event_id", "player_id", "event_timestamp")


@register("min_support_filter")
def _min_support(spark, sf):
    p = models(spark, sf).fct_perk_performance
    return p.where(F.col("times_used") >= 1500).select("perk_id", "role", "times_used")


@register("relative_time_filter")
def _relative_time(spark, sf):
    s = models(spark, sf).stg_sessions
    as_of = _max(s, "event_timestamp")
    return s.where(F.col("event_timestamp") >= F.timestamp_add("DAY", F.lit(-7), as_of)).select(
        "event_id", "event_timestamp")


@register("bounds_predicate")
def _bounds(spark, sf):
    m = models(spark, sf).int_session_metrics
    return m.where((F.col("session_duration_seconds") < 0) | (F.col("actions_per_minute") > 1)).select(
        "session_id", "login_at", "session_duration_seconds", "actions_per_minute")


@register("incremental_filter")
def _incremental_filter(spark, sf):
    from gamelake.operators.incremental import incremental_filter
    from gamelake.plans.staging import stg_sessions
    raw = models(spark, sf).raw["session_event"]
    cutoff = F.timestamp_add("DAY", F.lit(-5), _max(raw, "load_ts"))
    target = stg_sessions(raw.where(F.col("load_ts") < cutoff))
    batch = incremental_filter(raw, target, "load_ts", fixed.INCREMENTAL_LOOKBACK_DAYS)
    return batch.select(F.try_variant_get("raw_data", "$.event_id", "string").alias("event_id"), "load_ts")


@register("in_set")
def _in_set(spark, sf):
    m = models(spark, sf).stg_matches
    return m.where(F.col("game_mode").isin(*fixed.EXCLUDED_MODES)).select("match_id", "game_mode")


# ---- joins ----------------------------------------------------------------------------------
@register("join_dim_left")
def _join_dim(spark, sf):
    mm = models(spark, sf)
    maps = mm.seed("seed_maps").select("map_id", "map_name", "realm")
    return with_dim(mm.stg_matches.select("match_id", "map_id"), maps, "map_id")


@register("join_multi_left")
def _join_multi(spark, sf):
    lt = models(spark, sf).fct_player_lifetime
    return rounded(lt.select("player_id", "lifetime_spend_usd", "lifetime_transactions", "lifetime_sessions",
                             "total_matches"), as_double=["lifetime_spend_usd"])


@register("join_session_pairs")
def _session_pairs(spark, sf):
    return models(spark, sf).int_session_metrics.select(
        "session_id", "login_at", "logout_at", "session_duration_seconds", "event_count")


@register("join_offset_date")
def _offset_date(spark, sf):
    mm = models(spark, sf)
    cohort = mm.int_player_first_last.select("player_id", F.col("first_seen_date").alias("cohort_date"))
    return retention_flags(cohort, mm.int_player_daily_activity, fixed.RETENTION_DAYS)


@register("join_range")
def _join_range(spark, sf):
    """Distinct players over a 14-day trailing date range, computed with the linear
    coverage method (the range-join result without the range join)."""
    a = models(spark, sf).int_player_daily_activity
    return rolling_distinct(a, "activity_date", "player_id", 14, "players_14d")


@register("lateral_flatten")
def _flatten(spark, sf):
    m = models(spark, sf).stg_matches.select("match_id", "killer_perks")
    return flatten(m, "killer_perks", "perk_id")


@register("join_date_left")
def _join_date(spark, sf):
    mm = models(spark, sf)
    r = mm.fct_daily_revenue.select(F.col("revenue_date").alias("metric_date"),
                                    F.col("total_revenue_usd").cast("double").alias("revenue_usd"))
    return mm.fct_dau_mau.select("metric_date", "dau").join(r, "metric_date", "left")


@register("set_difference_keys")
def _key_diff(spark, sf):
    raw = models(spark, sf).raw["session_event"]
    return Q.schema_drift(spark, raw, fixed.EXPECTED_KEYS["session_event"])


@register("key_generator")
def _key_generator(spark, sf):
    mm = models(spark, sf)
    s = mm.stg_sessions
    d = s.agg(F.min(F.to_date("event_timestamp")).alias("lo"), F.max(F.to_date("event_timestamp")).alias("hi"))
    spine = spine_parts(d.select(F.explode(F.sequence("lo", "hi")).alias("date_day")))
    dau = mm.fct_dau_mau.select(F.col("metric_date").alias("date_day"), "dau")
    return spine.select("date_day", "year_number", "month_of_year", "day_of_month", "day_of_week",
                        "week_start_date").join(dau, "date_day", "left").fillna(0, ["dau"])


# ---- aggregates ---------------------------------------------------------------------------
@register("agg_basic")
def _agg_basic(spark, sf):
    a = models(spark, sf).int_player_daily_activity
    return rounded(a.groupBy("platform").agg(
        F.count(F.lit(1)).alias("rows"), F.min("first_event_at").alias("first_at"),
        F.max("last_event_at").alias("last_at"), F.sum("total_events").alias("events"),
        F.avg("active_minutes").alias("avg_active_minutes")), {"avg_active_minutes": 9})


@register("agg_count_distinct")
def _agg_cd(spark, sf):
    s = models(spark, sf).stg_sessions.withColumn("d", F.to_date("event_timestamp"))
    return s.groupBy(F.col("d").alias("activity_date")).agg(
        F.countDistinct("player_id").alias("players"), F.countDistinct("session_id").alias("sessions"))


@register("agg_distinct_rollup")
def _agg_rollup(spark, sf):
    """Monthly players from stored daily sketches, next to the exact count and within 3 % of it."""
    from gamelake.operators.incremental import materialize
    from gamelake.operators.stats import distinct_rollup, distinct_sketches
    from gamelake.session import scratch_path
    import uuid
    s = models(spark, sf).stg_sessions.select("player_id", F.to_date("event_timestamp").alias("activity_date"))
    daily = materialize(spark, distinct_sketches(s, ["activity_date"], "player_id"), "sketches", "table",
                        scratch_path(spark, "out", "sketches-" + uuid.uuid4().hex[:8]))
    rolled = distinct_rollup(daily, F.trunc("activity_date", "month").alias("month"), "estimate")
    exact = s.groupBy(F.trunc("activity_date", "month").alias("month")).agg(F.countDistinct("player_id").alias("players"))
    return exact.join(rolled, "month").select(
        "month", "players", (F.abs(F.col("estimate") - F.col("players")) <= 0.03 * F.col("players")).alias("within_error"))


@register("agg_count_distinct_approx")
def _agg_cd_approx(spark, sf):
    s = models(spark, sf).stg_sessions
    return s.groupBy(F.to_date("event_timestamp").alias("activity_date")).agg(
        F.approx_count_distinct("player_id", 0.01).alias("players_approx"))


@register("agg_count_if")
def _agg_count_if(spark, sf):
    m = models(spark, sf).stg_matches
    return m.groupBy("map_id").agg(F.count_if(F.col("killer_kills") >= 3).alias("wins"),
                                   F.count_if(F.col("killer_kills") == 0).alias("zero_kill"),
                                   F.count_if(F.col("duration_seconds") > 600).alias("long_matches"))


@register("agg_distinct_case")
def _agg_distinct_case(spark, sf):
    a = models(spark, sf).int_player_daily_activity
    per = a.groupBy("activity_date", "player_id").agg(
        F.max((F.col("store_visits") > 0).cast("int")).alias("v"), F.max((F.col("login_count") > 0).cast("int")).alias("l"))
    return per.groupBy("activity_date").agg(F.sum("v").cast("bigint").alias("store_visitors"),
                                            F.sum("l").cast("bigint").alias("login_players"))


@register("agg_pivot_sum")
def _agg_pivot(spark, sf):
    s = models(spark, sf).stg_store_transactions
    p = (s.groupBy(F.to_date("event_timestamp").alias("revenue_date"))
         .pivot("currency", fixed.CURRENCIES).agg(F.sum("amount_usd")))
    return p.select("revenue_date", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in fixed.CURRENCIES])


@register("agg_stddev")
def _agg_stddev(spark, sf):
    m = models(spark, sf).stg_matches
    return rounded(m.groupBy("killer_character_id").agg(F.stddev("killer_score").alias("stddev_score")),
                   {"stddev_score": 6})


@register("agg_median")
def _agg_median(spark, sf):
    e = models(spark, sf).match_survivors("character_id", "score")
    return exact_percentile_spread(e, ["survivor_character_id"], "survivor_score", 0.5, "median_score")


@register("agg_rate")
def _agg_rate(spark, sf):
    m = models(spark, sf).stg_matches
    return rounded(m.groupBy("killer_character_id").agg(
        (F.avg("killer_kills") / 4.0).alias("kill_rate"),
        (F.count_if(F.col("killer_kills") == 4) / F.count(F.lit(1))).alias("four_k_rate")),
        {"kill_rate": 9, "four_k_rate": 9})


@register("agg_group_by_ordinal")
def _agg_ordinal(spark, sf):
    s = models(spark, sf).stg_store_transactions
    return s.groupBy(F.to_date("event_timestamp").alias("revenue_date"), "currency").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount_usd").cast("double").alias("revenue_usd"))


@register("agg_global")
def _agg_global(spark, sf):
    m = models(spark, sf).stg_matches
    return rounded(m.agg(F.count(F.lit(1)).alias("matches"), F.avg("killer_kills").alias("avg_kills"),
                         F.min("event_timestamp").alias("first_match_at"), F.max("event_timestamp").alias("last_match_at")),
                   {"avg_kills": 9})


@register("agg_min_order")
def _agg_min_order(spark, sf):
    fl = models(spark, sf).int_player_first_last
    g = fl.groupBy(churn_segment("days_since_last_seen").alias("churn_segment")).agg(
        F.count(F.lit(1)).alias("players"), F.min("days_since_last_seen").alias("_m"))
    return g.orderBy("_m").drop("_m")


@register("pivot_mean")
def _pivot_mean(spark, sf):
    e = models(spark, sf).match_survivors("score")
    p = e.groupBy("killer_character_id").pivot("game_mode", fixed.GAME_MODES).agg(F.avg("survivor_score"))
    return rounded(p, {c: 6 for c in fixed.GAME_MODES})


@register("distinct_rows")
def _distinct_rows(spark, sf):
    return models(spark, sf).int_player_daily_activity.select("activity_date", "player_id").distinct()


# ---- windows ------------------------------------------------------------------------------
@register("dedup_latest")
def _dedup_latest(spark, sf):
    s = models(spark, sf).stg_sessions
    return latest_by(s, "player_id", [F.col("event_timestamp").desc_nulls_first(), F.col("event_id").desc()]).select(
        "player_id", "event_id", "event_timestamp", "action")


@register("latest_by_key")
def _latest_by_key(spark, sf):
    return latest_mmr(models(spark, sf).stg_mmr_updates).select("player_id", "event_id", "mmr_after", "role",
                                                               "event_timestamp")


@register("rolling_avg_7")
def _rolling_avg(spark, sf):
    d = models(spark, sf).fct_dau_mau.select("metric_date", "dau")
    return rounded(rolling_avg(d, "dau", "metric_date", 7, out_col="dau_7d_avg"), {"dau_7d_avg": 6})


@register("running_total")
def _running_total(spark, sf):
    r = models(spark, sf).fct_daily_revenue.select("revenue_date", F.col("total_revenue_usd").cast("double").alias("revenue"),
                                                  F.trunc("revenue_date", "month").alias("month"))
    return rounded(running_total(r, "revenue", "revenue_date", by=["month"], out_col="month_to_date"),
                   {"month_to_date": 6})


@register("rolling_distinct")
def _rolling_distinct(spark, sf):
    a = models(spark, sf).int_player_daily_activity
    w = rolling_distinct(a, "activity_date", "player_id", 7, "d7_coverage")
    m = rolling_distinct(a, "activity_date", "player_id", 30, "d30_explode", method="explode")
    return w.join(m, "activity_date")


@register("share_of_total")
def _share(spark, sf):
    p = models(spark, sf).stg_players.groupBy("platform").agg(F.count(F.lit(1)).alias("players"))
    return share_of_total(p, "players", 4, "share")


@register("period_delta")
def _period_delta(spark, sf):
    d = models(spark, sf).fct_dau_mau.select("metric_date", "dau", "mau")
    return period_delta(d, "metric_date", ["dau", "mau"])


# ---- sort ---------------------------------------------------------------------------------
@register("order_by")
def _order_by(spark, sf):
    o = models(spark, sf).fct_match_outcomes
    return rounded(o.select("killer_character_id", "kill_rate").orderBy(F.col("kill_rate").desc(),
                                                                        F.col("killer_character_id").asc_nulls_last()),
                   {"kill_rate": 9})


@register("top_k")
def _top_k(spark, sf):
    return rounded(RPT.top_ltv(models(spark, sf).fct_player_lifetime, 10), as_double=["lifetime_spend_usd"])


@register("order_by_case")
def _order_by_case(spark, sf):
    return RPT.order_by_case(models(spark, sf).stg_sessions.groupBy("action").agg(F.count(F.lit(1)).alias("events")),
                             "action", fixed.SESSION_ACTIONS)


@register("nulls_last")
def _nulls_last(spark, sf):
    """Top-20 MMR updates by value, DESC NULLS LAST (unknown MMR never tops the report)."""
    s = models(spark, sf).stg_mmr_updates
    return s.orderBy(F.col("mmr_after").desc_nulls_last(), F.col("event_id").asc()).limit(20).select(
        "event_id", "mmr_after")


@register("latest_row")
def _latest_row(spark, sf):
    return RPT.latest_row(models(spark, sf).fct_dau_mau, "metric_date")


# ---- set ----------------------------------------------------------------------------------
@register("union_all")
def _union_all(spark, sf):
    mm = models(spark, sf)
    m = mm.matches_shared(["killer_character_id", "killer_player_id"], "player_id")
    k = m.groupBy(F.col("killer_player_id").alias("player_id")).agg(F.count(F.lit(1)).alias("matches")) \
        .withColumn("role", F.lit("killer"))
    s = mm.survivors_of(m).groupBy(F.col("survivor_player_id").alias("player_id")).agg(
        F.count(F.lit(1)).alias("matches")).withColumn("role", F.lit("survivor"))
    return k.unionByName(s)


# ---- macros -------------------------------------------------------------------------------
@register("retention_cohort")
def _retention_cohort(spark, sf):
    mm = models(spark, sf)
    c = mm.int_player_first_last.select("player_id", F.col("first_seen_date").alias("cohort_date"))
    return retention_cohort(c, mm.int_player_daily_activity, 7)


@register("daily_unique_buyers")
def _true_buyers(spark, sf):
    return daily_unique_buyers(models(spark, sf).stg_store_transactions)


@register("date_spine")
def _date_spine(spark, sf):
    s = models(spark, sf).stg_sessions
    lo = s.select(F.min(F.to_date("event_timestamp"))).scalar()
    hi = s.select(F.max(F.to_date("event_timestamp"))).scalar()
    return date_spine(spark, lo, hi).select("date_day", "month_start_date", "month_end_date")


@register("pivot_sum")
def _pivot_sum(spark, sf):
    """Day x item category revenue: dynamic pivot over an explicit value list, empty cells 0."""
    from gamelake.functions.classify import item_category
    cats = ["cosmetic", "dlc", "rift_pass", "auric_cells", "other"]
    s = models(spark, sf).stg_store_transactions
    p = (s.withColumn("item_category", item_category("item_type"))
         .groupBy(F.to_date("event_timestamp").alias("revenue_date"))
         .pivot("item_category", cats).agg(F.sum("amount_usd")).fillna(0, subset=cats))
    return p.select("revenue_date", *[F.col(c).cast("double").alias(c) for c in cats])
