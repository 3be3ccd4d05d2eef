"""Player marts (M-12..M-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.functions import fixed
from gamelake.functions.classify import churn_segment, mmr_segment
from gamelake.functions.semantics import safe_ratio
from gamelake.operators.dedup import latest_by
from gamelake.operators.joins import retention_flags
from gamelake.operators.rolling import rolling_distinct, rolling_distinct_many


def fct_dau_mau(daily_activity: DataFrame, method: str = "coverage") -> DataFrame:
    """DAU / WAU / MAU and stickiness for every date with activity.

    WAU and MAU are exact trailing distinct counts over 7 and 30 days without a theta
    join. With ``coverage`` all three counts come from one pass over the distinct (date,
    player) pairs; other methods run ``rolling_distinct`` once for each window.
    """
    pairs = daily_activity.select("activity_date", "player_id").where(F.col("player_id").isNotNull()).distinct()
    if method == "coverage":
        return rolling_distinct_many(pairs, "activity_date", "player_id", {"wau": 7, "mau": 30}, "dau").select(
            F.col("activity_date").alias("metric_date"), "dau", "wau", "mau",
            safe_ratio("dau", "mau", 4).alias("stickiness_ratio"))
    dau = pairs.groupBy("activity_date").agg(F.count(F.lit(1)).alias("dau"))  # = count(distinct player_id)
    wau = rolling_distinct(pairs, "activity_date", "player_id", 7, "wau", method)
    mau = rolling_distinct(pairs, "activity_date", "player_id", 30, "mau", method)
    return (dau.join(wau, "activity_date", "left").join(mau, "activity_date", "left")
            .select(F.col("activity_date").alias("metric_date"), "dau", "wau", "mau",
                    safe_ratio("dau", "mau", 4).alias("stickiness_ratio")))


def fct_player_retention(first_last: DataFrame, daily_activity: DataFrame,
                         days: list[int] | None = None) -> DataFrame:
    """D1/D7/D30 retention by Monday-start cohort week; retained means active exactly
    N days after the first-seen date."""
    days = days or fixed.RETENTION_DAYS
    cohort = first_last.select("player_id", F.col("first_seen_date").alias("cohort_date"),
                               F.trunc("first_seen_date", "week").alias("cohort_week"))
    flags = retention_flags(cohort, daily_activity, days)
    # one row per player: counting rows and summing flags equals the distinct counts
    agg = flags.groupBy("cohort_week").agg(
        F.count("player_id").alias("cohort_size"),
        *[F.sum(F.col(f"retained_d{n}").cast("bigint")).alias(f"retained_d{n}") for n in days])
    return agg.select("cohort_week", "cohort_size", *[f"retained_d{n}" for n in days],
                      *[safe_ratio(f"retained_d{n}", "cohort_size", 4).alias(f"retention_d{n}") for n in days])


def retention_cohort(cohort: DataFrame, daily_activity: DataFrame, day_n: int) -> DataFrame:
    """Daily-cohort retention at any day N (the retention_cohort macro).

    ``cohort``: (player_id, cohort_date). Counts distinct cohort players and distinct
    retained players per cohort date.
    """
    c = cohort.select("player_id", "cohort_date").distinct()
    flags = retention_flags(c, daily_activity, [day_n])
    agg = flags.groupBy("cohort_date").agg(
        F.count("player_id").alias("cohort_size"),
        F.sum(F.col(f"retained_d{day_n}").cast("bigint")).alias("retained_players"))
    return agg.withColumn("retention_rate", safe_ratio("retained_players", "cohort_size", 4))


def fct_player_lifetime(first_last: DataFrame, stg_store: DataFrame, session_metrics: DataFrame,
                        match_enriched: DataFrame, match_player_col: str = "survivor_platform_player_id") -> DataFrame:
    """Lifetime spend, sessions, survivor matches and churn segment per registered player.

    Every input is reduced to one row per player before the left joins, so the joins
    never fan out. ``match_player_col`` picks which survivor id joins to ``player_id``
    (the platform id by default; the canonical id lives in a different id space).
    """
    spend = stg_store.groupBy("player_id").agg(
        F.sum("amount_usd").alias("total_spend_usd"), F.count(F.lit(1)).alias("total_transactions"))
    sess = session_metrics.groupBy("player_id").agg(
        F.countDistinct("session_id").alias("total_sessions"),
        F.avg("session_duration_seconds").alias("avg_session_duration_seconds"))
    matches = (match_enriched.where(F.col(match_player_col).isNotNull())
               .groupBy(F.col(match_player_col).alias("player_id"))
               .agg(F.count(F.lit(1)).alias("total_matches_survivor")))
    j = (first_last.join(spend, "player_id", "left").join(sess, "player_id", "left")
         .join(matches, "player_id", "left"))
    return j.select(
        "player_id", "platform", "region", "registration_date", "first_seen_date", "last_seen_date",
        "total_active_days", "days_since_last_seen",
        F.coalesce(F.col("total_spend_usd"), F.lit(0)).cast("decimal(18,2)").alias("lifetime_spend_usd"),
        F.coalesce(F.col("total_transactions"), F.lit(0)).alias("lifetime_transactions"),
        F.coalesce(F.col("total_sessions"), F.lit(0)).alias("lifetime_sessions"),
        F.coalesce(F.col("avg_session_duration_seconds"), F.lit(0.0)).alias("avg_session_duration_seconds"),
        F.coalesce(F.col("total_matches_survivor"), F.lit(0)).alias("total_matches"),
        churn_segment("days_since_last_seen").alias("churn_segment"))


def latest_mmr(stg_mmr: DataFrame) -> DataFrame:
    """Latest MMR update per player by event time; a NULL time ranks first (S-2)."""
    return latest_by(stg_mmr, "player_id",
                     [F.col("event_timestamp").desc_nulls_first(), F.col("event_id").desc_nulls_first()])


def dim_players(stg_players: DataFrame, lifetime: DataFrame, stg_mmr: DataFrame) -> DataFrame:
    """Current-state player dimension (not SCD2; history is in ``snap_player_mmr``)."""
    m = latest_mmr(stg_mmr).select("player_id", F.col("mmr_after").alias("_mmr"), F.col("role").alias("last_role"))
    lt = lifetime.select("player_id", "lifetime_spend_usd", "lifetime_sessions", "total_matches",
                         "churn_segment", "days_since_last_seen")
    j = (stg_players.select("player_id", "username", "platform", "region", "registered_at")
         .join(lt, "player_id", "left").join(m, "player_id", "left"))
    return j.select(
        "player_id", "username", "platform", "region", "registered_at",
        F.coalesce(F.col("_mmr"), F.lit(0)).alias("current_mmr"), "last_role",
        mmr_segment("_mmr", null_as=0).alias("mmr_segment"),
        "lifetime_spend_usd", "lifetime_sessions", "total_matches", "churn_segment", "days_since_last_seen")
