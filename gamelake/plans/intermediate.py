"""Intermediate models (M-7..M-11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.functions.classify import item_category
from gamelake.functions.semantics import datediff_boundary
from gamelake.operators.joins import each, with_dim


def as_of_date(as_of, frame: DataFrame | None = None, ts_col: str | None = None) -> Column:
    """``as_of`` as a DATE column. None means today, so that players age while a feed stands
    still; "latest" means the latest date in ``frame[ts_col]``, an uncorrelated scalar
    subquery (one small aggregate job), for data that has ended."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str) and as_of == "latest":
        return frame.select(F.max(F.to_date(ts_col))).scalar()
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    if isinstance(as_of, (_dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    raise TypeError(as_of)


def int_match_enriched(stg_matches: DataFrame, seed_killers: DataFrame, seed_survivors: DataFrame) -> DataFrame:
    """One row per (match, survivor). Matches with no survivors drop out (inner flatten).

    Where staging kept the whole payloads, each row has its own as ``survivor_payload`` (VARIANT).
    Survivor fields that staging left out are left out here; without the character id there is no
    name to look up.
    """
    own = ["match_id", "event_timestamp", "map_id", "game_mode", "duration_seconds", "killer_player_id",
           "killer_character_id", "killer_kills", "killer_hooks", "killer_score"]
    if "survivor_payloads" in stg_matches.columns:
        both = F.explode(F.arrays_zip(F.col("survivors").alias("s"), F.col("survivor_payloads").alias("payload")))
        m = stg_matches.select(*own, both.alias("x")).select(*own, F.col("x.s").alias("s"), F.col("x.payload").alias("survivor_payload"))
    else:
        m = stg_matches.select(*own, each("survivors").alias("s"))
    typed = {
        "player_id": F.col("s.player_id").alias("survivor_player_id"),
        "platform_player_id": F.col("s.platform_player_id").alias("survivor_platform_player_id"),
        "character_id": F.col("s.character_id").alias("survivor_character_id"),
        "escaped": F.col("s.escaped").alias("survivor_escaped"),
        "generators_completed": F.round("s.generators_completed").try_cast("bigint").alias("generators_completed"),
        "score": F.round("s.score").try_cast("bigint").alias("survivor_score"),
        "perks": F.col("s.perks").alias("survivor_perks")}
    there = m.schema["s"].dataType.names
    flat = m.select(*[c for c in m.columns if c != "s"], *[c for n, c in typed.items() if n in there])
    k = seed_killers.select(F.col("character_id").alias("killer_character_id"), "killer_name",
                            F.col("power").alias("killer_power"))
    out = with_dim(flat, k, "killer_character_id")
    if "character_id" in there:
        sv = seed_survivors.select(F.col("character_id").alias("survivor_character_id"), "survivor_name")
        out = with_dim(out, sv, "survivor_character_id")
    kills = F.col("killer_kills")
    return out.withColumn("is_4k", F.coalesce(kills == 4, F.lit(False))) \
              .withColumn("is_0k", F.coalesce(kills == 0, F.lit(False)))


def int_player_daily_activity(stg_sessions: DataFrame) -> DataFrame:
    """player x date x platform x region activity counts and span."""
    a = F.col("action")
    g = stg_sessions.groupBy(
        "player_id", F.to_date("event_timestamp").alias("activity_date"), "platform", "region")
    return g.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(a == "login").alias("login_count"),
        F.count_if(a == "match_start").alias("matches_started"),
        F.count_if(a == "match_end").alias("matches_ended"),
        F.count_if(a == "store_visit").alias("store_visits"),
        F.min("event_timestamp").alias("first_event_at"),
        F.max("event_timestamp").alias("last_event_at"),
    ).withColumn("active_minutes", datediff_boundary("minute", "first_event_at", "last_event_at"))


def int_session_metrics(stg_sessions: DataFrame) -> DataFrame:
    """One row per login: the session's logout time, duration and activity rate.

    The session side is aggregated to one row per session (event count and its last
    logout) before joining, so a session with many logins and logouts yields one row
    per login instead of every login x logout pair. A session without logout gets
    duration 0.
    """
    s = stg_sessions
    logins = s.where(F.col("action") == "login").select(
        "player_id", "session_id", "platform", "region", "client_version",
        F.col("event_timestamp").alias("login_at"))
    per_session = s.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.max(F.when(F.col("action") == "logout", F.col("event_timestamp"))).alias("logout_at"))
    j = logins.join(per_session, "session_id", "left")
    end = F.coalesce(F.col("logout_at"), F.col("login_at"))
    minutes = datediff_boundary("minute", F.col("login_at"), end)
    return j.select(
        "player_id", "session_id", "platform", "region", "client_version", "login_at", "logout_at",
        datediff_boundary("second", F.col("login_at"), end).alias("session_duration_seconds"),
        "event_count",
        F.when(minutes > 0, F.round(F.col("event_count") / minutes, 2)).otherwise(F.lit(0.0))
         .alias("actions_per_minute"))


def int_revenue_daily(stg_store: DataFrame) -> DataFrame:
    """date x category x currency revenue. Sum is coalesced to 0; avg/min/max are not."""
    t = stg_store.select(F.to_date("event_timestamp").alias("revenue_date"),
                         item_category("item_type").alias("item_type"), "currency", "player_id", "amount_usd")
    return t.groupBy("revenue_date", "item_type", "currency").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.countDistinct("player_id").alias("unique_buyers"),
        F.coalesce(F.sum("amount_usd"), F.lit(0)).cast("decimal(18,2)").alias("total_revenue_usd"),
        F.avg("amount_usd").alias("avg_transaction_usd"),
        F.min("amount_usd").alias("min_transaction_usd"),
        F.max("amount_usd").alias("max_transaction_usd"),
    )


def int_player_first_last(stg_sessions: DataFrame, stg_players: DataFrame, as_of=None) -> DataFrame:
    """Registered players with their first/last session dates; recency against ``as_of``.

    ``as_of``: a date, "latest" for the latest session date in the data, None for today.
    """
    d = F.to_date("event_timestamp")
    bounds = stg_sessions.groupBy("player_id").agg(
        F.min(d).alias("first_session_date"), F.max(d).alias("last_session_date"),
        F.countDistinct(d).alias("total_active_days"))
    today = as_of_date(as_of, stg_sessions, "event_timestamp")
    p = stg_players.select("player_id", "platform", "region", "registered_at")
    j = p.join(bounds, "player_id", "left")
    reg = F.to_date("registered_at")
    return j.select(
        "player_id", "platform", "region", reg.alias("registration_date"),
        F.coalesce(F.col("first_session_date"), reg).alias("first_seen_date"),
        F.col("last_session_date").alias("last_seen_date"),
        "total_active_days",
        F.date_diff(today, F.col("last_session_date")).alias("days_since_last_seen"))
