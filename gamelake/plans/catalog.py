"""Registry of runnable keys: name -> callable(spark, sf_dir) -> DataFrame.

Each entry builds the named model (or operator demonstration) over the driver tables
through the test adapters, then projects it for comparison with the DuckDB oracle:
arrays become counts or CSV strings, exact decimals are exposed as doubles, and
floating aggregates are rounded to a fixed number of digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.plans.models import Models

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str, **kw) -> Models:
    return Models.from_driver_tables(spark, sf_dir, **kw)


def rounded(df: DataFrame, digits: dict[str, int] | None = None, as_double: list[str] | None = None) -> DataFrame:
    """Expose decimals as double and round floating columns for stable comparison."""
    digits, as_double = digits or {}, as_double or []
    out = []
    for c in df.columns:
        col = F.col(c)
        if c in as_double:
            col = col.cast("double")
        if c in digits:
            col = F.round(col.cast("double"), digits[c])
        out.append(col.alias(c))
    return df.select(*out)


# ---- staging -------------------------------------------------------------------------------
@register("stg_sessions")
def _stg_sessions(spark, sf_dir):
    return models(spark, sf_dir).stg_sessions


@register("stg_store_transactions")
def _stg_store(spark, sf_dir):
    return models(spark, sf_dir).stg_store_transactions


@register("stg_players")
def _stg_players(spark, sf_dir):
    return models(spark, sf_dir).stg_players


@register("stg_mmr_updates")
def _stg_mmr(spark, sf_dir):
    return models(spark, sf_dir).stg_mmr_updates


@register("stg_progression")
def _stg_prog(spark, sf_dir):
    return models(spark, sf_dir).stg_progression


@register("stg_matches")
def _stg_matches(spark, sf_dir):
    # of the survivors only their number is shown: one typed field of each is enough
    m = models(spark, sf_dir).matches_with("character_id")
    return m.select("event_id", "match_id", "event_timestamp", "duration_seconds", "map_id", "game_mode",
                    "killer_player_id", "killer_character_id",
                    F.array_join("killer_perks", ",").alias("killer_perks_csv"),
                    "killer_kills", "killer_hooks", "killer_score",
                    F.coalesce(F.size("survivors"), F.lit(0)).cast("bigint").alias("survivor_count"),
                    "filename", "load_ts")


# ---- intermediate --------------------------------------------------------------------------
@register("int_match_enriched")
def _int_match_enriched(spark, sf_dir):
    e = models(spark, sf_dir).int_match_enriched
    cols = [c if c != "survivor_perks" else F.array_join("survivor_perks", ",").alias("survivor_perks_csv")
            for c in e.columns]
    return e.select(*cols)


@register("int_player_daily_activity")
def _int_daily(spark, sf_dir):
    return models(spark, sf_dir).int_player_daily_activity


@register("int_session_metrics")
def _int_session(spark, sf_dir):
    return models(spark, sf_dir).int_session_metrics


@register("int_revenue_daily")
def _int_revenue(spark, sf_dir):
    return rounded(models(spark, sf_dir).int_revenue_daily, {"avg_transaction_usd": 6},
                   ["total_revenue_usd", "min_transaction_usd", "max_transaction_usd"])


@register("int_player_first_last")
def _int_first_last(spark, sf_dir):
    return models(spark, sf_dir).int_player_first_last


# ---- player marts --------------------------------------------------------------------------
@register("fct_dau_mau")
def _dau_mau(spark, sf_dir):
    return models(spark, sf_dir).fct_dau_mau


@register("fct_player_retention")
def _retention(spark, sf_dir):
    return models(spark, sf_dir).fct_player_retention


@register("fct_player_lifetime")
def _lifetime(spark, sf_dir):
    return rounded(models(spark, sf_dir).fct_player_lifetime, {"avg_session_duration_seconds": 6},
                   ["lifetime_spend_usd"])


@register("dim_players")
def _dim_players(spark, sf_dir):
    return rounded(models(spark, sf_dir).dim_players, as_double=["lifetime_spend_usd"])


# ---- match marts ---------------------------------------------------------------------------
@register("fct_match_outcomes")
def _outcomes(spark, sf_dir):
    return rounded(models(spark, sf_dir).fct_match_outcomes,
                   {c: 9 for c in ["avg_kills", "kill_rate", "escape_rate", "avg_match_duration_seconds",
                                   "avg_killer_score"]})


@register("fct_perk_performance")
def _perks(spark, sf_dir):
    return rounded(models(spark, sf_dir).fct_perk_performance, {"avg_kills": 9, "win_rate": 9})


@register("fct_map_balance")
def _maps(spark, sf_dir):
    return rounded(models(spark, sf_dir).fct_map_balance,
                   {c: 9 for c in ["avg_kills", "kill_rate", "avg_duration_seconds", "stddev_kills"]})


@register("fct_mmr_distribution")
def _mmr_dist(spark, sf_dir):
    return rounded(models(spark, sf_dir).fct_mmr_distribution, {"avg_mmr": 9})


# ---- revenue marts -------------------------------------------------------------------------
@register("fct_daily_revenue")
def _daily_revenue(spark, sf_dir):
    d = models(spark, sf_dir).fct_daily_revenue
    money = ["total_revenue_usd", "cosmetic_revenue_usd", "dlc_revenue_usd", "rift_pass_revenue_usd",
             "auric_cells_revenue_usd"]
    return rounded(d, {"revenue_7d_avg": 6}, money)


@register("fct_arpdau")
def _arpdau(spark, sf_dir):
    return rounded(models(spark, sf_dir).fct_arpdau, as_double=["daily_revenue_usd"])


@register("fct_store_conversion")
def _store_conv(spark, sf_dir):
    return models(spark, sf_dir).fct_store_conversion


# operator, check, usage, report, source and streaming keys register themselves on import
from gamelake.plans import catalog_checks, catalog_ops, catalog_stored  # noqa: E402,F401
