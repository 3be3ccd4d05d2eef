"""The declared checks of the model contracts, run over a ``Models`` graph in one go."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.functions import fixed


class Check(NamedTuple):
    model: str
    column: str
    kind: str                # unique, not_null, accepted_values, between
    args: tuple = ()
    severity: str = "error"


def _both(model: str, column: str) -> list[Check]:
    return [Check(model, column, "unique"), Check(model, column, "not_null")]


# The declared checks: fixed values, by model and column.
CHECKS = [
    *_both("stg_matches", "event_id"),
    Check("stg_matches", "match_id", "not_null"),
    Check("stg_matches", "event_timestamp", "not_null"),
    Check("stg_matches", "game_mode", "accepted_values", tuple(fixed.GAME_MODES)),
    Check("stg_matches", "killer_player_id", "not_null"),
    Check("stg_matches", "killer_kills", "between", (0, 4)),
    *_both("stg_sessions", "event_id"),
    Check("stg_sessions", "player_id", "not_null"),
    Check("stg_sessions", "event_timestamp", "not_null"),
    Check("stg_sessions", "action", "accepted_values", tuple(fixed.SESSION_ACTIONS)),
    Check("stg_sessions", "platform", "accepted_values", tuple(fixed.PLATFORMS)),
    Check("stg_sessions", "region", "accepted_values", tuple(fixed.REGIONS)),
    *_both("stg_store_transactions", "event_id"),
    *_both("stg_store_transactions", "transaction_id"),
    Check("stg_store_transactions", "player_id", "not_null"),
    Check("stg_store_transactions", "item_type", "accepted_values", tuple(fixed.ITEM_TYPES)),
    Check("stg_store_transactions", "amount_usd", "between", (0, None)),
    *_both("stg_mmr_updates", "event_id"),
    Check("stg_mmr_updates", "player_id", "not_null"),
    *_both("stg_players", "player_id"),
    Check("stg_players", "platform", "accepted_values", tuple(fixed.PLATFORMS)),
    Check("fct_player_retention", "cohort_week", "not_null"),
    Check("fct_player_retention", "cohort_size", "not_null"),
    Check("fct_player_retention", "cohort_size", "between", (1, None)),
    *_both("fct_player_lifetime", "player_id"),
    Check("fct_player_lifetime", "lifetime_spend_usd", "not_null"),
    Check("fct_player_lifetime", "churn_segment", "not_null"),
    Check("fct_player_lifetime", "churn_segment", "accepted_values", tuple(fixed.CHURN_SEGMENTS)),
    *_both("dim_players", "player_id"),
    *_both("fct_dau_mau", "metric_date"),
    Check("fct_dau_mau", "dau", "not_null"),
    Check("fct_dau_mau", "dau", "between", (0, None)),
    Check("fct_dau_mau", "mau", "not_null"),
    Check("fct_match_outcomes", "killer_character_id", "not_null"),
    Check("fct_match_outcomes", "kill_rate", "not_null"),
    Check("fct_match_outcomes", "kill_rate", "between", (0, 1)),
    Check("fct_map_balance", "map_id", "not_null", (), "warn"),
    Check("fct_map_balance", "kill_rate", "not_null"),
    Check("fct_map_balance", "kill_rate", "between", (0, 1)),
    Check("fct_daily_revenue", "revenue_date", "not_null"),
    Check("fct_daily_revenue", "total_revenue_usd", "not_null"),
    Check("fct_arpdau", "metric_date", "not_null"),
    Check("fct_arpdau", "arpdau", "not_null"),
    Check("fct_arpdau", "arppu", "not_null"),
    Check("fct_arpdau", "payer_conversion_rate", "not_null"),
]


def _fails(c: Check) -> Column:
    v = F.col(c.column)
    if c.kind == "not_null":
        return v.isNull()
    if c.kind == "accepted_values":
        return v.isNotNull() & ~v.isin(*c.args)
    lo, hi = c.args
    out = F.lit(False)
    if lo is not None:
        out = out | (v < lo)
    return F.coalesce(out | (v > hi) if hi is not None else out, F.lit(False))


def run_suite(models, checks: list[Check] | None = None) -> DataFrame:
    """(model, column_name, check, failing_rows, status) of every declared check.

    A model is worked out once per unique column, once at least: its row checks are partial counts
    by value of the first unique column, whose values that occur more than once are counted over
    the same groups.
    """
    out = None
    by_model: dict[str, list[Check]] = {}
    for c in checks or CHECKS:
        by_model.setdefault(c.model, []).append(c)
    for model, own in by_model.items():
        df = getattr(models, model)
        plain = [c for c in own if c.kind != "unique"]
        unique = [c for c in own if c.kind == "unique"]
        for i, key in enumerate(unique or [None]):
            p = _counts(df, key, plain if i == 0 else [])
            p = p.select(F.lit(model).alias("model"), "column_name", "check", "failing_rows",
                         F.when(F.col("failing_rows") == 0, "pass").otherwise(F.col("severity")).alias("status"))
            out = p if out is None else out.unionByName(p)
    return out


def _counts(df: DataFrame, unique: Check | None, plain: list[Check]) -> DataFrame:
    """(column_name, check, severity, failing_rows) of row checks and one unique check, in one pass."""
    fails = [F.count_if(_fails(c)).alias(f"c{i}") for i, c in enumerate(plain)]
    if unique is None:
        sums, checks = df.agg(*fails), plain
    else:
        by_value = df.groupBy(F.col(unique.column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *fails)
        twice = F.count_if(F.col("_v").isNotNull() & (F.col("_n") > 1))
        sums = by_value.agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(plain))],
                            twice.alias(f"c{len(plain)}"))
        checks = [*plain, unique]
    return sums.select(F.explode(F.array(*[F.struct(
        F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check"), F.lit(c.severity).alias("severity"),
        F.col(f"c{i}").alias("failing_rows")) for i, c in enumerate(checks)])).alias("x")).select("x.*")
