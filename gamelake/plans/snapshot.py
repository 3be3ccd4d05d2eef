"""SCD2 history of player MMR (M-23), built from typed staging (see D-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.functions.classify import mmr_segment
from gamelake.operators.incremental import scd2_apply
from gamelake.plans.player import latest_mmr

CHECK_COLS = ["current_mmr", "mmr_segment"]


def mmr_state(stg_mmr: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest MMR per player among updates up to ``as_of`` (all updates when None)."""
    src = stg_mmr if as_of is None else stg_mmr.where(F.col("event_timestamp") <= as_of)
    lm = latest_mmr(src)
    return lm.select("player_id", F.col("mmr_after").alias("current_mmr"), F.col("role").alias("last_role"),
                     F.col("event_timestamp").alias("mmr_updated_at"),
                     mmr_segment("mmr_after").alias("mmr_segment"))


def snap_player_mmr(current: DataFrame | None, stg_mmr: DataFrame, as_of: Column) -> DataFrame:
    """One snapshot run at ``as_of``: apply the state as of then to the history."""
    return scd2_apply(current, mmr_state(stg_mmr, as_of), "player_id", CHECK_COLS, as_of)
