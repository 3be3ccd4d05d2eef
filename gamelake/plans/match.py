"""Match marts (M-16..M-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.functions.classify import balance_rating, bucket, mmr_segment
from gamelake.operators.joins import each, with_dim
from gamelake.plans.player import latest_mmr


def fct_match_outcomes(stg_matches: DataFrame, seed_killers: DataFrame) -> DataFrame:
    """Kill/escape rate, averages and exact median kills per killer character, in one scan.

    The median keeps counts by value, and a match has a handful of kills; for values without
    such a bound there is ``exact_percentile_spread``.
    """
    out = stg_matches.groupBy("killer_character_id").agg(
        F.countDistinct("match_id").alias("total_matches"),
        F.avg("killer_kills").alias("avg_kills"),
        F.avg("duration_seconds").alias("avg_match_duration_seconds"),
        F.avg("killer_score").alias("avg_killer_score"),
        F.median("killer_kills").alias("median_kills"))
    out = out.withColumn("kill_rate", F.col("avg_kills") / 4.0) \
             .withColumn("escape_rate", 1 - F.col("avg_kills") / 4.0)
    k = seed_killers.select(F.col("character_id").alias("killer_character_id"), "killer_name",
                            F.col("power").alias("killer_power"), F.col("chapter").alias("killer_chapter"))
    return with_dim(out, k, "killer_character_id").select(
        "killer_character_id", "total_matches", "avg_kills", "kill_rate", "escape_rate",
        "avg_match_duration_seconds", "avg_killer_score", "median_kills",
        "killer_name", "killer_power", "killer_chapter")


def fct_perk_performance(stg_matches: DataFrame, match_enriched: DataFrame, seed_perks: DataFrame) -> DataFrame:
    """Usage and win rate per (role, perk). Killer win: 3+ kills; survivor win: escaped."""
    kp = stg_matches.select("killer_kills", each("killer_perks").alias("perk_id"))
    killer = kp.groupBy("perk_id").agg(
        F.count(F.lit(1)).alias("times_used"),
        F.avg("killer_kills").alias("avg_kills"),
        (F.count_if(F.col("killer_kills") >= 3) / F.count(F.lit(1))).alias("win_rate"),
    ).withColumn("role", F.lit("killer"))
    sp = match_enriched.select("survivor_escaped", each("survivor_perks").alias("perk_id"))
    surv = sp.groupBy("perk_id").agg(
        F.count(F.lit(1)).alias("times_used"),
        F.lit(None).cast("double").alias("avg_kills"),
        (F.count_if(F.col("survivor_escaped")) / F.count(F.lit(1))).alias("win_rate"),
    ).withColumn("role", F.lit("survivor"))
    cols = ["perk_id", "role", "times_used", "avg_kills", "win_rate"]
    combined = killer.select(*cols).unionByName(surv.select(*cols))
    pk = seed_perks.select("perk_id", "perk_name", "perk_type", "tier")
    return with_dim(combined, pk, "perk_id")


def fct_map_balance(stg_matches: DataFrame, seed_maps: DataFrame) -> DataFrame:
    """Kill rate and balance rating per map (NULL map is its own group)."""
    agg = stg_matches.groupBy("map_id").agg(
        F.countDistinct("match_id").alias("total_matches"),
        F.avg("killer_kills").alias("avg_kills"),
        (F.avg("killer_kills") / 4.0).alias("kill_rate"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
        F.stddev("killer_kills").alias("stddev_kills"))
    mp = seed_maps.select("map_id", "map_name", "realm", "map_size")
    out = with_dim(agg, mp, "map_id")
    return out.withColumn("balance_rating", balance_rating("kill_rate"))


def fct_mmr_distribution(stg_mmr: DataFrame, width: int = 100) -> DataFrame:
    """Players per (segment, 100-point bucket) of their latest MMR, with a cumulative
    count inside each segment and the share of all players. NULL MMR goes to the top
    segment with a NULL bucket, ordered last (S-2)."""
    lm = latest_mmr(stg_mmr).select("player_id", F.col("mmr_after").alias("current_mmr"))
    b = lm.select("player_id", "current_mmr", bucket("current_mmr", width).alias("mmr_bucket"),
                  mmr_segment("current_mmr").alias("mmr_segment"))
    dist = b.groupBy("mmr_segment", "mmr_bucket").agg(
        F.countDistinct("player_id").alias("player_count"), F.avg("current_mmr").alias("avg_mmr"))
    # the windows run over the aggregated histogram (a few dozen rows), not over players
    w_seg = Window.partitionBy("mmr_segment").orderBy(F.col("mmr_bucket").asc_nulls_last())
    total = F.sum("player_count").over(Window.partitionBy())
    return dist.select(
        "mmr_segment", "mmr_bucket", "player_count", "avg_mmr",
        F.sum("player_count").over(w_seg).alias("cumulative_players"),
        F.round(F.col("player_count") / F.nullif(total, F.lit(0)), 4).alias("pct_of_total"))
