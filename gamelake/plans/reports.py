"""Dashboard report queries over the marts (RPT-1..RPT-16); drawing is not built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.functions import fixed
from gamelake.functions.classify import ltv_bucket
from gamelake.operators.rolling import period_delta


def _last_days(df: DataFrame, col: str, days: int | None, as_of: Column | None) -> DataFrame:
    if days is None:
        return df
    end = as_of if as_of is not None else df.select(F.max(col)).scalar()
    return df.where(F.col(col) >= F.date_sub(end, days))


def order_by_case(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Sort by a categorical order (ORD-3); unknown values last."""
    rank = F.lit(len(values) + 1)
    for i, v in reversed(list(enumerate(values))):
        rank = F.when(F.col(col) == v, i + 1).otherwise(rank)
    return df.orderBy(rank, F.col(col))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k with an explicit (tie-breaking) order (ORD-2)."""
    return df.orderBy(*order).limit(k)


def latest_row(df: DataFrame, date_col: str) -> DataFrame:
    """The row with the greatest date (ORD-5)."""
    return df.orderBy(F.col(date_col).desc_nulls_last()).limit(1)


def dau_series(m15: DataFrame, days: int | None = None, as_of: Column | None = None) -> DataFrame:
    return _last_days(m15, "metric_date", days, as_of).select("metric_date", "dau", "wau", "mau", "stickiness_ratio")


def retention_series(m12: DataFrame) -> DataFrame:
    return m12.select("cohort_week", "cohort_size", "retention_d1", "retention_d7", "retention_d30")


def churn_counts(m13: DataFrame) -> DataFrame:
    """Players per churn segment with share of all players, in segment order (RPT-3)."""
    g = m13.groupBy("churn_segment").agg(F.count(F.lit(1)).alias("player_count"))
    g = g.withColumn("pct_of_players", F.round(F.col("player_count") * 100.0 / F.sum("player_count").over(Window.partitionBy()), 1))
    return order_by_case(g, "churn_segment", fixed.CHURN_SEGMENTS)


def ltv_buckets(m13: DataFrame) -> DataFrame:
    """Players and means per spend bucket, ordered by the bucket's minimum spend (RPT-4)."""
    b = m13.withColumn("ltv_bucket", ltv_bucket("lifetime_spend_usd"))
    g = b.groupBy("ltv_bucket").agg(
        F.count(F.lit(1)).alias("player_count"),
        F.round(F.avg("lifetime_spend_usd"), 2).cast("double").alias("avg_spend"),
        F.round(F.avg("lifetime_sessions"), 0).alias("avg_sessions"),
        F.round(F.avg("total_matches"), 0).alias("avg_matches"),
        F.min("lifetime_spend_usd").alias("_min"))
    return g.orderBy("_min").drop("_min")


def top_ltv(m13: DataFrame, k: int = 10) -> DataFrame:
    return top_k(m13.select("player_id", "platform", "lifetime_spend_usd", "lifetime_sessions", "total_matches",
                            "total_active_days", "churn_segment"),
                 [F.col("lifetime_spend_usd").desc_nulls_last(), F.col("player_id").asc()], k)


def spend_histogram(m13: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of positive lifetime spend in ``bins`` equal-width bins (RPT-6).

    Bounds come from two scalar subqueries; rows are binned and counted in one aggregate.
    """
    pos = m13.where(F.col("lifetime_spend_usd") > 0).select(F.col("lifetime_spend_usd").cast("double").alias("x"))
    lo, hi = pos.select(F.min("x")).scalar(), pos.select(F.max("x")).scalar()
    width = (hi - lo) / F.lit(bins)
    idx = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)))
    g = pos.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("players"))
    return g.select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"), "players")


def kpi_latest(m15: DataFrame, m20: DataFrame, m21: DataFrame, m14: DataFrame) -> DataFrame:
    """Latest value of each headline KPI as (kpi, value, as_of_date) rows (RPT-7)."""
    def pick(df, date_col, cols):
        r = latest_row(df, date_col)
        return r.select(F.col(date_col).alias("as_of_date"),
                        F.explode(F.array(*[F.struct(F.lit(c).alias("kpi"), F.col(c).cast("double").alias("value"))
                                            for c in cols])).alias("x")).select("x.kpi", "x.value", "as_of_date")
    parts = [pick(m15, "metric_date", ["dau", "mau", "stickiness_ratio"]),
             pick(m20, "revenue_date", ["total_revenue_usd"]),
             pick(m21, "metric_date", ["arpdau", "arppu", "payer_conversion_rate"]),
             m14.agg(F.lit("total_players").alias("kpi"), F.count(F.lit(1)).cast("double").alias("value"),
                     F.lit(None).cast("date").alias("as_of_date"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def match_global(m16: DataFrame, m18: DataFrame) -> DataFrame:
    """Mean kill rate, total matches, killers and maps as (metric, value) rows (RPT-8).

    The NULL killer and the NULL map are groups of the marts, but no killer and no map.
    """
    a = m16.agg(F.round(F.avg("kill_rate"), 3).alias("avg_kill_rate"),
                F.sum("total_matches").cast("double").alias("total_matches"),
                F.count("killer_character_id").cast("double").alias("killers"))
    b = m18.agg(F.count("map_id").cast("double").alias("maps"))
    return (a.unpivot([], ["avg_kill_rate", "total_matches", "killers"], "metric", "value")
            .unionByName(b.unpivot([], ["maps"], "metric", "value")))


def killer_rates(m16: DataFrame, support: int = 10, k: int | None = None) -> DataFrame:
    """Kill / escape rate per killer with at least ``support`` matches (RPT-9)."""
    r = m16.where(F.col("total_matches") >= support).select(
        F.coalesce("killer_name", "killer_character_id").alias("killer"), "killer_character_id",
        "total_matches", "kill_rate", "escape_rate", "avg_kills", "median_kills")
    order = [F.col("kill_rate").desc(), F.col("killer_character_id").asc()]
    return top_k(r, order, k) if k else r.orderBy(*order)


def map_rates(m18: DataFrame, support: int = 10) -> DataFrame:
    """Kill rate and rating per map with at least ``support`` matches (RPT-10)."""
    return m18.where(F.col("total_matches") >= support).select(
        F.coalesce("map_name", "map_id", F.lit("unknown")).alias("map"), "map_id",
        F.coalesce("realm", F.lit("Unknown")).alias("realm"), "map_size", "total_matches", "kill_rate",
        "balance_rating", F.round("avg_duration_seconds", 0).alias("avg_duration_sec")).orderBy(
        F.col("kill_rate").desc(), F.col("map_id").asc_nulls_last())


def perk_top(m17: DataFrame, role: str, support: int = 50, k: int = 20) -> DataFrame:
    """Best ``k`` perks of a role by win rate among perks used at least ``support`` times (RPT-11)."""
    r = m17.where((F.col("role") == role) & (F.col("times_used") >= support)).select(
        F.coalesce("perk_name", "perk_id").alias("perk"), "perk_id", "role", "times_used", "win_rate")
    return top_k(r, [F.col("win_rate").desc(), F.col("perk_id").asc()], k)


def mmr_histogram(m19: DataFrame) -> DataFrame:
    return m19.select("mmr_segment", "mmr_bucket", "player_count").orderBy(F.col("mmr_bucket").asc_nulls_last())


def mmr_segment_totals(m19: DataFrame) -> DataFrame:
    return m19.groupBy("mmr_segment").agg(F.sum("player_count").alias("players"))


def revenue_series(m20: DataFrame, days: int | None = None) -> DataFrame:
    """Daily revenue, categories and day-over-day deltas (RPT-13)."""
    s = _last_days(m20, "revenue_date", days, None).select(
        "revenue_date", "total_revenue_usd", "total_transactions", "total_unique_buyers",
        "cosmetic_revenue_usd", "dlc_revenue_usd", "rift_pass_revenue_usd", "auric_cells_revenue_usd",
        "revenue_7d_avg")
    return period_delta(s, "revenue_date", ["total_revenue_usd", "total_transactions", "revenue_7d_avg"])


def revenue_breakdown(m20: DataFrame) -> DataFrame:
    """All-time revenue per category: one aggregate, then unpivot (RPT-14)."""
    cats = ["cosmetic", "dlc", "rift_pass", "auric_cells"]
    a = m20.agg(*[F.sum(f"{c}_revenue_usd").cast("double").alias(c) for c in cats])
    return a.unpivot([], cats, "category", "revenue_usd")


def arpdau_series(m21: DataFrame, days: int | None = None) -> DataFrame:
    s = _last_days(m21, "metric_date", days, None)
    return s.select("metric_date", "arpdau", "arppu", "payer_conversion_rate").fillna(0)


FUNNEL_STAGES = ["active_users", "store_visitors", "purchasers"]


def funnel(m22: DataFrame, mode: str = "latest", days: int = 30) -> DataFrame:
    """Store funnel stages as rows: latest day, or the mean of the last ``days`` days (RPT-16)."""
    if mode == "latest":
        r = latest_row(m22, "metric_date").select(*[F.col(c).cast("double").alias(c) for c in FUNNEL_STAGES])
    else:
        r = _last_days(m22, "metric_date", days, None).agg(*[F.avg(c).alias(c) for c in FUNNEL_STAGES])
    return r.unpivot([], FUNNEL_STAGES, "stage", "users")
