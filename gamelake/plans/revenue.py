"""Revenue marts (M-20..M-22)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.functions.semantics import safe_ratio

CATEGORY_COLUMNS = ["cosmetic", "dlc", "rift_pass", "auric_cells"]


def pivot_sum(df: DataFrame, by: list[str], key: str, values: list[str], measure: str,
              fmt: str = "{}_revenue_usd") -> DataFrame:
    """``sum(case when key = v then measure else 0 end)`` per value: a fixed-column pivot
    that stays one hash aggregate (AGG-5). Values outside ``values`` get no column."""
    return df.groupBy(*by).agg(*[
        F.sum(F.when(F.col(key) == v, F.col(measure)).otherwise(F.lit(0))).alias(fmt.format(v))
        for v in values])


def fct_daily_revenue(revenue_daily: DataFrame) -> DataFrame:
    """Daily totals, per-category revenue and a 7-row trailing average.

    ``total_unique_buyers`` adds per-category distinct buyers, so one buyer in two
    categories counts twice (the documented definition); ``true_unique_buyers`` in
    ``daily_unique_buyers`` gives the distinct count.
    """
    d = revenue_daily
    agg = d.groupBy("revenue_date").agg(
        F.sum("total_revenue_usd").alias("total_revenue_usd"),
        F.sum("transaction_count").alias("total_transactions"),
        F.sum("unique_buyers").alias("total_unique_buyers"),
        *[F.sum(F.when(F.col("item_type") == c, F.col("total_revenue_usd")).otherwise(F.lit(0)))
          .alias(f"{c}_revenue_usd") for c in CATEGORY_COLUMNS])
    # one row per day: the unpartitioned row-frame window runs over a calendar-sized series
    w = Window.orderBy("revenue_date").rowsBetween(-6, 0)
    money = ["total_revenue_usd"] + [f"{c}_revenue_usd" for c in CATEGORY_COLUMNS]
    out = agg.select("revenue_date", *[F.col(c).cast("decimal(18,2)").alias(c) if c in money else F.col(c)
                                       for c in agg.columns if c != "revenue_date"])
    return out.withColumn("revenue_7d_avg", F.avg("total_revenue_usd").over(w))


def daily_unique_buyers(stg_store: DataFrame) -> DataFrame:
    """True distinct buyers per day (the non-over-counted companion of M-20)."""
    return stg_store.groupBy(F.to_date("event_timestamp").alias("revenue_date")).agg(
        F.countDistinct("player_id").alias("true_unique_buyers"))


def fct_arpdau(dau_mau: DataFrame, daily_revenue: DataFrame) -> DataFrame:
    """ARPDAU (4 dp), ARPPU (2 dp) and payer conversion (4 dp) per DAU date; revenue on
    a date without DAU is dropped by the left join from the DAU side."""
    r = daily_revenue.select(F.col("revenue_date").alias("metric_date"), "total_revenue_usd", "total_unique_buyers")
    j = dau_mau.select("metric_date", "dau", "mau").join(r, "metric_date", "left")
    rev = F.coalesce(F.col("total_revenue_usd"), F.lit(0)).cast("decimal(18,2)")
    payers = F.coalesce(F.col("total_unique_buyers"), F.lit(0))
    return j.select(
        "metric_date", "dau", "mau", rev.alias("daily_revenue_usd"), payers.alias("paying_users"),
        safe_ratio(rev.cast("double"), "dau", 4, null_to_zero=True).alias("arpdau"),
        safe_ratio(rev.cast("double"), F.col("total_unique_buyers"), 2, null_to_zero=True).alias("arppu"),
        safe_ratio(payers, "dau", 4, null_to_zero=True).alias("payer_conversion_rate"))


def fct_store_conversion(daily_activity: DataFrame, stg_store: DataFrame) -> DataFrame:
    """Daily funnel: active users -> store visitors -> purchasers.

    Activity is first reduced to one row per (date, player) with a visited flag, so
    both distinct counts become a count and a sum in one aggregate (no Expand).
    Purchasers need not have visited, so purchase_rate may exceed 1.
    """
    per_player = daily_activity.groupBy("activity_date", "player_id").agg(
        F.max((F.col("store_visits") > 0).cast("int")).alias("_visited"))
    funnel = per_player.groupBy("activity_date").agg(
        F.count(F.lit(1)).alias("active_users"), F.sum("_visited").cast("bigint").alias("store_visitors"))
    purchases = stg_store.groupBy(F.to_date("event_timestamp").alias("activity_date")).agg(
        F.countDistinct("player_id").alias("_purchasers"))
    j = funnel.join(purchases, "activity_date", "left")
    buyers = F.coalesce(F.col("_purchasers"), F.lit(0))
    return j.select(
        F.col("activity_date").alias("metric_date"), "active_users", "store_visitors",
        buyers.alias("purchasers"),
        safe_ratio("store_visitors", "active_users", 4).alias("visit_rate"),
        safe_ratio(buyers, "store_visitors", 4).alias("purchase_rate"),
        safe_ratio(buyers, "active_users", 4).alias("overall_conversion_rate"))
