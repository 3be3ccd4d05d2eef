"""Usage / cost analytics over usage-log DataFrames (UC-1..UC-10).

Inputs: ``metering(warehouse_name, start_time, credits_used, credits_used_compute,
credits_used_cloud_services)``, ``query_log(query_id, ..., start_time, execution_time,
bytes_scanned, partitions_scanned, partitions_total, query_text, ...)`` and
``storage(usage_date, storage_bytes, stage_bytes, failsafe_bytes)``. ``as_of`` is a
timestamp Column (a literal or a scalar subquery); relative windows hang off it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.functions.semantics import safe_ratio

GB = 1024 ** 3
TB = 1024 ** 4


def _since(df: DataFrame, col: str, as_of: Column, days: int) -> DataFrame:
    return df.where(F.col(col) >= F.timestamp_add("DAY", F.lit(-days), as_of))


def usage_daily(metering: DataFrame, as_of: Column, days: int = 30, by_warehouse: bool = True) -> DataFrame:
    """Credits per (warehouse,) day over the last ``days`` days (UC-1)."""
    keys = (["warehouse_name"] if by_warehouse else []) + [F.to_date("start_time").alias("usage_date")]
    return _since(metering, "start_time", as_of, days).groupBy(*keys).agg(
        F.sum("credits_used").alias("credits_used"), F.sum("credits_used_compute").alias("credits_compute"),
        F.sum("credits_used_cloud_services").alias("credits_cloud"))


def usage_month_to_date(metering: DataFrame, as_of: Column) -> DataFrame:
    """Credits per warehouse since the start of ``as_of``'s month."""
    return metering.where(F.col("start_time") >= F.date_trunc("month", as_of)).groupBy("warehouse_name").agg(
        F.sum("credits_used").alias("credits_used"))


def usage_rolling_avg(metering: DataFrame, as_of: Column, days: int = 37) -> DataFrame:
    """Daily credits per warehouse with a 7-row trailing average per warehouse (UC-2)."""
    d = _since(metering, "start_time", as_of, days).groupBy(
        "warehouse_name", F.to_date("start_time").alias("usage_date")).agg(F.sum("credits_used").alias("credits_used"))
    w = Window.partitionBy("warehouse_name").orderBy("usage_date").rowsBetween(-6, 0)
    return d.withColumn("credits_7d_avg", F.avg("credits_used").over(w))


def warehouse_utilization(query_log: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Per warehouse and day: query count, execution seconds, GB scanned, scan ratio (UC-3)."""
    q = _since(query_log, "start_time", as_of, days).where(F.col("warehouse_name").isNotNull())
    g = q.groupBy("warehouse_name", F.to_date("start_time").alias("usage_date")).agg(
        F.count(F.lit(1)).alias("query_count"),
        (F.sum("execution_time") / 1000).alias("total_execution_seconds"),
        (F.avg("execution_time") / 1000).alias("avg_execution_seconds"),
        (F.max("execution_time") / 1000).alias("max_execution_seconds"),
        (F.sum("bytes_scanned") / GB).alias("total_gb_scanned"),
        F.sum("partitions_scanned").alias("total_partitions_scanned"),
        F.sum("partitions_total").alias("total_partitions_total"))
    return g.withColumn("partition_scan_ratio",
                        safe_ratio("total_partitions_scanned", "total_partitions_total", 4))


def _query_details(q: DataFrame) -> DataFrame:
    return q.select(
        "query_id", "query_type", "warehouse_name", "user_name", "role_name", "database_name", "schema_name",
        "execution_status", "start_time",
        (F.col("total_elapsed_time") / 1000).alias("elapsed_seconds"),
        (F.col("execution_time") / 1000).alias("execution_seconds"),
        (F.col("bytes_scanned") / GB).alias("gb_scanned"),
        "rows_produced", "partitions_scanned", "partitions_total",
        safe_ratio("partitions_scanned", "partitions_total", 4).alias("partition_efficiency"),
        F.substring("query_text", 1, 200).alias("query_preview"), "execution_time", "bytes_scanned")


def expensive_queries(query_log: DataFrame, as_of: Column, k: int = 20, days: int = 7) -> DataFrame:
    """Top ``k`` successful queries of the last ``days`` days by execution time (UC-4).

    A global top-k: each task keeps its own k best, the final k are merged
    (TakeOrderedAndProject); ties broken by query_id.
    """
    q = _since(query_log, "start_time", as_of, days).where(F.col("execution_status") == "SUCCESS")
    return (_query_details(q).orderBy(F.col("execution_time").desc_nulls_last(), F.col("query_id").asc())
            .limit(k).drop("execution_time", "bytes_scanned"))


def budget_check(metering: DataFrame, as_of: Column, budget: float = 10.0, warn: float = 0.80) -> DataFrame:
    """Month-to-date credits against a budget (UC-5): one verdict row."""
    g = metering.where(F.col("start_time") >= F.date_trunc("month", as_of)).agg(
        F.coalesce(F.sum("credits_used"), F.lit(0.0)).alias("total_credits_used"))
    pct = F.col("total_credits_used") / F.lit(budget) if budget > 0 else F.lit(0.0)
    return g.select("total_credits_used", F.lit(float(budget)).alias("monthly_budget"),
                    F.round(pct, 4).alias("usage_pct"),
                    F.when(pct >= 1.0, "error").when(pct >= warn, "warn").otherwise("ok").alias("status"))


def scan_threshold(query_log: DataFrame, as_of: Column, tb: float = 1.0, k: int = 10) -> DataFrame:
    """Successful queries of the last day scanning more than ``tb`` TB, top ``k`` by bytes (UC-6)."""
    q = (_since(query_log, "start_time", as_of, 1)
         .where((F.col("bytes_scanned") > F.lit(tb * TB)) & (F.col("execution_status") == "SUCCESS")))
    return (q.orderBy(F.col("bytes_scanned").desc(), F.col("query_id").asc()).limit(k)
            .select("query_id", F.col("user_name").alias("user"), F.col("warehouse_name").alias("warehouse"),
                    F.round(F.col("bytes_scanned") / GB, 2).alias("gb_scanned"),
                    (F.col("total_elapsed_time") / 1000).alias("elapsed_seconds"),
                    F.substring("query_text", 1, 200).alias("preview")))


def usage_cumulative(metering: DataFrame, as_of: Column, budget: float = 10.0) -> DataFrame:
    """Running month-to-date credits over a generated day spine for ``as_of``'s month,
    with the budget line and the days left in the month (UC-7). The spine is one row per
    calendar day, so the running sum runs over at most 31 rows."""
    start, end = F.to_date(F.date_trunc("month", as_of)), F.last_day(F.to_date(as_of))
    daily = (metering.where(F.col("start_time") >= F.date_trunc("month", as_of))
             .groupBy(F.to_date("start_time").alias("day")).agg(F.sum("credits_used").alias("daily_credits")))
    spine = metering.sparkSession.range(1).select(F.explode(F.sequence(start, end)).alias("day"))
    j = spine.join(daily, "day", "left").withColumn("daily_credits", F.coalesce("daily_credits", F.lit(0.0)))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return j.select("day", "daily_credits", F.sum("daily_credits").over(w).alias("cumulative_credits"),
                    F.lit(float(budget)).alias("budget"),
                    F.date_diff(end, F.to_date(as_of)).alias("days_left_in_month"))


def usage_pivot(metering: DataFrame, warehouses: list[str], as_of: Column | None = None, days: int = 30) -> DataFrame:
    """Day x warehouse credits of the last ``days`` days, missing cells 0 (UC-8).

    The columns are an explicit list; credits of any other warehouse go into ``other``.
    """
    m = metering if as_of is None else _since(metering, "start_time", as_of, days)
    named = F.when(F.col("warehouse_name").isin(*warehouses), F.col("warehouse_name")).otherwise("other")
    return (m.groupBy(F.to_date("start_time").alias("usage_date"))
            .agg(*[F.coalesce(F.sum(F.when(named == w, F.col("credits_used"))), F.lit(0.0)).alias(w)
                   for w in [*warehouses, "other"]]))


def usage_by_warehouse(metering: DataFrame) -> DataFrame:
    """Total credits per warehouse (the pivot's companion table)."""
    return metering.groupBy("warehouse_name").agg(F.sum("credits_used").alias("total_credits"))


def storage_trend(storage: DataFrame, as_of: Column | None = None, days: int | None = None) -> DataFrame:
    """Bytes per day converted to GB, and the mean total of a row in TB (UC-9)."""
    s = storage
    if as_of is not None and days is not None:
        s = s.where(F.col("usage_date") >= F.date_sub(F.to_date(as_of), days))
    total = F.col("storage_bytes") + F.col("stage_bytes") + F.col("failsafe_bytes")
    g = s.groupBy("usage_date").agg(F.avg(total).alias("mean_total"), *[
        F.sum(c).alias(c) for c in ["storage_bytes", "stage_bytes", "failsafe_bytes"]])
    return g.select("usage_date", (F.col("storage_bytes") / GB).alias("storage_gb"),
                    (F.col("stage_bytes") / GB).alias("stage_gb"), (F.col("failsafe_bytes") / GB).alias("failsafe_gb"),
                    (F.col("mean_total") / TB).alias("total_tb"))


def top_bytes(query_log: DataFrame, as_of: Column, k: int = 10, days: int = 7) -> DataFrame:
    """Top ``k`` successful warehouse queries of the last ``days`` days by bytes scanned, NULL bytes last (UC-10)."""
    q = _since(query_log, "start_time", as_of, days).where(
        (F.col("execution_status") == "SUCCESS") & F.col("warehouse_name").isNotNull())
    return (q.orderBy(F.col("bytes_scanned").desc_nulls_last(), "query_id", "start_time", "user_name").limit(k)
            .select("query_id", "warehouse_name", "user_name",
                    F.round(F.col("total_elapsed_time") / 1000, 1).alias("elapsed_seconds"),
                    F.round(F.col("bytes_scanned") / GB, 4).alias("gb_scanned"),
                    F.round("credits_used_cloud_services", 6).alias("credits"),
                    F.substring("query_text", 1, 150).alias("query_preview"), "start_time"))
