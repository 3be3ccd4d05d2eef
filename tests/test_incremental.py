"""Upsert, look-back refresh == full refresh (D-3), partition merge and SCD2 (FIXTURES 19-20)."""
import datetime as dt
import os
import random
import uuid

from pyspark.sql import functions as F

from conftest import rows
from gamelake.operators.incremental import (incremental_filter, merge_into_partitions, merge_upsert,
                                            refresh_daily_revenue, refresh_dau_mau, scd2_apply)
from gamelake.plans.player import fct_dau_mau
from gamelake.plans.revenue import fct_daily_revenue
from gamelake.session import scratch_path

D = dt.date


def test_merge_upsert_replaces_and_appends(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    b = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert rows(merge_upsert(t, b, "k")) == [("a", 1), ("b", 20), ("c", 30)]


def test_incremental_filter_first_run_and_lookback(spark):
    src = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in range(1, 11)], "ts timestamp_ntz")
    assert incremental_filter(src, None, "ts").count() == 10
    tgt = src.where(F.col("ts") <= dt.datetime(2024, 1, 6))
    got = [r.ts.day for r in incremental_filter(src, tgt, "ts", 3).orderBy("ts").collect()]
    assert got == [3, 4, 5, 6, 7, 8, 9, 10]


def _activity(spark, seed=3):
    rnd = random.Random(seed)
    data = [(f"p{rnd.randrange(60)}", D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(75))) for _ in range(2500)]
    return spark.createDataFrame(data, "player_id string, activity_date date")


def test_dau_mau_incremental_equals_full(spark):
    a = _activity(spark)
    full = fct_dau_mau(a)
    cutoff = D(2024, 3, 1)
    previous = fct_dau_mau(a.where(F.col("activity_date") < cutoff))
    # late rows for two days before the cutoff arrive with the new batch
    inc = refresh_dau_mau(previous, a, F.lit(cutoff - dt.timedelta(days=3)))
    assert rows(inc) == rows(full)


def test_daily_revenue_incremental_equals_full(spark):
    rnd = random.Random(5)
    from decimal import Decimal
    data = [(D(2024, 1, 1) + dt.timedelta(days=i), c, "usd", 1 + rnd.randrange(5), 1, Decimal(f"{rnd.randrange(1, 9999)}.{rnd.randrange(100):02d}"))
            for i in range(40) for c in ("cosmetic", "dlc") if rnd.random() < 0.8]
    rd = spark.createDataFrame(data, "revenue_date date, item_type string, currency string, transaction_count bigint, "
                                     "unique_buyers bigint, total_revenue_usd decimal(18,2)")
    full = fct_daily_revenue(rd)
    cutoff = D(2024, 1, 25)
    prev = fct_daily_revenue(rd.where(F.col("revenue_date") < cutoff))
    inc = refresh_daily_revenue(prev, rd, F.lit(cutoff - dt.timedelta(days=3)))
    assert rows(inc) == rows(full)


def test_merge_into_partitions_moves_rows_between_dates(spark):
    path = scratch_path(spark, "test-merge", uuid.uuid4().hex)
    t0 = spark.createDataFrame([("e1", D(2024, 1, 1), 1), ("e2", D(2024, 1, 1), 2), ("e3", D(2024, 1, 2), 3)],
                               "event_id string, event_date date, v int")
    merge_into_partitions(spark, t0, path, "event_id", "event_date")
    # e2 is re-delivered with a timestamp past midnight: it must leave 2024-01-01
    b = spark.createDataFrame([("e2", D(2024, 1, 2), 20), ("e4", D(2024, 1, 3), 4)], "event_id string, event_date date, v int")
    merge_into_partitions(spark, b, path, "event_id", "event_date")
    got = rows(spark.read.parquet(path), "event_id", "event_date", "v")
    assert got == [("e1", D(2024, 1, 1), 1), ("e2", D(2024, 1, 2), 20), ("e3", D(2024, 1, 2), 3), ("e4", D(2024, 1, 3), 4)]
    # replaying the same batch is idempotent
    merge_into_partitions(spark, b, path, "event_id", "event_date")
    assert rows(spark.read.parquet(path), "event_id", "event_date", "v") == got


def test_scd2_versions_and_null_safe_compare(spark):
    schema = "player_id string, current_mmr int, mmr_segment string"
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    s1 = spark.createDataFrame([("a", 100, "new"), ("b", 700, "casual"), ("c", None, "hardcore")], schema)
    h1 = scd2_apply(None, s1, "player_id", ["current_mmr", "mmr_segment"], t("2024-01-01 00:00:00"))
    s2 = spark.createDataFrame([("a", 100, "new"), ("b", 800, "casual"), ("c", None, "hardcore"), ("d", 5, "new")], schema)
    h2 = scd2_apply(h1, s2, "player_id", ["current_mmr", "mmr_segment"], t("2024-01-02 00:00:00"))
    s3 = spark.createDataFrame([("a", 100, "new"), ("b", 700, "casual"), ("c", 5, "new"), ("d", 5, "new")], schema)
    h3 = scd2_apply(h2, s3, "player_id", ["current_mmr", "mmr_segment"], t("2024-01-03 00:00:00"))
    got = rows(h3, "player_id", "current_mmr", "is_current")
    assert got == [("a", 100, True), ("b", 700, False), ("b", 700, True), ("b", 800, False),
                   ("c", 5, True), ("c", None, False), ("d", 5, True)]
    # replaying the same state adds nothing
    h4 = scd2_apply(h3, s3, "player_id", ["current_mmr", "mmr_segment"], t("2024-01-04 00:00:00"))
    assert h4.count() == h3.count()
    assert h3.where("is_current").groupBy("player_id").count().where("count > 1").count() == 0


def test_incremental_load_is_idempotent_and_picks_up_late_rows(spark):
    from gamelake.operators.incremental import incremental_load
    from gamelake.plans.staging import stg_sessions
    path = scratch_path(spark, "test-incr", uuid.uuid4().hex)
    mk = lambda eid, ts, load: (f'{{"event_id":"{eid}","timestamp":"{ts}","player_id":"p","action":"login"}}', "f", load)
    data = [mk("1", "2024-01-01T10:00:00Z", "2024-01-01 10:05:00"), mk("2", "2024-01-02T10:00:00Z", "2024-01-02 10:05:00")]
    raw = lambda d: spark.createDataFrame(d, "j string, filename string, load_ts string").select(
        F.parse_json("j").alias("raw_data"), "filename", F.col("load_ts").cast("timestamp_ntz").alias("load_ts"))
    incremental_load(spark, raw(data), stg_sessions, path)
    incremental_load(spark, raw(data), stg_sessions, path)              # same input again: no change
    assert spark.read.parquet(path).count() == 2
    late = data + [mk("3", "2023-12-31T23:00:00Z", "2024-01-02 12:00:00"),   # event 2 days old, loaded now
                   mk("1", "2024-01-01T10:00:30Z", "2024-01-02 12:00:01")]   # re-delivered, last load wins
    out = incremental_load(spark, raw(late), stg_sessions, path)
    got = rows(out, "event_id", "event_timestamp")
    assert got == [("1", dt.datetime(2024, 1, 1, 10, 0, 30)), ("2", dt.datetime(2024, 1, 2, 10, 0)),
                   ("3", dt.datetime(2023, 12, 31, 23, 0))]
