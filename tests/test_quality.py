"""Quality checks and monitors (FIXTURES 1-2, 21)."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from gamelake.operators import quality as Q

T = dt.datetime


def test_unique_not_null_accepted_between(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 3000, "bad")], "k string, v int, e string")
    assert rows(Q.unique(df, "k")) == [("a", 2)]
    nn = {r.column_name: (r.null_count, r.status) for r in Q.not_null(df, ["k", "e"]).collect()}
    assert nn == {"k": (0, "pass"), "e": (1, "error")}
    assert rows(Q.accepted_values(df, "e", ["x"]), "k") == [("b",)]
    assert rows(Q.between(df, "v", 0, 2200), "v") == [(3000,)]


def test_volume_anomaly_window_across_midnight(spark):
    as_of = T(2024, 1, 8, 2, 0)
    # 10 events per day in the 6h slot ending at 02:00 (20:00 previous day .. 02:00), 3 today
    data = [(T(2024, 1, d, 23, 0),) for d in range(1, 7) for _ in range(10)]
    data += [(T(2024, 1, 7, 23, 30),)] * 3
    df = spark.createDataFrame(data, "ts timestamp_ntz")
    r = Q.volume_anomaly(df, "ts", F.lit(as_of).cast("timestamp_ntz")).collect()[0]
    assert (r.recent_count, r.avg_7d_count, r.status) == (3, round(60 / 7, 1), "ANOMALY")
    empty = Q.volume_anomaly(df.where("false"), "ts", F.lit(as_of).cast("timestamp_ntz")).collect()[0]
    assert empty.status == "ANOMALY"  # a dead feed is no missing baseline


def test_near_duplicates_exact_vs_near(spark):
    raw = spark.sql("""select parse_json(j) raw_data from values
        ('{"event_id":"1","score":5}'), ('{"event_id":"1","score":5}'),
        ('{"event_id":"2","score":5}'), ('{"event_id":"2","score":6}'), ('{"event_id":"3"}') as t(j)""")
    r = Q.near_duplicates(raw).collect()[0]
    assert (r.distinct_keys, r.duplicated_keys, r.exact_duplicate_keys, r.near_duplicate_keys, r.redundant_rows) == (3, 2, 1, 1, 2)


def test_schema_drift_and_required_keys(spark):
    raw = spark.sql("""select parse_json(j) raw_data, timestamp_ntz'2024-01-01 00:00:00' load_ts from values
        ('{"a":1,"b":2}'), ('{"a":1,"c":null}') as t(j)""")
    d = Q.schema_drift(spark, raw, ["a", "b", "z"])
    assert rows(d) == [("c", "new"), ("z", "missing")]  # a key holding JSON null is present
    req = {r.key: r.missing_rows for r in Q.required_keys(raw, ["a", "b"]).collect()}
    assert req == {"a": 0, "b": 1}


def test_min_rows_per_hour_reports_silent_hours(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 0, 5),), (T(2024, 1, 1, 3, 5),)], "ts timestamp_ntz")
    got = rows(Q.min_rows_per_hour(df, "ts", 1), "row_count")
    assert got == [(0,), (0,)]


def test_out_of_order_and_repair(spark):
    df = spark.createDataFrame([("s", "e1", T(2024, 1, 1, 0, 1), T(2024, 1, 1, 1)), ("s", "e2", T(2024, 1, 1, 0, 0), T(2024, 1, 1, 2))],
                               "session_id string, event_id string, event_timestamp timestamp_ntz, load_ts timestamp_ntz")
    assert rows(Q.out_of_order(df), "event_id", "seconds_early") == [("e2", 60)]
    p = spark.createDataFrame([(["a,b,c"],), (["x"],)], "killer_perks array<string>")
    assert sorted(len(r.killer_perks) for r in Q.repair_nested(p).collect()) == [1, 3]


def test_out_of_order_hot_session_matches_window(spark):
    import random
    from pyspark.sql import Window
    rnd = random.Random(11)
    base = T(2024, 1, 1)
    data = []
    for i in range(4000):
        sess = "bot" if i % 3 == 0 else f"s{rnd.randrange(50)}"
        data.append((sess, f"e{i:05d}", base + dt.timedelta(seconds=rnd.randrange(100000)),
                     base + dt.timedelta(seconds=i * 7 + rnd.randrange(5))))
    df = spark.createDataFrame(data, "session_id string, event_id string, event_timestamp timestamp_ntz, load_ts timestamp_ntz")
    got = rows(Q.out_of_order(df), "event_id", "prev_event_timestamp")
    w = Window.partitionBy("session_id").orderBy("load_ts", "event_id")
    ref = df.withColumn("p", F.lag("event_timestamp").over(w)).where(F.col("event_timestamp") < F.col("p"))
    assert got == rows(ref, "event_id", "p")


def test_out_of_order_needs_no_python_and_splits_a_session(spark):
    from conftest import plan_text
    base = T(2024, 1, 1)
    df = spark.createDataFrame([("bot" if i % 5 else None, f"e{i:03d}", base + dt.timedelta(minutes=(i * 37) % 500), None if i < 3 else base + dt.timedelta(minutes=i * 9))
                                for i in range(200)],
                               "session_id string, event_id string, event_timestamp timestamp_ntz, load_ts timestamp_ntz")
    from pyspark.sql import Window
    w = Window.partitionBy("session_id").orderBy(F.col("load_ts").asc_nulls_first(), "event_id")
    ref = df.withColumn("p", F.lag("event_timestamp").over(w)).where(F.col("event_timestamp") < F.col("p"))
    for unit in ("minute", "hour", "day"):
        got = Q.out_of_order(df, bucket=unit)
        assert rows(got, "event_id", "prev_event_timestamp") == rows(ref, "event_id", "p")
    plan = plan_text(Q.out_of_order(df))
    assert "Python" not in plan and "MapInPandas" not in plan and "_bucket" in plan


def test_silent_hours_inside_a_window(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 5),), (T(2024, 1, 1, 5),), (T(2024, 1, 1, 8),), (T(9999, 1, 1),), (T(1, 1, 1),), (None,)], "ts timestamp_ntz")
    got = Q.min_rows_per_hour(df, "ts", 2, F.lit("2024-01-01 04:30:00"), F.lit("2024-01-01 09:10:00"))
    assert rows(got) == [(T(2024, 1, 1, h), 1 if h == 8 else 0) for h in (4, 6, 7, 8, 9)]
    empty = Q.min_rows_per_hour(df.limit(0), "ts", 1, F.lit("2024-01-01 00:00:00"), F.lit("2024-01-01 01:00:00"))
    assert rows(empty) == [(T(2024, 1, 1, 0), 0), (T(2024, 1, 1, 1), 0)]
    assert Q.min_rows_per_hour(df.limit(0), "ts", 1).count() == 0


def test_keys_are_read_without_text(spark):
    from conftest import plan_text
    raw = spark.sql("""select try_parse_json(j) raw_data, timestamp_ntz'2024-01-01 00:00:00' load_ts from values
      ('{"a":1,"b":null}'), ('{"a":2,"c":{"b":1}}'), ('[1,2]'), ('7'), ('{}'), ('bad'), (null) as t(j)""")
    assert {r.key: r.missing_rows for r in Q.required_keys(raw, ["a", "b", "z"]).collect()} == {"a": 5, "b": 6, "z": 7}
    assert rows(Q.schema_drift(spark, raw, ["a", "z"])) == [("b", "new"), ("c", "new"), ("z", "missing")]
    for df in (Q.required_keys(raw, ["a"]), Q.schema_drift(spark, raw, ["a"])):
        assert "to_json" not in plan_text(df) and "StructsToJson" not in plan_text(df)
    assert {r.key: r.missing_rows for r in Q.required_keys(raw.limit(0), ["a"]).collect()} == {"a": 0}


def test_account_map_does_not_depend_on_input_order(spark):
    lines = [f'{{"bhvr_id":"b1","platform_accounts":[{{"platform":"p","platform_player_id":"x{i}"}}]}}' for i in range(6)]
    def of(order):
        df = spark.createDataFrame([(j,) for j in order], "j string").coalesce(1)
        return Q.account_map(df.select(F.parse_json("j").alias("raw_data"), F.lit("f").alias("filename"),
                                       F.lit("2024-01-01").cast("timestamp_ntz").alias("load_ts")))
    assert rows(of(lines), "platform_player_id") == rows(of(lines[::-1]), "platform_player_id")
