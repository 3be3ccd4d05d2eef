"""Dedup, rolling distinct, retention, exact median (FIXTURES 1-2, 11, 12)."""
import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from gamelake.operators.dedup import latest_by
from gamelake.operators.joins import retention_flags
from gamelake.operators.rolling import rolling_distinct
from gamelake.operators.stats import exact_percentile
from brute import rolling_distinct_theta

D = dt.date


def test_latest_by_last_load_wins_and_null_first(spark):
    df = spark.createDataFrame([
        ("e1", dt.datetime(2024, 1, 1, 1), "a", 1), ("e1", dt.datetime(2024, 1, 1, 2), "a", 2),  # near duplicate
        ("e2", dt.datetime(2024, 1, 1, 1), "a", 3), ("e2", None, "b", 4),                       # NULL ranks first
    ], "k string, load_ts timestamp_ntz, filename string, v int")
    out = latest_by(df, "k", [F.col("load_ts").desc_nulls_first(), F.col("filename").desc()])
    assert rows(out, "k", "v") == [("e1", 2), ("e2", 4)]


def test_dedup_plans_window_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    from conftest import plan_text
    plan = plan_text(latest_by(df, "k", [F.col("t").desc()]))
    assert "WindowGroupLimit" in plan


def _sparse_activity(spark, seed=7):
    rnd = random.Random(seed)
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(110) if not 40 <= i < 50]  # a 10-day hole
    data = [(f"p{rnd.randrange(400)}", d) for d in days for _ in range(rnd.randrange(1, 30))]
    data += [("edge", D(2024, 1, 1)), ("edge", D(2024, 1, 30))]  # active only at window edges
    return spark.createDataFrame(data, "player_id string, activity_date date")


def test_rolling_distinct_methods_agree(spark):
    a = _sparse_activity(spark)
    for n in (7, 30):
        got = {m: rows(rolling_distinct(a, "activity_date", "player_id", n, "x", m)) for m in ("coverage", "explode")}
        brute = rows(rolling_distinct_theta(a, "activity_date", "player_id", n, "x"))
        assert got["coverage"] == brute == got["explode"]


def test_rolling_distinct_hot_player_and_no_nested_loop(spark):
    hot = [("hot", D(2024, 1, 1) + dt.timedelta(days=i % 20)) for i in range(3000)]
    cold = [(f"c{i}", D(2024, 1, 1) + dt.timedelta(days=i % 20)) for i in range(6000)]
    a = spark.createDataFrame(hot + cold, "player_id string, activity_date date")
    out = rolling_distinct(a, "activity_date", "player_id", 7, "wau")
    assert rows(out) == rows(rolling_distinct_theta(a, "activity_date", "player_id", 7, "wau"))
    from conftest import plan_text
    assert "NestedLoop" not in plan_text(out)


def test_retention_is_exact_day(spark):
    cohort = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 1)), ("c", D(2024, 1, 1))],
                                   "player_id string, cohort_date date")
    act = spark.createDataFrame([("a", D(2024, 1, 2)), ("a", D(2024, 1, 8)), ("a", D(2024, 1, 31)),
                                 ("b", D(2024, 1, 7)), ("b", D(2024, 1, 9))], "player_id string, activity_date date")
    out = retention_flags(cohort, act, [1, 7, 30])
    assert rows(out, "player_id", "retained_d1", "retained_d7", "retained_d30") == [
        ("a", True, True, True), ("b", False, False, False), ("c", False, False, False)]


def test_exact_median_matches_interpolation(spark):
    data = [("g", v) for v in [1, 2, 3, 4]] + [("h", v) for v in [5, 5, 9]] + [("n", None)]
    df = spark.createDataFrame(data, "g string, v int")
    got = dict((r.g, r.m) for r in exact_percentile(df, ["g"], "v", 0.5, "m").collect())
    assert got == {"g": 2.5, "h": 5.0}


def test_session_metrics_hot_session_one_row_per_login(spark):
    from gamelake.plans.intermediate import int_session_metrics
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    data = []
    for i in range(400):  # one hot session: 200 logins and 200 logouts
        data.append((f"e{i}", base + dt.timedelta(seconds=i * 30), "p1", "hot", "login" if i % 2 == 0 else "logout"))
    data.append(("x1", base, "p2", "cold", "login"))  # no logout: duration 0
    s = spark.createDataFrame(data, "event_id string, event_timestamp timestamp_ntz, player_id string, session_id string, "
                                    "action string").withColumn("platform", F.lit("steam")).withColumn(
        "region", F.lit("eu")).withColumn("client_version", F.lit("1"))
    m = int_session_metrics(s)
    assert m.count() == 201
    hot = m.where("session_id = 'hot'").select("logout_at", "event_count").distinct().collect()
    assert len(hot) == 1 and hot[0].event_count == 400 and hot[0].logout_at == base + dt.timedelta(seconds=399 * 30)
    cold = m.where("session_id = 'cold'").first()
    assert (cold.session_duration_seconds, cold.actions_per_minute) == (0, 0.0)


def test_percentile_of_a_hot_group_is_spread_and_exact(spark):
    import random
    import statistics
    from conftest import plan_text
    from gamelake.operators.stats import exact_percentile, exact_percentile_spread
    rnd = random.Random(2)
    data = [("hot", rnd.random() ** 3 * 1e6) for _ in range(5000)] + [("hot", 5.0)] * 3000 + [("one", 4.0), (None, 1.0), (None, 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["percentile"] for r in exact_percentile_spread(df, ["g"], "v").collect()}
    assert got == {"hot": statistics.median(v for g, v in data if g == "hot"), "one": 4.0, None: 1.5}
    for p in (0.0, 0.25, 0.9, 1.0):
        a, b = exact_percentile_spread(df, ["g"], "v", p), exact_percentile(df, ["g"], "v", p)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert exact_percentile_spread(df.limit(0), ["g"], "v").count() == 0
    plan = plan_text(exact_percentile_spread(df, ["g"], "v"))
    assert "windowspecdefinition(g" in plan and "_range" in plan


def test_sketches_roll_up(spark):
    from gamelake.operators.stats import distinct_rollup, distinct_sketches
    df = spark.range(40000).selectExpr("id % 10 AS day", "id % 20000 AS player")
    days = distinct_sketches(df, ["day"], "player")
    n = distinct_rollup(days, F.lit(1).alias("all")).first()["n_distinct"]
    assert days.count() == 10 and abs(n - 20000) < 600


def test_dear_tie_break_only_for_ties(spark):
    from gamelake.operators.dedup import latest_by, latest_by_tied
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", 2, "x"), ("b", 1, "w"), (None, 1, "n")], "k string, o int, v string")
    tie = F.xxhash64("v")
    assert sorted(map(str, latest_by_tied(df, "k", [F.col("o").desc()], tie).collect())) == \
        sorted(map(str, latest_by(df, "k", [F.col("o").desc(), tie]).collect()))
