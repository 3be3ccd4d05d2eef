"""Physical-plan assertions: the plans we want at scale, not just the right rows."""
import datetime as dt

from pyspark.sql import functions as F

from gamelake.plans import intermediate as I
from gamelake.plans.player import fct_dau_mau
from gamelake.sources.seeds import seed


def _plan(df):
    from conftest import plan_text
    return plan_text(df)


def test_dau_mau_has_no_nested_loop_and_prunes_columns(spark, tmp_path):
    rows = [(f"p{i % 40}", dt.date(2024, 1, 1) + dt.timedelta(days=i % 45), "steam", "eu", i) for i in range(3000)]
    spark.createDataFrame(rows, "player_id string, activity_date date, platform string, region string, x int") \
        .write.parquet(str(tmp_path / "act"))
    a = spark.read.parquet(str(tmp_path / "act"))
    p = _plan(fct_dau_mau(a))
    assert "NestedLoop" not in p and "CartesianProduct" not in p
    assert "ReadSchema: struct<player_id:string,activity_date:date>" in p
    final = p.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and final.count("Window [lead(") == 1  # three counts from one pass


def test_seed_dimensions_are_broadcast(spark):
    m = spark.createDataFrame([("m1", dt.datetime(2024, 1, 1), "map_1", "public", 300, "b1", "killer_1", 2, 3, 4,
                                [("b2", "2", "surv_1", True, 1.0, 10.0, ["sperk_1"])])],
                              "match_id string, event_timestamp timestamp_ntz, map_id string, game_mode string, "
                              "duration_seconds int, killer_player_id string, killer_character_id string, killer_kills int, "
                              "killer_hooks int, killer_score int, survivors array<struct<player_id string, "
                              "platform_player_id string, character_id string, escaped boolean, generators_completed double, "
                              "score double, perks array<string>>>")
    p = _plan(I.int_match_enriched(m, seed(spark, "seed_killers"), seed(spark, "seed_survivors")))
    assert p.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in p


def test_date_partition_filter_prunes(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 10).alias("k"),
                                 F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("event_date"))
    df.write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    q = spark.read.parquet(str(tmp_path / "t")).where(F.col("event_date") >= "2024-01-04")
    p = _plan(q)
    assert "PartitionFilters: [isnotnull(event_date" in p


def test_variant_paths_are_pushed_into_the_bronze_scan(spark, tmp_path):
    from gamelake.plans.staging import stg_sessions
    raw = spark.sql("""select parse_json(j) raw_data, 'f' filename, timestamp_ntz'2024-01-01 00:00:00' load_ts from values
        ('{"event_id":"1","timestamp":"2024-01-01T00:00:00Z","player_id":"p","action":"login","big":"xxxxxxxx"}') as t(j)""")
    raw.write.parquet(str(tmp_path / "bronze"))
    p = _plan(stg_sessions(spark.read.parquet(str(tmp_path / "bronze"))).select("event_id", "action"))
    scan = [l for l in p.splitlines() if "ReadSchema" in l][0]
    assert "raw_data:struct<" in scan and "variant" not in scan.split("ReadSchema")[1].split("raw_data:struct")[0]


def test_players_age_while_the_feed_stands_still(spark):
    """Without ``as_of`` recency counts from today; "latest" counts from the data."""
    import datetime as dt
    from gamelake.functions.classify import churn_segment
    from gamelake.plans.intermediate import int_player_first_last
    days = {"p1": dt.datetime(2024, 1, 1), "p2": dt.datetime(2024, 1, 12), "p3": dt.datetime(2024, 1, 31), "p4": dt.datetime(2024, 2, 20)}
    s = spark.createDataFrame(list(days.items()), "player_id string, event_timestamp timestamp_ntz")
    p = s.select("player_id", F.lit("steam").alias("platform"), F.lit("eu").alias("region"), F.col("event_timestamp").alias("registered_at"))

    def segments(as_of):
        f = int_player_first_last(s, p, as_of)
        return {r["player_id"]: r["s"] for r in f.select("player_id", churn_segment("days_since_last_seen").alias("s")).collect()}
    assert segments("latest") == {"p1": "churned", "p2": "churned", "p3": "dormant", "p4": "active"}
    assert segments("2024-01-20") == {"p1": "dormant", "p2": "at_risk", "p3": "active", "p4": "active"}
    assert set(segments(None).values()) == {"churned"}


def test_retention_of_several_cohorts_and_its_bounds(spark):
    """Three weeks of cohorts, each with another share of returns; the bounds check finds a bad row."""
    import datetime as dt
    from gamelake.operators import quality as Q
    from gamelake.plans.player import fct_player_retention
    first, active = [], []
    for w in range(3):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=7 * w)
        for i in range(4):
            first.append((f"c{w}p{i}", day))
            active += [(f"c{w}p{i}", day + dt.timedelta(days=n)) for n in (1, 7, 30) if i < w + (n == 1)]
    f = spark.createDataFrame(first, "player_id string, first_seen_date date")
    a = spark.createDataFrame(active, "player_id string, activity_date date")
    r = fct_player_retention(f, a)
    got = {x["cohort_week"]: (x["cohort_size"], x["retained_d1"], x["retained_d7"], x["retained_d30"], float(x["retention_d1"])) for x in r.collect()}
    assert got == {dt.date(2024, 1, 1): (4, 1, 0, 0, 0.25), dt.date(2024, 1, 8): (4, 2, 1, 1, 0.5), dt.date(2024, 1, 15): (4, 3, 2, 2, 0.75)}
    assert Q.retention_bounds(r).count() == 0
    assert Q.retention_bounds(r.withColumn("retention_d7", F.lit(1.5))).count() == 3
