"""Property tests (hypothesis, few examples: each one is a Spark job)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute import rolling_distinct_theta
from conftest import rows
from gamelake.operators.dedup import latest_by
from gamelake.operators.rolling import rolling_distinct

D0 = dt.date(2024, 1, 1)
pairs = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 60)), min_size=1, max_size=120)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(pairs, st.sampled_from([1, 3, 7, 30]))
def test_rolling_distinct_equals_range_join(spark, data, n):
    a = spark.createDataFrame([(f"p{p}", D0 + dt.timedelta(days=d)) for p, d in data], "player_id string, activity_date date")
    assert rows(rolling_distinct(a, "activity_date", "player_id", n, "x")) == \
        rows(rolling_distinct_theta(a, "activity_date", "player_id", n, "x"))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 100)), min_size=1, max_size=60))
def test_dedup_is_idempotent_and_keeps_one_per_key(spark, data):
    df = spark.createDataFrame([(f"e{k}", l, v) for k, l, v in data], "k string, load int, v int")
    order = [F.col("load").desc(), F.col("v").desc()]
    once = latest_by(df, "k", order)
    assert rows(latest_by(once, "k", order)) == rows(once)
    assert once.count() == len({k for k, _, _ in data})


def test_segment_counts_sum_to_players(spark):
    from gamelake.plans.match import fct_mmr_distribution
    mmr = spark.createDataFrame(
        [(f"e{i}", dt.datetime(2024, 1, 1, 0, i % 60), f"p{i % 37}", None if i % 11 == 0 else (i * 97) % 2201, "killer")
         for i in range(500)], "event_id string, event_timestamp timestamp_ntz, player_id string, mmr_after int, role string")
    d = fct_mmr_distribution(mmr)
    assert d.agg(F.sum("player_count")).first()[0] == 37
    assert abs(d.agg(F.sum("pct_of_total")).first()[0] - 1.0) < 1e-3
