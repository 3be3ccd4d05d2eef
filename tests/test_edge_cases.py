"""Cases that lose or change rows when handled carelessly: merges, snapshots, staging, identity."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gamelake.operators.incremental import (maintain_mart, merge_into_partitions, merge_upsert, read_table,
                                            refresh_dau_mau, scd2_apply)
from gamelake.operators.joins import retention_flags
from gamelake.operators.quality import identity_conflicts, resolve_identity, retention_bounds
from gamelake.plans.staging import stg_sessions, stg_store_transactions
from gamelake.plans.usage import usage_pivot

D = dt.date
SCHEMA = "id string, v int, day date"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def merged(spark, path, *batches):
    touched = None
    for b in batches:
        touched = merge_into_partitions(spark, frame(spark, b), path, "id", "day")
    stored = rows(spark.read.schema(SCHEMA).parquet(path), "id", "v", "day")
    return stored, None if touched is None else {r["day"] for r in touched.collect()}


def test_merge_keeps_null_dates_and_keys(spark, tmp_path):
    got, touched = merged(spark, str(tmp_path / "t"), [("a", 1, None), ("b", 1, None), ("c", 1, D(2024, 1, 1))],
                          [("d", 2, None), (None, 2, D(2024, 1, 1))], [(None, 3, D(2024, 1, 1))])
    assert got == rows(frame(spark, [("a", 1, None), ("b", 1, None), ("c", 1, D(2024, 1, 1)), ("d", 2, None),
                                     (None, 3, D(2024, 1, 1))]))
    assert touched == {D(2024, 1, 1)}
    only_null, _ = merged(spark, str(tmp_path / "n"), [("a", 1, None)], [("a", 2, None)])
    assert only_null == [("a", 2, None)]


def test_merge_finds_a_key_nine_days_away_and_drops_the_emptied_partition(spark, tmp_path):
    got, touched = merged(spark, str(tmp_path / "t"), [("a", 1, D(2024, 1, 1)), ("b", 1, D(2024, 1, 5))],
                          [("a", 2, D(2024, 1, 10))])
    assert got == [("a", 2, D(2024, 1, 10)), ("b", 1, D(2024, 1, 5))]
    assert touched == {D(2024, 1, 1), D(2024, 1, 10)}
    assert not (tmp_path / "t" / "day=2024-01-01").exists()


def test_merge_of_an_empty_batch_and_a_failing_read(spark, tmp_path):
    path = str(tmp_path / "t")
    merged(spark, path, [("a", 1, D(2024, 1, 1))])
    assert merge_into_partitions(spark, frame(spark, []), path, "id", "day") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "bad"))
    assert read_table(spark, str(tmp_path / "none")) is None


def test_upsert_replaces_null_key_parts(spark):
    s = "p string, q string, n int"
    out = merge_upsert(frame(spark, [("a", None, 1), ("b", "x", 1)], s), frame(spark, [("a", None, 2)], s), ["p", "q"])
    assert rows(out) == [("a", None, 2), ("b", "x", 1)]


def test_scd2_keeps_an_open_null_key(spark):
    as_of = lambda d: F.lit(dt.datetime(2024, 1, d)).cast("timestamp_ntz")
    one = scd2_apply(None, frame(spark, [(None, 1), ("a", 1)], "k string, v int"), "k", ["v"], as_of(1))
    same = scd2_apply(one, frame(spark, [(None, 1), ("a", 1)], "k string, v int"), "k", ["v"], as_of(2))
    assert rows(same, "k", "v", "is_current") == rows(one, "k", "v", "is_current")
    moved = scd2_apply(one, frame(spark, [(None, 2), ("a", 1)], "k string, v int"), "k", ["v"], as_of(2))
    assert rows(moved, "k", "v", "is_current") == [(None, 1, False), (None, 2, True), ("a", 1, True)]


def test_retention_of_each_cohort_row(spark):
    c = frame(spark, [("p", D(2024, 1, 1)), ("p", D(2024, 1, 5))], "player_id string, cohort_date date")
    a = frame(spark, [("p", D(2024, 1, 2))], "player_id string, activity_date date")
    assert rows(retention_flags(c, a, [1]), "cohort_date", "retained_d1") == [
        (D(2024, 1, 1), True), (D(2024, 1, 5), False)]


def test_retention_bounds_report_only_bad_rates(spark):
    m = frame(spark, [(D(2024, 1, 1), 0.5, 1.2, 0.1), (D(2024, 1, 8), -0.1, 0.2, 0.3), (D(2024, 1, 15), 0.0, 1.0, None)],
              "cohort_week date, retention_d1 double, retention_d7 double, retention_d30 double")
    assert [r[0] for r in rows(retention_bounds(m), "cohort_week")] == [D(2024, 1, 1), D(2024, 1, 8)]


def bronze(spark, docs):
    return spark.createDataFrame([(j, "f", dt.datetime(2024, 1, 1, 0, 0, n)) for j, n in docs],
                                 "j string, filename string, load_ts timestamp_ntz").select(
        F.parse_json("j").alias("raw_data"), "filename", "load_ts")


def test_staging_does_not_depend_on_input_order(spark):
    docs = [('{"event_id": "1", "region": "A"}', 0), ('{"event_id": "1", "region": "B"}', 0),
            ('{"event_id": "1", "region": "C"}', 0)]
    seen = {tuple(rows(stg_sessions(bronze(spark, order).coalesce(1)), "region"))
            for order in (docs, docs[::-1], [docs[1], docs[2], docs[0]])}
    assert len(seen) == 1


def test_staging_survives_wide_numbers(spark):
    docs = [('{"event_id": "1", "amount": 3000000000}', 0), ('{"event_id": "2", "amount": 1e300}', 0),
            ('{"event_id": "3", "amount": "x"}', 0)]
    assert rows(stg_store_transactions(bronze(spark, docs)), "event_id", "amount") == [
        ("1", 3000000000), ("2", None), ("3", None)]


def test_identity_does_not_multiply_rows(spark):
    reg = lambda who: ('{"bhvr_id": "%s", "platform_accounts": [{"platform_player_id": "p", "display_name": "n"}]}' % who)
    r = bronze(spark, [(reg("b1"), 0), (reg("b2"), 5)])
    ids = frame(spark, [("p",), ("q",)], "player_id string")
    assert rows(resolve_identity(ids, "player_id", r)) == [("p", "b2"), ("q", None)]
    assert rows(identity_conflicts(r)) == [("p", 2)]


def test_pivot_keeps_other_warehouses(spark):
    m = frame(spark, [("a", dt.datetime(2024, 1, 2), 1.0), ("z", dt.datetime(2024, 1, 2), 2.0), (None, dt.datetime(2024, 1, 2), 4.0),
                      ("a", dt.datetime(2023, 1, 2), 8.0)], "warehouse_name string, start_time timestamp_ntz, credits_used double")
    out = usage_pivot(m, ["a"], F.lit(dt.datetime(2024, 1, 3)).cast("timestamp_ntz"))
    assert rows(out, "usage_date", "a", "other") == [(D(2024, 1, 2), 1.0, 6.0)]


def test_stored_mart_takes_in_a_late_row(spark, tmp_path):
    """A row five days late changes the stored DAU/WAU/MAU exactly as a full refresh would."""
    from gamelake.plans.player import fct_dau_mau
    s = "player_id string, activity_date date"
    act = [(f"p{i % 7}", D(2024, 1, 1) + dt.timedelta(days=i)) for i in range(50)]
    late = [("late", D(2024, 2, 14))]
    path, fact = str(tmp_path / "mart"), str(tmp_path / "fact")
    key = ["player_id", "activity_date"]
    touched = merge_into_partitions(spark, frame(spark, act, s), fact, key, "activity_date")
    first = spark.read.schema(s).parquet(fact)
    maintain_mart(spark, path, "metric_date", fct_dau_mau(first), None, touched, "activity_date")
    touched = merge_into_partitions(spark, frame(spark, late, s), fact, key, "activity_date")
    now = spark.read.schema(s).parquet(fact)
    got = maintain_mart(spark, path, "metric_date", fct_dau_mau(now),
                        lambda target, since: refresh_dau_mau(target, now, since), touched, "activity_date")
    assert rows(got) == rows(fct_dau_mau(frame(spark, act + late, s)))
    assert rows(maintain_mart(spark, path, "metric_date", fct_dau_mau(now), None, None)) == rows(got)


def test_unknown_survivor_fields_live_on(spark):
    from gamelake.plans.intermediate import int_match_enriched
    from gamelake.plans.staging import stg_matches
    from gamelake.sources.seeds import seed
    raw = spark.sql("""select parse_json(j) raw_data, 'f' filename, timestamp_ntz'2024-01-01 00:00:00' load_ts from values
      ('{"event_id":"a","match_id":"m1","survivors":[{"player_id":"s1","new_field":{"x":7}},{"player_id":"s2","perks":"p,q"}]}'),
      ('{"event_id":"b","match_id":"m2","survivors":{"player_id":"s3","new_field":{"x":8}}}'),
      ('{"event_id":"c","match_id":"m3","survivors":[]}'), ('{"event_id":"d","match_id":"m4"}') as t(j)""")
    e = int_match_enriched(stg_matches(raw, complete=True), seed(spark, "seed_killers"), seed(spark, "seed_survivors"))
    got = {r[0]: r[1] for r in e.select("survivor_player_id", F.try_variant_get("survivor_payload", "$.new_field.x", "int")).collect()}
    assert got == {"s1": 7, "s2": None, "s3": 8}
    assert "survivor_payloads" not in stg_matches(raw).columns
