"""Keyed tables, stored histories, landing streams and late rows over several commits."""
import datetime as dt
import os
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan_text, rows
from gamelake.operators.incremental import (affected_spans, maintain_mart, refresh_dau_mau_spans, scd2_apply, within)
from gamelake.operators.keyed_table import Commits, HistoryTable, KeyedTable, load_order
from gamelake.plans.player import fct_dau_mau
from gamelake.session import scratch_path
from gamelake.streaming import landing

D = dt.date
ROW = "k string, v int, load_ts timestamp_ntz, filename string, d date"


def fresh(spark, name):
    return scratch_path(spark, name, uuid.uuid4().hex)


def row(k, v, day, load=1, name="f"):
    return (k, v, dt.datetime(2024, 2, load), name, None if day is None else D(2024, 1, day))


def table(spark, root, **kw):
    return KeyedTable(spark, root, "k", "d", StructType.fromDDL(ROW), **kw)


def state(t):
    return {r["k"]: (r["v"], r["d"]) for r in t.read().collect()}


def test_merge_moves_keys_and_keeps_versions(spark):
    t = table(spark, fresh(spark, "t-keyed"), n_buckets=4)
    assert t.read().count() == 0
    t.merge(spark.createDataFrame([row("a", 1, 1), row("b", 1, 2), row(None, 1, 2), row("c", 1, None)], ROW))
    touched = t.merge(spark.createDataFrame([row("a", 2, 9), row(None, 2, 3), row("e", 1, 2)], ROW))
    assert {r["d"] for r in touched.collect()} == {D(2024, 1, n) for n in (1, 2, 3, 9)}
    assert touched.schema["d"].dataType.simpleString() == "date"
    want = {"a": (2, D(2024, 1, 9)), "b": (1, D(2024, 1, 2)), None: (2, D(2024, 1, 3)), "c": (1, None), "e": (1, D(2024, 1, 2))}
    assert state(t) == want and t.read().count() == 5
    assert t.read(1).count() == 4  # the version before
    assert t.merge(spark.createDataFrame([], ROW)) is None
    assert re.search(r"PartitionFilters: \[[^\n]*d#", plan_text(t.read().where("d = DATE'2024-01-02'")))
    gone = t.commits.vacuum(keep=1)
    assert gone and state(t) == want


def test_merge_equals_dictionary_over_many_commits(spark):
    rng = random.Random(1)
    t, want = table(spark, fresh(spark, "t-many"), n_buckets=2, max_deltas=2), {}
    for n in range(6):
        batch = {f"k{rng.randrange(30)}": (n, rng.randrange(1, 6)) for _ in range(12)}
        t.merge(spark.createDataFrame([row(k, v, d) for k, (v, d) in batch.items()], ROW))
        want |= {k: (v, D(2024, 1, d)) for k, (v, d) in batch.items()}
        assert state(t) == want and t.read().count() == len(want)
    entries = t.commits.latest()[1]
    assert max(sum(e.kind == "index" and e.value == b for e in entries) for b in "01") <= 3  # compacted


def test_run_killed_before_its_commit_changes_nothing(spark):
    t = table(spark, fresh(spark, "t-killed"))
    t.merge(spark.createDataFrame([row("a", 1, 1), row("b", 1, 1)], ROW), mark="m1")

    def die():
        raise RuntimeError("killed")
    batch = spark.createDataFrame([row("a", 2, 2)], ROW)
    with pytest.raises(RuntimeError):
        t.merge(batch, mark="m2", before_commit=die)
    assert state(t) == {"a": (1, D(2024, 1, 1)), "b": (1, D(2024, 1, 1))} and t.value("mark") == "m1"
    t.merge(batch, mark="m2")  # the same version number again, over the dead run's folder
    assert state(t) == {"a": (2, D(2024, 1, 2)), "b": (1, D(2024, 1, 1))} and t.value("mark") == "m2"


def test_merge_reads_only_its_index_buckets(spark):
    t = table(spark, fresh(spark, "t-buckets"), n_buckets=8)
    t.merge(spark.createDataFrame([row(f"k{i}", 1, 1 + i % 5) for i in range(80)], ROW))
    keys = spark.createDataFrame([row("k3", 2, 9)], ROW)
    bucket = keys.select(t._bucket().alias("b")).first()["b"]
    found = t.located(keys.select(F.col("k").alias("_m_k")), t.commits.latest()[1], {bucket})
    assert rows(found, "k", "_part") == [("k3", D(2024, 1, 4))]
    files = {m for f in found.inputFiles() for m in re.findall(r"_bucket=(\d+)", f)} | \
        set(re.findall(r"_bucket=(\d+)", plan_text(found)))
    assert files <= {str(bucket)}


def test_order_decides_between_stored_and_new(spark):
    t = table(spark, fresh(spark, "t-order"))
    order = load_order(t.schema.names)
    t.merge(spark.createDataFrame([row("a", 1, 1, load=5), row("b", 1, 1, load=1)], ROW), order)
    t.merge(spark.createDataFrame([row("a", 2, 2, load=3), row("b", 2, 2, load=2), row("b", 3, 2, load=2)], ROW), order)
    got = state(t)
    assert got["a"] == (1, D(2024, 1, 1)) and got["b"][1] == D(2024, 1, 2)
    other = table(spark, fresh(spark, "t-order"))  # ties do not depend on the input's order
    other.merge(spark.createDataFrame([row("b", 3, 2, load=2), row("a", 1, 1, load=5), row("b", 2, 2, load=2)], ROW), order)
    assert state(other)["b"] == got["b"]


def test_replace_drops_vanished_keys(spark):
    t = table(spark, fresh(spark, "t-replace"))
    t.merge(spark.createDataFrame([row("a", 1, 1), row("b", 1, 1), row("c", 1, 2)], ROW))
    t.replace(spark.createDataFrame([row("b", 5, 1)], ROW), [D(2024, 1, 1)])
    assert state(t) == {"b": (5, D(2024, 1, 1)), "c": (1, D(2024, 1, 2))}
    t.merge(spark.createDataFrame([row("a", 2, 3)], ROW))
    assert state(t)["a"] == (2, D(2024, 1, 3)) and t.read().count() == 3


# ---- stored history ---------------------------------------------------------------------------
STATE = "id string, x int, y string"


def test_stored_history_equals_the_one_shot_history(spark):
    t = HistoryTable(spark, fresh(spark, "t-hist"), "id", ["x"], StructType.fromDDL(STATE))
    runs = [([("a", 1, "p"), ("b", 1, "p"), (None, 1, "p")], dt.datetime(2024, 1, 5)),
            ([("a", 2, "q"), ("b", 1, "z"), (None, None, "p"), ("c", 1, "p")], dt.datetime(2024, 2, 5)),
            ([("a", 1, "p"), (None, None, "p")], dt.datetime(2024, 3, 5))]
    want, closed = None, []
    for data, when in runs:
        df = spark.createDataFrame(data, STATE)
        want = scd2_apply(want, df, "id", ["x"], F.lit(str(when)))
        t.run(df, when)
        assert rows(t.read()) == rows(want, *t.columns)
        now = [e for e in t.commits.latest()[1] if e.kind == "closed"]
        assert now[:len(closed)] == closed  # folders of closed rows are never replaced
        closed = now
    assert len(closed) == 2
    at = {r["id"]: r["x"] for r in t.as_of(dt.datetime(2024, 2, 10)).collect()}
    assert at == {"a": 2, "b": 1, None: None, "c": 1}
    assert "2024-02" not in {re.search("_valid_month=([^/]*)", f)[1] for f in t.as_of(dt.datetime(2024, 3, 10)).inputFiles()}


def test_history_run_that_dies_leaves_the_old_one(spark, monkeypatch):
    t = HistoryTable(spark, fresh(spark, "t-hist-die"), "id", ["x"], StructType.fromDDL(STATE))
    t.run(spark.createDataFrame([("a", 1, "p")], STATE), dt.datetime(2024, 1, 5))
    before = rows(t.read())
    with monkeypatch.context() as m:
        m.setattr(Commits, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            t.run(spark.createDataFrame([("a", 2, "p")], STATE), dt.datetime(2024, 2, 5))
    assert rows(t.read()) == before
    t.run(spark.createDataFrame([("a", 3, "p")], STATE), dt.datetime(2024, 2, 6))
    assert [r["x"] for r in t.read().orderBy("valid_from").collect()] == [1, 3]


# ---- landing ----------------------------------------------------------------------------------
def _lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_landing_by_type_with_dead_letters(spark):
    base = fresh(spark, "t-landing")
    _lines(f"{base}/in/x", "1.json", ['{"event_type":"a","event_id":"1"}', "{broken", '{"event_type":"b"}', '{"event_id":"2"}', "7",
                                      '{"event_type":"other"}'])

    def run():
        landing.ingest_by_type(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", ["a", "b"]).awaitTermination()
    run()
    run()
    assert landing.landed_events(spark, f"{base}/out", "a").count() == 1
    assert landing.landed_events(spark, f"{base}/out", "none").count() == 0
    dead = {r["bad_line"]: r["reason"] for r in landing.dead_letters(spark, f"{base}/out").collect()}
    assert dead == {"{broken": "not JSON", '{"event_id":"2"}': "no event type", "7": "no event type",
                    '{"event_type":"other"}': "unknown event type"}
    # a batch that runs again overwrites its own files only
    _lines(f"{base}/in/x", "2.json", ['{"event_type":"a","event_id":"3"}'])
    run()
    batch = landing.routed(spark.read.text(f"{base}/in/x/2.json").select(
        "value", F.col("_metadata.file_path").alias("filename"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("load_ts")), ["a", "b"])
    (batch.withColumn("batch", F.lit(landing.batch_label(f"{base}/ckpt", 1))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("stream", "load_date", "batch").parquet(f"{base}/out"))
    a = landing.landed_events(spark, f"{base}/out", "a")
    assert a.count() == 2
    day = a.first()["load_date"]
    pruned = plan_text(landing.loaded_since(a, f"{day + dt.timedelta(days=9)}T00:00:00", 3))
    assert re.search(r"PartitionFilters: \[[^\]]*load_date", pruned)
    assert all("stream=a" in f for f in a.inputFiles())


TYPED = "event_id string, event_timestamp timestamp_ntz, v int, load_ts timestamp_ntz, filename string"


def _event(i, day, v=0, load=None):
    at = dt.datetime(2024, 1, day, 12)
    return (f"e{i}", at, v, load or at, "f")


def test_late_rows_have_an_output_of_their_own(spark):
    base = fresh(spark, "t-late")
    schema = StructType.fromDDL(TYPED + ", event_date date")
    t = KeyedTable(spark, f"{base}/table", "event_id", "event_date", schema)
    sink = landing.LateSplit(t, f"{base}/late", "ckpt")
    assert sink.late_rows() is None and sink.apply_late() is None
    sink(spark.createDataFrame([_event(1, 10), _event(2, 1)], TYPED), 0)  # nothing is late in the first batch
    assert t.read().count() == 2 and sink.late_rows() is None
    second = spark.createDataFrame([_event(3, 9), _event(4, 2), _event(1, 10, 7, dt.datetime(2024, 1, 11)), (None, None, 1, None, "f")], TYPED)
    for _ in range(2):  # a retried batch
        sink(second, 1)
    assert {r["event_id"] for r in sink.late_rows().collect()} == {"e4"}
    assert {r["event_id"]: r["v"] for r in t.read().collect()} == {"e1": 7, "e2": 0, "e3": 0, None: 1}
    sink(spark.createDataFrame([_event(5, 3)], TYPED), 2)  # late rows only
    assert {r["event_date"] for r in sink.apply_late().collect()} == {D(2024, 1, 2), D(2024, 1, 3)}
    sink.apply_late()
    assert {r["event_id"] for r in t.read().collect()} == {"e1", "e2", "e3", "e4", "e5", None} and t.read().count() == 6
    assert t.value("mark") == "2024-01-10T12:00:00"


# ---- marts by affected spans ------------------------------------------------------------------
def test_spans_cover_what_depends_on_touched_dates(spark):
    days = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 3),), (D(2024, 3, 1),), (None,)], "event_date date")
    assert affected_spans(days, days_after=2) == [(D(2024, 1, 1), D(2024, 1, 5)), (D(2024, 3, 1), D(2024, 3, 3))]
    assert affected_spans(days.limit(0)) == []


def test_one_old_row_recomputes_one_span(spark):
    rng = random.Random(4)
    start, base = D(2023, 1, 1), fresh(spark, "t-spans")
    data = sorted({(f"p{rng.randrange(40)}", start + dt.timedelta(days=rng.randrange(300))) for _ in range(1500)})
    late = [("new", start + dt.timedelta(days=2)), ("p1", start + dt.timedelta(days=150)), ("p2", start + dt.timedelta(days=400))]
    schema = "player_id string, activity_date date"
    spark.createDataFrame(data + late, schema).write.partitionBy("activity_date").parquet(f"{base}/activity")
    activity = spark.read.parquet(f"{base}/activity")
    old = fct_dau_mau(spark.createDataFrame(data, schema))
    maintain_mart(spark, f"{base}/mart", "metric_date", old, None, None)
    touched = spark.createDataFrame([(d,) for _, d in late], "event_date date")
    reads = []

    def refresh(target, spans):
        hist = activity.where(within("activity_date", spans, 29))
        reads.append(len({re.search("activity_date=([0-9-]*)", f)[1] for f in
                          {r["f"] for r in hist.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}}))
        assert re.search(r"PartitionFilters: \[[^\n]*activity_date", plan_text(hist))
        return refresh_dau_mau_spans(target, activity, spans)
    got = maintain_mart(spark, f"{base}/mart", "metric_date", old, refresh, touched, days_after=29)
    assert rows(got) == rows(fct_dau_mau(activity))
    assert reads[0] <= 3 * 59
