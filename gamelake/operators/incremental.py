"""Incremental loads: look-back filter (FLT-6), upsert (SNK-1), partition-overwrite
merge, correct mart refresh (STR-4 / D-3) and check-strategy SCD2 (SNK-3).

Parquet has no MERGE, and no table-format jar is assumed. Upserts are expressed as
DataFrames (anti-join + union) and written by overwriting only the touched
partitions (dynamic partition overwrite) after staging the new content under the
shared checkpoint folder. This is single-writer: two concurrent merges into the
same table are not isolated from each other.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.session import scratch_path


def high_water_mark(target: DataFrame, col: str) -> Column:
    """``max(col)`` of the target as an uncorrelated scalar subquery (evaluated once)."""
    return target.select(F.max(col)).scalar()


def incremental_filter(src: DataFrame, target: DataFrame | None, col: str, lookback_days: int = 3) -> DataFrame:
    """Rows with ``col >= max(target.col) - lookback_days``; the whole source on a first run.

    The bound is a scalar subquery, so when ``col`` is a partition column of ``src`` the
    scan prunes partitions at run time.
    """
    if target is None:
        return src
    hwm = high_water_mark(target, col)
    return src.where(F.col(col) >= F.timestamp_add("DAY", F.lit(-lookback_days), hwm))


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame | None:
    """The stored table, or None when there is none yet. Any other failure is raised."""
    r = spark.read.format(fmt)
    try:
        return (r.schema(schema) if schema is not None else r).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    """Null-safe equality of ``cols``; ``right`` carries them with the prefix ``_m_``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[f"_m_{c}"])
    return cond


def _keyed(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_m_{c}") for c in cols]).distinct()


def merge_upsert(target: DataFrame, batch: DataFrame, key: list[str] | str) -> DataFrame:
    """A batch row replaces the target row with the same key; new keys are appended.

    Keys compare null-safe, so a row whose key has a NULL part replaces its predecessor.
    """
    key = [key] if isinstance(key, str) else list(key)
    keys = _keyed(batch, key)
    kept = target.join(keys, _same(target, keys, key), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def merge_into_partitions(spark: SparkSession, batch: DataFrame, path: str, key: list[str] | str,
                          part_col: str, fmt: str = "parquet") -> DataFrame | None:
    """Upsert ``batch`` into a table partitioned by ``part_col`` rewriting only touched partitions.

    Returns the touched partition values (None for an empty batch), which is what models
    on top have to refresh.

    Touched partitions are the batch's own plus those that hold a replaced key, however
    far away (an event can be delivered again with another date); the search reads the
    key and partition columns of the whole table and nothing else. Keys and partition
    values compare null-safe. The batch is computed once, into a staging table under the
    shared checkpoint folder, and so is the new content, because a job cannot overwrite
    the files it reads. Both staging tables belong to the target (one folder each,
    overwritten by the next merge), so scratch space does not grow with the runs.
    """
    key = [key] if isinstance(key, str) else list(key)
    schema = batch.schema
    stage = scratch_path(spark, "merge-stage", hashlib.sha256(path.encode()).hexdigest()[:32])
    batch.write.format(fmt).mode("overwrite").save(f"{stage}/batch")
    batch = spark.read.format(fmt).schema(schema).load(f"{stage}/batch")
    if batch.isEmpty():  # e.g. the trailing no-data batch of a stateful stream
        return None
    target = read_table(spark, path, schema, fmt)
    emptied: list[str] = []
    if target is None:
        touched = batch.select(part_col).distinct()
        content, mode = batch, {}
    else:
        keys = _keyed(batch, key)
        moved = target.join(keys, _same(target, keys, key), "left_semi").select(part_col)
        touched = batch.select(part_col).union(moved).distinct()
        parts = _keyed(touched, [part_col])
        old = target.join(parts, _same(target, parts, [part_col]), "left_semi")
        new = old.join(keys, _same(old, keys, key), "left_anti").unionByName(batch)
        new.write.format(fmt).mode("overwrite").save(f"{stage}/content")
        content, mode = spark.read.format(fmt).schema(schema).load(f"{stage}/content"), {"partitionOverwriteMode": "dynamic"}
        # Partitions whose rows all moved elsewhere have no new content to overwrite them.
        filled = _keyed(content, [part_col])
        folder = target.select(part_col, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"))
        gone = folder.join(parts, _same(folder, parts, [part_col]), "left_semi")
        gone = gone.join(filled, _same(gone, filled, [part_col]), "left_anti")
        emptied = [r["folder"] for r in gone.select("folder").distinct().collect()]
    touched.write.format(fmt).mode("overwrite").save(f"{stage}/touched")
    # One writer a partition, more where a partition is large: AQE splits by size.
    (content.hint("rebalance", part_col).write.format(fmt).partitionBy(part_col)
     .mode("overwrite").options(**mode).save(path))
    for folder in emptied:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return spark.read.format(fmt).schema(touched.schema).load(f"{stage}/touched")


def first_touched(touched: DataFrame, col: str = "event_date") -> Column:
    """The earliest touched date: everything that depends on it or on later ones is stale."""
    return touched.select(F.min(col)).scalar()


def refresh_dau_mau(target: DataFrame, daily_activity: DataFrame, since: Column, method: str = "coverage") -> DataFrame:
    """Incremental DAU/MAU equal to a full refresh (fixes D-3).

    ``since`` is the earliest changed activity date (``first_touched`` of the merge).
    Dates from ``since`` on are recomputed from activity reaching back a full 30-day
    window before it; WAU/MAU at date t depend only on activity up to t, so earlier
    target dates stand as long as no activity before ``since`` has changed.
    """
    from gamelake.plans.player import fct_dau_mau
    hist = daily_activity.where(F.col("activity_date") >= F.date_sub(since, 29))
    fresh = fct_dau_mau(hist, method).where(F.col("metric_date") >= since)
    return merge_upsert(target.where(F.col("metric_date") < since), fresh, "metric_date")


Span = tuple[dt.date, dt.date]


def affected_spans(touched: DataFrame, col: str = "event_date", days_after: int = 0) -> list[Span]:
    """Spans of dates that depend on the touched ones: each reaches ``days_after`` days on; those that meet are one.

    The touched dates come to the driver: as many as the calendar has, not the data.
    """
    spans: list[Span] = []
    for day in sorted(r[0] for r in touched.select(col).distinct().collect() if r[0] is not None):
        last = day + dt.timedelta(days=days_after)
        if spans and day <= spans[-1][1] + dt.timedelta(days=1):
            spans[-1] = (spans[-1][0], last)
        else:
            spans.append((day, last))
    return spans


def within(col: str, spans: list[Span], days_before: int = 0) -> Column:
    """``col`` lies in a span or up to ``days_before`` days ahead of one: literals, so folders are pruned at planning."""
    cond = F.lit(False)
    for first, last in spans:
        cond = cond | F.col(col).between(F.lit(first - dt.timedelta(days=days_before)), F.lit(last))
    return cond


def refresh_dau_mau_spans(target: DataFrame, daily_activity: DataFrame, spans: list[Span], method: str = "coverage") -> DataFrame:
    """DAU/MAU with only the dates of ``spans`` recomputed (``affected_spans(touched, col, 29)``).

    A date depends on 30 days of activity, so a row 300 days late costs 30 dates and reads
    59 days of activity, not the 300 since. Equals a full refresh.
    """
    from gamelake.plans.player import fct_dau_mau
    if not spans:
        return target
    fresh = fct_dau_mau(daily_activity.where(within("activity_date", spans, 29)), method).where(within("metric_date", spans))
    return target.where(~within("metric_date", spans)).unionByName(fresh.select(*target.columns))


def maintain_mart(spark: SparkSession, path: str, key: str, full: DataFrame, refresh, touched: DataFrame | None,
                  touched_col: str = "event_date", days_after: int | None = None) -> DataFrame:
    """One maintenance run of a stored mart with one row per ``key`` date (STR-4).

    First run: the ``full`` model is stored. Later runs: ``refresh(target, since)`` gives
    the mart with everything from the earliest touched date recomputed, and replaces the
    stored one by way of a staging table. With ``days_after`` (how many later dates a date
    bears on) it is ``refresh(target, spans)`` and only the affected spans are recomputed.
    Nothing touched: nothing is written.
    """
    target = read_table(spark, path, full.schema)
    if target is not None and touched is None:
        return target
    if target is None:
        new = full
    elif days_after is None:
        new = refresh(target, first_touched(touched, touched_col))
    else:
        new = refresh(target, affected_spans(touched, touched_col, days_after))
    stage = scratch_path(spark, "mart-stage", hashlib.sha256(path.encode()).hexdigest()[:32])
    new.select(*full.columns).write.mode("overwrite").parquet(stage)
    staged = spark.read.schema(full.schema).parquet(stage)
    staged.hint("rebalance", key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)
    return spark.read.schema(full.schema).parquet(path)


def refresh_daily_revenue(target: DataFrame, revenue_daily: DataFrame, since: Column) -> DataFrame:
    """Incremental daily revenue whose 7-row average equals a full refresh (D-3).

    The trailing average needs the 6 previous revenue rows, so the recomputation reads
    the target's last 6 rows before ``since`` (one-row-per-day, small) plus fresh days.
    """
    from gamelake.plans.revenue import fct_daily_revenue
    fresh = fct_daily_revenue(revenue_daily.where(F.col("revenue_date") >= since))
    from pyspark.sql import Window
    prior = target.where(F.col("revenue_date") < since)
    tail = (prior.withColumn("_rk", F.row_number().over(Window.orderBy(F.col("revenue_date").desc())))
            .where(F.col("_rk") <= 6).drop("_rk"))
    both = tail.select(fresh.columns).unionByName(fresh)
    w = Window.orderBy("revenue_date").rowsBetween(-6, 0)
    recomputed = both.withColumn("revenue_7d_avg", F.avg("total_revenue_usd").over(w)) \
        .where(F.col("revenue_date") >= since)
    return merge_upsert(prior, recomputed, "revenue_date")


def scd2_apply(current: DataFrame | None, incoming: DataFrame, key: str, check_cols: list[str],
               as_of: Column) -> DataFrame:
    """Check-strategy SCD2 (SNK-3).

    ``current``: a snapshot table with ``valid_from, valid_to, is_current``; None on the
    first run. ``incoming``: one row per key, the latest state. A key whose check
    columns differ (NULL-safe) gets its open row closed at ``as_of`` and a new open
    version; new keys get a first version; keys absent from ``incoming`` stay open.
    One full-outer join of open rows against the incoming state.
    """
    def opened(df):
        return (df.withColumn("valid_from", as_of.cast("timestamp_ntz"))
                  .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
                  .withColumn("is_current", F.lit(True)))

    if current is None:
        return opened(incoming)
    cols = incoming.columns
    history = current.where(~F.col("is_current"))
    open_ = current.where(F.col("is_current"))
    o = open_.select(F.lit(True).alias("_o"), *[F.col(c).alias(f"o_{c}") for c in open_.columns])
    i = incoming.select(F.lit(True).alias("_i"), *[F.col(c).alias(f"i_{c}") for c in cols])
    j = o.join(i, F.col(f"o_{key}").eqNullSafe(F.col(f"i_{key}")), "full_outer")
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"o_{c}").eqNullSafe(F.col(f"i_{c}"))
    has_o, has_i = F.col("_o").isNotNull(), F.col("_i").isNotNull()  # a NULL key is a key
    changed = has_o & has_i & ~same
    keep_open = j.where(has_o & (~has_i | same)).select(*[F.col(f"o_{c}").alias(c) for c in open_.columns])
    closed = j.where(changed).select(*[F.col(f"o_{c}").alias(c) for c in open_.columns]) \
        .withColumn("valid_to", as_of.cast("timestamp_ntz")).withColumn("is_current", F.lit(False))
    fresh = opened(j.where(has_i & (~has_o | changed)).select(*[F.col(f"i_{c}").alias(c) for c in cols]))
    return history.unionByName(keep_open).unionByName(closed).unionByName(fresh)


def materialize(spark: SparkSession, df: DataFrame, name: str, mode: str = "table", path: str | None = None,
                key: list[str] | str | None = None, partition: str | None = None) -> DataFrame:
    """Materialise a model as a view, a table or an incremental table (SRC-6).

    ``view``: a temp view, recomputed on use. ``table``: full rewrite at ``path``
    (clustered by ``partition`` when given), read back so consumers start from storage.
    ``incremental``: ``df`` is the new batch; it is upserted by ``key`` into the touched
    ``partition`` values of the table at ``path``. Returns the stored table.
    """
    from gamelake.sources.events import write_clustered
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    path = path or scratch_path(spark, "tables", name)
    if mode == "table":
        write_clustered(df, path, [partition] if partition else None)
    elif mode == "incremental":
        if key is None or partition is None:
            raise ValueError("incremental materialisation needs key and partition")
        merge_into_partitions(spark, df, path, key, partition)
    else:
        raise ValueError(mode)
    return spark.read.parquet(path)


def incremental_load(spark: SparkSession, raw: DataFrame, build, path: str, key: str = "event_id",
                     ts_col: str = "event_timestamp", lookback_days: int = 3) -> DataFrame:
    """One run of an incremental staging model: bound the bronze scan by the target's
    load-time high-water mark minus the look-back, build the batch, and upsert it into
    the event-date partitions of the target (SNK-1 + FLT-6). The first run loads all."""
    target = read_table(spark, path)
    batch = build(incremental_filter(raw, target, "load_ts", lookback_days))
    batch = batch.withColumn("event_date", F.to_date(ts_col))
    return materialize(spark, batch, "incremental", "incremental", path, key, "event_date")
