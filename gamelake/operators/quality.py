"""Data-quality checks and monitors (DQ-1..DQ-19).

Every check returns a DataFrame: violating rows, or a small verdict frame with a
``status`` column. ``raise_on_error`` turns an error verdict into an exception for
schedulers. Checks are single-pass aggregates or anti-joins; none collects data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.operators.dedup import with_key
from gamelake.operators.joins import key_diff


def unique(df: DataFrame, cols: list[str] | str) -> DataFrame:
    """Duplicate keys (DQ-1): (cols..., n_rows) for every key seen more than once."""
    cols = [cols] if isinstance(cols, str) else cols
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def not_null(df: DataFrame, cols: list[str], severity: str = "error") -> DataFrame:
    """NULL count per column in one pass (DQ-2): (column_name, null_count, severity, status)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "null_count")
    return long.withColumn("severity", F.lit(severity)).withColumn(
        "status", F.when(F.col("null_count") == 0, "pass").otherwise(F.lit(severity)))


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is outside the enumeration (DQ-3); NULL passes."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows outside [lo, hi] (DQ-4); NULL passes."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return df.where(bad)


def relationships(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent (DQ-5)."""
    parent_col = parent_col or child_col
    p = parent.select(F.col(parent_col).alias("_pk")).distinct()
    return child.where(F.col(child_col).isNotNull()).join(p, F.col(child_col) == F.col("_pk"), "left_anti")


def positive_revenue(stg_store: DataFrame) -> DataFrame:
    """Transactions with negative revenue (DQ-6)."""
    return stg_store.where(F.col("amount_usd") < 0).select("event_id", "transaction_id", "amount_usd")


def retention_bounds(retention: DataFrame) -> DataFrame:
    """Cohorts with a retention rate outside [0, 1] (DQ-7)."""
    cols = [c for c in retention.columns if c.startswith("retention_d")]
    bad = F.lit(False)
    for c in cols:
        bad = bad | (F.col(c) < 0) | (F.col(c) > 1)
    return retention.where(bad).select("cohort_week", *cols)


def valid_kill_rate(outcomes: DataFrame) -> DataFrame:
    """Killers whose kill rate is outside [0, 1] (DQ-8)."""
    return outcomes.where((F.col("kill_rate") < 0) | (F.col("kill_rate") > 1)).select(
        "killer_character_id", "kill_rate")


def freshness(df: DataFrame, source: str, ts_col: str, warn_hours: float, error_hours: float,
              as_of: Column) -> DataFrame:
    """Age of the newest row against warn/error limits (DQ-9): one verdict row."""
    g = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / 3.6e9
    return g.select(
        F.lit(source).alias("source"), "max_loaded_at",
        F.round(age, 4).alias("age_hours"),
        F.lit(float(warn_hours)).alias("warn_after_hours"), F.lit(float(error_hours)).alias("error_after_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age > error_hours), "error")
         .when(age > warn_hours, "warn").otherwise("pass").alias("status"))


def min_rows_per_hour(df: DataFrame, ts_col: str, n: int = 100, since: Column | None = None,
                      until: Column | None = None) -> DataFrame:
    """Hours with fewer than ``n`` rows (DQ-10); a silent hour is reported with 0 rows.

    Hours without rows are the gaps between an hour and the next one that has some, made
    row by row from the sorted hours. Between the first and last observed hour, or from
    ``since`` to ``until`` (hours outside are not read and cost nothing, edges without rows count).
    """
    hour, one = F.date_trunc("hour", F.col(ts_col)).cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR")
    h = df.select(hour.alias("hour")).where(F.col("hour").isNotNull())
    edges = []
    for edge, step in ((since, -one), (until, one)):
        if edge is not None:
            edges.append((F.date_trunc("hour", edge).cast("timestamp_ntz") + step).alias("hour"))
    if since is not None:
        h = h.where(F.col("hour") >= F.date_trunc("hour", since).cast("timestamp_ntz"))
    if until is not None:
        h = h.where(F.col("hour") <= F.date_trunc("hour", until).cast("timestamp_ntz"))
    counts = h.groupBy("hour").agg(F.count(F.lit(1)).alias("row_count"))
    for edge in edges:  # an hour outside the window, only there to end a gap
        counts = counts.unionByName(df.sparkSession.range(1).select(edge, F.lit(None).cast("bigint").alias("row_count")))
    from pyspark.sql import Window
    following = F.lead("hour").over(Window.orderBy("hour"))  # one row an hour
    gap = F.when(F.col("next") > F.col("hour") + one, F.sequence(F.col("hour") + one, F.col("next") - one, one))
    rows = counts.withColumn("next", following).select(F.explode(F.concat(
        F.array(F.struct("hour", "row_count")),
        F.coalesce(F.transform(gap, lambda x: F.struct(x.alias("hour"), F.lit(0).cast("bigint").alias("row_count"))), F.array()))).alias("x"))
    return rows.select("x.*").where(F.col("row_count") < n)


def exploded_keys(bronze: DataFrame, col: str = "raw_data") -> DataFrame:
    """Bronze rows by top-level key of their VARIANT object: pos, key. Others give one row without a key."""
    kept = bronze.select(col)
    return kept.lateralJoin(bronze.sparkSession.tvf.variant_explode_outer(F.col(col).outer())).select("pos", "key")


def required_keys(bronze: DataFrame, keys: list[str]) -> DataFrame:
    """Rows missing each required top-level key (DQ-11): (key, missing_rows, status).

    Keys are read from the binary VARIANT and counted before any shuffle; a row counts
    once in all, at its first key.
    """
    wanted = F.when(F.col("key").isin(keys), F.col("key"))
    found = exploded_keys(bronze).groupBy(wanted.alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("rows"))
    asked = bronze.sparkSession.createDataFrame([(k, 0, 0) for k in keys], "key string, n bigint, rows bigint")
    from pyspark.sql import Window
    both = found.unionByName(asked).groupBy("key").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    missing = F.sum("rows").over(Window.partitionBy(F.lit(1))) - F.col("n")  # one row a required key
    return both.withColumn("missing_rows", missing).where(F.col("key").isNotNull()).select(
        "key", "missing_rows", F.when(F.col("missing_rows") == 0, "pass").otherwise("fail").alias("status"))


def volume_anomaly(df: DataFrame, ts_col: str, as_of: Column, hours: int = 6, threshold: float = 0.80,
                   days: int = 7) -> DataFrame:
    """Volume of the last ``hours`` hours against the same slot on each of the previous
    ``days`` days (DQ-12, corrected form: slots are timestamp ranges, so a window that
    spans midnight is handled and the slot under test is not part of its baseline).

    One pass with two conditional counts over the rows of that period only. Verdict row:
    recent_count, avg_7d_count, ratio, threshold, status (OK / ANOMALY / NO_BASELINE). A feed
    without any row in the period is an anomaly.
    """
    df = df.where(F.col(ts_col) >= F.timestamp_add("HOUR", F.lit(-(days * 24 + hours)), as_of))
    secs = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col(ts_col).cast("timestamp"))
    day_back = F.floor(secs / 86400)
    in_slot = (secs >= 0) & ((secs - day_back * 86400) < hours * 3600)
    g = df.select(day_back.alias("k"), in_slot.alias("s")).agg(
        F.count_if(F.col("s") & (F.col("k") == 0)).alias("recent_count"),
        F.count_if(F.col("s") & (F.col("k") >= 1) & (F.col("k") <= days)).alias("_base"))
    avg = F.col("_base") / float(days)
    ratio = F.col("recent_count") / F.nullif(avg, F.lit(0.0))
    return g.select(
        "recent_count", F.round(avg, 1).alias("avg_7d_count"), F.round(ratio, 4).alias("ratio"),
        F.lit(threshold).alias("threshold"),
        F.when(ratio.isNull(), F.when(F.col("recent_count") > 0, "NO_BASELINE").otherwise("ANOMALY")).when(ratio >= threshold, "OK").otherwise("ANOMALY").alias("status"))


def schema_drift(spark: SparkSession, bronze: DataFrame, expected: list[str], since: Column | None = None) -> DataFrame:
    """New and missing top-level keys among rows loaded since ``since`` (DQ-13).

    Rows: (key, side) with side 'new' or 'missing'; no row means no drift. No sample
    limit: every recent row's keys are inspected (distinct keys are tiny).
    """
    b = bronze if since is None else bronze.where(F.col("load_ts") >= since)
    actual = exploded_keys(b).where(F.col("key").isNotNull()).select("key").distinct()
    exp = spark.createDataFrame([(k,) for k in expected], "key string")
    return key_diff(actual, exp, "key")


def drift_status(diff: DataFrame) -> DataFrame:
    """One verdict row from ``schema_drift`` output."""
    return diff.agg(F.count_if(F.col("side") == "new").alias("new_keys"),
                    F.count_if(F.col("side") == "missing").alias("missing_keys")).withColumn(
        "status", F.when((F.col("new_keys") + F.col("missing_keys")) == 0, "OK").otherwise("DRIFT"))


def resolve_identity(df: DataFrame, id_col: str, registrations: DataFrame) -> DataFrame:
    """Map any platform account id to its canonical id (DQ-14).

    ``registrations`` is bronze player_registration. Accounts are exploded to
    (platform_player_id, canonical_id) from the latest registration of each canonical
    id; an account claimed by several canonical ids belongs to the one loaded last
    (``identity_conflicts`` lists them). ``df`` keeps its rows and gains ``canonical_id``
    (NULL when the id is unknown).
    """
    from gamelake.operators.dedup import latest_by
    acc = latest_by(account_map(registrations), "platform_player_id",
                    [F.col("load_ts").desc_nulls_last(), F.col("canonical_id").asc()])
    m = acc.select(F.col("platform_player_id").alias("_pid"), "canonical_id")
    return df.join(m, F.col(id_col) == F.col("_pid"), "left").drop("_pid")


def account_map(registrations: DataFrame, canonical_id: str = "$.bhvr_id") -> DataFrame:
    """Every linked platform account with its canonical id (the payload's path is a parameter)."""
    from gamelake.operators.dedup import latest_by, load_order
    r = registrations.select(
        F.try_variant_get("raw_data", canonical_id, "string").alias("canonical_id"),
        F.try_variant_get("raw_data", "$.platform_accounts",
                          "array<struct<platform string, platform_player_id string, display_name string, "
                          "is_primary boolean>>").alias("accounts"),
        "load_ts", "filename")
    latest = latest_by(r.where(F.col("canonical_id").isNotNull()), "canonical_id",
                       load_order(r.columns))
    return latest.select("canonical_id", F.explode("accounts").alias("a"), "load_ts").select(
        "canonical_id", "a.platform", "a.platform_player_id", "a.display_name", "a.is_primary", "load_ts")


def identity_conflicts(registrations: DataFrame) -> DataFrame:
    """Platform accounts that more than one canonical id claims."""
    return (account_map(registrations).groupBy("platform_player_id")
            .agg(F.countDistinct("canonical_id").alias("canonical_ids")).where(F.col("canonical_ids") > 1))


def identity_name_mismatches(registrations: DataFrame) -> DataFrame:
    """Canonical ids whose linked accounts carry different display names."""
    acc = account_map(registrations)
    return (acc.groupBy("canonical_id").agg(F.countDistinct("display_name").alias("distinct_names"),
                                            F.count(F.lit(1)).alias("accounts"))
            .where(F.col("distinct_names") > 1))


LATENESS_BUCKETS = [(1, "on_time_lt_1h"), (6, "late_1_6h"), (24, "late_6_24h"), (48, "late_24_48h")]


def late_arrivals(df: DataFrame, ts_col: str, ingest_col: str, by: str = "event_type") -> DataFrame:
    """Share of events by lateness bucket per ``by`` (DQ-15)."""
    hours = (F.unix_micros(F.col(ingest_col).cast("timestamp")) - F.unix_micros(F.col(ts_col).cast("timestamp"))) / 3.6e9
    b = F.lit("late_gt_48h")
    for lim, name in reversed(LATENESS_BUCKETS):
        b = F.when(hours < lim, name).otherwise(b)
    b = F.when(hours.isNull(), "unknown").otherwise(b)
    from pyspark.sql import Window
    g = df.select(F.col(by).alias(by), b.alias("lateness_bucket")).groupBy(by, "lateness_bucket").agg(
        F.count(F.lit(1)).alias("events"))
    tot = F.sum("events").over(Window.partitionBy(by))
    return g.withColumn("share", F.round(F.col("events") / tot, 4))


def near_duplicates(bronze: DataFrame, key_path: str = "$.event_id") -> DataFrame:
    """Exact vs near duplicates per event id (DQ-16): one summary row.

    VARIANT is not groupable, so payloads are compared by a hash of their JSON text.
    Two-level aggregation: per id (partial-aggregated), then global sums.
    """
    per_key = with_key(bronze, F.try_variant_get("raw_data", key_path, "string"), "k") \
        .select("k", F.xxhash64(F.to_json("raw_data")).alias("h")) \
        .groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("h").alias("payloads"))
    return per_key.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.count_if((F.col("n") > 1) & (F.col("payloads") == 1)).alias("exact_duplicate_keys"),
        F.count_if(F.col("payloads") > 1).alias("near_duplicate_keys"),
        F.sum(F.col("n") - 1).cast("bigint").alias("redundant_rows"))


def repair_nested(stg_like: DataFrame, col: str = "killer_perks") -> DataFrame:
    """Split a single comma-joined element into several (DQ-17, opt-in repair)."""
    c = F.col(col)
    fixed_col = F.when((F.size(c) == 1) & c[0].contains(","), F.split(c[0], r"\s*,\s*")).otherwise(c)
    return stg_like.withColumn(col, fixed_col)


def out_of_order(df: DataFrame, session_col: str = "session_id", ts_col: str = "event_timestamp",
                 order_cols: list[str] | None = None, bucket: str = "hour") -> DataFrame:
    """Events whose timestamp is earlier than the previous event's in load order (DQ-18).

    A ``Window.partitionBy(session)`` would put a session holding a third of all rows (a bot)
    into one task. The order's first column is a time, so a session's rows are cut into
    buckets of it (``bucket``: a unit of ``date_trunc``): inside a bucket ``lag`` finds the
    predecessor; the first row of a bucket follows the last one of the session's bucket
    before, found by a window over one row a bucket. NULLs come first; rows without a
    session are one session.
    """
    from pyspark.sql import Window
    order_cols = order_cols or ["load_ts", "event_id"]
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    cut = df.withColumn("_bucket", F.date_trunc(bucket, F.col(order_cols[0])))
    prev = F.lag(ts_col).over(Window.partitionBy(session_col, "_bucket").orderBy(*order))
    inside = cut.withColumn("prev_event_timestamp", prev).drop("_bucket")
    by = F.struct(*[F.col(c) for c in order_cols])
    edges = cut.groupBy(session_col, "_bucket").agg(
        F.min_by(F.struct(*[F.col(c) for c in df.columns]), by).alias("_first"), F.max_by(F.col(ts_col), by).alias("_last"))
    before = F.lag("_last").over(Window.partitionBy(session_col).orderBy(F.col("_bucket").asc_nulls_first()))
    across = edges.withColumn("prev_event_timestamp", before).select("_first.*", "prev_event_timestamp")
    return (inside.unionByName(across).where(F.col(ts_col) < F.col("prev_event_timestamp"))
            .withColumn("seconds_early", F.timestamp_diff("SECOND", F.col(ts_col), F.col("prev_event_timestamp"))))


def exclude_modes(df: DataFrame, modes: list[str], col: str = "game_mode") -> DataFrame:
    """Drop matches of excluded modes (DQ-19); a NULL mode is kept."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(*modes))


def raise_on_error(verdict: DataFrame, status_col: str = "status", bad=("error", "fail", "ANOMALY", "DRIFT")) -> DataFrame:
    """Raise if any verdict row has a failing status (one small aggregate action)."""
    n = verdict.where(F.col(status_col).isin(*bad)).limit(1).count()
    if n:
        raise RuntimeError(f"quality check failed: {status_col} in {bad}")
    return verdict
