"""Join-shaped operators (JN-1, JN-4, JN-6, JN-8, JN-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def with_dim(df: DataFrame, dim: DataFrame, on: Column | str | list, cols: list[str] | None = None,
             how: str = "left") -> DataFrame:
    """Left-join a dimension (JN-1).

    No side is broadcast by hand: the planner broadcasts the dimension when its size,
    known from the plan or measured at run time, is under
    ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise.
    """
    return df.join(dim.select(*(cols or dim.columns)), on, how)


def unique_dim(dim: DataFrame, key: str) -> DataFrame:
    """The dimension, if its key is unique; duplicates would multiply facts and are an error."""
    twice = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(key).limit(5).collect()
    if twice:
        raise ValueError(f"{key} is not unique: " + ", ".join(f"{r[key]!r} x {r['n']}" for r in twice))
    return dim


def each(array_col: str) -> Column:
    """``explode`` of an array that an expression made (JN-6), the expression worked out once a row.

    Spark infers ``size(array) > 0`` below an ``explode`` of a plain column, and that filter works
    the whole expression out a second time (typed reads of nested payloads, say).
    """
    return F.explode(F.coalesce(F.col(array_col), F.array()))


def flatten(df: DataFrame, array_col: str, alias: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Lateral flatten without OUTER: rows whose array is NULL or empty disappear (JN-6).

    Project the needed columns before calling so the explode carries only them.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != array_col]
    return df.select(*keep, F.explode(F.col(array_col)).alias(alias))


def key_diff(actual: DataFrame, expected: DataFrame, key: str = "key") -> DataFrame:
    """Keys present on one side only (JN-8): (key, side) with side 'new' or 'missing'."""
    a = actual.select(key).distinct()
    e = expected.select(key).distinct()
    new = a.join(e, key, "left_anti").withColumn("side", F.lit("new"))
    missing = e.join(a, key, "left_anti").withColumn("side", F.lit("missing"))
    return new.unionByName(missing)


def date_spine(spark: SparkSession, start: Column | str, end: Column | str, col: str = "date_day") -> DataFrame:
    """One row per day in [start, end] with date parts (JN-9, date_spine macro)."""
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    d = spark.range(1).select(F.explode(F.sequence(s, e)).alias(col))
    return spine_parts(d, col)


def spine_parts(d: DataFrame, col: str = "date_day") -> DataFrame:
    c = F.col(col)
    return d.select(c, F.year(c).alias("year_number"), F.month(c).alias("month_of_year"),
                    F.dayofmonth(c).alias("day_of_month"), F.dayofweek(c).alias("day_of_week"),
                    F.weekofyear(c).alias("week_of_year"), F.trunc(c, "week").alias("week_start_date"),
                    F.trunc(c, "month").alias("month_start_date"), F.last_day(c).alias("month_end_date"))


def retention_flags(cohort: DataFrame, activity: DataFrame, days: list[int], id_col: str = "player_id",
                    cohort_col: str = "cohort_date", activity_col: str = "activity_date") -> DataFrame:
    """Per cohort member, one boolean per offset N: active exactly N days after cohort date (JN-4).

    One equi-join on the id plus day-difference flags replaces one left join per offset; an
    id with several cohort dates gets the flags of each date on its own.
    The activity side is reduced to distinct (id, day) first, so even an id with a third
    of all events contributes at most one row per calendar day. Output: ``cohort`` rows
    plus ``retained_d{N}`` (never NULL).
    """
    act = activity.select(id_col, activity_col).distinct()
    c = cohort.select(id_col, cohort_col)
    diff = F.date_diff(F.col(activity_col), F.col(cohort_col))
    hits = (c.join(act, id_col, "inner").where(diff.isin(*days))
            .groupBy(id_col, cohort_col).agg(*[F.max((diff == n).cast("int")).alias(f"retained_d{n}") for n in days]))
    out = cohort.join(hits, [id_col, cohort_col], "left")
    for n in days:
        out = out.withColumn(f"retained_d{n}", F.coalesce(F.col(f"retained_d{n}"), F.lit(0)) == 1)
    return out
