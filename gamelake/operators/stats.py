"""Exact order statistics without buffering a group's values (AGG-7), and distinct counts that roll up (AGG-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.session import ensure_checkpoint_dir


def exact_percentile(df: DataFrame, group_cols: list[str], value_col: str, p: float = 0.5,
                     out_col: str = "percentile") -> DataFrame:
    """``percentile_cont(p) within group (order by value_col)`` per group, exactly.

    Instead of collecting every value of a group into one buffer (what ``percentile``
    does, fatal for a group holding a third of the rows), values are first counted per
    (group, value) with map-side partial aggregation. A running count over the distinct
    values of each group then locates the two ranks around position p * (n - 1) and
    interpolates linearly between them. NULL values are ignored; groups with no value
    are absent from the result (left-join it back). A group's different values meet in
    one window: for groups with very many of them use ``exact_percentile_spread``.
    """
    v = F.col(value_col)
    h = df.where(v.isNotNull()).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_n"))
    w_run = Window.partitionBy(*group_cols).orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*group_cols)
    h = (h.withColumn("_cum", F.sum("_n").over(w_run))
          .withColumn("_tot", F.sum("_n").over(w_all))
          .withColumn("_pos", F.lit(p) * (F.col("_tot") - 1))
          .withColumn("_lo", F.floor("_pos"))
          .withColumn("_hi", F.ceil("_pos")))
    start = F.col("_cum") - F.col("_n")
    at = lambda r: F.min(F.when((start <= F.col(r)) & (F.col(r) < F.col("_cum")), v))
    g = h.groupBy(*group_cols).agg(at("_lo").alias("_vlo"), at("_hi").alias("_vhi"),
                                   F.first("_pos").alias("_pos"), F.first("_lo").alias("_lo"))
    return _interpolated(g, group_cols, out_col)


SPLITS = 64


def exact_percentile_spread(df: DataFrame, group_cols: list[str], value_col: str, p: float = 0.5,
                            out_col: str = "percentile") -> DataFrame:
    """``exact_percentile`` for groups with very many different values.

    A group's values are cut into ``SPLITS`` ranges of about as many different values
    each (bounds from a mergeable approximate quantile sketch; they only decide who works on
    what). Counts by range find the range that holds the wanted rank; the other ranges are
    dropped, and the rank is found inside the one that is left. No task holds more than
    about one range of a group in its window, and the result is exact. The counts by value
    are checkpointed: bounds, ranges and the last step read them, not ``df``.
    """
    v = F.col(value_col)
    ensure_checkpoint_dir(df.sparkSession)
    h = df.where(v.isNotNull()).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    cuts = [k / SPLITS for k in range(1, SPLITS)]
    bounds = h.groupBy(*group_cols).agg(F.percentile_approx(v, cuts, 20 * SPLITS).alias("_bounds"))
    ranged = _joined(h, bounds, group_cols).withColumn("_range", F.size(F.filter("_bounds", lambda b: b < v))).drop("_bounds")
    sums = ranged.groupBy(*group_cols, "_range").agg(F.sum("_n").alias("_m"))
    w = Window.partitionBy(*group_cols)  # at most SPLITS rows a group
    sums = (sums.withColumn("_upto", F.sum("_m").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_pos", F.lit(p) * (F.sum("_m").over(w) - 1))
            .withColumn("_lo", F.floor("_pos")).withColumn("_hi", F.ceil("_pos")).withColumn("_start", F.col("_upto") - F.col("_m")))

    def holds(r: str, start, end):
        return (start <= F.col(r)) & (F.col(r) < end)
    chosen = sums.where(holds("_lo", F.col("_start"), F.col("_upto")) | holds("_hi", F.col("_start"), F.col("_upto"))).drop("_m", "_upto")
    inside = _joined(ranged, chosen, [*group_cols, "_range"])
    run = Window.partitionBy(*group_cols, "_range").orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("_cum", F.col("_start") + F.sum("_n").over(run))

    def at(r: str):
        return F.min(F.when(holds(r, F.col("_cum") - F.col("_n"), F.col("_cum")), v))
    g = inside.groupBy(*group_cols).agg(at("_lo").alias("_vlo"), at("_hi").alias("_vhi"),
                                        F.first("_pos").alias("_pos"), F.first("_lo").alias("_lo"))
    return _interpolated(g, group_cols, out_col)


def _joined(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Inner join on ``cols``, null-safe."""
    other = right.select(*[F.col(c).alias(f"_j_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(other[f"_j_{c}"])
    return left.join(other, cond).drop(*[f"_j_{c}" for c in cols])


def distinct_sketches(df: DataFrame, by: list[str], id_col: str, lg_k: int = 14) -> DataFrame:
    """One mergeable HyperLogLog sketch of ``id_col`` for each ``by``: the table to store a day at a time.

    Relative standard error about 0.83 / sqrt(2**lg_k): 0.65 % at 14, 16 KB a group.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(id_col, lg_k).alias("sketch"))


def distinct_rollup(sketches: DataFrame, by, out_col: str = "n_distinct") -> DataFrame:
    """Distinct counts of coarser groups from stored sketches, without the rows."""
    return sketches.groupBy(by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out_col))


def _interpolated(g: DataFrame, group_cols: list[str], out_col: str) -> DataFrame:
    return g.select(*group_cols, (F.col("_vlo").cast("double") + (F.col("_pos") - F.col("_lo"))
                                 * (F.col("_vhi") - F.col("_vlo")).cast("double")).alias(out_col))
