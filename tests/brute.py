"""Brute-force references used only by tests and the benchmark comparison."""
from pyspark.sql import functions as F


def rolling_distinct_theta(activity, date_col, id_col, days, out_col="n_distinct"):
    """Trailing distinct ids by the naive range join (plans as a nested loop)."""
    pairs = activity.select(date_col, id_col).where(F.col(id_col).isNotNull()).distinct()
    a = pairs.alias("a")
    d = pairs.select(date_col).distinct().alias("d")
    j = d.join(a, (F.col(f"a.{date_col}") >= F.date_sub(F.col(f"d.{date_col}"), days - 1))
               & (F.col(f"a.{date_col}") <= F.col(f"d.{date_col}")))
    return j.groupBy(F.col(f"d.{date_col}").alias(date_col)).agg(F.countDistinct(F.col(f"a.{id_col}")).alias(out_col))
