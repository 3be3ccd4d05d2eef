"""Latest-row-per-key deduplication (WIN-1, WIN-2).

``row_number() over (partition by key order by ...) = 1`` is planned by Spark with a
WindowGroupLimit on the map side, so each task keeps at most one row per key before
the exchange: a key that holds a third of the rows ships one row per map task, not
a third of the table. The caller states the full order, tie-breaks included (S-10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str] | str, order: list[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (write NULL placement explicitly)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def load_order(columns: list[str]) -> list[Column]:
    """Last load wins: load time, file, then a hash of the row, so that no tie is left to chance."""
    return [F.col("load_ts").desc_nulls_first(), F.col("filename").desc_nulls_first(),
            F.xxhash64(*[F.col(c) for c in columns])]


def latest_by_tied(df: DataFrame, keys: list[str] | str, order: list[Column], tie: Column) -> DataFrame:
    """``latest_by`` with a last order column that is dear: computed only where a key's first place is shared.

    ``rank`` keeps all rows that share the first place (limited on the map side like
    ``row_number``); they are counted, and where there are several the least ``tie`` wins (any of
    the rows that share that, too). One exchange and one sort after it in all. A hash leads the
    sort: keys that begin alike would be compared in full, wide row by wide row.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = Window.partitionBy("_h", *keys)
    ordered = by.orderBy(*order)
    first = df.withColumn("_h", F.xxhash64(*keys)).withColumn("_rk", F.rank().over(ordered)).where(F.col("_rk") == 1)
    tied = first.withColumn("_n", F.count(F.lit(1)).over(by)).withColumn("_tie", F.when(F.col("_n") > 1, tie))
    least = tied.withColumn("_least", F.min("_tie").over(by)).where(F.col("_tie").eqNullSafe(F.col("_least")))
    return (least.withColumn("_rn", F.row_number().over(ordered)).where(F.col("_rn") == 1)
            .drop("_h", "_rk", "_n", "_tie", "_least", "_rn"))


def with_key(df: DataFrame, key: Column, name: str = "_key") -> DataFrame:
    """Rows that have a key, with it as column ``name``.

    The one-element ``explode`` keeps the filter where it is: pushed below the projection that
    makes the key's source (a VARIANT payload, say), it would make that twice for every row.
    """
    return df.select("*", F.explode(F.array(key)).alias(name)).where(F.col(name).isNotNull())


def latest_by_max(df: DataFrame, keys: list[str] | str, order_col: str, cols: list[str]) -> DataFrame:
    """Alternative form: ``max_by(struct(cols), order_col)`` grouped by key.

    Note the NULL semantics differ from ``latest_by`` with ``desc_nulls_first``: here a
    NULL ordering value never wins.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    s = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col)).alias("_s")
    return df.groupBy(*keys).agg(s).select(*keys, "_s.*")
