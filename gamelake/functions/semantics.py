"""Column helpers that pin warehouse-SQL semantics onto Spark.

All return ``Column`` expressions built from ``pyspark.sql.functions``, so they stay
inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"second": "SECOND", "minute": "MINUTE", "hour": "HOUR"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def datediff_boundary(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end`` (S-1).

    ``timestampdiff`` counts whole elapsed units (00:00:59 -> 00:01:01 is 0 minutes);
    the warehouse counts boundaries (1 minute). Truncating both ends to the unit first
    turns elapsed-units into boundary counts. ``day`` works on dates.
    """
    start, end = _c(start), _c(end)
    unit = unit.lower()
    if unit == "day":
        return F.date_diff(F.to_date(end), F.to_date(start))
    u = _UNITS[unit]
    return F.timestamp_diff(u, F.date_trunc(unit, start), F.date_trunc(unit, end))


def safe_ratio(num, den, digits: int | None = None, null_to_zero: bool = False) -> Column:
    """``round(num / nullif(den, 0), digits)`` with optional outer coalesce to 0 (S-3).

    ANSI mode raises on x/0, so the denominator is always guarded.
    """
    num, den = _c(num), _c(den)
    r = num / F.nullif(den, F.lit(0))
    if digits is not None:
        r = F.round(r, digits)
    if null_to_zero:
        r = F.coalesce(r, F.lit(0.0))
    return r


def to_array(v) -> Column:
    """Warehouse ``::array`` on a VARIANT (S-5, PRJ-4).

    An array stays an array, NULL (SQL or JSON null) stays NULL and any other
    value becomes a one-element array. Result type: ``array<variant>``. The array
    test is a typed cast (cheap), not ``schema_of_variant`` (which walks the value).
    """
    v = _c(v)
    arr = F.try_variant_get(v, "$", "array<variant>")
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(None))
        .when(arr.isNotNull(), arr)
        .otherwise(F.array(v))
    )


def to_string_array(v) -> Column:
    """``to_array`` then each element as a string (``value::varchar`` per element).

    Fast path: a well-formed array of scalars casts in one step; the element-wise
    coercion only runs where that cast fails (an object, a joined string, mixed types).
    """
    v = _c(v)
    return F.coalesce(F.try_variant_get(v, "$", "array<string>"),
                      F.transform(to_array(v), lambda x: F.try_variant_get(x, "$", "string")))


def path_string_array(root, path: str) -> Column:
    """``root:path::array`` with string elements, reading typed values straight from
    the root by path (which the parquet scan can push down); the element-wise
    coercion of ``to_string_array`` only runs where the typed read fails."""
    root = _c(root)
    return F.coalesce(F.try_variant_get(root, path, "array<string>"),
                      to_string_array(F.variant_get(root, path, "variant")))


def cents_to_dollars(col) -> Column:
    """``round(col::number(18,2) / 100, 2)``."""
    return F.round(_c(col).cast("decimal(18,2)") / F.lit(100), 2).cast("decimal(18,2)")


def money(col) -> Column:
    """Exact decimal money total exposed as double, cast once at the end (S-12)."""
    return _c(col).cast("double")
