"""Rule-based classifiers (PRJ-6..PRJ-11). Limits live in ``fixed.py``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gamelake.functions import fixed


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def item_category(item_type) -> Column:
    """Map a raw item type to a broad category; anything unmatched (incl. NULL) is 'other'."""
    t = _c(item_type)
    return (
        F.when(t.startswith("cosmetic"), "cosmetic")
        .when(t.startswith("dlc"), "dlc")
        .when(t == "rift_pass", "rift_pass")
        .when(t.startswith("auric"), "auric_cells")
        .when(t.isin("bundle", "charm"), "cosmetic")
        .otherwise("other")
    )


def churn_segment(days_since) -> Column:
    """Recency segment; NULL recency (never seen) falls through to 'churned'."""
    d = _c(days_since)
    a, r, m = fixed.CHURN_LIMITS
    s = fixed.CHURN_SEGMENTS
    return F.when(d <= a, s[0]).when(d <= r, s[1]).when(d <= m, s[2]).otherwise(s[3])


def mmr_segment(mmr, null_as: int | None = None) -> Column:
    """MMR segment. ``null_as=None`` sends NULL to the top segment (distribution mart);
    ``null_as=0`` treats NULL as 0 (player dimension)."""
    m = _c(mmr)
    first = F.coalesce(m, F.lit(null_as)) if null_as is not None else m
    lo, mid, hi = fixed.MMR_LIMITS
    s = fixed.MMR_SEGMENTS
    return F.when(first < lo, s[0]).when(m < mid, s[1]).when(m < hi, s[2]).otherwise(s[3])


def balance_rating(kill_rate) -> Column:
    r = _c(kill_rate)
    s = fixed.BALANCE_RATINGS
    return (F.when(r < 0.40, s[0]).when(r < 0.50, s[1]).when(r <= 0.60, s[2])
            .when(r <= 0.70, s[3]).otherwise(s[4]))


def ltv_bucket(spend) -> Column:
    x = _c(spend)
    s = fixed.LTV_BUCKETS
    return (F.when(x == 0, s[0]).when(x < 10, s[1]).when(x < 50, s[2]).when(x < 100, s[3])
            .otherwise(s[4]))


def bucket(col, width: int = 100) -> Column:
    """``floor(x / width) * width`` histogram bucket."""
    return F.floor(_c(col) / F.lit(width)) * F.lit(width)
