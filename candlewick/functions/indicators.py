"""Scalar column expressions of the indicator pipeline (PRJ3-PRJ7, PD1-PD2)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.functions.timefn import col_

_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
          "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
          "week": 7 * 86_400_000_000}


def interval_micros(interval: str) -> int:
    """'4 hours' -> 14_400_000_000."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", interval.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported interval {interval!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def gain(delta) -> Column:
    """Positive part; NULL delta (first row) counts as 0."""
    d = col_(delta)
    return F.when(d > 0, d).otherwise(F.lit(0.0))


def loss(delta) -> Column:
    """Magnitude of the negative part; NULL delta counts as 0."""
    d = col_(delta)
    return F.when(d < 0, -d).otherwise(F.lit(0.0))


def gain_keep_null(delta) -> Column:
    """Notebook form: negatives clipped to 0, NULL stays NULL."""
    d = col_(delta)
    return F.when(d < 0, F.lit(0.0)).otherwise(d)


def loss_keep_null(delta) -> Column:
    """Notebook form: positives clipped to 0, then absolute value."""
    d = col_(delta)
    return F.abs(F.when(d > 0, F.lit(0.0)).otherwise(d))


def relative_strength(up, down) -> Column:
    """up / down, NULL when down is 0 (pre-ANSI division semantics)."""
    return F.try_divide(col_(up), col_(down))


def rsi_from_rs(rs) -> Column:
    return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + col_(rs))


def rsi_from_averages_warm(au, ad) -> Column:
    """pandas semantics: AD = 0 gives 100 when AU > 0 and NULL (NaN) when AU = 0."""
    au, ad = col_(au), col_(ad)
    return (F.when(au.isNull() | ad.isNull(), F.lit(None).cast("double"))
             .when(ad == 0, F.when(au > 0, F.lit(100.0)))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + au / ad)))


def pct_change(a, b) -> Column:
    """pc(a, b): 0 when equal, else (b - a) / a * 100 (NULL when a = 0)."""
    a, b = col_(a), col_(b)
    return F.when(a == b, F.lit(0.0)).otherwise(F.try_divide(b - a, a) * F.lit(100.0))
