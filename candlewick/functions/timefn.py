"""Time expressions (epoch decode, exchange wall clock, elapsed days, buckets)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ holding the UTC wall clock (DT1)."""
    return F.timestamp_millis(col_(ms).cast("bigint")).cast("timestamp_ntz")


def utc_to_wall_clock(ts, tz: str) -> Column:
    """UTC wall clock -> wall clock of ``tz`` (DT2), kept as TIMESTAMP_NTZ.

    ``from_utc_timestamp`` works on TIMESTAMP and returns TIMESTAMP; with the
    session pinned to UTC the cast back to NTZ keeps the shifted wall clock.
    """
    return F.from_utc_timestamp(col_(ts).cast("timestamp"), tz).cast("timestamp_ntz")


def micros(ts) -> Column:
    """Microseconds since the epoch for a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.unix_micros(col_(ts).cast("timestamp"))


def elapsed_days(later, earlier) -> Column:
    """Whole elapsed days, floored, from the exact difference (DT3).

    Equals Python's ``(d1 - d2).days``; calendar-day difference would not.
    """
    return F.floor((micros(later) - micros(earlier)) / F.lit(MICROS_PER_DAY)).cast("int")


def ordering_key(ts, seq) -> Column:
    """Pack (ts, seq) into one fixed-width decimal(38,0) sort key.

    A struct ordering makes min_by/max_by fall back to a sort-based
    aggregate; a decimal key keeps the map-side hash aggregate.  seq is
    shifted into [0, 2^64) so the packing preserves (ts, seq) order.
    """
    shift = F.expr("CAST('100000000000000000000' AS DECIMAL(38,0))")   # 10^20
    offset = F.expr("CAST('9223372036854775808' AS DECIMAL(38,0))")    # 2^63
    ts_part = micros(ts).cast("decimal(38,0)") * shift
    seq_part = col_(seq).cast("decimal(38,0)") + offset
    return (ts_part + seq_part).cast("decimal(38,0)")
