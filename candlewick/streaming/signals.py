"""Streaming RSI, divergence and signal lifecycle with per-symbol state (STR2, STR3).

Per symbol the state holds: last candle time, previous close, the two EWMA
states, the newest ``lookback - 1`` candles (time, close, rsi, low, high) and
the live signal.  Each candle costs O(1): the EWMA update is the original
recursion, so values equal the batch fold bit for bit.

``advance`` takes one batch of closed candles and the state table and gives
the batch's signal rows and the next state table (a keyed upsert: one row per
symbol).  ``stream_signals`` is the same step on Structured Streaming state, for
a candle stream that is in time order.

A candle at or before the stored time is not folded in.  If it repeats one of
the stored candles it is a re-delivery and is skipped; any other is late or
corrected, and comes out as a row with ``late`` set and no indicator, so that
it can be seen and replayed.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from candlewick import schema as S

OUT_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampNTZType()), T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("up_ewma", T.DoubleType()), T.StructField("down_ewma", T.DoubleType()),
    T.StructField("rsi", T.DoubleType()), T.StructField("bull", T.BooleanType()),
    T.StructField("bear", T.BooleanType()), T.StructField("kind", T.IntegerType()),
    T.StructField("signal_datetime", T.TimestampNTZType()), T.StructField("signal_close", T.DoubleType()),
    T.StructField("pct", T.DoubleType()), T.StructField("converted", T.BooleanType()),
    T.StructField("age_days", T.IntegerType()), T.StructField("live_after", T.BooleanType()),
    T.StructField("late", T.BooleanType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("last_us", T.LongType()), T.StructField("prev_close", T.DoubleType()),
    T.StructField("up_ewma", T.DoubleType()), T.StructField("down_ewma", T.DoubleType()),
    T.StructField("h_rsi", T.ArrayType(T.DoubleType())), T.StructField("h_low", T.ArrayType(T.DoubleType())),
    T.StructField("h_high", T.ArrayType(T.DoubleType())), T.StructField("kind", T.IntegerType()),
    T.StructField("s_us", T.LongType()), T.StructField("s_close", T.DoubleType()),
    T.StructField("h_us", T.ArrayType(T.LongType())), T.StructField("h_close", T.ArrayType(T.DoubleType())),
])

_DAY_US = 86_400_000_000


class _State:
    """One symbol's state, from a row of the state table (or None)."""

    def __init__(self, row=None):
        self.exists, self.get = row is not None, row

    def update(self, values) -> None:
        self.exists, self.get = True, values


def make_step(com: float = S.COM, lookback: int = S.DIVERGENCE_ROWS):
    a = 1.0 / (com + 1.0)
    keep = 1.0 - a
    back = lookback - 1
    kept = max(back, 1)

    def step(key, pdfs, state):
        if state.exists:
            (last_us, prev_close, ue, de, h_rsi, h_low, h_high, kind, s_us, s_close, h_us, h_close) = state.get
            h_rsi, h_low, h_high, h_us, h_close = (list(x) for x in (h_rsi, h_low, h_high, h_us, h_close))
        else:
            last_us, prev_close, ue, de = None, None, 0.0, 0.0
            h_rsi, h_low, h_high, kind, s_us, s_close, h_us, h_close = [], [], [], 0, None, None, [], []
        out = []
        # a group is one symbol's candles of one batch, which the source bounds
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values("datetime", kind="stable")
        for r in pdf.itertuples(index=False):
            us = int(pd.Timestamp(r.datetime).value // 1000)
            close, low, high = float(r.close), float(r.low), float(r.high)
            if last_us is not None and us <= last_us:
                if (us, close, low, high) not in zip(h_us, h_close, h_low, h_high):
                    out.append((r.datetime, key[0], float(r.open), high, low, close, None, None, None, None, None,
                                None, None, None, None, None, None, None, True))
                continue
            if prev_close is None:
                up = down = 0.0
                ue, de = up, down           # e_0 = first value (0)
            else:
                d = close - prev_close
                up = d if d > 0 else 0.0
                down = -d if d < 0 else 0.0
                ue = keep * ue + a * up
                de = keep * de + a * down
            rsi = None if de == 0 else 100.0 - 100.0 / (1.0 + ue / de)
            win = ([*zip(h_rsi, h_low, h_high)][-back:] if back else []) + [(rsi, low, high)]
            bull = rsi is not None and any(q is not None and not math.isnan(q) and q <= S.OVERSOLD
                                           and q <= rsi and ql > low for q, ql, _ in win)
            bear = rsi is not None and any(q is not None and not math.isnan(q) and q >= S.OVERBOUGHT
                                           and q >= rsi and qh < high for q, _, qh in win)
            if kind == 0 and (bull or bear):
                kind, s_us, s_close = (S.BEARISH if bear else S.BULLISH), us, close
            row_kind, sig_us, sig_close = kind, s_us, s_close
            pct = conv = age = None
            if kind:
                pct = 0.0 if close == s_close else ((s_close - close) / close * 100.0 if close else None)
                conv = None if pct is None else ((pct >= S.CONVERT_PCT and kind == S.BULLISH)
                                                 or (pct <= -S.CONVERT_PCT and kind == S.BEARISH))
                age = (us - s_us) // _DAY_US
                if age >= S.EXPIRY_DAYS:
                    kind, s_us, s_close = 0, None, None
            out.append((r.datetime, key[0], float(r.open), high, low, close, ue, de, rsi, bull, bear,
                        row_kind, pd.Timestamp(sig_us, unit="us") if sig_us is not None else None,
                        sig_close, pct, conv, age, kind != 0, False))
            h_rsi = (h_rsi + [float("nan") if rsi is None else rsi])[-kept:]
            h_low, h_high = (h_low + [low])[-kept:], (h_high + [high])[-kept:]
            h_us, h_close = (h_us + [us])[-kept:], (h_close + [close])[-kept:]
            prev_close, last_us = close, us
        state.update((last_us, prev_close, ue, de, h_rsi, h_low, h_high, kind, s_us, s_close, h_us, h_close))
        if out:
            yield pd.DataFrame(out, columns=OUT_SCHEMA.fieldNames())

    return step


def stream_signals(candles: DataFrame, com: float = S.COM, lookback: int = S.DIVERGENCE_ROWS) -> DataFrame:
    """STR2 + STR3 on streaming state: per-candle RSI, flags and lifecycle."""
    return (candles.groupBy("symbol")
                   .applyInPandasWithState(make_step(com, lookback), OUT_SCHEMA, STATE_SCHEMA,
                                           "append", GroupStateTimeout.NoTimeout))


#: One row per symbol.
STATE_TABLE = T.StructType([T.StructField("symbol", T.StringType()), *STATE_SCHEMA.fields])
_ADVANCED = T.StructType([T.StructField("symbol", T.StringType()),
                          T.StructField("rows", T.ArrayType(OUT_SCHEMA)), T.StructField("state", STATE_SCHEMA)])


def advance(candles: DataFrame, state: DataFrame, com: float = S.COM, lookback: int = S.DIVERGENCE_ROWS) -> DataFrame:
    """(symbol, rows, state): signal rows of one batch of closed candles and
    the state after it, one row for each symbol of batch or state."""
    def plain(v):
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime()
        return None if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) else v

    def one(key, batch, before):
        import pyarrow as pa

        row = None
        if before.num_rows:
            row = tuple(before.column(f.name)[0].as_py() for f in STATE_SCHEMA.fields)
        held, out = _State(row), []
        if batch.num_rows:
            pdf = batch.to_pandas()
            for made in make_step(com, lookback)((key[0].as_py(),), [pdf], held):
                out = [tuple(map(plain, r)) for r in made.astype(object).itertuples(index=False)]
        rows = [dict(zip(OUT_SCHEMA.fieldNames(), r)) for r in out]
        now = dict(zip(STATE_SCHEMA.fieldNames(), held.get))
        return pa.Table.from_pylist([{"symbol": key[0].as_py(), "rows": rows, "state": now}], schema=_arrow())

    def _arrow():
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(_ADVANCED)

    return (candles.groupBy("symbol").cogroup(state.groupBy("symbol")).applyInArrow(one, _ADVANCED))
