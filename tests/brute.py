"""Plain sequential reference implementations used as test oracles.

the blocked Spark plans can be checked against the obvious loop.
"""

from __future__ import annotations

import math

import pandas as pd

A = 1.0 / 14.0
KEEP = 1.0 - A


def fold(values, seed=None):
    e = values[0] if seed is None else seed
    for v in (values[1:] if seed is None else values):
        e = KEEP * e + A * v
    return e


def rsi_rows(closes):
    """Per-row (up, down, up_ewma, down_ewma, rsi) by the original recurrence."""
    out = []
    ups, downs = [], []
    prev = None
    for c in closes:
        d = None if prev is None else c - prev
        up = d if d is not None and d > 0 else 0.0
        dn = -d if d is not None and d < 0 else 0.0
        ups.append(up)
        downs.append(dn)
        ue, de = fold(ups), fold(downs)
        rsi = None if de == 0 else 100.0 - 100.0 / (1.0 + ue / de)
        out.append((up, dn, ue, de, rsi))
        prev = c
    return out


def flags(rows, lookback=30):
    """rows: list of (rsi, low, high) oldest first -> list of (bull, bear)."""
    res = []
    for i, (r, lo, hi) in enumerate(rows):
        win = rows[max(0, i - lookback + 1): i + 1]
        bull = r is not None and any(q is not None and q <= 30 and q <= r and ql > lo for q, ql, _ in win)
        bear = r is not None and any(q is not None and q >= 70 and q >= r and qh < hi for q, _, qh in win)
        res.append((bull, bear))
    return res


def lifecycle(ticks):
    """ticks: list of (datetime, close, bull, bear) -> list of dicts per tick."""
    live, kind, sdt, sc = False, 0, None, None
    out = []
    for dt, close, bull, bear in ticks:
        if not live and (bull or bear):
            live, kind, sdt, sc = True, (2 if bear else 1), dt, close
        row = {"kind": 0, "pct": None, "converted": None, "age_days": None}
        if live:
            pct = 0.0 if close == sc else (sc - close) / close * 100
            age = math.floor((dt - sdt).total_seconds() / 86400)
            row = {"kind": kind, "pct": pct, "age_days": age,
                   "converted": (pct >= 4.3 and kind == 1) or (pct <= -4.3 and kind == 2)}
            if age >= 2:
                live = False
        row["live_after"] = live
        out.append(row)
    return out


def candles_pd(ticks: pd.DataFrame, freq: str) -> pd.DataFrame:
    t = ticks.sort_values(["symbol", "ts", "seq"])
    t = t.assign(datetime=t["ts"].dt.floor(freq))
    g = t.groupby(["symbol", "datetime"], sort=True)
    return pd.DataFrame({"open": g["price"].first(), "high": g["price"].max(),
                         "low": g["price"].min(), "close": g["price"].last(),
                         "NumTrades": g["price"].size()}).reset_index()
