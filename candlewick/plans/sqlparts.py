"""DuckDB oracle SQL building blocks for the query catalogue.

The oracle restates each query from its definition in plain SQL: candles
by ``time_bucket`` + ``arg_min/arg_max``, the recursive EWMA by
``list_reduce`` over a running list, look-backs by window frames, the
lifecycle by a recursive CTE.  DuckDB divides by zero to inf/NaN, so the
RS divisor is wrapped in ``nullif``.
"""

from __future__ import annotations

from candlewick import schema as S

A = f"(1.0 / {S.COM + 1})"
KEEP = f"(1.0 - 1.0 / {S.COM + 1})"
FOLD = f"lambda acc, x: {KEEP} * acc + {A} * x"

EVENT_TICKS = ("SELECT event_type AS symbol, ts, event_id AS seq, value AS price, 1.0 AS qty "
               "FROM events WHERE ts IS NOT NULL AND value IS NOT NULL")
ORDER_TICKS = ("SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey AS seq, "
               "o_totalprice AS price, 1.0 AS qty FROM orders "
               "WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL")


def candles(ticks: str, interval: str) -> str:
    return (f"SELECT symbol, time_bucket(INTERVAL '{interval}', ts) AS datetime, "
            "arg_min(price, (ts, seq)) AS open, max(price) AS high, min(price) AS low, "
            "arg_max(price, (ts, seq)) AS close, sum(qty) AS volume, "
            "sum(price * qty) AS QuoteAssetVolume, CAST(count(*) AS INTEGER) AS NumTrades "
            f"FROM ({ticks}) GROUP BY 1, 2")


def gains(src: str) -> str:
    return ("SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0.0 END AS up, "
            "CASE WHEN delta < 0 THEN -delta ELSE 0.0 END AS down FROM ("
            "SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY datetime) AS prev_close, "
            "close - lag(close) OVER (PARTITION BY symbol ORDER BY datetime) AS delta, "
            "CAST(row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS BIGINT) AS t "
            f"FROM ({src}))")


def rsi_full(src: str) -> str:
    """Full-history RSI rows (all candle columns + up/down/ewma/rs/rsi, t)."""
    w = "(PARTITION BY symbol ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return ("SELECT *, up_ewma / nullif(down_ewma, 0) AS rs, "
            "100.0 - 100.0 / (1.0 + up_ewma / nullif(down_ewma, 0)) AS rsi FROM ("
            f"SELECT *, list_reduce(list(up) OVER {w}, {FOLD}) AS up_ewma, "
            f"list_reduce(list(down) OVER {w}, {FOLD}) AS down_ewma FROM ({gains(src)}))")


def rsi_tail(src: str, tail: int = S.TAIL_ROWS) -> str:
    w = f"(PARTITION BY symbol ORDER BY datetime ROWS BETWEEN {tail - 2} PRECEDING AND CURRENT ROW)"
    return ("SELECT *, 100.0 - 100.0 / (1.0 + up_ewma / nullif(down_ewma, 0)) AS rsi FROM ("
            f"SELECT *, list_reduce(list_prepend(0.0, list(up) OVER {w}), {FOLD}) AS up_ewma, "
            f"list_reduce(list_prepend(0.0, list(down) OVER {w}), {FOLD}) AS down_ewma "
            f"FROM ({gains(src)}))")


def warmup_gaps(src: str) -> str:
    """The normalised averages over rows of which some have no difference:
    weighted sums of values and of weights, each a fold over a running list."""
    w = "(PARTITION BY symbol ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    n = S.WARMUP_PERIODS
    return ("SELECT datetime, symbol, close, AU, AD, CASE WHEN AU IS NULL OR AD IS NULL THEN NULL "
            "WHEN AD = 0 THEN CASE WHEN AU > 0 THEN 100.0 END ELSE 100.0 - 100.0 / (1.0 + AU / AD) END AS RSI FROM ("
            f"SELECT *, CASE WHEN seen >= {n} THEN u / k END AS AU, CASE WHEN seen >= {n} THEN d / k END AS AD FROM ("
            f"SELECT *, count(delta) OVER {w} AS seen, list_reduce(list(up) OVER {w}, {FOLD}) AS u, "
            f"list_reduce(list(down) OVER {w}, {FOLD}) AS d, "
            f"list_reduce(list(CASE WHEN delta IS NULL THEN 0.0 ELSE 1.0 END) OVER {w}, {FOLD}) AS k "
            f"FROM ({gains(src)})))")


def flags(rsi_src: str, lookback: int = S.DIVERGENCE_ROWS) -> str:
    """bull/bear per row by a correlated EXISTS over the look-back rows."""
    back = lookback - 1
    return (
        f"WITH rr AS ({rsi_src}) SELECT r.*, "
        f"EXISTS (SELECT 1 FROM rr q WHERE q.symbol = r.symbol AND q.t BETWEEN r.t - {back} AND r.t "
        f"AND q.rsi <= {S.OVERSOLD} AND q.rsi <= r.rsi AND q.low > r.low) AS bull, "
        f"EXISTS (SELECT 1 FROM rr q WHERE q.symbol = r.symbol AND q.t BETWEEN r.t - {back} AND r.t "
        f"AND q.rsi >= {S.OVERBOUGHT} AND q.rsi >= r.rsi AND q.high < r.high) AS bear "
        f"FROM rr r")


def lifecycle(flag_src: str) -> str:
    """Recursive replay of the tick loop, one row per tick per symbol."""
    day_us = 86_400_000_000
    return f"""
WITH RECURSIVE f AS (SELECT symbol, datetime, close, bull, bear, t FROM ({flag_src})),
r AS (
  SELECT symbol, t, datetime, close, bull, bear,
         CASE WHEN bear THEN {S.BEARISH} WHEN bull THEN {S.BULLISH} END AS kind,
         CASE WHEN bull OR bear THEN datetime END AS s_dt,
         CASE WHEN bull OR bear THEN close END AS s_close
  FROM f WHERE t = 0
  UNION ALL
  SELECT n.symbol, n.t, n.datetime, n.close, n.bull, n.bear,
         CASE WHEN p.live THEN p.kind WHEN n.bear THEN {S.BEARISH} WHEN n.bull THEN {S.BULLISH} END,
         CASE WHEN p.live THEN p.s_dt WHEN n.bull OR n.bear THEN n.datetime END,
         CASE WHEN p.live THEN p.s_close WHEN n.bull OR n.bear THEN n.close END
  FROM (SELECT *, kind IS NOT NULL AND
               floor((epoch_us(datetime) - epoch_us(s_dt)) / {day_us}) < {S.EXPIRY_DAYS} AS live
        FROM r) p
  JOIN f n ON n.symbol = p.symbol AND n.t = p.t + 1
)
SELECT datetime, symbol, close, bull, bear, CAST(kind AS INTEGER) AS kind,
       s_dt AS signal_datetime, s_close AS signal_close,
       CASE WHEN kind IS NOT NULL THEN
         CASE WHEN close = s_close THEN 0.0 ELSE (s_close - close) / nullif(close, 0) * 100 END END AS pct,
       CAST(floor((epoch_us(datetime) - epoch_us(s_dt)) / {day_us}) AS INTEGER) AS age_days,
       t
FROM r"""


def lifecycle_final(flag_src: str) -> str:
    return f"""
SELECT datetime, symbol, close, bull, bear, CAST(coalesce(kind, 0) AS INTEGER) AS kind,
       signal_datetime, signal_close, pct,
       CASE WHEN kind IS NULL THEN NULL ELSE
         (pct >= {S.CONVERT_PCT} AND kind = {S.BULLISH}) OR (pct <= -{S.CONVERT_PCT} AND kind = {S.BEARISH})
       END AS converted,
       age_days,
       kind IS NOT NULL AND age_days < {S.EXPIRY_DAYS} AS live_after, t
FROM ({lifecycle(flag_src)})"""


def daily_tick(src: str) -> str:
    """The newest candle of each symbol as a tick: RSI of the newest 200
    candles, flags against the 29 rows before it of the RSI history without
    the tick, and one step of the signal state after that history."""
    newest = "row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC)"
    hist = f"SELECT * FROM ({src}) QUALIFY {newest} > 1"
    cols = "symbol, datetime, close, low, high, rsi"
    return f"""
WITH stored AS ({rsi_full(hist)}),
tick AS (SELECT {cols} FROM ({rsi_tail(src)}) QUALIFY {newest} = 1),
look AS (SELECT {cols} FROM stored QUALIFY {newest} <= {S.DIVERGENCE_ROWS - 1}),
f AS (SELECT t.*,
  EXISTS (SELECT 1 FROM look q WHERE q.symbol = t.symbol AND q.rsi <= {S.OVERSOLD} AND q.rsi <= t.rsi AND q.low > t.low) AS bull,
  EXISTS (SELECT 1 FROM look q WHERE q.symbol = t.symbol AND q.rsi >= {S.OVERBOUGHT} AND q.rsi >= t.rsi AND q.high < t.high) AS bear
  FROM tick t),
before AS (SELECT symbol, live_after AS live, kind AS k0, signal_datetime AS t0, signal_close AS c0
  FROM ({lifecycle_final(flags(rsi_full(hist)))}) QUALIFY {newest} = 1),
s AS (SELECT f.*,
  CAST(CASE WHEN live THEN k0 WHEN bear THEN {S.BEARISH} WHEN bull THEN {S.BULLISH} ELSE 0 END AS INTEGER) AS kind,
  CASE WHEN live THEN t0 WHEN bull OR bear THEN datetime END AS signal_datetime,
  CASE WHEN live THEN c0 WHEN bull OR bear THEN close END AS signal_close
  FROM f JOIN before USING (symbol)),
p AS (SELECT *, CASE WHEN kind > 0 THEN CASE WHEN close = signal_close THEN 0.0
    ELSE (signal_close - close) / nullif(close, 0) * 100 END END AS pct,
  CAST(floor((epoch_us(datetime) - epoch_us(signal_datetime)) / 86400000000) AS INTEGER) AS age_days FROM s)
SELECT *, CASE WHEN kind > 0 THEN (pct >= {S.CONVERT_PCT} AND kind = {S.BULLISH})
    OR (pct <= -{S.CONVERT_PCT} AND kind = {S.BEARISH}) END AS converted,
  kind > 0 AND age_days < {S.EXPIRY_DAYS} AS live_after FROM p"""
