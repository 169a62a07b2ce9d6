"""Candle building and resampling (RES1-RES3).

Ticks -> OHLCV candles: ``groupBy(symbol, bucket)``.  The aggregation is
partial on the map side (one row per symbol x bucket x input split leaves a
task), so a symbol with a third of all ticks still spreads over every bucket
and every reducer.  Empty buckets produce no candle.  Buckets are aligned to
the epoch in UTC, so one-day candles start at 00:00 UTC (09:00 in Seoul).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.timefn import ordering_key


def bucket_start(ts: str, interval: str):
    return F.window(F.col(ts), interval).start


def candles_from_ticks(ticks: DataFrame, interval: str) -> DataFrame:
    """OHLCV candles; open/close are the first/last tick by (ts, seq)."""
    t = ticks.select("symbol", "price", "qty",
                     bucket_start("ts", interval).alias("datetime"),
                     ordering_key("ts", "seq").alias("_ord"))
    return (t.groupBy("symbol", "datetime")
             .agg(F.min_by("price", "_ord").alias("open"),
                  F.max("price").alias("high"),
                  F.min("price").alias("low"),
                  F.max_by("price", "_ord").alias("close"),
                  F.sum("qty").alias("volume"),
                  F.sum(F.col("price") * F.col("qty")).alias("QuoteAssetVolume"),
                  F.count(F.lit(1)).cast("int").alias("NumTrades")))


def resample_candles(candles: DataFrame, interval: str) -> DataFrame:
    """Coarser candles from finer ones (1h -> 4h, 4h -> 1d).

    Input rows are unique per (symbol, datetime), so ``datetime`` alone
    orders them; sums of sums keep volume and trade counts exact.
    """
    c = candles.select("symbol", "open", "high", "low", "close", "volume",
                       "QuoteAssetVolume", "NumTrades",
                       F.col("datetime").alias("_src"),
                       bucket_start("datetime", interval).alias("datetime"))
    return (c.groupBy("symbol", "datetime")
             .agg(F.min_by("open", "_src").alias("open"),
                  F.max("high").alias("high"),
                  F.min("low").alias("low"),
                  F.max_by("close", "_src").alias("close"),
                  F.sum("volume").alias("volume"),
                  F.sum("QuoteAssetVolume").alias("QuoteAssetVolume"),
                  F.sum("NumTrades").cast("int").alias("NumTrades")))
