"""Table schemas and fixed values.

Fixed values (must equal the original pipeline's for identical results):
  RSI centre of mass com = 13  (alpha = 1 / (com + 1))
  RSI warm-up periods = 14 (notebook variant, min_periods)
  oversold threshold 30, overbought threshold 70 (inclusive)
  divergence lookback = newest 30 rows (the row itself included)
  incremental RSI tail = newest 200 rows
  conversion threshold 4.3 percent; signal expiry after 2 elapsed days
  signal codes: 1 bullish, 2 bearish; exchange time zone "Asia/Seoul"
"""

from __future__ import annotations

from pyspark.sql import types as T

COM = 13
WARMUP_PERIODS = 14
OVERSOLD = 30.0
OVERBOUGHT = 70.0
DIVERGENCE_ROWS = 30
TAIL_ROWS = 200
CONVERT_PCT = 4.3
EXPIRY_DAYS = 2
BULLISH = 1
BEARISH = 2
EXCHANGE_TZ = "Asia/Seoul"

# Names and types of kline_1d as written by the backfill job
# (12 columns, positional from the exchange array; index 6 is skipped).
KLINE_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("QuoteAssetVolume", T.DoubleType(), True),
    T.StructField("NumTrades", T.IntegerType(), True),
    T.StructField("TakerBuyBaseAssetVolume", T.DoubleType(), True),
    T.StructField("TakerBuyQuoteAssetVolume", T.DoubleType(), True),
    T.StructField("Ignore", T.StringType(), True),
])

# The daily tick writes the first eleven columns only.
KLINE_TICK_SCHEMA = T.StructType(KLINE_SCHEMA.fields[:11])

RSI_COLUMNS = ["datetime", "symbol", "open", "high", "low", "close",
               "up_ewma", "down_ewma", "rsi"]
RSI_SCHEMA = T.StructType(
    [KLINE_SCHEMA["datetime"], KLINE_SCHEMA["symbol"]]
    + [T.StructField(c, T.DoubleType(), True) for c in RSI_COLUMNS[2:]])

SIGNAL_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("diversions", T.IntegerType(), True),
    T.StructField("convert", T.IntegerType(), True),
])

STATE_SCHEMA = T.StructType([T.StructField("state", T.LongType(), True)])

# Candle file as read by the notebook prototype.
CSV_CANDLE_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("NumTrades", T.IntegerType(), True),
])

# Candle columns produced by the resampler.
CANDLE_COLUMNS = ["symbol", "datetime", "open", "high", "low", "close",
                  "volume", "QuoteAssetVolume", "NumTrades"]
