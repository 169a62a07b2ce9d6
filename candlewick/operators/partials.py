"""Candles that can be merged (RES1-RES3, incrementally).

A partial candle keeps, beside its values, the ordering keys of its first and
last tick.  Partials of one bucket merge in any order, and into coarser
buckets, without the ticks: late ticks change the one bucket of each interval
that they fall into.  Merging is a grouped aggregate with map-side combine.
Ticks that come twice count twice; feed each once (``plans.feeds``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.functions.timefn import ordering_key
from candlewick.operators.resample import bucket_start

FIRST, LAST = "first_key", "last_key"


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol", "datetime").agg(
        F.min_by("open", FIRST).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", LAST).alias("close"), F.sum("volume").alias("volume"),
        F.sum("QuoteAssetVolume").alias("QuoteAssetVolume"), F.sum("NumTrades").cast("int").alias("NumTrades"),
        F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST))


def partials_from_ticks(ticks: DataFrame, interval: str) -> DataFrame:
    """One row per symbol and bucket that ``ticks`` fall into."""
    key = ordering_key("ts", "seq")
    return _merged(ticks.select(
        "symbol", bucket_start("ts", interval).alias("datetime"), F.col("price").alias("open"), F.col("price").alias("high"),
        F.col("price").alias("low"), F.col("price").alias("close"), F.col("qty").alias("volume"),
        (F.col("price") * F.col("qty")).alias("QuoteAssetVolume"), F.lit(1).alias("NumTrades"), key.alias(FIRST),
        key.alias(LAST)))


def merge_partials(*parts: DataFrame, interval: str | None = None) -> DataFrame:
    """Partials of the same buckets, or of finer ones into those of ``interval``."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return _merged(rows.withColumn("datetime", bucket_start("datetime", interval)) if interval else rows)


def candles_of(partials: DataFrame) -> DataFrame:
    return partials.select(*S.CANDLE_COLUMNS)
