"""Trade ticks: the raw input of every candle.

A tick table has columns ``symbol string, ts timestamp_ntz, seq bigint,
price double, qty double``.  ``seq`` breaks ties between ticks of one symbol
that share a timestamp.  Rows without a timestamp or price carry no trade:
``ticks_from`` leaves them out, ``tick_rejects`` shows them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sources.tables import table

TICK_COLUMNS = ["symbol", "ts", "seq", "price", "qty"]


def ticks_from(df: DataFrame, symbol: str, ts: str, seq: str, price: str,
               qty: str | None = None) -> DataFrame:
    return (df.where(F.col(ts).isNotNull() & F.col(price).isNotNull())
              .select(F.col(symbol).alias("symbol"),
                      F.col(ts).alias("ts"),
                      F.col(seq).cast("bigint").alias("seq"),
                      F.col(price).cast("double").alias("price"),
                      (F.col(qty).cast("double") if qty else F.lit(1.0)).alias("qty")))


def tick_rejects(df: DataFrame, ts: str, price: str) -> DataFrame:
    """The rows that ``ticks_from`` leaves out."""
    return df.where(F.col(ts).isNull() | F.col(price).isNull())


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ticks: symbol = event_type, price = value, tie-break event_id."""
    return ticks_from(table(spark, sf_dir, "events"), "event_type", "ts", "event_id", "value")


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a long daily series: symbol = o_orderpriority."""
    return ticks_from(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate",
                      "o_orderkey", "o_totalprice")
