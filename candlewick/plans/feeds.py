"""Candle tables that grow by feeds of ticks, in any order (RES1-RES3).

A store holds a table of partial candles for each interval.  ``feed_ticks``
merges a feed's partials into the buckets that they fall into: it reads and
writes the slices of these buckets, of the finest interval and its parents
alike, and commits them together with the feed's name.  A feed whose job died
has changed nothing and can be fed again; one that is committed is skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators.partials import candles_of, merge_partials, partials_from_ticks
from candlewick.session import materialize
from candlewick.sinks.store import Store

INTERVALS = ("1 hour", "4 hours", "1 day")  # each one divides the next


def table_of(interval: str) -> str:
    return "partials_" + interval.replace(" ", "_")


def feed_ticks(spark: SparkSession, out_dir: str, ticks: DataFrame, feed: str,
               intervals: tuple[str, ...] = INTERVALS) -> bool:
    """Merge a feed of ticks into the tables; False if it was there already."""
    store = Store(spark, out_dir)
    snap = store.snapshot()
    named = spark.createDataFrame([(feed,)], "feed string")
    if snap:
        fed = store.read(snap, "feeds")
        if not fed.where(fed.feed == feed).isEmpty():
            return False
        named = fed.unionByName(named)
    commit, new = store.begin(snap, by="month"), None
    for interval in intervals:
        new = materialize(partials_from_ticks(ticks, interval) if new is None else merge_partials(new, interval=interval))
        rows = new
        if snap:
            rows = merge_partials(store.read(snap, table_of(interval), store.slices_of(new, snap)), new)
        commit.write(table_of(interval), rows)
    commit.write_whole("feeds", named)
    commit.commit()
    return True


def fed_candles(spark: SparkSession, out_dir: str, interval: str) -> DataFrame:
    store = Store(spark, out_dir)
    return candles_of(store.read(store.snapshot(), table_of(interval)))
