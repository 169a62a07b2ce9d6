"""Streaming candles and landing (STR1, STR4).

STR1: ticks -> tumbling-window candles with a watermark, append mode, so a
candle is emitted once, when its window has closed (window end <= max event
time - delay).  ``withWatermark`` needs TIMESTAMP, so tick times are cast
from TIMESTAMP_NTZ under the UTC session.

STR4: ``land`` writes every micro-batch with ``foreachBatch`` into its own
``batch=<id>`` folder in overwrite mode: a replayed batch rewrites the same
folder, so landing is idempotent.  Rows are clustered by symbol and time slice
(a hot symbol's backlog is many tasks' work) and sorted by time inside each
file.
"""

from __future__ import annotations

import json
import os
import threading
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.timefn import MICROS_PER_DAY, micros, ordering_key

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

CANDLE_STREAM_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()), T.StructField("QuoteAssetVolume", T.DoubleType()),
    T.StructField("NumTrades", T.IntegerType()),
])


SLICE_DAYS = 30  # time slice of a landed file's rows


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is one file, in whatever file system it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def _is_tick():
    return F.col("ts").isNotNull() & F.col("value").isNotNull()


def event_tick_stream(spark: SparkSession, path: str, max_files: int | None = None,
                      names: list[str] | None = None) -> DataFrame:
    """``events`` parquet files as a tick stream (symbol, ts TIMESTAMP, seq,
    price, qty), all or those of the given ``names``."""
    # a file may be admitted long after newer ones
    r = spark.readStream.schema(EVENTS_SCHEMA).option("maxFileAge", "36500d")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if is_file(spark, path):  # a single-file table: stream its folder, filtered to the file
        path, names = os.path.dirname(path), [os.path.basename(path)]
    if names:
        literal = ["".join(f"\\{c}" if c in "{}[]*?\\,^!" else c for c in n) for n in names]
        r = r.option("pathGlobFilter", literal[0] if len(literal) == 1 else "{" + ",".join(literal) + "}")
    ev = r.parquet(path)
    return (ev.where(_is_tick())
              .select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"),
                      F.col("event_id").alias("seq"), F.col("value").alias("price"),
                      F.lit(1.0).alias("qty")))


def measured_lag(spark: SparkSession, path: str) -> tuple[int | None, int]:
    """(newest tick in epoch milliseconds, delay in milliseconds) of a whole
    ``events`` table: with this delay its stream drops no tick, whatever files
    a batch takes.

    Files are streamed by modification time, so the delay covers how far the
    oldest tick of a file lags behind the newest of the files before it; files
    of one time may come in any order.  Files in time order need none.  The
    running maximum is over one row per modification time."""
    # the watermark drops a tick at its own millisecond too, and both ends are cut to milliseconds
    spare = 2
    at, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    us = micros("ts")
    files = (spark.read.schema(EVENTS_SCHEMA).parquet(path).where(_is_tick()).groupBy(at.alias("m"))
             .agg(F.min(us).alias("lo"), F.max(us).alias("hi"), (F.min(name) != F.max(name)).alias("several")))
    before = F.max("hi").over(Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1))
    lag = F.greatest(before, F.when(F.col("several"), F.col("hi"))) - F.col("lo")
    newest, lag = files.select("hi", lag.alias("lag")).agg(F.max("hi"), F.max("lag")).first()
    return (None if newest is None else newest // 1000), (0 if lag is None or lag < 0 else lag // 1000 + spare)


SPARE_MS = 2  # the watermark drops a tick at its own millisecond too, and both ends are cut to milliseconds


def admissions(spark: SparkSession, path: str, max_files: int) -> tuple[list[tuple[list[str], int]], bool]:
    """A whole ``events`` table in event-time order: (names of files, delay in
    milliseconds) of each step, in turn, and whether the last step has the
    newest tick (else windows stay open, see ``repeat_newest_tick``).

    Files are admitted by their oldest tick, ``max_files`` at a time, whenever
    they were written.  After a step the watermark may reach the oldest tick of
    the files still to come, so the delay is what the newest tick so far is
    ahead of it: nothing is dropped, and the state holds the overlap of the
    files, not the table.  The last step's delay is 0.  The driver sees a row
    for each file, as a file index does; files of one name go together."""
    us = micros("ts")
    files = (spark.read.schema(EVENTS_SCHEMA).parquet(path).where(_is_tick()).groupBy(F.col("_metadata.file_name").alias("name"))
             .agg(F.min(us).alias("lo"), F.max(us).alias("hi")).orderBy("lo", "name").collect())
    steps, newest = [], None
    for i in range(0, len(files), max_files):
        part = files[i:i + max_files]
        newest = max([f.hi for f in part] + ([] if newest is None else [newest]))
        ahead = newest // 1000 + SPARE_MS - files[i + max_files].lo // 1000 if i + max_files < len(files) else 0
        ends = max(f.hi for f in part) == newest
        steps.append(([unquote(f.name) for f in part], max(0, ahead)))  # the metadata is URL-encoded
    return steps, not steps or ends


def repeat_newest_tick(spark: SparkSession, path: str, folder: str) -> None:
    """Deliver the newest tick of ``events`` once more, so that the watermark
    reaches it; as a tick that came already it is in no candle."""
    ticks = spark.read.schema(EVENTS_SCHEMA).parquet(path).where(_is_tick())
    ticks.orderBy(F.col("ts").desc()).limit(1).coalesce(1).write.mode("append").parquet(folder)


def stream_candles(ticks: DataFrame, interval: str, delay: str, dedupe: bool = True) -> DataFrame:
    """STR1: closed candles only; same columns and rules as the batch resampler.

    ``delay`` is how far ticks may lag behind the newest one; later ones are
    dropped by the watermark and counted (``Landing``).

    With ``dedupe`` a tick re-delivered by an at-least-once source (same
    symbol and seq) is counted once (``dropDuplicatesWithinWatermark``).
    """
    t = ticks.withWatermark("ts", delay)
    if dedupe:
        t = t.dropDuplicatesWithinWatermark(["symbol", "seq"])
    t = (t.select("symbol", "price", "qty", F.window("ts", interval).alias("w"),
                      ordering_key("ts", "seq").alias("_ord")))
    c = (t.groupBy("symbol", "w")
          .agg(F.min_by("price", "_ord").alias("open"), F.max("price").alias("high"),
               F.min("price").alias("low"), F.max_by("price", "_ord").alias("close"),
               F.sum("qty").alias("volume"), F.sum(F.col("price") * F.col("qty")).alias("QuoteAssetVolume"),
               F.count(F.lit(1)).cast("int").alias("NumTrades")))
    return c.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("datetime"),
                    "open", "high", "low", "close", "volume", "QuoteAssetVolume", "NumTrades")


def write_batch(batch: DataFrame, path: str, key: str = "symbol", order: str = "datetime") -> None:
    """One batch's folder; writing it again replaces it."""
    part = F.floor(micros(order) / F.lit(SLICE_DAYS * MICROS_PER_DAY))
    (batch.repartition(key, part).sortWithinPartitions(key, order).write.mode("overwrite").parquet(path))


def batch_folder(out_dir: str, batch_id: int) -> str:
    return os.path.join(out_dir, f"batch={batch_id:012d}")


class Landing:
    """A started landing query; batch by batch the ticks that its watermark dropped and the rows of its state."""

    def __init__(self) -> None:
        self.query, self.started, self.batches, self.by_batch, self.held = None, threading.Event(), 0, {}, {}

    def note(self) -> None:
        """Take over the figures of the progress entries there are.  The query keeps
        only the newest ones, so every batch notes those of the batches before it."""
        for p in self.query.recentProgress:
            p = json.loads(p.json if isinstance(p.json, str) else json.dumps(p))
            dropped, held = (sum(int(op.get(x, 0)) for op in p.get("stateOperators", []))
                             for x in ("numRowsDroppedByWatermark", "numRowsTotal"))
            self.by_batch[p["batchId"]] = max(dropped, self.by_batch.get(p["batchId"], 0))
            self.held[p["batchId"]] = max(held, self.held.get(p["batchId"], 0))

    def await_dropped(self) -> int:
        """Rows that the watermark dropped as too late, over all batches of the query."""
        self.query.awaitTermination()
        self.note()
        if self.batches and not self.by_batch:
            raise RuntimeError("dropped ticks can't be counted: spark.sql.streaming.numRecentProgressUpdates is below 2")
        return sum(self.by_batch.values())


def land(df: DataFrame, out_dir: str, checkpoint: str, key: str = "symbol",
         order: str = "datetime", trigger: dict | None = None, then=None, landing: Landing | None = None):
    """STR4: idempotent per-batch landing; returns the started query.
    ``then(spark, batch_id)`` follows each landed batch; ``landing`` counts
    the dropped ticks."""

    def landed(batch: DataFrame, batch_id: int):
        if landing:
            landing.started.wait()
            landing.batches += 1
            landing.note()
        write_batch(batch, batch_folder(out_dir, batch_id), key, order)
        if then:
            then(batch.sparkSession, batch_id)

    w = df.writeStream.foreachBatch(landed).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    q = w.start()
    if landing:
        landing.query = q
        landing.started.set()
    return q


def landed_glob(out_dir: str) -> str:
    return os.path.join(out_dir, "batch=*", "*.parquet")
