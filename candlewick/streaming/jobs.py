"""Streaming pipeline: STR1 lands closed candles, STR2/STR3 follow each batch.

One streaming query makes candles.  Its ``foreachBatch`` lands a batch (STR4)
and then advances the signals by exactly that batch: it reads the state table
as the last batch left it, writes the batch's signal rows and the next state
table.  Batches are taken whole and in the order of their ids, whatever number
of files they have and whenever these were written; a batch that is replayed
starts from the same state and overwrites the same folders.

The source bounds a batch (``max_files`` tick files), so a backlog is many
batches.  Every run without ``base`` uses fresh folders under the shared
checkpoint directory.
"""

from __future__ import annotations

import os
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.timefn import micros
from candlewick.session import checkpoint_dir, materialize
from candlewick.streaming.candles import (
    CANDLE_STREAM_SCHEMA, Landing, admissions, batch_folder, event_tick_stream, land, landed_glob, repeat_newest_tick,
    stream_candles, write_batch)
from candlewick.streaming.blocked import advance_blocked
from candlewick.streaming.signals import OUT_SCHEMA, STATE_TABLE, advance


def run_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


MAX_FILES = 64  # tick files of one batch
GROUP_ROWS = 50_000  # candles of a symbol that one task folds; a batch with more of one goes in blocks


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def landed_ids(spark: SparkSession, out_dir: str) -> list[int]:
    """Ids of the batches in ``out_dir``, ascending."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def advance_batch(spark: SparkSession, base: str, batch_id: int, candles_dir: str | None = None,
                  group_rows: int = GROUP_ROWS) -> None:
    """Signals of one landed batch, and the state table after it."""
    signals, states = os.path.join(base, "signals"), os.path.join(base, "state")
    candles = spark.read.schema(CANDLE_STREAM_SCHEMA).parquet(
        batch_folder(candles_dir or os.path.join(base, "candles"), batch_id))
    before = [i for i in landed_ids(spark, states) if i < batch_id]
    state = (spark.read.schema(STATE_TABLE).parquet(batch_folder(states, before[-1])) if before
             else spark.createDataFrame([], STATE_TABLE))
    most, lo, hi = candles.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.min(micros("datetime")).alias("lo"), F.max(micros("datetime")).alias("hi")).agg(
        F.max("n"), F.min("lo"), F.max("hi")).first()
    if (most or 0) > group_rows:
        rows, now = advance_blocked(candles, state, max(1, (hi - lo) // most))
    else:
        done = materialize(advance(candles, state))
        rows, now = done.select(F.explode("rows").alias("r")).select("r.*"), done.select("symbol", "state.*")
    write_batch(rows, batch_folder(signals, batch_id))
    # last: a batch with a state table is complete
    now.write.mode("overwrite").parquet(batch_folder(states, batch_id))


def run_candle_stream(spark: SparkSession, events_path: str, interval: str, delay: str | None = "0 seconds",
                      base: str | None = None, max_files: int = MAX_FILES, signals: bool = False) -> str:
    """Run STR1 -> STR4 (with ``signals`` also STR2/STR3) to completion
    (availableNow); returns the landed folder.  Ticks that lag behind the
    newest one by more than ``delay`` are dropped by the watermark; their
    number is written to ``<base>/dropped`` and a warning names it.

    ``delay=None`` is for a whole table and a fresh ``base``: its files are
    admitted in event-time order (``admissions``), each step a run of the same
    query with the delay that the files to come need, the last without (and the
    newest tick once more, if it came earlier); a dropped tick is an error.  The most rows that the state held after a batch
    are written beside the dropped ticks."""
    base = base or run_folder(spark, "candles")
    out = os.path.join(base, "candles")
    then = (lambda s, i: advance_batch(s, base, i)) if signals else None
    whole = delay is None
    if whole:
        if landed_ids(spark, out):
            raise ValueError(f"event-time order needs a fresh folder, {out} has batches")
        again = os.path.join(base, "again")
        make_folder(spark, again)
        plan, ends = admissions(spark, events_path, max_files)
        plan = plan or [(None, 0)]
        steps = [(names, f"{ms} milliseconds") for names, ms in (plan if ends else [*plan, plan[-1]])]
    else:
        steps = [(None, delay)]
    dropped = held = 0
    for i, (names, delay) in enumerate(steps):
        ticks = event_tick_stream(spark, events_path, None if whole else max_files, names)
        if whole:
            if i == len(plan):
                repeat_newest_tick(spark, events_path, again)
            ticks = ticks.unionByName(event_tick_stream(spark, again))
        landing = Landing()
        q = land(stream_candles(ticks, interval, delay), out, os.path.join(base, "_ckpt_candles"), then=then,
                 landing=landing)
        dropped += landing.await_dropped()
        held = max([held, *landing.held.values()])
        (spark.range(1).select(F.lit(str(q.runId)).alias("run"), F.lit(delay).alias("delay"),
                               F.lit(dropped).cast("long").alias("dropped"), F.lit(held).cast("long").alias("state_rows"))
         .write.mode("append").parquet(os.path.join(base, "dropped")))
    if dropped:
        said = f"{dropped} ticks came later than the delay of {delay} and were dropped"
        if whole:
            raise RuntimeError(said)
        warnings.warn(said, stacklevel=2)
    return out


def run_signal_stream(spark: SparkSession, candles_dir: str, base: str) -> str:
    """Advance the signals over all landed batches that have none yet, in id order."""
    done = set(landed_ids(spark, os.path.join(base, "state")))
    for i in landed_ids(spark, candles_dir):
        if i not in done:
            advance_batch(spark, base, i, candles_dir)
    return os.path.join(base, "signals")


def read_signals(spark: SparkSession, signals_dir: str, late: bool = False) -> DataFrame:
    """Signal rows; with ``late`` the late and corrected candles instead."""
    rows = spark.read.schema(OUT_SCHEMA).parquet(landed_glob(signals_dir))
    return rows.where(F.col("late") if late else ~F.col("late")).drop("late")


def run_streams(spark: SparkSession, events_path: str, interval: str = "4 hours",
                delay: str | None = "0 seconds", max_files: int = MAX_FILES) -> DataFrame:
    base = run_folder(spark, "streams")
    run_candle_stream(spark, events_path, interval, delay, base, max_files, signals=True)
    return read_signals(spark, os.path.join(base, "signals"))


def current_state(spark: SparkSession, base: str) -> DataFrame:
    """SNK3: one row per symbol from the newest state table -- the newest
    candle's time and close, the live signal (``now_diversions``) and
    ``state`` (``task_state``: 1 while a signal is live)."""
    states = os.path.join(base, "state")
    rows = spark.read.schema(STATE_TABLE).parquet(batch_folder(states, landed_ids(spark, states)[-1]))
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return rows.select("symbol", at("last_us").alias("datetime"), F.col("prev_close").alias("close"), "kind",
                       at("s_us").alias("signal_datetime"), F.col("s_close").alias("signal_close"),
                       (F.col("kind") > 0).cast("bigint").alias("state"))
