"""STR2/STR3 on one batch in blocks: a symbol's candles are many tasks' work.

``signals.advance`` folds a symbol's candles of a batch in one group.  A
backlog of a hot symbol can be larger than a task should take;
``advance_blocked`` gives the same rows and the same state table by the batch
operators, with the state row as their entry:

* EWMA: the newest stored candle is row 0 and enters with its stored averages,
  the batch's candles follow; blocked scan and exact fold as in ``rsi_frame``.
* Look-backs: the other stored candles are the end of the block before block 0.
* Signals: a signal that is live enters as an opening at row 0.  The blocks'
  transfer maps are composed as in ``lifecycle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.functions.indicators import relative_strength, rsi_from_rs
from candlewick.functions.timefn import micros
from candlewick.operators.divergence import divergence_flags
from candlewick.operators.ewma import alpha_of, blocked_ewma, exact_fold, local_sums
from candlewick.operators.lifecycle import lifecycle
from candlewick.operators.rsi import frame_rows, with_gains
from candlewick.operators.sequence import BLK, DEFAULT_BLOCK_ROWS, OWN, T, blocks_with_halo, with_row_index
from candlewick.operators.topn import newest, newest_n
from candlewick.session import materialize, materialize_by
from candlewick.streaming.signals import OUT_SCHEMA, STATE_TABLE

_CANDLE = ["symbol", "datetime", "open", "high", "low", "close"]


def _sorted_out(candles: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new candles with ``_had``: their symbol has a state; late or corrected ones).

    What repeats a stored candle, or another of the batch, is in neither."""
    before = state.select("symbol", "last_us", F.arrays_zip("h_us", "h_close", "h_low", "h_high").alias("_held"))
    c = candles.select(*_CANDLE).withColumn("_us", micros("datetime")).join(before, "symbol", "left")
    stale = F.coalesce(F.col("_us") <= F.col("last_us"), F.lit(False))
    known = F.exists("_held", lambda h: (h["h_us"] == F.col("_us")) & (h["h_close"] == F.col("close"))
                     & (h["h_low"] == F.col("low")) & (h["h_high"] == F.col("high")))
    same_time = Window.partitionBy("symbol", "datetime")  # copies of one candle
    order = same_time.orderBy(F.xxhash64("close", "low", "high", "open"))
    values = F.struct("close", "low", "high")
    c = c.withColumn("_stale", stale).withColumn("_n", F.row_number().over(order)).withColumn(
        "_again", F.when(F.col("_stale"), known).otherwise(values == F.first(values).over(order)))
    c = materialize(c.withColumn("_had", F.col("last_us").isNotNull()))
    fresh = c.where(~F.col("_stale") & (F.col("_n") == 1)).select(*_CANDLE, "_had")
    late = c.where((F.col("_stale") | (F.col("_n") > 1)) & ~F.col("_again")).select(*_CANDLE)
    return fresh, late


def _history(state: DataFrame) -> DataFrame:
    """The stored candles as rows; the newest is row 0, the others are before it."""
    h = state.select("symbol", F.size("h_us").alias("_len"), F.posexplode(
        F.arrays_zip("h_us", "h_close", "h_rsi", "h_low", "h_high")).alias("_i", "h"))
    return h.select("symbol", (F.col("_i") - F.col("_len") + 1).cast("bigint").alias(T),
                    F.timestamp_micros("h.h_us").cast("timestamp_ntz").alias("datetime"),
                    F.col("h.h_close").alias("close"), F.nanvl("h.h_rsi", F.lit(None).cast("double")).alias("rsi"),
                    F.col("h.h_low").alias("low"), F.col("h.h_high").alias("high"))


def advance_blocked(candles: DataFrame, state: DataFrame, span_micros: int, com: float = S.COM,
                    lookback: int = S.DIVERGENCE_ROWS, block_rows: int = DEFAULT_BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(signal rows, state table): what ``signals.advance`` gives for one batch
    of closed candles.  ``span_micros`` is the candles' interval; it sizes the
    row-index spans."""
    r = frame_rows(com, block_rows, True)
    keys, order = ["symbol", BLK], ["symbol", BLK, T]
    fresh, late = _sorted_out(candles, state)
    met = materialize(state.join(fresh.select("symbol").distinct(), "symbol", "left_semi"))
    seq = with_row_index(fresh, span_micros * r).withColumn(T, F.col(T) + F.col("_had").cast("bigint")).drop("_had")
    history = _history(met)

    # averages: row 0 enters with the stored ones (a fold that starts there has them as its first value)
    entry = history.where(F.col(T) == 0).join(met.select("symbol", F.col("up_ewma").alias("_ue"), F.col("down_ewma").alias("_de")), "symbol")
    rows = seq.select(*_CANDLE, T, F.lit(None).cast("double").alias("_ue"), F.lit(None).cast("double").alias("_de"))
    rows = rows.unionByName(entry.drop("rsi").withColumn("open", F.lit(None).cast("double")))
    u = with_gains(blocks_with_halo(rows, r, 1).repartition(*keys), "symbol")
    u = u.withColumn("up", F.coalesce("_ue", "up")).withColumn("down", F.coalesce("_de", "down"))
    for x, name in (("_xu", "up"), ("_xd", "down")):  # the zero-seeded scan gives the first value the weight alpha
        u = u.withColumn(x, F.when(F.col(T) == 0, F.col(name) / F.lit(alpha_of(com))).otherwise(F.col(name)))
    u = u.select("*", *local_sums(["_xu", "_xd"], com, r)).where(F.col(OWN)).drop(OWN)
    u = materialize_by(u, keys, order)
    averages = ["up_ewma", "down_ewma"]
    e = exact_fold(blocked_ewma(u, ["_xu", "_xd"], averages, com, r), ["up", "down"], averages, com, r)
    e = materialize(e.where(F.col("_ue").isNull()).withColumn("rsi", rsi_from_rs(relative_strength(*averages)))
                    .select(*_CANDLE, T, *averages, "rsi"))

    # flags over the stored and the new candles
    look = ["symbol", T, "datetime", "close", "rsi", "low", "high"]
    frame = e.select(*look, F.lit(True).alias("_new")).unionByName(history.select(*look, F.lit(False).alias("_new")))
    frame = frame.withColumn(BLK, F.floor(F.col(T) / r)).repartition(*keys)
    frame = materialize_by(frame, keys, order)
    flags = divergence_flags(frame, r, lookback).where("_new").select("symbol", T, "datetime", "close", "bull", "bear")

    # signals: the live one opens at row 0
    live = F.coalesce(F.col("kind"), F.lit(0)) != 0
    opening = met.select(
        "symbol", F.lit(0).cast("bigint").alias(T),
        F.timestamp_micros(F.when(live, F.col("s_us")).otherwise(F.col("last_us"))).cast("timestamp_ntz").alias("datetime"),
        F.when(live, F.col("s_close")).otherwise(F.col("prev_close")).alias("close"),
        (live & (F.col("kind") == S.BULLISH)).alias("bull"), (live & (F.col("kind") == S.BEARISH)).alias("bear"),
        F.lit(True).alias("_entry"))
    told = materialize(flags.withColumn("_entry", F.lit(False)).unionByName(opening))
    life = lifecycle(told.drop("_entry"), block_rows=r).drop("datetime", "close")
    life = life.join(opening.select("symbol", T), ["symbol", T], "left_anti")
    done = materialize(e.join(life, ["symbol", T]))

    columns = [f.name for f in OUT_SCHEMA.fields]
    gone = late.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in OUT_SCHEMA.fields
                              if f.name not in _CANDLE and f.name != "late"], F.lit(True).alias("late"))
    out = done.withColumn("late", F.lit(False)).select(columns).unionByName(gone.select(columns))
    return out, _next_state(done, history, state, lookback)


def _next_state(done: DataFrame, history: DataFrame, state: DataFrame, lookback: int) -> DataFrame:
    kept = max(lookback - 1, 1)
    some = ["symbol", "datetime", "close", "rsi", "low", "high"]
    held = newest_n(done.select(some).unionByName(history.select(some)), kept, rank_col=None)
    row = F.struct(micros("datetime").alias("us"), "close", F.coalesce("rsi", F.lit(float("nan"))).alias("rsi"), "low", "high")
    held = held.groupBy("symbol").agg(F.array_sort(F.collect_list(row)).alias("h"))  # at most ``kept`` rows
    last, on = newest(done), F.col("live_after")
    now = last.join(held, "symbol").select(
        "symbol", micros("datetime").alias("last_us"), F.col("close").alias("prev_close"), "up_ewma", "down_ewma",
        F.col("h.rsi").alias("h_rsi"), F.col("h.low").alias("h_low"), F.col("h.high").alias("h_high"),
        F.when(on, F.col("kind")).otherwise(0).cast("int").alias("kind"),
        F.when(on, micros("signal_datetime")).alias("s_us"), F.when(on, F.col("signal_close")).alias("s_close"),
        F.col("h.us").alias("h_us"), F.col("h.close").alias("h_close"))
    columns = [f.name for f in STATE_TABLE.fields]
    return now.select(columns).unionByName(state.join(now.select("symbol"), "symbol", "left_anti").select(columns))
