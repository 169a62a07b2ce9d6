"""End-to-end pipelines (PIPE1 daily tick, PIPE2 backfill) and corrections.

The tables klines, klines_rsi, ticks (flags and signal of every tick) and state
(per symbol the last tick and the live signal) are one store (``sinks.store``):
each job is one commit, so a job that ends anywhere leaves the tables as they
were, and nobody sees RSI rows without their state.

PIPE2 ``backfill``: ticks -> candles -> klines table -> RSI history ->
klines_rsi table; ``replay_state`` adds the ticks and the state of every symbol.

PIPE1 ``daily_tick``: new candles with the RSI of the newest 200 candles each;
divergence over the newest 30 RSI rows; conversion check and expiry of the live
signal; the new state.  It reads the slices of the newest 200 rows, chosen by
the slice index, and writes the newest slices anew; the length of the history
plays no part.

``correct_candles``: changed or late candles of the past.  RSI rows are mended
in the slices that the change reaches, and the signals replayed from there.

``daily`` replays the whole history instead (e.g. to audit the stored state).
The streaming form of PIPE1 is ``streaming.jobs.run_streams``.
"""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schema as S
from candlewick.functions.indicators import gain, interval_micros, loss, pct_change, relative_strength, rsi_from_rs
from candlewick.functions.timefn import MICROS_PER_DAY, elapsed_days
from candlewick.operators.divergence import divergence_flags, signal_code
from candlewick.operators.ewma import fold_step
from candlewick.operators.lifecycle import converted, lifecycle
from candlewick.operators.resample import candles_from_ticks
from candlewick.operators.rsi import frame_rows, rsi_frame
from candlewick.operators.sequence import DEFAULT_BLOCK_ROWS
from candlewick.operators.topn import newest, newest_n
from candlewick.plans.corrections import mended_rsi, reached, replayed_ticks
from candlewick.session import drop_scratch, materialize, materialize_by
from candlewick.sinks.store import Commit, Snapshot, Store, slice_of
from candlewick.sinks.tables import read_table

TICK_COLUMNS = ["datetime", "symbol", "close", "rsi", "bull", "bear", "kind", "signal_datetime", "signal_close", "pct",
                "converted", "age_days", "live_after"]


def _slice(interval: str) -> str:
    """Slices of at most some 1,500 rows, down to minute candles."""
    step = interval_micros(interval)
    return "year" if step >= MICROS_PER_DAY else "month" if step >= MICROS_PER_DAY // 24 else "day"


def backfill(spark: SparkSession, ticks: DataFrame, out_dir: str, interval: str = "1 day",
             block_rows: int = DEFAULT_BLOCK_ROWS) -> dict[str, str]:
    """PIPE2: writes ``klines`` and ``klines_rsi``."""
    return backfill_candles(spark, candles_from_ticks(ticks, interval), out_dir, interval, block_rows)


def backfill_candles(spark: SparkSession, candles: DataFrame, out_dir: str, interval: str = "1 day",
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> dict[str, str]:
    """The folders of the two tables' files; ``read_table`` of ``<out_dir>/<table>`` reads the newest version."""
    store = Store(spark, out_dir)
    new = store.begin(None, _slice(interval))
    new.write("klines", candles)
    r = rsi_frame(new.read("klines"), interval, block_rows=block_rows, exact=True)
    new.write("klines_rsi", r.select(*S.RSI_COLUMNS))
    new.commit()
    return {t: new.folder(t) for t in ("klines", "klines_rsi")}


def replay_state(spark: SparkSession, out_dir: str, interval: str = "1 day",
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> None:
    """The ticks and the state of the backfilled history, from which ticks go on."""
    store = Store(spark, out_dir)
    snap = store.snapshot()
    new = store.begin(snap)
    ticks = materialize(signal_states(store.read(snap, "klines"), interval, block_rows).select(*TICK_COLUMNS))
    new.write("ticks", ticks)
    new.write_whole("state", _state_of(newest(ticks)))
    new.commit()


def _state_of(ticks: DataFrame) -> DataFrame:
    """State rows of the newest ticks: ``state`` 1 and the signal while one is
    live, and the last tick's time."""
    live = F.col("live_after")
    return ticks.select("symbol", live.cast("bigint").alias("state"), F.when(live, F.col("kind")).alias("kind"),
                        F.when(live, F.col("signal_datetime")).alias("signal_datetime"),
                        F.when(live, F.col("signal_close")).alias("signal_close"), "datetime")


def tail_rsi(candles: DataFrame, tail: int = S.TAIL_ROWS, com: float = S.COM) -> DataFrame:
    """CMP2 as the tick runs it: the newest ``tail`` candles of each symbol ->
    the RSI row of the newest one.  A group has ``tail`` rows at most."""
    cols = ["datetime", "open", "high", "low", "close"]
    rows = (newest_n(candles, tail, rank_col=None).groupBy("symbol")
            .agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("w")))
    steps = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.get("w", i)["close"] - F.get("w", i - 1)["close"])
    steps = F.when(F.size("w") > 1, steps).otherwise(F.array().cast("array<double>"))
    fold = lambda part: F.aggregate(F.transform("_d", part), F.lit(0.0), fold_step(com))
    out = rows.withColumn("_d", steps).select(
        "symbol", F.element_at("w", -1).alias("c"), fold(gain).alias("up_ewma"), fold(loss).alias("down_ewma"))
    return (out.select("c.*", "symbol", "up_ewma", "down_ewma")
            .withColumn("rsi", rsi_from_rs(relative_strength("up_ewma", "down_ewma"))).select(*S.RSI_COLUMNS))


def newest_flags(rsi_rows: DataFrame, lookback: int = S.DIVERGENCE_ROWS) -> DataFrame:
    """CMP4/CMP5 for the newest row of each symbol over its newest ``lookback`` rows."""
    cols = ["datetime", "close", "rsi", "low", "high"]
    rows = (newest_n(rsi_rows, lookback, rank_col=None).groupBy("symbol")
            .agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("w")).withColumn("n", F.element_at("w", -1)))
    n = F.col("n")
    some = lambda test: F.coalesce(F.exists("w", test), F.lit(False))
    return rows.select("symbol", "n.*", some(
        lambda q: (q["rsi"] <= S.OVERSOLD) & (q["rsi"] <= n["rsi"]) & (q["low"] > n["low"])).alias("bull"), some(
        lambda q: (q["rsi"] >= S.OVERBOUGHT) & (q["rsi"] >= n["rsi"]) & (q["high"] < n["high"])).alias("bear"))


def _arrived(store: Store, snap: Snapshot, candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that are not stored as they are, with ``_stored`` telling whether
    another version is; the rows of the slices they fall into)."""
    told = lambda c: F.concat(F.lit(f"a candle has no {c}: "), F.to_json(F.struct("symbol", "datetime")))
    there = lambda c, kind: F.coalesce(F.col(c).cast(kind), F.raise_error(told(c)).cast(kind)).alias(c)
    kinds = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(snap.schemas["klines"])).fields}
    values = {c: k for c, k in kinds.items() if c not in ("symbol", "datetime")}
    given = [c for c in values if c in candles.columns]
    new = materialize(candles.select(
        there("symbol", kinds["symbol"]), there("datetime", kinds["datetime"]),
        *[(F.col(c) if c in given else F.lit(None)).cast(k).alias(c) for c, k in values.items()]).distinct())
    twice = new.groupBy("symbol", "datetime").count().where("count > 1").first()
    if twice:
        raise ValueError(f"{twice.symbol} {twice.datetime}: two versions of a candle arrive together")
    stored = materialize(store.read(snap, "klines", store.slices_of(new, snap)))
    old = stored.select("symbol", "datetime", F.struct(*given).alias("_old"))
    same = F.coalesce(F.col("_old").eqNullSafe(F.struct(*given)), F.lit(False))
    return (materialize(new.join(old, ["symbol", "datetime"], "left").where(~same)
                        .withColumn("_stored", F.col("_old").isNotNull()).drop("_old")), stored)


def daily_tick(spark: SparkSession, out_dir: str, new_candles: DataFrame, interval: str = "1 day") -> DataFrame:
    """PIPE1: new closed candles, as a rule one per symbol, against the tables of
    ``backfill`` and ``replay_state``.  Commits the candles, their RSI rows and
    ticks and the new state together, and returns the tick rows.

    A candle that is stored as it is is skipped, so a repeat finds nothing; one
    that is stored with other values, or that is older than the symbol's last
    tick, is an error (``correct_candles`` takes such).  So is a candle without
    symbol or time, and one that arrives in two versions.  A symbol's candles
    are taken one after the other, a round each."""
    ticks, commit = stage_tick(spark, out_dir, new_candles, interval)
    if commit:
        commit.commit()
    return ticks


def stage_tick(spark: SparkSession, out_dir: str, new_candles: DataFrame,
               interval: str = "1 day") -> tuple[DataFrame, Commit | None]:
    """The tick rows, and what ``daily_tick`` commits (None if nothing is new)."""
    store = Store(spark, out_dir)
    snap = store.snapshot()
    if snap is None or "state" not in snap.schemas:
        raise ValueError(f"{out_dir} has no state: run backfill and replay_state")
    state = materialize(store.read(snap, "state"))
    new, stored = _arrived(store, snap, new_candles)
    late = new.join(state.select("symbol", F.col("datetime").alias("_last")), "symbol", "left").where(
        F.col("_stored") | (F.col("datetime") <= F.col("_last"))).first()
    if late:
        told = "stored with other values" if late["_stored"] else f"older than the last tick, {late['_last']}"
        raise ValueError(f"{late.symbol} {late.datetime}: the candle is {told} (correct_candles takes it)")
    pending = materialize(new.drop("_stored").withColumn("_round", F.row_number().over(
        Window.partitionBy("symbol").orderBy("datetime"))))
    rounds = pending.agg(F.max("_round")).first()[0] or 0

    def tail(table: str, n: int) -> DataFrame:
        """The newest ``n`` stored rows of the symbols."""
        rows = store.read(snap, table, store.newest_slices(snap, table, pending, n))
        return materialize(newest_n(rows.join(pending.select("symbol").distinct(), "symbol", "left_semi"), n, rank_col=None))

    klines, rsi_rows = tail("klines", S.TAIL_ROWS), tail("klines_rsi", S.DIVERGENCE_ROWS)
    now, rsis, ticks = state, [], []
    for i in range(1, rounds + 1):
        at = pending.where(F.col("_round") == i).drop("_round")
        klines = klines.unionByName(at)
        one = materialize(tail_rsi(klines.join(at.select("symbol"), "symbol", "left_semi")))
        rsi_rows = rsi_rows.unionByName(one)
        step = materialize(_tick(newest_flags(rsi_rows.join(at.select("symbol"), "symbol", "left_semi")), now))
        now = now.join(step.select("symbol"), "symbol", "left_anti").unionByName(_state_of(step))
        now = materialize(now) if i < rounds else now
        rsis.append(one)
        ticks.append(step)
    if not rounds:
        return spark.createDataFrame([], _tick(newest_flags(rsi_rows), now).schema), None
    commit, out = store.begin(snap), reduce(DataFrame.unionByName, ticks)
    touched = materialize(store.slices_of(pending, snap))
    commit.write("klines", stored.unionByName(pending.drop("_round")))
    commit.write("klines_rsi", store.read(snap, "klines_rsi", touched).unionByName(reduce(DataFrame.unionByName, rsis)))
    commit.write("ticks", store.read(snap, "ticks", touched).unionByName(out.select(*TICK_COLUMNS)))
    commit.write_whole("state", now)
    return out, commit


def _tick(flags: DataFrame, state: DataFrame) -> DataFrame:
    """One step of the signal state for the newest row of each symbol in ``flags``."""
    before = state.select(
        "symbol", F.col("kind").alias("k0"), F.col("signal_datetime").alias("t0"), F.col("signal_close").alias("c0"),
        (F.col("state") != 0).alias("live"))
    j = flags.join(before, "symbol", "left").withColumn("live", F.coalesce("live", F.lit(False)))
    opens = ~F.col("live") & (F.col("bull") | F.col("bear"))
    j = (j.withColumn("kind", F.when(F.col("live"), F.col("k0")).when(opens, signal_code()).otherwise(0).cast("int"))
         .withColumn("signal_datetime", F.when(F.col("live"), F.col("t0")).when(opens, F.col("datetime")))
         .withColumn("signal_close", F.when(F.col("live"), F.col("c0")).when(opens, F.col("close"))))
    on = F.col("kind") > 0
    j = (j.withColumn("pct", F.when(on, pct_change("close", "signal_close")))
         .withColumn("age_days", F.when(on, elapsed_days("datetime", "signal_datetime"))))
    return (j.withColumn("converted", F.when(on, converted(F.col("pct"), F.col("kind"))))
            .withColumn("live_after", on & (F.coalesce("age_days", F.lit(0)) < S.EXPIRY_DAYS))
            .drop("k0", "t0", "c0", "live"))


def correct_candles(spark: SparkSession, out_dir: str, candles: DataFrame, interval: str = "1 day",
                    block_rows: int = DEFAULT_BLOCK_ROWS) -> int:
    """Changed or late candles up to a symbol's last tick.  Commits the mended
    klines, RSI rows, ticks and state; they equal those of a backfill of the
    corrected candles.  Returns how many candles differed from the stored ones.

    A changed close moves the EWMA by an amount that decays with every row, so
    RSI rows are folded anew in the slices that lie within the warm-up length
    after a change (``corrections.reached``), each slice on its own.  Signals
    depend on those before: they are replayed from the first slice reached to
    the end, of the symbols concerned alone."""
    store = Store(spark, out_dir)
    snap = store.snapshot()
    if snap is None or "state" not in snap.schemas:
        raise ValueError(f"{out_dir} has no state: run backfill and replay_state")
    changed, stored = _arrived(store, snap, candles)
    state = materialize(store.read(snap, "state"))
    ahead = changed.join(state.select("symbol", F.col("datetime").alias("_last")), "symbol", "left").where(
        "_last IS NULL OR datetime > _last").first()
    if ahead:
        raise ValueError(f"{ahead.symbol} {ahead.datetime}: the candle is newer than the last tick (daily_tick takes it)")
    n = changed.count()
    if not n:
        return 0
    changed = changed.drop("_stored")
    touched = materialize(store.slices_of(changed, snap))
    klines = stored.withColumn("slice", slice_of("datetime", snap.by)).join(touched, ["symbol", "slice"], "left_semi").drop("slice")
    klines = materialize(klines.join(changed.select("symbol", "datetime"), ["symbol", "datetime"], "left_anti")
                         .unionByName(changed))
    commit = store.begin(snap)
    commit.write("klines", klines)
    plan = reached(store, snap, klines, touched)
    rsi_rows = materialize(mended_rsi(store, snap, klines, touched, plan))
    commit.write("klines_rsi", rsi_rows)
    ticks = materialize(replayed_ticks(store, snap, rsi_rows, plan, interval, block_rows).select(*TICK_COLUMNS))
    commit.write("ticks", ticks)
    now = _state_of(newest(ticks))
    commit.write_whole("state", state.join(now.select("symbol"), "symbol", "left_anti").unionByName(now))
    commit.commit()
    return n


def signal_states(candles: DataFrame, interval: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Every tick's RSI, divergence flags and lifecycle state."""
    keys, order = ["symbol", "_blk"], ["symbol", "_blk", "_t"]
    rows = frame_rows(S.COM, block_rows, True)
    r = materialize_by(rsi_frame(candles, interval, block_rows=block_rows, exact=True), keys, order)
    f = materialize_by(divergence_flags(r, rows), keys, order)
    return lifecycle(f, block_rows=rows, block_col="_blk")


def daily(candles: DataFrame, interval: str = "1 day", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Per symbol, the newest tick with its RSI, flags and signal state, by a
    replay of the whole history."""
    s = newest(signal_states(candles, interval, block_rows))
    return s.withColumn("state", F.col("live_after").cast("bigint"))


def _main(argv=None) -> None:
    """Command line for spark-submit (or ``python -m candlewick.plans.jobs``).

    backfill: ticks parquet -> <out>/klines, klines_rsi, state   (PIPE2)
    tick:     candles parquet (new closed candles) -> <out>, as PIPE1
    correct:  candles parquet (changed or late candles) -> <out>
    vacuum:   removes the files of <out> that no recent version names
    daily:    klines parquet -> <out>/daily (newest tick per symbol, by replay)
    stream:   events parquet folder -> landed candles and signal tables (STR1-STR4)
    """
    import argparse

    from candlewick.session import get_spark
    from candlewick.sources.ticks import ticks_from

    p = argparse.ArgumentParser(prog="candlewick.plans.jobs")
    p.add_argument("command", choices=["backfill", "tick", "correct", "vacuum", "daily", "stream"])
    p.add_argument("--input", help="all but vacuum")
    p.add_argument("--out", required=True)
    p.add_argument("--interval", default="1 day")
    p.add_argument("--block-rows", type=int, default=DEFAULT_BLOCK_ROWS)
    p.add_argument("--symbol-col", default="event_type")
    p.add_argument("--ts-col", default="ts")
    p.add_argument("--seq-col", default="event_id")
    p.add_argument("--price-col", default="value")
    p.add_argument("--qty-col", default=None)
    p.add_argument("--delay", help="stream: how far ticks may lag behind the newest one, e.g. '1 hour'")
    p.add_argument("--max-files", type=int, default=64, help="stream: tick files of one batch")
    a = p.parse_args(argv)
    if a.command != "vacuum" and not a.input:
        p.error(f"{a.command} needs --input")
    spark = get_spark()
    if a.command == "backfill":
        ticks = ticks_from(spark.read.parquet(a.input), a.symbol_col, a.ts_col, a.seq_col, a.price_col, a.qty_col)
        print(backfill(spark, ticks, a.out, a.interval, a.block_rows))
        replay_state(spark, a.out, a.interval, a.block_rows)
        drop_scratch(spark)
    elif a.command == "tick":
        daily_tick(spark, a.out, spark.read.parquet(a.input), a.interval).show(100, truncate=False)
    elif a.command == "correct":
        print(correct_candles(spark, a.out, spark.read.parquet(a.input), a.interval, a.block_rows))
        drop_scratch(spark)
    elif a.command == "vacuum":
        print(Store(spark, a.out).vacuum())
    elif a.command == "daily":
        state = daily(read_table(spark, a.input), a.interval, a.block_rows)
        state.write.mode("overwrite").parquet(os.path.join(a.out, "daily"))
        drop_scratch(spark)
    else:
        from candlewick.streaming.jobs import run_candle_stream
        if not a.delay:
            p.error("stream needs --delay: how far ticks may lag behind the newest one")
        print(run_candle_stream(spark, a.input, a.interval, a.delay, a.out, a.max_files, signals=True))


if __name__ == "__main__":
    _main()
