"""How far a corrected candle reaches, and the rows mended there.

A store's slices are the unit.  ``reached`` plans, from the slice index alone,
which RSI slices a change reaches: its own, and those that begin within
``REACH`` rows after it (the EWMA's warm-up length, after which a state error
of any size has decayed below the last bit, plus the look-back of the flags).

``mended_rsi`` folds each reached slice on its own: it starts ``warmup_rows``
before the slice from the stored average there.  That average may itself be
stale, but its error has decayed when the slice begins, so slices don't wait
for each other and a symbol of any length is many bounded groups.

``replayed_ticks`` replays the signals of the symbols concerned from their
first reached slice on.  The signal that is live there is in the stored tick
before the slice.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.functions.indicators import gain, interval_micros, loss, relative_strength, rsi_from_rs
from candlewick.operators.divergence import divergence_flags
from candlewick.operators.ewma import alpha_of, warmup_rows
from candlewick.operators.lifecycle import lifecycle
from candlewick.operators.rsi import frame_rows
from candlewick.operators.sequence import BLK, T, with_row_index
from candlewick.session import materialize, materialize_by
from candlewick.sinks.store import Snapshot, Store, slice_of

WARM = warmup_rows(S.COM)
BACK = WARM + 1              # rows before a slice that its fold reads: the warm-up and the row before it
REACH = WARM + S.DIVERGENCE_ROWS


def reached(store: Store, snap: Snapshot, klines: DataFrame, touched: DataFrame) -> DataFrame:
    """(symbol, slice, rows, hi, touched, first, last, target, sources): the
    slices of the concerned symbols with the positions of their first and last
    row once the ``klines`` of the ``touched`` slices are in place; whether a
    slice is to be mended, and the slices that its fold reads."""
    new = klines.withColumn("slice", slice_of("datetime", snap.by)).groupBy("symbol", "slice").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("datetime").cast("timestamp")).alias("hi"))
    kept = store.entries(snap, "klines").join(touched.select("symbol").distinct(), "symbol", "left_semi").join(
        touched, ["symbol", "slice"], "left_anti").select("symbol", "slice", "rows", "hi")
    index = kept.withColumn("touched", F.lit(False)).unionByName(new.withColumn("touched", F.lit(True)))
    order = Window.partitionBy("symbol").orderBy("slice")   # one row per slice
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    index = index.withColumn("last", F.sum("rows").over(upto) - 1).withColumn("first", F.col("last") - F.col("rows") + 1)
    changed = F.last(F.when(F.col("touched"), F.col("last")), ignorenulls=True).over(upto)
    index = index.withColumn("target", F.coalesce(F.col("first") - changed <= REACH, F.lit(False)))
    # the slices of the BACK rows before, by position: a frame over the rows, not over the slices
    near = Window.partitionBy("symbol").orderBy("first").rangeBetween(-(BACK + _most_rows(index)), 0)
    some = F.filter(F.collect_list(F.struct("slice", "last")).over(near), lambda x: x["last"] >= F.col("first") - BACK)
    return materialize(index.withColumn("sources", F.when(F.col("target"), F.transform(some, lambda x: x["slice"]))))


def _most_rows(index: DataFrame) -> int:
    return int(index.agg(F.max("rows")).first()[0] or 0)


def _rows_of(store: Store, snap: Snapshot, table: str, wanted: DataFrame, new: DataFrame | None = None,
             replaced: DataFrame | None = None) -> DataFrame:
    """Rows of the ``wanted`` slices, those ``replaced`` taken from ``new``; with their slice."""
    old = wanted if replaced is None else wanted.join(replaced, ["symbol", "slice"], "left_anti")
    rows = store.read(snap, table, old).withColumn("slice", slice_of("datetime", snap.by))
    if new is None:
        return rows
    mine = new.withColumn("slice", slice_of("datetime", snap.by)).join(
        wanted.join(replaced, ["symbol", "slice"], "left_semi"), ["symbol", "slice"], "left_semi")
    return rows.unionByName(mine)


def mended_rsi(store: Store, snap: Snapshot, klines: DataFrame, touched: DataFrame, plan: DataFrame) -> DataFrame:
    """The RSI rows of the target slices, folded anew."""
    pairs = materialize(plan.where("target").select("symbol", F.col("slice").alias("_to"), F.col("first").alias("_first"),
                                                    F.explode("sources").alias("slice")))
    wanted = pairs.select("symbol", "slice").distinct()
    candles = _rows_of(store, snap, "klines", wanted, klines, touched)
    stored = _rows_of(store, snap, "klines_rsi", wanted).select("symbol", "datetime", "up_ewma", "down_ewma")
    rows = candles.join(stored, ["symbol", "datetime"], "left").select(
        "symbol", "datetime", "open", "high", "low", "close", "up_ewma", "down_ewma", "slice")
    a = alpha_of(S.COM)
    keep = 1.0 - a

    def step(acc: float, x: float) -> float:
        return keep * acc + a * x

    def fold(g):
        g = g.sort_values("datetime", kind="stable").reset_index(drop=True)
        own = int((g["slice"] == g["_to"]).to_numpy().argmax())
        oldest = int(g["_first"].iloc[0]) == own   # the symbol's first row is here: the fold starts with it
        start = 0 if oldest else max(0, own - WARM)
        while not oldest and start > 0 and g["up_ewma"].isna().iloc[start]:   # an inserted row has no stored average
            start -= 1
        for x, e in (("_up", "up_ewma"), ("_down", "down_ewma")):
            xs = g[x].tolist()
            seed = xs[0] if oldest else float(g[e].iloc[start])
            g.loc[start:, e] = list(accumulate(xs[start + 1:], step, initial=seed))
        return g.loc[own:, columns]

    columns = ["symbol", "datetime", "open", "high", "low", "close", "up_ewma", "down_ewma"]
    kinds = dict(rows.dtypes)
    w = Window.partitionBy("symbol", "_to").orderBy("datetime")   # a bounded group: a slice and its warm-up
    delta = F.col("close") - F.lag("close").over(w)
    grouped = rows.join(pairs, ["symbol", "slice"]).withColumn("_up", gain(delta)).withColumn("_down", loss(delta))
    folded = grouped.groupBy("symbol", "_to").applyInPandas(fold, ", ".join(f"`{c}` {kinds[c]}" for c in columns))
    return (folded.withColumn("rsi", rsi_from_rs(relative_strength("up_ewma", "down_ewma"))).select(*S.RSI_COLUMNS))


def replayed_ticks(store: Store, snap: Snapshot, rsi_rows: DataFrame, plan: DataFrame, interval: str,
                   block_rows: int) -> DataFrame:
    """Flags and signals from the first target slice of each symbol on."""
    start = plan.where("target").groupBy("symbol").agg(F.min("slice").alias("_from"), F.min("first").alias("_first"))
    # slices before it: its look-back, and the two days that a live signal can be old
    begin = plan.join(start, "symbol")
    two_days = F.expr(f"INTERVAL {S.EXPIRY_DAYS + 1} DAYS")
    begins = materialize(rsi_rows.groupBy("symbol").agg(F.min("datetime").alias("_begin")).join(start, "symbol"))
    wanted = materialize(begin.join(begins.select("symbol", "_begin"), "symbol").where(
        (F.col("slice") >= F.col("_from")) | (F.col("last") >= F.col("_first") - S.DIVERGENCE_ROWS)
        | (F.col("hi") >= F.col("_begin").cast("timestamp") - two_days)).select("symbol", "slice").distinct())
    targets = plan.where("target").select("symbol", "slice")
    rows = _rows_of(store, snap, "klines_rsi", wanted, rsi_rows, targets)
    r = frame_rows(S.COM, block_rows, True)
    seq = with_row_index(rows, interval_micros(interval) * r).withColumn(BLK, F.floor(F.col(T) / r))
    keys, order = ["symbol", BLK], ["symbol", BLK, T]
    seq = materialize_by(seq.repartition(*keys), keys, order)
    flags = divergence_flags(seq, r)
    # of the rows before, only the opening of the signal that is still live counts
    old = _rows_of(store, snap, "ticks", wanted.join(targets, ["symbol", "slice"], "left_anti")).join(
        begins.select("symbol", "_from", "_begin"), "symbol").where(F.col("slice") < F.col("_from"))
    last = old.groupBy("symbol").agg(F.max_by(F.struct("live_after", "kind", "signal_datetime"), "datetime").alias("_e"))
    flags = flags.join(begins.select("symbol", "_from"), "symbol").join(last, "symbol", "left")
    before = F.col("slice") < F.col("_from")
    opening = F.coalesce(F.col("_e")["live_after"] & (F.col("_e")["signal_datetime"] == F.col("datetime")), F.lit(False))
    for name, kind in (("bull", S.BULLISH), ("bear", S.BEARISH)):
        flags = flags.withColumn(name, F.when(before, opening & (F.col("_e")["kind"] == kind)).otherwise(F.col(name)))
    flags = materialize_by(flags.drop("_e"), keys, order)
    ticks = lifecycle(flags, block_rows=r, block_col=BLK)
    return ticks.join(begins.select("symbol", "_from"), "symbol").where(
        slice_of("datetime", snap.by) >= F.col("_from")).drop("_from")
