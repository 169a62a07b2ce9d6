"""Signal lifecycle (LIFE1, FLT4, FLT5, CMP7).

Per tick, in order: when no signal is live, detection runs and a flagged
tick opens a signal (bearish wins a tie); when a signal is live (including
one opened on this tick) the conversion check runs:
``pct = pc(now_close, signal_close)``, converted when ``pct >= 4.3`` for a
bullish and ``pct <= -4.3`` for a bearish signal; then the signal expires
once ``floor(elapsed days) >= 2``.  Conversion does not close the signal.

The replay is an ordered fold per symbol.  It runs over blocks of ``R``
consecutive ticks (``_lb = _t div R``).  ``M``, measured on the data, bounds
the ticks of a symbol in any two days; with ``R > M`` a block spans more than
two days, so a signal live at a block's start opened in the previous block's
last two days (the halo, chosen by time), however dense the ticks are.  Three
passes; loops run over flagged ticks and signals only:

1. per block (bounded): the block's transfer map -- for the idle entry and
   for every halo flag that could still be live, the state at the block's
   end.  A backward pass gives, for every tick, the end state when idle
   there; a signal opened at ``g`` jumps to the tick after its expiry.
2. compose the maps in block order -> the true entry state of every block,
   by log2(blocks) rounds of distributed doubling over the small map table
   (one row per block and entry); no task holds a whole symbol.
3. per block (bounded): replay the ticks from that entry state.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from candlewick import schema as S
from candlewick.functions.indicators import pct_change
from candlewick.functions.timefn import MICROS_PER_DAY, elapsed_days, micros
from candlewick.operators.sequence import T
from candlewick.operators.topn import newest

LB = "_lb"
IDLE = -1
_EXPIRY_US = S.EXPIRY_DAYS * MICROS_PER_DAY


def converted(pct: Column, kind: Column, threshold: float = S.CONVERT_PCT,
              direction: str = "literal") -> Column:
    """FLT5.  ``direction='literal'`` keeps the original sign convention
    (pct = (signal - now) / now); ``'intended'`` flips it so a bullish signal
    converts when the price rises."""
    p = pct if direction == "literal" else -pct
    return (((p >= F.lit(threshold)) & (kind == F.lit(S.BULLISH)))
            | ((p <= F.lit(-threshold)) & (kind == F.lit(S.BEARISH))))


def _block_arrays(pdf: pd.DataFrame):
    pdf = pdf.sort_values(T, kind="stable")
    ts = pdf[T].to_numpy(dtype=np.int64)
    us = pdf["_us"].to_numpy(dtype=np.int64)
    kind = np.where(pdf["bear"].to_numpy(dtype=bool), S.BEARISH,
                    np.where(pdf["bull"].to_numpy(dtype=bool), S.BULLISH, 0))
    return pdf, ts, us, kind


def _end_states(ts, us, kind):
    """(flagged, state): positions of the flagged ticks, and for each the state
    at block end when it opens a signal; one more entry, idle, after the last."""
    n = len(ts)
    flagged = np.flatnonzero(kind)
    # the first tick two days after each opening closes it; detection resumes after that tick
    expiry = np.searchsorted(us, us[flagged] + _EXPIRY_US, side="left")
    resume = np.searchsorted(flagged, expiry + 1, side="left")
    state = np.full(len(flagged) + 1, IDLE, dtype=np.int64)
    for i in range(len(flagged) - 1, -1, -1):
        state[i] = ts[flagged[i]] if expiry[i] >= n else state[resume[i]]
    return flagged, state


def _transfer_map(own: pd.DataFrame, halo: pd.DataFrame) -> pd.DataFrame:
    if own.empty:  # halo sent past a symbol's last block
        return pd.DataFrame({"symbol": pd.Series([], dtype=object), LB: pd.Series([], dtype="int64"),
                             "entry": pd.Series([], dtype="int64"), "exit": pd.Series([], dtype="int64")})
    own, ts, us, kind = _block_arrays(own)
    key = own.iloc[0]
    flagged, state = _end_states(ts, us, kind)
    entries, exits = [np.array([IDLE])], [state[:1]]
    if len(halo):
        halo, hts, hus, hkind = _block_arrays(halo)
        # live when this block begins: not two days old at the previous block's last tick
        live = (hkind > 0) & (hus + _EXPIRY_US > hus[-1])
        expiry = np.searchsorted(us, hus[live] + _EXPIRY_US, side="left")
        entries.append(hts[live])
        exits.append(np.where(expiry >= len(ts), hts[live], state[np.searchsorted(flagged, expiry + 1, side="left")]))
    return pd.DataFrame({"symbol": key["symbol"], LB: key[LB], "entry": np.concatenate(entries),
                         "exit": np.concatenate(exits)})


def compose_entries(maps: DataFrame) -> DataFrame:
    """Entry state of every block from the per-block transfer maps.

    Hillis-Steele doubling over the map table, all rounds distributed: after
    round k, the row (b, e -> x) maps the state entering block
    ``b - 2^k + 1`` (clamped at 0) to the state leaving block ``b``.  One
    round joins the table with itself shifted by ``2^k`` blocks on the
    intermediate state; rows per round stay at one per (block, entry).  The
    number of rounds is log2 of the longest symbol's block count; each round
    is checkpointed so the lineage stays flat.
    """
    from candlewick.session import materialize
    longest = maps.agg(F.max(LB)).first()[0]
    a = maps.select("symbol", F.col(LB).alias("_b"), "entry", "exit")
    if longest:
        a = materialize(a)
    step = 1
    while longest is not None and step <= longest:
        earlier = a.select("symbol", (F.col("_b") + step).alias("_b"), "entry", F.col("exit").alias("_mid"))
        later = a.select("symbol", "_b", F.col("entry").alias("_mid"), "exit")
        composed = earlier.join(later, ["symbol", "_b", "_mid"]).select("symbol", "_b", "entry", "exit")
        a = materialize(a.where(F.col("_b") < step).unionByName(composed))
        step *= 2
    first = (maps.where(F.col(LB) == 0).select("symbol").distinct()
                 .select("symbol", F.lit(0).cast("long").alias(LB), F.lit(IDLE).cast("long").alias("entry")))
    after = a.where(F.col("entry") == IDLE).select("symbol", (F.col("_b") + 1).alias(LB),
                                                   F.col("exit").alias("entry"))
    return first.unionByName(after)


def _replay(own: pd.DataFrame, entry: pd.DataFrame, carried: list[str]) -> pd.DataFrame:
    if own.empty:
        return _empty_out(carried)
    own, ts, us, kind = _block_arrays(own)
    closes = own["close"].to_numpy(dtype=float)
    n = len(ts)
    out_kind = np.zeros(n, dtype=np.int32)
    s_us_out = np.full(n, np.iinfo(np.int64).min, dtype=np.int64)
    s_close_out = np.full(n, np.nan)
    live_after = np.zeros(n, dtype=bool)
    flagged = np.flatnonzero(kind)

    def mark(first: int, k: int, opened: int, close: float) -> int:
        """One signal from its first tick here to its expiry; where detection resumes."""
        last = int(np.searchsorted(us, opened + _EXPIRY_US, side="left"))
        out_kind[first:last + 1], s_us_out[first:last + 1], s_close_out[first:last + 1] = k, opened, close
        live_after[first:last] = True
        return last + 1

    at = 0
    if len(entry):
        e = entry.iloc[0]
        at = mark(0, int(e["s_kind"]), int(e["s_us"]), float(e["s_close"]))
    while (j := int(np.searchsorted(flagged, at, side="left"))) < len(flagged):
        i = int(flagged[j])
        at = mark(i, int(kind[i]), int(us[i]), closes[i])
    sig = pd.to_datetime(np.where(out_kind > 0, s_us_out, 0), unit="us")
    return pd.DataFrame({
        "datetime": own["datetime"].to_numpy(), "symbol": own["symbol"].to_numpy(),
        "close": closes, "bull": own["bull"].to_numpy(dtype=bool), "bear": own["bear"].to_numpy(dtype=bool),
        T: ts, "kind": out_kind,
        "signal_datetime": sig.where(out_kind > 0), "signal_close": np.where(out_kind > 0, s_close_out, np.nan),
        "live_after": live_after, **{c: own[c].to_numpy(dtype=float) for c in carried}})


def _empty_out(carried: list[str]) -> pd.DataFrame:
    dtypes = {"datetime": "datetime64[us]", "symbol": object, "close": "float64", "bull": bool,
              "bear": bool, T: "int64", "kind": "int32", "signal_datetime": "datetime64[us]",
              "signal_close": "float64", "live_after": bool, **dict.fromkeys(carried, "float64")}
    return pd.DataFrame({c: pd.Series([], dtype=d) for c, d in dtypes.items()})


_MAP_SCHEMA = "symbol string, _lb long, entry long, exit long"
_OUT_SCHEMA = T_.StructType([
    T_.StructField("datetime", T_.TimestampNTZType()), T_.StructField("symbol", T_.StringType()),
    T_.StructField("close", T_.DoubleType()), T_.StructField("bull", T_.BooleanType()),
    T_.StructField("bear", T_.BooleanType()), T_.StructField(T, T_.LongType()),
    T_.StructField("kind", T_.IntegerType()), T_.StructField("signal_datetime", T_.TimestampNTZType()),
    T_.StructField("signal_close", T_.DoubleType()), T_.StructField("live_after", T_.BooleanType())])


def two_day_ticks(flags: DataFrame, key: str = "symbol") -> int:
    """A bound, from the data, of a symbol's ticks in any two days: the most
    in two neighbouring two-day slices."""
    slices = (flags.groupBy(key, F.floor(micros("datetime") / F.lit(_EXPIRY_US)).alias("_slice"))
              .agg(F.count(F.lit(1)).alias("_n")))
    # a slice counts for itself and for the pair with the slice before it
    pairs = slices.select(key, F.explode(F.array(F.col("_slice"), F.col("_slice") + 1)).alias("_slice"), "_n")
    most = pairs.groupBy(key, "_slice").agg(F.sum("_n").alias("_n")).agg(F.max("_n")).first()[0]
    return int(most or 0)


def lifecycle(flags: DataFrame, key: str = "symbol", block_rows: int = 2048, direction: str = "literal",
              block_col: str | None = None) -> DataFrame:
    """LIFE1 over a flag frame (datetime, symbol, close, bull, bear, _t).

    Ticks are unique per (symbol, datetime) and may be any time apart.
    ``flags`` is read more than once and should be materialised.  Output per
    tick: datetime, symbol, close, bull, bear, kind (0 = no live signal),
    signal_datetime, signal_close, pct, converted, age_days, live_after, and
    ``rsi`` if the flags have it.

    ``block_rows`` is enlarged where two days hold more ticks.  ``block_col``
    names an existing ``_t div block_rows`` column of ``flags``; it is used,
    and data already partitioned by it is not shuffled again, unless the
    blocks have to be larger.
    """
    if key != "symbol":
        flags = flags.withColumnRenamed(key, "symbol")
    rows_r = max(block_rows, two_day_ticks(flags) + 1)
    blk = F.col(block_col) if block_col and rows_r == block_rows else F.floor(F.col(T) / rows_r)
    carried = ["rsi"] if "rsi" in flags.columns else []
    rows = (flags.select("symbol", T, "datetime", "close", "bull", "bear", *carried, blk.alias(LB))
                 .withColumn("_us", micros("datetime")))
    # a block's last tick by position, and the rows that are not two days older
    ends = rows.where(F.col(T) == (F.col(LB) + 1) * rows_r - 1).select(
        F.col("symbol").alias("_es"), F.col(LB).alias("_eb"), F.col("_us").alias("_end"))
    halo = (rows.join(ends, (F.col("symbol") == F.col("_es")) & (F.col(LB) == F.col("_eb"))
                      & (F.col("_us") + F.lit(_EXPIRY_US) > F.col("_end")))
                .where(F.col("bull") | F.col("bear") | (F.col("_us") == F.col("_end")))
                .select(*[F.col(c).alias(c) for c in ("symbol", T, "datetime", "close", "bull", "bear", "_us")],
                        (F.col(LB) + 1).alias(LB)))
    maps = (rows.groupBy("symbol", LB).cogroup(halo.groupBy("symbol", LB))
                .applyInPandas(_transfer_map, _MAP_SCHEMA))
    entries = compose_entries(maps)
    live_in = (entries.where(F.col("entry") != IDLE)
                      .join(halo.select("symbol", LB, F.col(T).alias("entry"), F.col("_us").alias("s_us"),
                                        F.col("close").alias("s_close"),
                                        F.when(F.col("bear"), S.BEARISH).otherwise(S.BULLISH).alias("s_kind")),
                            ["symbol", LB, "entry"]))
    schema = T_.StructType(_OUT_SCHEMA.fields + [T_.StructField(c, T_.DoubleType()) for c in carried])

    def replay(own: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        return _replay(own, entry, carried)

    folded = (rows.groupBy("symbol", LB).cogroup(live_in.groupBy("symbol", LB))
                  .applyInPandas(replay, schema))
    kind = F.col("kind")
    live = kind > 0
    pct = F.when(live, pct_change("close", "signal_close"))
    age = F.when(live, elapsed_days("datetime", "signal_datetime"))
    out = folded.select(
        "datetime", "symbol", "close", "bull", "bear", kind.alias("kind"), "signal_datetime",
        "signal_close", pct.alias("pct"),
        F.when(live, converted(pct, kind, direction=direction)).alias("converted"),
        age.alias("age_days"), "live_after", T, *carried)
    return out.withColumnRenamed("symbol", key) if key != "symbol" else out


def live_signals(states: DataFrame, key: str = "symbol") -> DataFrame:
    """The live-signal store (``now_diversions``): per symbol the signal that
    is checked on its newest tick, if there is one.  A signal opens while none
    is live, so a later flag does not replace it; ``states`` is a lifecycle
    frame, cut at the tick in question."""
    now = newest(states, key).where(F.col("kind") > 0)
    return now.select(key, F.col("signal_datetime").alias("datetime"), F.col("signal_close").alias("close"),
                      F.col("kind").alias("diversions"))


def conversion_check(candles_latest: DataFrame, live_signal: DataFrame,
                     direction: str = "literal") -> DataFrame:
    """CMP7: newest candle per symbol joined to the live signal of the symbol
    (``live_signals``); symbols without one are not checked, as the state gate
    has it."""
    s = live_signal.select("symbol", F.col("datetime").alias("signal_datetime"),
                           F.col("close").alias("signal_close"), F.col("diversions"))
    j = candles_latest.select("symbol", "datetime", "close").join(s, "symbol")
    pct = pct_change("close", "signal_close")
    age = elapsed_days("datetime", "signal_datetime")
    return j.select("symbol", "datetime", "close", "signal_datetime", "signal_close", "diversions",
                    pct.alias("pct"),
                    F.when(converted(pct, F.col("diversions"), direction=direction), 1)
                     .otherwise(0).cast("int").alias("convert"),
                    age.alias("age_days"),
                    (age >= F.lit(S.EXPIRY_DAYS)).alias("expired"))
