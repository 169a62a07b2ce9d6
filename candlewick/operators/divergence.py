"""RSI / price divergence (CMP4, CMP5, FLT1-FLT3) and signal emit (CMP6).

Every row is treated as the newest row of a detection tick: its look-back is
the row itself plus the ``lookback - 1`` rows before it in its symbol.

* bullish: some look-back row has rsi <= 30, rsi <= newest rsi and
  low > newest low;
* bearish: some look-back row has rsi >= 70, rsi >= newest rsi and
  high < newest high.

The look-back is a bounded window frame inside each ``(symbol, _blk)``
block; the first rows of a block get the previous block's tail through a
small array join (``halo_arrays``), so the RSI frame is not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.operators.sequence import T, halo_arrays, in_block

_CAND = ["rsi", "low", "high"]


def _exists(arr: Column, pred) -> Column:
    return F.coalesce(F.exists(arr, pred), F.lit(False))


def oversold(rsi: str = "rsi") -> Column:
    return F.col(rsi) <= F.lit(S.OVERSOLD)


def overbought(rsi: str = "rsi") -> Column:
    return F.col(rsi) >= F.lit(S.OVERBOUGHT)


def divergence_flags(rsi_rows: DataFrame, block_rows: int, lookback: int = S.DIVERGENCE_ROWS,
                     key: str = "symbol") -> DataFrame:
    """Add boolean ``bull`` and ``bear`` to an RSI frame carrying ``_t``/``_blk``."""
    back = lookback - 1
    if back >= block_rows:
        raise ValueError("look-back must be shorter than a block")
    r = halo_arrays(rsi_rows, block_rows, back, _CAND, key)
    frame = in_block(key).rowsBetween(-back, 0)
    inside = F.collect_list(F.struct(*[F.col(c) for c in _CAND])).over(frame)
    before = F.filter(F.coalesce(F.col("_halo"), F.array()), lambda h: h[T] >= F.col(T) - back)
    cands = F.concat(F.transform(before, lambda h: F.struct(*[h[c].alias(c) for c in _CAND])), inside)
    rsi_now, low_now, high_now = F.col("rsi"), F.col("low"), F.col("high")
    bull = _exists(cands, lambda c: (c["rsi"] <= F.lit(S.OVERSOLD)) & (c["rsi"] <= rsi_now)
                   & (c["low"] > low_now))
    bear = _exists(cands, lambda c: (c["rsi"] >= F.lit(S.OVERBOUGHT)) & (c["rsi"] >= rsi_now)
                   & (c["high"] < high_now))
    return r.withColumn("bull", bull).withColumn("bear", bear).drop("_halo")


def signal_code(bull: str = "bull", bear: str = "bear") -> Column:
    """Bearish wins a tie: the bearish check runs last and overwrites."""
    return F.when(F.col(bear), F.lit(S.BEARISH)).when(F.col(bull), F.lit(S.BULLISH)).cast("int")


def signals(flags: DataFrame) -> DataFrame:
    """CMP6: one ``now_diversions`` row per flagged tick."""
    return (flags.where(F.col("bull") | F.col("bear"))
                 .select("datetime", "symbol", "close",
                         signal_code().alias("diversions"),
                         F.lit(0).cast("int").alias("convert")))
