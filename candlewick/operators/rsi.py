"""RSI operators (CMP1 full history, CMP2 newest-200 tail, CMP3 warm-up).

All three share one plan shape: row index -> blocks with halo -> one window
stage over ``(symbol, _blk)`` (lag, gain/loss, running sums) -> block carry
join.  Rows of one symbol are spread over ``rows / R`` independent groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick import schema as S
from candlewick.functions.indicators import (
    gain, interval_micros, loss, relative_strength, rsi_from_averages_warm, rsi_from_rs)
from candlewick.operators.ewma import (
    alpha_of, block_plan, blocked_ewma, exact_fold, exact_rows, local_sums)
from candlewick.session import materialize, materialize_by
from candlewick.operators.sequence import (
    BLK, DEFAULT_BLOCK_ROWS, OWN, T, block_position, blocks_with_halo, in_block, prefix_sum, with_row_index)


def with_gains(df: DataFrame, key: str) -> DataFrame:
    prev = F.lag("close", 1).over(in_block(key))
    return (df.withColumn("prev_close", prev)
              .withColumn("delta", F.col("close") - F.col("prev_close"))
              .withColumn("up", gain("delta"))
              .withColumn("down", loss("delta")))


def frame_rows(com: float, block_rows: int, exact: bool) -> int:
    return exact_rows(com, block_rows) if exact else block_plan(com, block_rows)[0]


def rsi_frame(candles: DataFrame, interval: str = "1 hour", com: float = S.COM,
              block_rows: int = DEFAULT_BLOCK_ROWS, key: str = "symbol",
              order: str = "datetime", exact: bool = False) -> DataFrame:
    """Full-history RSI per row, keeping ``_t``/``_blk`` for chained operators.

    Adds prev_close, delta, up, down, up_ewma, down_ewma, rs, rsi.  The EWMA
    values come from the native blocked scan (within ~1e-15 relative), with no
    Python.  With ``exact`` they are replayed per block (``exact_fold``) and
    equal the original sequential fold bit for bit, which matters where RSI
    values are compared with each other (divergence on flat prices).  Blocks
    have ``frame_rows(com, block_rows, exact)`` rows.
    """
    _, r = _averages(candles, ["up", "down"], interval, com, block_rows, key, order, exact)
    return (r.withColumn("rs", relative_strength("up_ewma", "down_ewma"))
             .withColumn("rsi", rsi_from_rs("rs")))


def _averages(candles: DataFrame, cols: list[str], interval: str, com: float, block_rows: int, key: str, order: str,
              exact: bool) -> tuple[DataFrame, DataFrame]:
    """The gain columns of every row, in blocks (a written table), and these
    rows with ``<c>_ewma`` of ``cols``."""
    rows_r = frame_rows(com, block_rows, exact)
    seq = with_row_index(candles, interval_micros(interval) * rows_r, key, order)
    blocks = blocks_with_halo(seq, rows_r, 1).repartition(key, BLK)  # AQE may coalesce
    u = with_gains(blocks, key).withColumn("known", F.col("delta").isNotNull().cast("double"))
    u = u.select("*", *local_sums(cols, com, rows_r, key)).where(F.col(OWN)).drop(OWN)
    # read three times (block sums, carry join, exact-fold halo): write the
    # windowed rows once as a table bucketed by (symbol, block) in the shared
    # checkpoint folder; readers keep that partitioning, nothing reshuffles
    u = materialize_by(u if "known" in cols else u.drop("known"), [key, BLK], [key, BLK, T])
    averages = [f"{c}_ewma" for c in cols]
    r = blocked_ewma(u, cols, averages, com, rows_r, key)
    return u, exact_fold(r, cols, averages, com, rows_r, key) if exact else r


def rsi(candles: DataFrame, interval: str = "1 hour", com: float = S.COM,
        block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """CMP1: the 9-column ``kline_1d_rsi`` table."""
    return rsi_frame(candles, interval, com, block_rows).select(*S.RSI_COLUMNS)


def rsi_tail(candles: DataFrame, interval: str = "1 hour", com: float = S.COM,
             tail: int = S.TAIL_ROWS, block_rows: int = DEFAULT_BLOCK_ROWS,
             key: str = "symbol", order: str = "datetime") -> DataFrame:
    """CMP2/WIN4: RSI of every row computed from its newest ``tail`` rows only.

    The tail's oldest row has no predecessor inside the tail, so it adds the
    0 seed; the fold then runs over the other ``tail - 1`` rows.  Two native
    running sums per column, whatever the tail's length.
    """
    beta = 1.0 - alpha_of(com)
    # halo rows are scaled too: the whole span stays numerically safe
    rows_r = max(tail + 1, min(max(block_rows, 2 * tail), block_plan(com, 1 << 30)[0] - tail))
    seq = with_row_index(candles, interval_micros(interval) * rows_r, key, order)
    u = with_gains(blocks_with_halo(seq, rows_r, tail), key)
    u = u.select("*", *tail_sums(["up", "down"], ["up_ewma", "down_ewma"], beta, tail, rows_r, key)).where(F.col(OWN))
    return (u.withColumn("rs", relative_strength("up_ewma", "down_ewma"))
             .withColumn("rsi", rsi_from_rs("rs"))
             .select(*S.RSI_COLUMNS))


def tail_sums(cols: list[str], out: list[str], beta: float, tail: int, block_rows: int, key: str) -> list[Column]:
    """The fold of the last ``tail - 1`` values from a 0 seed, as a difference
    of running sums ``sum b^-j x_j``: the older sum is the smaller by far, and
    a tail of zeros gives an exact zero."""
    j = block_position(block_rows)
    scale = F.pow(F.lit(beta), -j)
    upto = in_block(key).rowsBetween(Window.unboundedPreceding, 0)
    older = in_block(key).rowsBetween(Window.unboundedPreceding, -(tail - 1))
    return [(F.lit(1.0 - beta) * F.pow(F.lit(beta), j)
             * (F.sum(F.col(c) * scale).over(upto) - F.coalesce(F.sum(F.col(c) * scale).over(older), F.lit(0.0)))).alias(o)
            for c, o in zip(cols, out)]


def rsi_warmup(candles: DataFrame, interval: str = "1 hour", period: int = S.WARMUP_PERIODS,
               block_rows: int = DEFAULT_BLOCK_ROWS, exact: bool = False) -> DataFrame:
    """CMP3: normalised averages with ``min_periods = period`` (com = period - 1).

    The weighted mean of the differences so far, weights decaying by position:
    AU_t = sum(b^(t-i) up_i) / sum(b^(t-i)) over the rows i that have a
    difference, NULL while fewer than ``period`` of them have one.  A row
    without a close takes part in neither sum and repeats the averages before
    it, the rows after it weigh what was before the less.  (Only after some
    9,000 rows without one do the weights underflow, and the averages are NULL
    until the next.)  Columns: datetime, symbol, close, AU, AD, RSI.
    """
    com, key = period - 1, "symbol"
    u, r = _averages(candles, ["up", "down", "known"], interval, com, block_rows, key, "datetime", exact)
    # differences before a block, and in it
    blocks = materialize(u.groupBy(key, BLK).agg(F.sum("known").cast("bigint").alias("_n")))
    before = prefix_sum(blocks, key, BLK, "_n", "_before").select(key, BLK, "_before")
    seen = F.sum("known").over(in_block(key).rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    r = r.join(before, [key, BLK]).withColumn("_seen", seen)
    warm = F.col("_seen") >= period
    au = F.when(warm, F.try_divide("up_ewma", "known_ewma"))
    ad = F.when(warm, F.try_divide("down_ewma", "known_ewma"))
    return (r.select("datetime", "symbol", "close", au.alias("AU"), ad.alias("AD"))
             .withColumn("RSI", rsi_from_averages_warm("AU", "AD")))
