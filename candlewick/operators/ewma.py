"""Exponentially weighted moving averages over per-symbol row order.

The recursive form of the original jobs is ``e_0 = x_0``,
``e_t = (1 - a) * e_{t-1} + a * x_t`` with ``a = 1 / (com + 1)``.  The forms
(the newest-N variant is ``rsi.tail_sums``):

* blocked scan (``blocked_ewma``): O(1) per row at any history length.
  Inside a block of R rows, ``local_j = a * b^j * sum_{i<=j} b^-i x_i``
  (b = 1 - a) is a native running sum; R is capped so b^-R stays below
  e^300.  The value entering block k is the fold of the previous blocks'
  end values: ``carry_k = sum_c L_c * b^(R*(k-1-c))`` over full blocks.
  Terms more than ~1500/(R*ln(1/b)) blocks back underflow to exactly 0 in
  double arithmetic, so the K previous blocks give the complete sum.  While K
  is small each block's end value is sent to its next K blocks (explode +
  group by block); for a long memory (large com) the end values are scanned
  the same way themselves, one level up, so no task orders a symbol's blocks
  and no block is sent to many.
  Then ``e_t = b^(j+1) * carry + local_j``.
* ``exact_fold``: per-block replay of the literal recursion, seeded from the
  blocked scan ``warmup_rows`` before the block; same bits as one sequential
  fold.  Blocks are at least that long (``exact_rows``), whatever ``com`` is.
* ``ewma_fold_expr`` / ``ewma_running_list``: fold over an array, for tests
  and the literal running-list form.

The blocked scan equals the sequential fold up to floating-point rounding.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.sequence import BLK, OWN, T, block_position, in_block
from candlewick.session import materialize


def alpha_of(com: float) -> float:
    if com < 0:
        raise ValueError("com must be >= 0")
    return 1.0 / (com + 1.0)


def block_plan(com: float, block_rows: int) -> tuple[int, int]:
    """(R, K): rows per block kept numerically safe, carry frame in blocks."""
    beta = 1.0 - alpha_of(com)
    if beta <= 0.0:
        return block_rows, 1
    lam = -math.log(beta)
    rows = max(1, min(block_rows, int(300.0 / lam)))
    frame = int(math.ceil(1500.0 / (lam * rows))) + 1
    return rows, frame


def exact_rows(com: float, block_rows: int) -> int:
    """Block rows for ``exact_fold``: longer than its warm-up, and still
    numerically safe for the scan (the warm-up decays by 2^-64, far from the
    scan's e^-300)."""
    return block_plan(com, max(block_rows, warmup_rows(com) + 1))[0]


def fold_step(com: float):
    a = alpha_of(com)
    keep = 1.0 - a
    return lambda acc, x: F.lit(keep) * acc + F.lit(a) * x


def ewma_fold_expr(arr: Column, com: float, seed: Column | None = None) -> Column:
    """``e = arr[0]`` (or ``seed`` before arr[0]) then the recursive update."""
    step = fold_step(com)
    if seed is None:
        return F.aggregate(F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0))),
                           F.element_at(arr, 1).cast("double"), step)
    return F.aggregate(arr, seed.cast("double"), step)


def local_sums(cols: list[str], com: float, block_rows: int, key: str = "symbol") -> list[Column]:
    """Running in-block sums ``sum b^-j x_j`` over own rows (halo rows add 0)."""
    beta = 1.0 - alpha_of(com)
    w = in_block(key).rowsBetween(Window.unboundedPreceding, 0)
    scale = F.pow(F.lit(beta), -block_position(block_rows))
    return [F.sum(F.when(F.col(OWN), F.col(c) * scale).otherwise(F.lit(0.0))).over(w).alias(f"_s_{c}")
            for c in cols]


def blocked_ewma(rows: DataFrame, cols: list[str], out: list[str], com: float,
                 block_rows: int, key: str = "symbol") -> DataFrame:
    """EWMA of ``cols`` for own rows carrying ``_t``, ``_blk`` and ``_s_<col>``.

    ``rows`` must be the own rows (``_own``) after ``local_sums``.
    """
    a = alpha_of(com)
    beta = 1.0 - a
    if beta <= 0.0:
        return rows.select("*", *[F.col(c).alias(o) for c, o in zip(cols, out)])
    _, frame = block_plan(com, block_rows)
    j = block_position(block_rows)
    blocks = rows.groupBy(key, BLK).agg(
        F.count(F.lit(1)).alias("_m"), *[F.sum(F.col(c) * F.pow(F.lit(beta), -j)).alias(f"_S_{c}")
                                         for c in cols])
    ends = blocks.select(key, BLK, *[
        (F.lit(a) * F.pow(F.lit(beta), F.col("_m") - 1) * F.col(f"_S_{c}")).alias(f"_L_{c}")
        for c in cols])
    names = [f"_L_{c}" for c in cols]
    ends = materialize(ends) if frame > MAX_SENT else ends
    carry = block_carry(ends, names, -math.log(beta) * block_rows, key, BLK).select(
        key, BLK, *[F.col(n).alias(f"_c_{c}") for n, c in zip(names, cols)])
    joined = rows.join(carry, [key, BLK], "left")
    outs = []
    for c, o in zip(cols, out):
        local = F.lit(a) * F.pow(F.lit(beta), j) * F.col(f"_s_{c}")
        outs.append((F.pow(F.lit(beta), j + 1) * F.coalesce(F.col(f"_c_{c}"), F.lit(0.0)) + local).alias(o))
    drop = [f"_c_{c}" for c in cols] + [f"_s_{c}" for c in cols]
    return joined.select("*", *outs).drop(*drop)


MAX_SENT = 16  # blocks that a block's end value is sent to


def block_carry(ends: DataFrame, cols: list[str], lam: float, key: str, idx: str) -> DataFrame:
    """State entering each step of a decaying sum: for steps ``idx`` (0, 1, ...
    per ``key``) with end values ``cols`` and decay ``e^-lam`` a step,
    ``carry_k = sum over c < k of x_c * e^(-lam (k - 1 - c))``."""
    frame = int(math.ceil(1500.0 / lam)) + 1
    if frame <= MAX_SENT:
        decay = F.lit(math.exp(-lam))
        sent = ends.select(key, F.col(idx).alias("_src"), *cols,
                           F.explode(F.sequence(F.col(idx) + 1, F.col(idx) + frame)).alias(idx))
        # steps without an end value in between can't occur: idx has no gaps
        got = sent.groupBy(key, idx).agg(
            F.array_sort(F.collect_list(F.struct("_src", *cols))).alias("_prev"))

        def fold_of(field):
            return lambda acc, v: acc * decay + v[field]

        return got.select(key, idx, *[
            F.aggregate(F.col("_prev"), F.lit(0.0), fold_of(c)).alias(c) for c in cols])
    # groups of steps, scanned natively; group ends go the same way one level up
    size = max(2, int(300.0 / lam))
    group, pos = f"{idx}g", F.col(idx) - F.col(f"{idx}g") * size
    g = ends.withColumn(group, F.floor(F.col(idx) / size))
    inside = Window.partitionBy(key, group).orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    g = g.select(key, idx, group, *[
        (F.exp(-lam * pos) * F.sum(F.col(c) * F.exp(lam * pos)).over(inside)).alias(c) for c in cols])
    g = materialize(g)
    outer = block_carry(g.where(pos == size - 1).select(key, F.col(group), *cols), cols, lam * size, key, group)
    outer = outer.select(key, group, *[F.col(c).alias(f"_up_{c}") for c in cols])
    return g.join(outer, [key, group], "left").select(key, (F.col(idx) + 1).alias(idx), *[
        (F.col(c) + F.exp(-lam * (pos + 1)) * F.coalesce(F.col(f"_up_{c}"), F.lit(0.0))).alias(c) for c in cols])


def ewma(df: DataFrame, col: str, com: float, out: str | None = None,
         span_micros: int = 3_600_000_000, block_rows: int = 2048,
         key: str = "symbol", order: str = "datetime") -> DataFrame:
    """EWMA of ``col`` per ``key`` in ``order``, seeded with the first value.

    ``e_0 = x_0``; the zero-seeded scan gives ``x_0`` weight ``a``, so the
    first value enters as ``x_0 / a``.  ``span_micros`` is the typical row
    spacing (one hour by default); it only sizes the row-index spans.
    """
    from candlewick.operators.sequence import blocks_with_halo, with_row_index
    from candlewick.session import materialize_by
    out = out or f"{col}_ewma"
    rows_r, _ = block_plan(com, block_rows)
    a = alpha_of(com)
    seq = with_row_index(df, span_micros * rows_r, key, order)
    seq = seq.withColumn("_x", F.when(F.col(T) == 0, F.col(col) / F.lit(a)).otherwise(F.col(col)))
    u = blocks_with_halo(seq, rows_r, 0).repartition(key, BLK)
    u = u.select("*", *local_sums(["_x"], com, rows_r, key))
    # read twice (block sums, carry join): one bucketed table, read in place
    u = materialize_by(u, [key, BLK], [key, BLK, T])
    return blocked_ewma(u, ["_x"], [out], com, rows_r, key).drop("_x", OWN)


def warmup_rows(com: float) -> int:
    """Rows after which a state error of one part in 2^64 has decayed away."""
    beta = 1.0 - alpha_of(com)
    if beta <= 0.0:
        return 1
    return int(math.ceil(64 * math.log(2.0) / -math.log(beta)))


def exact_fold(rows: DataFrame, xcols: list[str], ecols: list[str], com: float,
               block_rows: int, key: str = "symbol") -> DataFrame:
    """Replace approximate EWMA columns by the literal sequential fold.

    ``rows`` are own rows partitioned by ``(key, _blk)`` carrying ``_t``, the
    inputs ``xcols`` and approximate results ``ecols`` (blocked scan).  Each
    block is replayed with ``e = (1 - a) * e + a * x``, starting ``H`` rows
    before the block from the approximate value there; the start error is
    damped by ``(1 - a)^H < 2^-64`` before the first own row, so the block's
    values carry the same bits as one fold over the whole history.  Block 0
    starts from its first value, as the original UDF does.

    The halo is the previous block's last ``H`` rows, co-grouped per block;
    the big side keeps its ``(key, _blk)`` partitioning.
    """
    a = alpha_of(com)
    keep = 1.0 - a
    halo_n = warmup_rows(com)
    if halo_n >= block_rows:
        raise ValueError(f"an exact fold with com {com} needs blocks of more than {halo_n} rows (exact_rows)")
    j = block_position(block_rows)
    # fresh column ids: the halo is a view of ``rows`` and must not alias it
    halo = (rows.where(j >= block_rows - halo_n)
                .select(F.col(key).alias(key), (F.col(BLK) + 1).alias(BLK), F.col(T).alias(T),
                        *[F.col(c).alias(c) for c in xcols + ecols]))
    schema = rows.schema
    names = schema.fieldNames()

    def step(acc: float, v: float) -> float:
        return keep * acc + a * v

    def replay(own, prev):
        own = own.sort_values(T, kind="stable")
        prev = prev.sort_values(T, kind="stable")
        for x, e in zip(xcols, ecols):
            xs = own[x].tolist()  # plain floats: the same bits, a fraction of the time
            if len(prev):
                *_, acc = accumulate(prev[x].tolist()[1:], step, initial=float(prev[e].iloc[0]))
                own[e] = list(accumulate(xs, step, initial=acc))[1:]
            else:
                own[e] = list(accumulate(xs, step))
        return own[names]

    return (rows.groupBy(key, BLK).cogroup(halo.groupBy(key, BLK))
                .applyInPandas(replay, schema))


def ewma_running_list(df: DataFrame, col: str, com: float, out: str, key: str = "symbol",
                      order: str = "datetime") -> DataFrame:
    """WIN2 + UDF1 in their literal form: fold over ``collect_list`` of a
    running frame.  O(n^2) per symbol and one task per symbol: kept as the
    executable definition for tests, never used by the catalogue."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, ewma_fold_expr(F.collect_list(F.col(col)).over(w), com))
