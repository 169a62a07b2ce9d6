"""Per-symbol row order without one task per symbol.

A candle table is ordered per symbol by ``datetime``.  Window functions over
``partitionBy(symbol)`` would put a whole symbol into one task; a symbol may
hold a third of all rows.  Instead:

1. ``with_row_index`` gives every row its 0-based position ``_t`` in its
   symbol.  Rows are grouped into coarse time spans ``(symbol, _tb)``; the
   per-span counts (one row per span, pre-aggregated map-side) are
   prefix-summed per symbol and joined back, then ``row_number`` runs inside
   each span.  The rows are computed and written once (bucketed by span); the
   span offsets come from the small table of counts, by levels where it is
   large, so no task orders a symbol's spans beyond a bound.
2. ``blocks_with_halo`` cuts each symbol into blocks of exactly ``R`` rows
   (``_blk = _t div R``, the last block may be shorter).  Row windows run over
   ``partitionBy(symbol, _blk)``: bounded groups, spread over all tasks.  The
   last ``halo`` rows of every block are copied into the next block (flag
   ``_own = false``) so that lags and look-back frames crossing a block edge
   see their predecessors.  One shuffle moves rows and halo copies together.
3. ``halo_arrays`` serves look-backs on data that is already partitioned by
   ``(symbol, _blk)``: the tail of each block travels as one small array
   row to the next block, so the big side is not shuffled again.

Input rows must be unique per (symbol, datetime); see ``dedupe``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.timefn import micros
from candlewick.session import materialize, materialize_by

T, BLK, OWN, J = "_t", "_blk", "_own", "_j"

DEFAULT_BLOCK_ROWS = 2048


def with_row_index(df: DataFrame, span_micros: int, key: str = "symbol",
                   order: str = "datetime") -> DataFrame:
    """Add ``_t`` = 0-based position of the row within its ``key``.

    ``span_micros`` sizes the coarse spans: pick interval x block rows so a
    span holds a bounded number of candles.  A row without ``order`` or ``key``
    has no position: it fails the job (see ``sources.ticks.tick_rejects`` and
    ``sources.klines.kline_rejects`` for setting such rows aside).

    The input is computed once: its rows are written as a table bucketed by
    (key, span), which the counts, the join and the numbering read in place.
    """
    lacks = lambda c: F.raise_error(F.lit(f"a row has no {c}")).cast("bigint")
    at = F.coalesce(F.floor(micros(order) / F.lit(int(span_micros))), lacks(order))
    at = F.when(F.col(key).isNull(), lacks(key)).otherwise(at)
    d = materialize_by(df.withColumn("_tb", at).repartition(key, "_tb"), [key, "_tb"], [key, "_tb", order])
    counts = materialize(d.groupBy(key, "_tb").agg(F.count(F.lit(1)).alias("_n")))
    offsets = prefix_sum(counts, key, "_tb", "_n", "_off")
    # content hash as tie-break: positions stay the same when a lost task is
    # recomputed, even if a (key, order) pair slipped through twice
    inside = Window.partitionBy(key, "_tb").orderBy(order, F.xxhash64(*[F.col(c) for c in df.columns]))
    return (d.join(offsets, [key, "_tb"])
             .withColumn(T, (F.col("_off") + F.row_number().over(inside) - 1).cast("bigint"))
             .drop("_tb", "_off"))


SPAN_GROUP = 1024
ONE_WINDOW = 1 << 20  # rows that a per-key running sum may order in one task


def prefix_sum(df: DataFrame, key: str, order: str, value: str, out: str,
               group: int = SPAN_GROUP, one_window: int = ONE_WINDOW) -> DataFrame:
    """Exclusive running sum of ``value`` per ``key`` in ``order`` (an integer).

    ``df`` is a materialised table of counts.  Up to ``one_window`` rows a key
    (measured) a window per key does it.  A larger one goes by levels, so that
    no task orders a whole key: running sums inside groups of ``group``
    consecutive order values, plus the running sum of the group totals, a table
    ``group`` times smaller that goes the same way, joined back.
    """
    before = Window.unboundedPreceding, -1
    most = df.groupBy(key).count().agg(F.max("count")).first()[0]
    if (most or 0) <= max(2, one_window):
        w = Window.partitionBy(key).orderBy(order).rowsBetween(*before)
        return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
    up = f"{order}g"  # the next level's order column
    g = df.withColumn(up, F.floor(F.col(order) / group))
    inner = Window.partitionBy(key, up).orderBy(order).rowsBetween(*before)
    g = g.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    totals = materialize(g.groupBy(key, up).agg(F.sum(value).alias(value)))
    outer = prefix_sum(totals, key, up, value, "_out", group, one_window).select(key, up, "_out")
    return (g.join(outer, [key, up])
             .select(*[F.col(c) for c in df.columns], (F.col("_out") + F.col("_in")).alias(out)))


def blocks_with_halo(seq: DataFrame, block_rows: int, halo: int) -> DataFrame:
    """Assign ``_blk`` and add halo copies of each block's last rows.

    The copies are generated in the same pipeline (``explode`` of one or two
    targets per row): rows and copies move in one shuffle.
    """
    if halo >= block_rows:
        raise ValueError("halo must be shorter than a block")
    blk = F.floor(F.col(T) / block_rows)
    if halo <= 0:
        return seq.withColumn(BLK, blk).withColumn(OWN, F.lit(True))
    own = F.struct(blk.alias("b"), F.lit(True).alias("o"))
    copy = F.struct((blk + 1).alias("b"), F.lit(False).alias("o"))
    in_tail = F.pmod(F.col(T), F.lit(block_rows)) >= block_rows - halo
    targets = F.when(in_tail, F.array(own, copy)).otherwise(F.array(own))
    return (seq.withColumn("_tgt", F.explode(targets))
               .withColumn(BLK, F.col("_tgt.b")).withColumn(OWN, F.col("_tgt.o"))
               .drop("_tgt"))


def in_block(key: str = "symbol") -> Window:
    return Window.partitionBy(key, BLK).orderBy(T)


def block_position(block_rows: int):
    """0-based position of a row inside its block."""
    return F.col(T) - F.col(BLK) * F.lit(block_rows)


def halo_arrays(df: DataFrame, block_rows: int, halo: int, cols: list[str],
                key: str = "symbol", name: str = "_halo") -> DataFrame:
    """Join the last ``halo`` rows of the previous block to the first ``halo``
    rows of each block, which alone look back past its edge.

    ``df`` holds own rows with ``_t``/``_blk``.  The array is sorted by
    ``_t``; it is NULL for other rows and in the first block.
    """
    tail = (df.where(F.pmod(F.col(T), F.lit(block_rows)) >= block_rows - halo)
              .groupBy(F.col(key).alias("_hk"), (F.col(BLK) + 1).alias("_hb"))
              .agg(F.array_sort(F.collect_list(F.struct(F.col(T), *[F.col(c) for c in cols])))
                   .alias(name)))
    first = block_position(block_rows) < halo
    return df.join(tail, (F.col(key) == F.col("_hk")) & (F.col(BLK) == F.col("_hb")) & first,
                   "left").drop("_hk", "_hb")
