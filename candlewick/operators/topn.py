"""Newest-N per symbol, closed-candle pick, dedupe (SRC2, SRC5, SRT2-SRT5, SNK2).

``row_number() <= N`` over ``partitionBy(symbol).orderBy(desc)`` is planned
by Spark with a map-side WindowGroupLimit: every task keeps only its N newest
rows per symbol before the shuffle, so a hot symbol ships N rows per task,
not its history.  "All but the newest N" is an anti join against that small
top-N set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.timefn import micros
from candlewick.session import materialize


def newest_n(df: DataFrame, n: int, key: str = "symbol", order: str = "datetime",
             rank_col: str | None = "rn") -> DataFrame:
    """SRC5/SRT3: the newest ``n`` rows of each key; ``rn`` = 1 for the newest."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    if rank_col:
        return out.withColumn(rank_col, F.col("_rn").cast("bigint")).drop("_rn")
    return out.drop("_rn")


def newest(df: DataFrame, key: str = "symbol", order: str = "datetime") -> DataFrame:
    """SRT2/SRT4: newest row per key."""
    return newest_n(df, 1, key, order, rank_col=None)


def closed_latest(df: DataFrame, key: str = "symbol", order: str = "datetime") -> DataFrame:
    """SRC2: the newest *closed* candle, i.e. the second newest row per key
    (the newest candle is still in progress)."""
    return (newest_n(df, 2, key, order, rank_col="_r2").where(F.col("_r2") == 2).drop("_r2"))


def drop_newest(df: DataFrame, n: int, key: str = "symbol", order: str = "datetime") -> DataFrame:
    """SRT5: every row except the newest ``n`` of each key (a null key is one).
    The input is read twice, so it is computed once and checkpointed."""
    df = materialize(df)
    top = newest_n(df, n, key, order, rank_col=None).select(F.col(key).alias("_key"), F.col(order).alias("_at"))
    return df.join(top, F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_at")), "left_anti")


def dedupe_latest(df: DataFrame, keys: list[str], version: str, tiebreak: list[str] | None = None
                  ) -> DataFrame:
    """SNK2 upsert: keep the newest version of each key.

    Implemented as an aggregation so copies of one hot key are combined on
    the map side.  Each value column is picked by one fixed-width ordering key
    (version time, row hash), which keeps the hash aggregate and picks all
    columns from the same row.
    """
    values = [c for c in df.columns if c not in keys and c != version]
    rowhash = F.xxhash64(*[F.col(c) for c in (tiebreak or values)])
    order = (micros(version).cast("decimal(38,0)")
             * F.expr("CAST('100000000000000000000' AS DECIMAL(38,0))")
             + rowhash.cast("decimal(38,0)")
             + F.expr("CAST('9223372036854775808' AS DECIMAL(38,0))"))
    d = df.withColumn("_ord", order.cast("decimal(38,0)"))
    return (d.groupBy(*keys)
             .agg(F.max(version).alias(version),
                  *[F.max_by(F.col(c), F.col("_ord")).alias(c) for c in values])
             .select(*df.columns))
