"""Table sinks on files (SNK1-SNK3), merge-on-read upsert, keyed state tables.

The original overwrote or appended PostgreSQL tables.  On a cluster the
tables are parquet folders partitioned by symbol and a slice of ``datetime``
(month, or year for daily rows):

* ``overwrite_table`` (SNK1/SNK3): rows clustered by (symbol, slice) and sorted
  by time (SRT1), so a symbol's history is many tasks' work, and a read of its
  newest rows can skip old slices.  Dynamic partition overwrite replaces the
  (symbol, slice) partitions that the new rows touch, or the whole table.
* ``append_table`` (SNK2): append, laid out alike.
* ``read_upserted`` (SNK2 made idempotent): the newest version of each
  (symbol, datetime) wins when the table is read, so appending the same
  tick twice, or a re-delivered candle, changes nothing.
* ``upsert_state`` / ``read_state`` (SNK3): a small table with one row per key.
  Each upsert writes the next compacted version; readers take the newest
  complete one, and versions before the last two are removed.

The tables of the daily pipeline change together and live in a store
(``sinks.store``); ``read_table`` and ``read_state`` read the newest version of
a store's table by its path, ``<store>/<table>``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.topn import dedupe_latest
from candlewick.sinks.store import _SYMBOL, SLICES, Store, slice_of


def _laid_out(df: DataFrame, order: str, by: str) -> DataFrame:
    return df.withColumn(by, slice_of(order, by))


def overwrite_table(df: DataFrame, path: str, key: str = "symbol", order: str = "datetime",
                    replace: str = "partitions", by: str = "month") -> None:
    """``replace``: "partitions" (those that ``df`` has rows of) or "all"."""
    if replace not in ("partitions", "all"):
        raise ValueError("replace is 'partitions' or 'all'")
    (_laid_out(df, order, by).repartition(key, by).sortWithinPartitions(key, by, order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
     .partitionBy(key, by).parquet(path))


def append_table(df: DataFrame, path: str, key: str = "symbol", order: str = "datetime", by: str = "month") -> None:
    _laid_out(df, order, by).repartition(key, by).write.mode("append").partitionBy(key, by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table without its layout column (a filter on that needs the plain reader)."""
    folder, name = os.path.split(path.rstrip("/"))
    store = Store(spark, folder or ".")
    if store.exists() and name in (snap := store.snapshot()).schemas:
        return store.read(snap, name)
    found = spark.read.parquet(path).drop(*SLICES)
    return found.drop("symbol").withColumnRenamed(_SYMBOL, "symbol") if _SYMBOL in found.columns else found


def read_upserted(spark: SparkSession, path: str, keys: list[str], version: str) -> DataFrame:
    return dedupe_latest(read_table(spark, path), keys, version)


# ---------------------------------------------------------------- state tables

KEPT_VERSIONS = 2


def _versions(spark: SparkSession, path: str) -> tuple:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p(path)):
        return fs, p, []
    names = [f.getPath().getName() for f in fs.listStatus(p(path))]
    found = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return fs, p, [v for v in found if fs.exists(p(f"{path}/version={v:012d}/_SUCCESS"))]


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version, None before the first upsert."""
    folder, name = os.path.split(path.rstrip("/"))
    store = Store(spark, folder or ".")
    if store.exists() and name in (snap := store.snapshot()).schemas:
        return store.read(snap, name)
    *_, versions = _versions(spark, path)
    return spark.read.parquet(os.path.join(path, f"version={versions[-1]:012d}")) if versions else None


def upsert_state(spark: SparkSession, path: str, rows: DataFrame, key: str = "symbol") -> None:
    """Replace the rows of the keys in ``rows`` (unique), keep those of others."""
    fs, p, versions = _versions(spark, path)
    now = rows
    if versions:
        before = read_state(spark, path)
        now = before.join(rows.select(key), key, "left_anti").select(*rows.columns).unionByName(rows)
    new = (versions[-1] if versions else 0) + 1
    now.write.mode("overwrite").parquet(f"{path}/version={new:012d}")
    for v in [*versions, new][:-KEPT_VERSIONS]:
        fs.delete(p(f"{path}/version={v:012d}"), True)
