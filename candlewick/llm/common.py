"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import checkpoint_dir

#: Upper bound of one Arrow batch handed to a Python worker.
ARROW_BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so long texts cannot swell a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def fold(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(n)).cast("int")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker.

    Operator code is shipped by value, so module globals are new in each task;
    the interpreter's ``sys`` module is not.
    """
    return sys.__dict__.setdefault("_candlewick_worker_cache", {})


def shared_path(spark: SparkSession, name: str) -> str:
    """A new location in the folder that driver and executors share."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage durably: a lost executor re-reads the table.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
