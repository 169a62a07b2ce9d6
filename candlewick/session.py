"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every candlewick job relies on.  UTC pins wall-clock arithmetic
# (the KST shift is explicit, see functions.timefn); AQE re-plans joins from
# runtime sizes and splits skewed shuffle partitions.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE sizes shuffle partitions from runtime statistics toward this target
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of released DataFrames are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "candlewick", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only on a ``local[...]`` master, where the setting is absent in tests, a
    scratch folder is created; on a cluster a folder of one machine would be a
    different one on every node, so its absence is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        path = tempfile.mkdtemp(prefix="candlewick-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A table location inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", name)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where a plan reads the same expensive frame more than once; a lost
    executor then re-reads the checkpoint instead of recomputing upstream.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SCRATCH = "candlewick_"


def _scratch_names(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(SCRATCH)]


@contextmanager
def scratch_scope(spark: SparkSession):
    """Drops the scratch tables that were made inside, when it ends: for whoever
    reads or writes a query's result within it."""
    before = set(_scratch_names(spark))
    try:
        yield
    finally:
        drop_scratch(spark, keep=before)


def drop_scratch(spark: SparkSession, keep: set[str] = frozenset()) -> int:
    """Drop the tables that ``materialize_by`` has written in this session,
    with their files, but for those to ``keep``; frames over them can't be read
    any more.  Returns how many there were.  The jobs call it when their
    results are written."""
    names = [n for n in _scratch_names(spark) if n not in keep]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        spark.sql(f"DROP TABLE {name}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_table_path(spark, name))
        path.getFileSystem(conf).delete(path, True)
    return len(names)


def bucket_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize_by(df, keys: list[str], order: list[str] | None = None, buckets: int | None = None):
    """Cut lineage by writing a bucketed, sorted parquet table in the shared
    checkpoint folder and reading it back.

    Unlike ``checkpoint()`` the read keeps ``HashPartitioning(keys)`` (bucket
    ids use the shuffle hash), so later joins, groups, windows and cogroups on
    ``keys`` read the table in place instead of shuffling it again.  ``df``
    should already be hash-partitioned on ``keys`` into ``buckets``
    partitions (one file per bucket).
    """
    spark = df.sparkSession
    n = buckets or bucket_count(spark)
    name = f"{SCRATCH}{uuid.uuid4().hex[:16]}"
    w = df.write.format("parquet").bucketBy(n, *keys)
    if order:
        w = w.sortBy(*order)
    w.option("path", scratch_table_path(spark, name)).saveAsTable(name)
    return spark.table(name)
