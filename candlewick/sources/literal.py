"""SRC8: the one-row ``task_state`` table, built on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_frame(spark: SparkSession, state: int) -> DataFrame:
    return spark.range(1).select(F.lit(int(state)).cast("bigint").alias("state"))
