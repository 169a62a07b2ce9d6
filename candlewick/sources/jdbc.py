"""JDBC sources and sinks (SRC4-SRC6, SNK1-SNK3 on a database).

Thin on purpose: Spark's JDBC data source does the work.  Full-table reads
are split into ``num_partitions`` range queries on a numeric or time column
(one JDBC partition was the original's bottleneck); bounded reads
(newest-N, state tables) push the whole query down with the ``query``
option.  Lower-case identifiers are quoted.  A JDBC driver jar and a
reachable database are required; none exists in this build environment, so
these functions are not exercised by the query catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _options(url: str, props: dict | None) -> dict:
    return {"url": url, **(props or {})}


def read_table(spark: SparkSession, url: str, table: str, props: dict | None = None,
               partition_column: str | None = None, lower=None, upper=None,
               num_partitions: int | None = None) -> DataFrame:
    """SRC4/SRC6: whole table, optionally split into parallel range reads."""
    r = spark.read.format("jdbc").options(**_options(url, props)).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", str(num_partitions or 8)))
    return r.load()


def read_query(spark: SparkSession, url: str, query: str, props: dict | None = None) -> DataFrame:
    """SRC5: a bounded query (e.g. ORDER BY "datetime" DESC LIMIT 200) run by the database."""
    return spark.read.format("jdbc").options(**_options(url, props)).option("query", query).load()


def newest_rows_query(table: str, n: int, order: str = "datetime") -> str:
    return f'SELECT * FROM "{table}" ORDER BY "{order}" DESC LIMIT {int(n)}'


def write_table(df: DataFrame, url: str, table: str, mode: str = "append",
                props: dict | None = None, batch_size: int = 10_000) -> None:
    """SNK1 (overwrite), SNK2 (append), SNK3 (overwrite of a state table)."""
    (df.write.format("jdbc").options(**_options(url, props)).option("dbtable", table)
       .option("batchsize", str(batch_size)).mode(mode).save())
