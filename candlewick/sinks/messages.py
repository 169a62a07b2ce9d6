"""Signal messages (SNK4) and the Kafka frame (SNK5).

The original publishes each signal row as JSON on topic ``coin``.  The frame
is built on the executors (``to_json(struct(*))``); a Kafka write needs the
spark-sql-kafka package on the classpath, which this environment lacks, so
``publish_kafka`` is gated and tests use the frame or a file sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOPIC = "coin"


def to_json_messages(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def kafka_frame(df: DataFrame, key: str = "symbol") -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def publish_kafka(df: DataFrame, bootstrap_servers: str, topic: str = TOPIC, key: str = "symbol"):
    """Batch publish; raises a clear error when the Kafka connector is absent."""
    frame = kafka_frame(df, key)
    try:
        (frame.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
              .option("topic", topic).save())
    except Exception as exc:  # connector jar missing or broker unreachable
        raise RuntimeError(f"Kafka publish failed ({exc.__class__.__name__}); "
                           "is spark-sql-kafka on the classpath?") from exc


def console(df: DataFrame, n: int = 20) -> None:
    """SNK6: debugging display only; never part of a pipeline."""
    df.show(n, truncate=False)


def stream_to_kafka(df: DataFrame, bootstrap_servers: str, checkpoint: str, topic: str = TOPIC,
                    key: str = "symbol"):
    """SNK5 for a streaming frame: key = symbol, value = the row as JSON.

    Needs the spark-sql-kafka connector; returns the started query."""
    return (kafka_frame(df, key).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def stream_to_console(df: DataFrame, checkpoint: str):
    """SNK6 for a streaming frame (debugging only)."""
    return (df.writeStream.format("console").option("truncate", False)
              .option("checkpointLocation", checkpoint).start())


def parse_messages(df: DataFrame, schema, value: str = "value") -> DataFrame:
    """Decode JSON messages back into columns (consumer side / round trip)."""
    return df.select(*[c for c in df.columns if c != value],
                     F.from_json(F.col(value), schema).alias("_m")).select(
        *[c for c in df.columns if c != value], "_m.*")
