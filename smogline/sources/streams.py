"""Message streams in and out, by format name and options.

Kafka needs Spark's Kafka package on the classpath; file formats need nothing
more and take the same code path after ``messages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

# How topics are read and written.
START_AT = "latest"
ACKNOWLEDGE = "all"
RETRIES = "1"
# End of fixed values.

ORDER = "write_order"


def kafka_stream(spark: SparkSession, brokers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic from now on, or from the query's checkpoint after a restart."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", START_AT)
        .options(**options)
    )
    return kafka_messages(reader.load())


def kafka_messages(df: DataFrame) -> DataFrame:
    """``value`` text and the order of writing: by time, then by place in the topic."""
    order = F.struct(
        F.col("timestamp").alias("at"), F.col("partition").alias("part"), F.col("offset").alias("pos")
    )
    return df.select(F.col("value").cast("string").alias("value"), order.alias(ORDER))


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files that arrive in a folder."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def numbered_messages(df: DataFrame, value: str, number: str) -> DataFrame:
    """``value`` text and the order of writing, from an explicit sequence number."""
    order = F.struct(
        F.lit(None).cast("timestamp").alias("at"),
        F.lit(None).cast("int").alias("part"),
        F.col(number).cast("bigint").alias("pos"),
    )
    return df.select(F.col(value).alias("value"), order.alias(ORDER))


def publish(df: DataFrame, fmt: str, path: str | None = None, **options: str) -> None:
    """Send the ``value`` column, without a key, to a topic or to files."""
    outgoing = df.select("value").write.format(fmt).mode("append").options(**options)
    outgoing.save(path) if path else outgoing.save()


def publish_stream(
    stream: DataFrame, fmt: str, checkpoint: str, path: str | None = None, **options: str
) -> DataStreamWriter:
    """The same for a stream; set a trigger and call ``start()`` on the result."""
    outgoing = stream.select("value").writeStream.format(fmt).option("checkpointLocation", checkpoint)
    return outgoing.options(**options, **({"path": path} if path else {}))


def publish_to_kafka(df: DataFrame, brokers: str, topic: str, **options: str) -> None:
    publish(df, "kafka", **kafka_producer_options(brokers, topic), **options)


def kafka_producer_options(brokers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": ACKNOWLEDGE,
        "kafka.retries": RETRIES,
    }
