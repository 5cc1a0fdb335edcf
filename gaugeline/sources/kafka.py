"""Kafka topics. Needs the spark-sql-kafka-0-10 package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeline.schema import MESSAGE_SCHEMA
from gaugeline.sources.archive import MAX_FILE_AGE


def read_messages(
    spark: SparkSession,
    broker: str,
    topic: str,
    starting: str = "latest",
    min_partitions: int | None = None,
    max_offsets: int | None = None,
) -> DataFrame:
    """Stream of a topic. Spark picks a consumer group per query, so queries never share one.

    ``min_partitions`` spreads a hot topic partition over several tasks, ``max_offsets`` bounds a
    micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", broker)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def read_message_files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same stream from Parquet files of Kafka-shaped rows."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE)
        .parquet(path)
    )


def publish(messages: DataFrame, broker: str, topic: str) -> None:
    """Append (key, value) rows of a batch to a topic."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", broker).option("topic", topic).save()


def publish_stream(messages: DataFrame, broker: str, topic: str, checkpoint: str) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", broker)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
