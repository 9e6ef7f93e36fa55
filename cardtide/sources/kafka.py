"""Topic source and sink as plain Spark options.

The connector is a separate Spark package (``spark-sql-kafka-0-10``); without it
Spark reports the data source as missing when a reader or writer is started.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardtide.functions.wire import encode_wire


def source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options to read one topic.

    ``max_offsets_per_trigger`` bounds a micro-batch after an outage, and
    ``min_partitions`` cuts large topic partitions into more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def message_text(raw: DataFrame) -> DataFrame:
    """Keep the message as text; its key is not used."""
    return raw.select(F.col("value").cast("string").alias("value"))


def read_topic(spark: SparkSession, **options) -> DataFrame:
    """A stream of ``value`` texts; keyword arguments as for ``source_options``."""
    reader = spark.readStream.format("kafka").options(**source_options(**options))
    return message_text(reader.load())


def write_topic(txns: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of typed wire rows, one message each."""
    encode_wire(txns).write.format("kafka").options(**sink_options(servers, topic)).save()


def start_topic(txns: DataFrame, servers: str, topic: str, checkpoint: str):
    """Publish a stream of typed wire rows; returns the running query."""
    return (
        encode_wire(txns)
        .writeStream.format("kafka")
        .options(**sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )
