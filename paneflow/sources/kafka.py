"""Kafka topics as a DataFrame of text messages.

The connector is a package of the cluster (``spark-sql-kafka-0-10``); the options
are built here and can be looked at without it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The client security settings.
KERBEROS = {
    "security.protocol": "SASL_PLAINTEXT",
    "sasl.kerberos.service.name": "kafka",
    "sasl.mechanism": "GSSAPI",
}

#: Order of messages that arrived at the same time.
TOPIC_ARRIVAL = ("ts", "topic", "partition", "offset")


def sasl_plain(jaas_config: str) -> dict[str, str]:
    """Security settings for name-and-password login; the caller supplies the JAAS line."""
    return {
        "security.protocol": "SASL_PLAINTEXT",
        "sasl.mechanism": "PLAIN",
        "sasl.jaas.config": jaas_config,
    }


def prefixed(client: Mapping[str, object]) -> dict[str, str]:
    return {f"kafka.{key}": str(value) for key, value in client.items()}


def consumer_options(
    servers: str,
    topic_pattern: str,
    *,
    starting: str = "latest",
    security: Mapping[str, str] = KERBEROS,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options to subscribe to every topic whose whole name matches the pattern.

    A fresh start reads from the latest offsets, a restart from the checkpoint, so no
    consumer group or auto-commit is set. ``max_offsets_per_trigger`` bounds a
    micro-batch after an outage; ``min_partitions`` splits a topic partition that
    holds much more than the others over several tasks.
    """
    options = {
        "subscribePattern": topic_pattern,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
        **prefixed({"bootstrap.servers": servers, **security}),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def topics_frame(records: DataFrame) -> DataFrame:
    """Kafka's record columns as messages: UTF-8 text, arrival time, place in the topic."""
    return records.select(
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("ts"),
        F.col("value").cast("string").alias("value"),
    )


def topic_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return topics_frame(spark.readStream.format("kafka").options(**options).load())


def read_topics(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The same topics as a bounded batch, from the earliest to the latest offset."""
    bounded = {**options, "startingOffsets": "earliest", "endingOffsets": "latest"}
    bounded.pop("maxOffsetsPerTrigger", None)
    return topics_frame(spark.read.format("kafka").options(**bounded).load())
