"""Records to a Kafka topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.encode import json_bytes
from ..sources.kafka import KERBEROS, prefixed

# The producer's settings. Serializers are not among them: the connector
# takes a key and a value column and sends bytes.
PRODUCER = {
    "acks": "all",
    "retries": 1,
    "batch.size": 16384,
    "linger.ms": 1,
    "buffer.memory": 33554432,
    "max.request.size": 10485760,
}


def producer_options(servers: str, *, security: Mapping[str, str] = KERBEROS) -> dict[str, str]:
    return prefixed({"bootstrap.servers": servers, **PRODUCER, **security})


def kafka_frame(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key STRING, value BINARY``, the value being the record's JSON bytes."""
    return rows.select(F.col(key).cast("string").alias("key"), json_bytes(columns).alias("value"))


def write_topic(frame: DataFrame, topic: str, options: Mapping[str, str]) -> None:
    frame.write.format("kafka").options(**options).option("topic", topic).save()


def topic_writer(frame: DataFrame, topic: str, options: Mapping[str, str]) -> DataStreamWriter:
    return frame.writeStream.format("kafka").options(**options).option("topic", topic)
