"""The raw tap: every message as it came, before any check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what the tap prints before each message.
TAP_PREFIX = "kafka-info:> "


def tap_line(value: str = "value") -> Column:
    return F.concat(F.lit(TAP_PREFIX), F.coalesce(F.col(value), F.lit("null")))


def raw_tap(messages: DataFrame, value: str = "value") -> DataFrame:
    return messages.select(tap_line(value).alias("line"))
