"""Files and tables in the place of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def line_stream(spark: SparkSession, folder: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of text lines from the files that arrive in a folder.

    The arrival time is the micro-batch's clock; a line's place in its file is
    not known, so use ``message_stream`` where the order within a batch matters.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).select("value", F.current_timestamp().alias("ts"))


def line_table(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the files in a folder, as a batch."""
    return spark.read.text(folder)


def message_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of stored messages (parquet), arrival columns and all."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)
