"""Append to a catalog table, a micro-batch at a time.

The table is partitioned by load and micro-batch (``sinks.loads``) and a batch overwrites its own
partition, so a batch that is run again after a failure replaces what it wrote before, and a new
load adds its rows to those that are there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import APPEND_TABLE, USER
from .loads import BATCH_ID, DEFAULT_LOAD, LOAD_ID, checked_load


def create_append_table(
    spark: SparkSession,
    table: str = APPEND_TABLE,
    schema: T.StructType = USER,
    location: str | None = None,
) -> None:
    """Create the table (and its database) unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    if "." in table:
        database = table.rsplit(".", 1)[0]
        home = f" LOCATION '{location}-database'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{home}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {LOAD_ID} STRING, {BATCH_ID} BIGINT) "
        f"USING parquet PARTITIONED BY ({LOAD_ID}, {BATCH_ID}){place}"
    )


def append_batch(rows: DataFrame, batch_id: int, table: str = APPEND_TABLE, load_id: str = DEFAULT_LOAD) -> None:
    """Write a batch's rows as a partition of the table; one write, no shuffle."""
    spark = rows.sparkSession
    columns = [c for c in spark.table(table).columns if c not in (LOAD_ID, BATCH_ID)]
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} "
        f"PARTITION ({LOAD_ID} = '{checked_load(load_id)}', {BATCH_ID} = {int(batch_id)}) SELECT * FROM {{rows}}",
        rows=rows.select(*columns),
    )


def append_rows(rows: DataFrame, table: str) -> None:
    """Plain append to a table without a batch partition: at least once, like the row by
    row insert it stands for. Columns are matched by name."""
    rows.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=rows)


def read_table(spark: SparkSession, table: str = APPEND_TABLE) -> DataFrame:
    return spark.table(table).drop(LOAD_ID, BATCH_ID)
