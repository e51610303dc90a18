"""Append to a table of files by the protocol of the JDBC sink: staging, ledger, one commit per batch.

A batch is staged, then moved to the target unless the ledger has it (an anti join by load and batch,
``sinks.loads``), and shows from the moment the ledger names it: readers take the batches of the ledger only.
A batch that fails half-way is not seen, and running it again replaces what it left; one that is in the
ledger is left as it is. It stands where there is no database, or ahead of one that loads from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove
from .loads import BATCH_ID, DEFAULT_LOAD, LOAD_ID, batch_folder, checked_load

_KEY = [LOAD_ID, BATCH_ID]
_LEDGER = f"n_rows long, {LOAD_ID} string, {BATCH_ID} long"


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """(n_rows, load_id, batch_id) of the batches that are in the table."""
    place = f"{folder}/ledger"
    spark.createDataFrame([], _LEDGER).write.mode("ignore").parquet(f"{place}/{LOAD_ID}=none/{BATCH_ID}=-1")
    return spark.read.schema(_LEDGER).parquet(place)


def append_batch(rows: DataFrame, batch_id: int, folder: str, load_id: str = DEFAULT_LOAD) -> bool:
    """Write a batch once. True if it was written, False if the ledger had it already."""
    spark, folder = rows.sparkSession, folder.rstrip("/")
    staging = batch_folder(f"{folder}/staging", batch_id, load_id)
    rows.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(rows.schema).parquet(staging)
    tagged = staged.withColumns({LOAD_ID: F.lit(checked_load(load_id)), BATCH_ID: F.lit(int(batch_id)).cast("long")})
    entry = tagged.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    known = read_ledger(spark, folder)
    done = not known.filter((F.col(LOAD_ID) == load_id) & (F.col(BATCH_ID) == int(batch_id))).isEmpty()
    fresh = tagged.join(known.select(*_KEY), _KEY, "left_anti")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_KEY).parquet(f"{folder}/rows")
    if not done:
        none = spark.createDataFrame([(0, load_id, int(batch_id))], _LEDGER)
        counted = entry.unionByName(none).groupBy(*_KEY).agg(F.sum("n_rows").alias("n_rows"))
        counted.drop(*_KEY).coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{folder}/ledger", batch_id, load_id))
    remove(spark, staging)
    return not done


def read_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of the batches in the ledger; ``schema`` is that of the rows."""
    key = [T.StructField(LOAD_ID, T.StringType()), T.StructField(BATCH_ID, T.LongType())]
    rows = spark.read.schema(T.StructType([*schema.fields, *key])).parquet(f"{folder.rstrip('/')}/rows")
    return rows.join(read_ledger(spark, folder.rstrip("/")).select(*_KEY), _KEY, "left_semi").select(*schema.names)
