"""Puts to a keyed store: the last write to a row key wins.

The store kept in files is a log of puts, a folder per load and micro-batch (``sinks.loads``); a
batch appends its own puts and rewrites none of what is there, so its cost does not grow with the
store. Reading takes the latest put of each key. A batch that is run again replaces its folder, and
the keys come from the rows, so nothing doubles. ``merge`` folds a log into a table of the winning puts
that is partitioned by the beginning of the key's salt, so that a lookup by key reads one partition, and
rewrites only those partitions that the log has keys of. ``put_partitions`` feeds a real store instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import cell_rows, cell_struct, complete
from ..functions.keys import PARITY_PATTERN, row_key
from ..operators.windows import latest
from ..schema import ARRIVAL, CELL_FAMILY, DEFAULT_BATCH_ROWS, INCOMPLETE, OK
from ..session import written
from .loads import BATCH_ID, DEFAULT_LOAD, LOAD_ID, batch_folder

#: The first digits of a key's salt part the merged table; two make 256 partitions.
SALT, SALT_DIGITS = "salt", 2
#: The load of a compacted log.
COMPACTED = "compacted"


def keyed_puts(
    rows: DataFrame,
    keep: Sequence[str] = (),
    pattern: str = PARITY_PATTERN,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """One put per complete record: row key, the family's cells, arrival and ``keep``."""
    return rows.filter(complete()).select(
        row_key(order[0], pattern=pattern).alias("rowkey"),
        cell_struct().alias(CELL_FAMILY),
        *order,
        *keep,
    )


def incomplete_rows(rows: DataFrame) -> DataFrame:
    """The records no put can be made of: a cell cannot hold a null."""
    return rows.filter(~complete()).withColumn("verdict", F.lit(INCOMPLETE))


def keyed_verdict() -> Column:
    """The message's verdict, with incomplete records told apart from the good ones."""
    fields = [f"record.{c}" for c in ("uid", "name", "code")]
    return F.when((F.col("verdict") == OK) & ~complete(fields), INCOMPLETE).otherwise(F.col("verdict"))


def latest_puts(puts: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The last put of each key."""
    return latest(puts.drop(LOAD_ID, BATCH_ID), ["rowkey"], order)


def append_batch(puts: DataFrame, batch_id: int, folder: str, load_id: str = DEFAULT_LOAD) -> None:
    """Write a batch's puts as its own folder of the log, sorted for lookups by key."""
    puts.sortWithinPartitions("rowkey").write.mode("overwrite").parquet(batch_folder(folder, batch_id, load_id))


def read_puts(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The whole log; ``schema`` is that of the puts."""
    ids = [T.StructField(LOAD_ID, T.StringType()), T.StructField(BATCH_ID, T.LongType())]
    logged = T.StructType([*schema.fields, *ids])
    return spark.read.schema(logged).parquet(folder)


def compact(spark: SparkSession, folder: str, schema: T.StructType, target: str,
            order: Sequence[str] = ARRIVAL) -> None:
    """Write the log's winning puts, arrival included, as a new log of one load of one batch."""
    append_batch(latest_puts(read_puts(spark, folder, schema), order), 0, target, COMPACTED)


def _salted(puts: DataFrame, digits: int) -> DataFrame:
    return puts.withColumn(SALT, F.substring("rowkey", 1, digits))


def merge(
    spark: SparkSession, folder: str, schema: T.StructType, target: str, order: Sequence[str] = ARRIVAL, digits: int = SALT_DIGITS
) -> None:
    """Fold a log of puts into the table ``target``; a merge that is run again changes nothing.

    ``digits`` is one number for all merges and reads of a table.
    """
    salted = T.StructType([*schema.fields, T.StructField(SALT, T.StringType())])
    spark.createDataFrame([], salted).write.mode("ignore").partitionBy(SALT).parquet(target)
    fresh = _salted(latest_puts(read_puts(spark, folder, schema), order), digits)
    # At most 16 ** digits rows.
    touched = written(fresh.select(SALT).distinct(), "touched-salts")
    held = spark.read.schema(salted).parquet(target).join(touched, SALT, "left_semi")
    won = latest(fresh.unionByName(held), [SALT, "rowkey"], order).select(*salted.names)
    won = written(won, "merged-puts")
    rows = won.repartition(SALT).sortWithinPartitions(SALT, "rowkey")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SALT).parquet(target)


def read_merged(
    spark: SparkSession, target: str, schema: T.StructType, rowkey: str | None = None, digits: int = SALT_DIGITS
) -> DataFrame:
    """The merged puts, or that of one key, from the key's partition alone."""
    puts = spark.read.schema(T.StructType([*schema.fields, T.StructField(SALT, T.StringType())])).parquet(target)
    if rowkey is not None:
        puts = puts.filter((F.col(SALT) == rowkey[:digits]) & (F.col("rowkey") == rowkey))
    return puts.drop(SALT)


def put_cells(puts: DataFrame, keep: Sequence[str] = ("rowkey",)) -> DataFrame:
    """The puts as cells ``(*keep, family, qualifier, value)``."""
    qualifiers = {q: q for q in puts.schema[CELL_FAMILY].dataType.fieldNames()}
    return cell_rows(puts.select(*keep, f"{CELL_FAMILY}.*"), keep, qualifiers)


def _chunks(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    chunk: list[Row] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def put_partitions(
    puts: DataFrame,
    open_store: Callable[[], object],
    *,
    rows_per_put: int = DEFAULT_BATCH_ROWS,
    order: Sequence[str] = ARRIVAL,
) -> None:
    """Send the winning puts to a store, one client per partition.

    ``open_store()`` runs in the task and gives a client with ``put(rows)``, called with up
    to ``rows_per_put`` rows, and ``close()``. A key is in one put of a batch only, so the order in
    which tasks run, or are run again, does not show in the store. ``version``, the arrival time in
    microseconds, is for the store to tell which put is the later one when batches overtake each other,
    as the log does.
    """

    def send(rows: Iterator[Row]) -> None:
        store = open_store()
        try:
            for chunk in _chunks(rows, rows_per_put):
                store.put(chunk)
        finally:
            store.close()

    version = F.unix_micros(F.col(order[0]).cast("timestamp"))
    latest_puts(puts, order).withColumn("version", version).foreachPartition(send)
