"""Windows that come in several micro-batches.

A micro-batch is numbered like any table, spread over the tasks. What it needs from the ones
before is a number per window: how many places of it were given out so far. Each micro-batch writes
these totals, of every window, for a row may come however late, and the next one reads them: a short
row per window, 300,000 in a year of two-minute windows. Two places take turns (``session.slot``), so
nothing piles up, and a micro-batch that is run again finds what it found the first time. Batch ids
count up from 0, and a folder belongs to one checkpoint. A result is to be used before the next
micro-batch is begun.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ARRIVAL
from ..session import read_slot, slot, write_slot
from .numbering import SLICE_ROWS
from .windows import duration_micros, numbered_in_window, tumbling_counts

_HELD = "_held"


def _totals(rows: DataFrame, folder: str, label: str, batch_id: int, ts: str) -> DataFrame:
    """(window_start, n) that a micro-batch wrote."""
    schema = T.StructType([T.StructField("window_start", rows.schema[ts].dataType), T.StructField("n", T.LongType())])
    return read_slot(rows.sparkSession, folder, label, batch_id, schema)


def _counted_on(earlier: DataFrame, rows: DataFrame, size: str, ts: str) -> DataFrame:
    counts = earlier.unionByName(tumbling_counts(rows, size, ts)).groupBy("window_start")
    return counts.agg(F.sum("n").alias("n"))


def _ended(size: str, now_us: int) -> Column:
    return F.unix_micros(F.col("window_start").cast("timestamp")) + duration_micros(size) <= now_us


def _placed(
    rows: DataFrame, earlier: DataFrame, size: str, threshold: int, order: Sequence[str], slice_rows: int
) -> DataFrame:
    """The rows' places ``rn`` and ``batch_no``, after those given out earlier."""
    # A row per window, read from a written table: the planner sees its size.
    before = earlier.withColumnRenamed("n", "_earlier")
    numbered = numbered_in_window(rows, size, order, slice_rows=slice_rows).join(before, "window_start", "left")
    place = numbered.withColumn("rn", F.coalesce("_earlier", F.lit(0).cast("long")) + F.col("rn"))
    return place.withColumn("batch_no", F.expr(f"(rn - 1) div {threshold}")).drop("_earlier")


def carried_batches(
    rows: DataFrame,
    size: str,
    threshold: int,
    folder: str,
    batch_id: int,
    order: Sequence[str] = ARRIVAL,
    *,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """As ``count_batches``, the rows of earlier micro-batches counted in.

    A batch of a window has ``threshold`` rows also where it began in an earlier micro-batch;
    its rows are tagged, and can be written, as they come.
    """
    earlier = _totals(rows, folder, "totals", batch_id - 1, order[0])
    write_slot(_counted_on(earlier, rows, size, order[0]), folder, "totals", batch_id)
    return _placed(rows, earlier, size, int(threshold), order, slice_rows)


def held_batches(
    rows: DataFrame,
    size: str,
    threshold: int,
    folder: str,
    batch_id: int,
    now_us: int,
    order: Sequence[str] = ARRIVAL,
    *,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Batches that fire when they are full, and the rest of a window when it ends by the clock.

    The rows of the batches that fire in this micro-batch, with ``window_start, rn, batch_no, reason``.
    A row's place in its window is given out when it comes, on all tasks, so a batch has exactly
    ``threshold`` rows at any width, and a window one remainder. Rows wait for the rest of their batch in a
    written table: less than a batch for a window that is open. ``now_us`` is the clock at the
    micro-batch. Rows of a window that come after its end fire with the micro-batch they come in, in batches
    of their own numbers. A micro-batch without rows fires what is due.
    """
    threshold, ts = int(threshold), order[0]
    earlier = _totals(rows, folder, "totals", batch_id - 1, ts)
    placed = _placed(rows, earlier, size, threshold, order, slice_rows)
    waiting = T.StructType([*placed.schema.fields, T.StructField(_HELD, T.BooleanType())])
    before = read_slot(rows.sparkSession, folder, "waiting", batch_id - 1, waiting).filter(_HELD).drop(_HELD)

    # After its end a window goes on with a new batch.
    counted = _counted_on(earlier, rows, size, ts)
    known = counted.select("window_start", "n", F.expr(f"n div {threshold}").alias("_full"), _ended(size, now_us).alias("_ended"))
    whole = F.expr(f"(n + {threshold - 1}) div {threshold} * {threshold}")
    totals = known.withColumn("n", F.when(F.col("_ended"), whole).otherwise(F.col("n")))
    told = write_slot(totals, folder, "totals", batch_id).drop("n")

    full = F.col("batch_no") < F.col("_full")
    pool = before.unionByName(placed).join(told, "window_start")
    pool = pool.withColumn("reason", F.when(full, "count").otherwise("window_end")).withColumn(_HELD, ~full & ~F.col("_ended"))
    # The rows that wait lie apart, so the next micro-batch reads only those.
    kept = [*waiting.names, "reason"]
    pool = pool.select(*kept)
    place = slot(folder, "waiting", batch_id)
    pool.write.mode("overwrite").partitionBy(_HELD).parquet(place)
    return rows.sparkSession.read.schema(pool.schema).parquet(place).filter(~F.col(_HELD)).drop(_HELD)


def ended_windows(rows: DataFrame, size: str, folder: str, batch_id: int, now_us: int, ts: str = ARRIVAL[0]) -> DataFrame:
    """(window_start, n) of the windows that end by the clock in this micro-batch, each once.

    Only open windows are kept from one micro-batch to the next. Rows that come after their window was
    given are given as a further row of it, with the next micro-batch, so that every row is in one.
    """
    schema = T.StructType([
        T.StructField("window_start", rows.schema[ts].dataType), T.StructField("n", T.LongType()), T.StructField("given", T.BooleanType()),
    ])
    open_ = read_slot(rows.sparkSession, folder, "open", batch_id - 1, schema).filter(~F.col("given")).drop("given")
    counted = _counted_on(open_, rows, size, ts).withColumn("given", _ended(size, now_us))
    return write_slot(counted, folder, "open", batch_id).filter("given").drop("given")
