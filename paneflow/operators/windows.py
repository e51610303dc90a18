"""Tumbling windows over all messages, their batches and their lists.

Windows are aligned to the epoch and closed-open. A pane's rows stay rows, tagged with
``window_start`` and ``batch_no``; sinks write those in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ARRIVAL, DEFAULT_BATCH_ROWS
from .numbering import SLICE_ROWS, number_rows

#: Batch numbers that one row of ``pane_counts`` is unfolded to at a time.
NUMBER_BLOCK = 1 << 17

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(duration: str) -> int:
    """Microseconds of a duration such as ``5 minutes``."""
    amount, unit = duration.split()
    return int(amount) * _UNIT_MICROS[unit.rstrip("s")]


def slice_of(size: str, parts: int) -> str:
    """A ``parts``-th of a window of ``size``, or of fewer parts if that does not divide."""
    micros = duration_micros(size)
    while parts > 1 and micros % parts:
        parts -= 1
    return f"{micros // parts} microseconds"


def window_start(size: str, ts: str = "ts") -> Column:
    """The start of a row's window.

    ``window`` leaves out rows without a time. A message always has an arrival time, so a
    missing one is an error of the source and fails the query.
    """
    missing = F.raise_error(F.lit(f"a message has no arrival time ({ts})"))
    return F.window(F.coalesce(F.col(ts), missing), size)["start"]


def with_window(rows: DataFrame, size: str, ts: str = "ts") -> DataFrame:
    return rows.withColumn("window_start", window_start(size, ts))


def tumbling_counts(rows: DataFrame, size: str, ts: str = "ts") -> DataFrame:
    """Rows per window. Counted before the shuffle, so a hot window is one small row
    per task; an empty window gives no row."""
    return (
        with_window(rows, size, ts)
        .groupBy("window_start")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def numbered_in_window(
    rows: DataFrame,
    size: str,
    order: Sequence[str] = ARRIVAL,
    *,
    last: bool = False,
    method: str = "auto",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``window_start``, ``rn``, a row's place in its window, and if asked for ``is_last``."""
    return number_rows(
        with_window(rows, size, order[0]),
        ["window_start"],
        order,
        lambda parts: window_start(slice_of(size, parts), order[0]),
        last=last,
        method=method,
        slice_rows=slice_rows,
    )


def count_batches(
    rows: DataFrame,
    size: str,
    threshold: int = DEFAULT_BATCH_ROWS,
    order: Sequence[str] = ARRIVAL,
    *,
    method: str = "auto",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Tag each row with ``window_start``, ``batch_no`` and ``rn``, its place in the window.

    In each window every ``threshold`` rows make a batch, in arrival order, and the
    rest make the last one when the window ends.
    """
    numbered = numbered_in_window(rows, size, order, method=method, slice_rows=slice_rows)
    return numbered.withColumn("batch_no", F.expr(f"(rn - 1) div {int(threshold)}"))


def batch_summary(members: DataFrame, row_id: str = ARRIVAL[-1]) -> DataFrame:
    """Size, first and last row of each batch; a batch's rows meet before the shuffle."""
    return members.groupBy("window_start", "batch_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(row_id, "rn").alias("first_id"),
        F.max_by(row_id, "rn").alias("last_id"),
    )


def pane_counts(rows: DataFrame, size: str, threshold: int, ts: str = "ts") -> DataFrame:
    """Rows per batch, from the window counts alone: no row is numbered or moved."""
    return batch_sizes(tumbling_counts(rows, size, ts), threshold)


def batch_sizes(counted: DataFrame, threshold: int) -> DataFrame:
    """The batches of windows of ``n`` rows. Their numbers are unfolded block by block, and the blocks
    of a large window are spread, so that no array holds them all."""
    last = F.expr(f"(n - 1) div {int(threshold)}")
    first = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {int(threshold)} div {NUMBER_BLOCK}"))
    blocks = counted.select("window_start", "n", F.explode(first).alias("block")).repartition("window_start", "block")
    start = F.col("block") * NUMBER_BLOCK
    numbers = F.sequence(start, F.least(last, start + (NUMBER_BLOCK - 1)))
    batches = blocks.select("window_start", "n", F.explode(numbers).alias("batch_no"))
    held = F.least(F.lit(threshold).cast("long"), F.col("n") - F.col("batch_no") * threshold)
    return batches.select("window_start", "batch_no", held.alias("n"))


def window_lists(
    rows: DataFrame,
    size: str,
    fields: Sequence[str],
    order: Sequence[str] = ARRIVAL,
    *,
    list_rows: int = DEFAULT_BATCH_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """A window's records as lists, in arrival order.

    A list has up to ``list_rows`` records: a window with more gives several, numbered
    by ``list_no``, so that no single array holds a window of any size.
    """
    numbered = numbered_in_window(rows, size, order, slice_rows=slice_rows)
    list_no = F.expr(f"(rn - 1) div {int(list_rows)}").alias("list_no")
    item = F.struct("rn", F.struct(*fields).alias("record"))
    return (
        numbered.groupBy("window_start", list_no)
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select(
            "window_start",
            "list_no",
            F.size("items").cast("long").alias("n"),
            F.col("items.record").alias("records"),
        )
    )


#: Of a batch's window, number and rows (in order, an Arrow batch), the rows it becomes.
BatchFunction = Callable[[object, int, pa.RecordBatch], pa.RecordBatch]


def each_batch(tagged: DataFrame, function: BatchFunction, schema: str | T.StructType) -> DataFrame:
    """A function of the caller over every batch of every window.

    ``tagged`` has ``window_start``, ``batch_no`` and ``rn``, as from ``count_batches`` or, on a stream,
    ``operators.carry.held_batches``. A pane of any size comes in its batches, which are bounded and spread
    over the tasks; the function holds one of them.
    """
    place = ["window_start", "batch_no"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def key(batch: pa.RecordBatch, row: int) -> tuple:
            return batch["window_start"][row].as_py(), batch["batch_no"][row].as_py()

        def called() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return function(*key(whole, 0), whole)

        for batch in batches:
            if not batch.num_rows:
                continue
            starts, numbers = (batch[c].cast(pa.int64()).to_numpy() for c in place)
            turns = np.flatnonzero((np.diff(starts) != 0) | (np.diff(numbers) != 0)) + 1
            edges = [0, *turns.tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:], strict=False):
                piece = batch.slice(begin, end - begin)
                if held and key(held[0], 0) != key(piece, 0):
                    yield called()
                    held = []
                held.append(piece)
        if held:
            yield called()

    return tagged.repartition(*place).sortWithinPartitions(*place, "rn").mapInArrow(work, schema)


def running_count(
    rows: DataFrame,
    size: str,
    order: Sequence[str] = ARRIVAL,
    *,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The counter's value after each row of a window (a running sum of ones)."""
    return numbered_in_window(rows, size, order, slice_rows=slice_rows).withColumnRenamed("rn", "c")


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The last row, in arrival order, of each combination of ``keys``.

    Each task passes on one row per key, so a key that holds a large part of the rows does
    not load the task where it meets.
    """
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def keep_latest(rows: DataFrame, size: str, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The last row of each window."""
    return latest(with_window(rows, size, order[0]), ["window_start"], order)
