"""The three jobs as resumable streams.

A query keeps offsets, state and commits in its checkpoint folder, so a stopped or failed run
goes on where it was when it is started again with the same folder; a new folder is a new load.
A micro-batch that is run again overwrites its own output, and a new load adds to what others wrote
(``sinks.loads``).

Windows of the clock need no state: micro-batches of ``Trigger.ProcessingTime(size)`` start on
multiples of ``size``, so a micro-batch mostly is one pane; where it holds several (the first one,
one after an outage) its rows are tagged with the window they arrived in. That holds whatever the
rate, for the rows of a pane stay spread over the tasks.
Queries that must fire while their topics are silent have the clock as a second source
(``triggers.with_clock``); they need a cadence and run until they are stopped.

What a micro-batch writes on its way is removed when it is done.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.keys import PARITY_PATTERN
from ..operators.carry import ended_windows, held_batches
from ..operators.panes import carried_panes
from ..operators.quality import classify, dead_letters
from ..operators.tap import raw_tap
from ..operators.windows import BatchFunction, each_batch, tumbling_counts, with_window
from ..plans import jobs as plans
from ..plans.jobs import KeyedStore, SideOutputs
from ..schema import (
    APPEND_TABLE,
    ARRIVAL,
    DEFAULT_BATCH_ROWS,
    DEFAULT_FIRE_INTERVAL,
    JDBC_JOB_WINDOW,
    KEYED_JOB_BATCH_ROWS,
    KEYED_JOB_WINDOW,
    TABLE_JOB_CADENCE,
)
from ..sinks.jdbc import JdbcTarget
from ..session import passing_scratch
from ..sinks.loads import BATCH_ID, LOAD_ID, batch_folder
from .triggers import TICK, with_clock


def resumable(
    stream: DataFrame | DataStreamWriter, name: str, checkpoint: str, cadence: str | None
) -> DataStreamWriter:
    """A writer with its checkpoint folder and its cadence; without a cadence the stream
    takes what is there, in as many micro-batches as the source makes, and ends."""
    writer = stream.writeStream if isinstance(stream, DataFrame) else stream
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if cadence is None else writer.trigger(processingTime=cadence)


def load_of(spark: SparkSession, checkpoint: str) -> str:
    """The query's id as its checkpoint keeps it: the same after a restart, new with a new folder."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int, str], object],
    name: str,
    checkpoint: str,
    cadence: str | None,
    mode: str = "append",
) -> StreamingQuery:
    """Hand over each micro-batch with its id and that of its load."""

    @cache
    def load_id() -> str:
        return load_of(stream.sparkSession, checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        with passing_scratch(batch.sparkSession):
            handle(batch, batch_id, load_id())

    return resumable(stream.writeStream.foreachBatch(run).outputMode(mode), name, checkpoint, cadence).start()


def start_clocked(
    stream: DataFrame,
    handle: Callable[[DataFrame, int, str, int], object],
    name: str,
    checkpoint: str,
    cadence: str,
) -> StreamingQuery:
    """As ``start_batches``, at every trigger also without rows, with the clock in microseconds."""
    if cadence is None:
        raise ValueError("what fires by the clock needs a query that runs on")

    def run(batch: DataFrame, batch_id: int, load_id: str) -> None:
        handle(batch.filter(~F.col(TICK)).drop(TICK), batch_id, load_id, time.time_ns() // 1000)

    return start_batches(with_clock(stream), run, name, checkpoint, cadence)


def start_console_tap(messages: DataFrame, checkpoint: str, cadence: str = TABLE_JOB_CADENCE, rows: int = 20) -> StreamingQuery:
    """The raw messages on the console: the first ``rows`` of each micro-batch. For all of
    them give a job a ``tap`` folder."""
    writer = raw_tap(messages).writeStream.format("console").option("numRows", rows).option("truncate", "false")
    return resumable(writer, "tap", checkpoint, cadence).start()


def start_table_job(
    messages: DataFrame,
    checkpoint: str,
    target: str = APPEND_TABLE,
    sides: SideOutputs = SideOutputs(),
    cadence: str | None = TABLE_JOB_CADENCE,
) -> StreamingQuery:
    """Job A: messages to a table."""

    def load(batch: DataFrame, batch_id: int, load_id: str) -> None:
        plans.load_table(batch, batch_id, target, sides, load_id=load_id)

    return start_batches(messages, load, "table-job", checkpoint, cadence)


def start_jdbc_job(
    messages: DataFrame,
    checkpoint: str,
    target: JdbcTarget | str,
    sides: SideOutputs = SideOutputs(),
    cadence: str | None = JDBC_JOB_WINDOW,
    **how,
) -> StreamingQuery:
    """Job B: a window's messages to a database in one transaction, or to the folder of a table with a ledger."""

    def load(batch: DataFrame, batch_id: int, load_id: str) -> None:
        plans.load_jdbc(batch, batch_id, target, sides, load_id=load_id, **how)

    return start_batches(messages, load, "jdbc-job", checkpoint, cadence)


def start_keyed_job(
    messages: DataFrame,
    checkpoint: str,
    store: KeyedStore,
    sides: SideOutputs = SideOutputs(),
    cadence: str | None = KEYED_JOB_WINDOW,
    *,
    window: str = KEYED_JOB_WINDOW,
    batch_rows: int = KEYED_JOB_BATCH_ROWS,
    pattern: str = PARITY_PATTERN,
    order: Sequence[str] = ARRIVAL,
) -> StreamingQuery:
    """Job C: messages to a keyed store, a window to a micro-batch.

    A window that is spread over micro-batches is counted on from one to the next; the totals
    are kept next to the checkpoint. ``order`` names the arrival columns; those of topics are
    ``sources.kafka.TOPIC_ARRIVAL``.
    """
    totals = f"{checkpoint.rstrip('/')}-totals"

    def load(batch: DataFrame, batch_id: int, load_id: str) -> None:
        plans.load_keyed(
            batch,
            batch_id,
            store,
            sides,
            window=window,
            batch_rows=batch_rows,
            pattern=pattern,
            order=order,
            totals=totals,
            load_id=load_id,
        )

    return start_batches(messages, load, "keyed-job", checkpoint, cadence)


def start_keyed_job_by_count(
    messages: DataFrame,
    checkpoint: str,
    store: KeyedStore,
    sides: SideOutputs = SideOutputs(),
    cadence: str = TABLE_JOB_CADENCE,
    *,
    window: str = KEYED_JOB_WINDOW,
    batch_rows: int = KEYED_JOB_BATCH_ROWS,
    pattern: str = PARITY_PATTERN,
    order: Sequence[str] = ARRIVAL,
) -> StreamingQuery:
    """Job C with a record held until its batch is full or its window ends by the clock.

    A batch has exactly ``batch_rows`` records, a window one remainder, on any number of tasks; the
    records that wait are kept next to the checkpoint (``operators.carry.held_batches``).
    """
    kept = f"{checkpoint.rstrip('/')}-totals"

    def load(batch: DataFrame, batch_id: int, load_id: str, now_us: int) -> None:
        how = {"window": window, "batch_rows": batch_rows, "pattern": pattern, "order": order}
        plans.load_keyed(batch, batch_id, store, sides, totals=kept, now_us=now_us, load_id=load_id, **how)

    return start_clocked(messages, load, "keyed-job-by-count", checkpoint, cadence)


def start_early_panes(
    messages: DataFrame,
    checkpoint: str,
    folder: str,
    size: str,
    limit: int,
    interval: str = DEFAULT_FIRE_INTERVAL,
    cadence: str = TABLE_JOB_CADENCE,
    order: Sequence[str] = ARRIVAL,
) -> StreamingQuery:
    """The panes that fire without clearing, by count, by interval and at the window's end, as they fire.

    A window is kept as five numbers; no row is held (``operators.panes.carried_panes``).
    """
    kept = f"{checkpoint.rstrip('/')}-panes"

    def fire(batch: DataFrame, batch_id: int, load_id: str, now_us: int) -> None:
        fired = carried_panes(batch, size, limit, interval, kept, batch_id, now_us, order)
        fired.write.mode("overwrite").parquet(batch_folder(folder, batch_id, load_id))

    return start_clocked(messages.select(*order), fire, "early-panes", checkpoint, cadence)


def start_pane_function(
    messages: DataFrame,
    checkpoint: str,
    folder: str,
    size: str,
    function: BatchFunction,
    schema: str | T.StructType,
    part_rows: int = DEFAULT_BATCH_ROWS,
    cadence: str = TABLE_JOB_CADENCE,
    order: Sequence[str] = ARRIVAL,
) -> StreamingQuery:
    """A function of the caller over each window, in parts of ``part_rows`` rows as they are full and the
    rest when the window ends by the clock (``operators.windows.each_batch``)."""
    kept = f"{checkpoint.rstrip('/')}-parts"

    def call(batch: DataFrame, batch_id: int, load_id: str, now_us: int) -> None:
        parts = held_batches(batch, size, part_rows, kept, batch_id, now_us, order)
        each_batch(parts, function, schema).write.mode("overwrite").parquet(batch_folder(folder, batch_id, load_id))

    return start_clocked(messages, call, "pane-function", checkpoint, cadence)


def start_window_ends(
    messages: DataFrame, checkpoint: str, folder: str, size: str, cadence: str = TABLE_JOB_CADENCE, ts: str = ARRIVAL[0]
) -> StreamingQuery:
    """The rows of each window, given once when it ends by the clock, also while nothing comes."""
    kept = f"{checkpoint.rstrip('/')}-open"

    def give(batch: DataFrame, batch_id: int, load_id: str, now_us: int) -> None:
        given = ended_windows(batch, size, kept, batch_id, now_us, ts)
        given.write.mode("overwrite").parquet(batch_folder(folder, batch_id, load_id))

    return start_clocked(messages.select(ts), give, "window-ends", checkpoint, cadence)


def start_window_reducers(
    messages: DataFrame,
    checkpoint: str,
    folder: str,
    size: str,
    cadence: str | None = TABLE_JOB_CADENCE,
    order: Sequence[str] = ARRIVAL,
) -> StreamingQuery:
    """The reducers of a window on a stream: its counter and its last row, whatever the order rows come in.

    Spark's own aggregation keeps a row per window and gives those that changed; each micro-batch writes
    them, and ``read_window_reducers`` takes the latest of each window.
    """
    rest = [c for c in messages.columns if c != "window_start"]
    reduced = with_window(messages, size, order[0]).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("c"), F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    )

    def write(batch: DataFrame, batch_id: int, load_id: str) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(folder, batch_id, load_id))

    return start_batches(reduced, write, "window-reducers", checkpoint, cadence, "update")


def read_window_reducers(spark: SparkSession, folder: str) -> DataFrame:
    """``window_start``, the counter ``c`` and the columns of the last row, of all windows so far."""
    rows = spark.read.parquet(folder).drop(LOAD_ID, BATCH_ID)
    # The counter only grows, so the row of the highest is the latest.
    latest = rows.groupBy("window_start").agg(F.max("c").alias("c"), F.max_by("last", "c").alias("last"))
    return latest.select("window_start", "c", "last.*")


def start_window_counts(
    messages: DataFrame,
    checkpoint: str,
    folder: str,
    size: str,
    cadence: str | None = TABLE_JOB_CADENCE,
    ts: str = ARRIVAL[0],
) -> StreamingQuery:
    """Rows per window, a partial count per micro-batch, so that a row counts however late it is.

    ``read_window_counts`` sums them up. No state is held, and a row without a time is an error.
    """

    def count(batch: DataFrame, batch_id: int, load_id: str) -> None:
        tumbling_counts(batch, size, ts).write.mode("overwrite").parquet(batch_folder(folder, batch_id, load_id))

    return start_batches(messages, count, "window-counts", checkpoint, cadence)


def read_window_counts(spark: SparkSession, folder: str, time: T.DataType | None = None) -> DataFrame:
    """``window_start, n`` of all windows so far; ``time`` is the type of the arrival time."""
    kind = T.StructType([T.StructField("window_start", time or T.TimestampType()), T.StructField("n", T.LongType())])
    return spark.read.schema(kind).parquet(folder).groupBy("window_start").agg(F.sum("n").alias("n"))


def start_tap(messages: DataFrame, checkpoint: str, folder: str, cadence: str | None = TABLE_JOB_CADENCE) -> StreamingQuery:
    """All raw messages as files of their own, each once."""
    writer = raw_tap(messages).writeStream.format("parquet").option("path", folder)
    return resumable(writer, "raw-tap", checkpoint, cadence).start()


def start_dead_letters(
    messages: DataFrame, checkpoint: str, folder: str, cadence: str | None = TABLE_JOB_CADENCE
) -> StreamingQuery:
    """The rejected messages as files of their own, each once (the file sink's log)."""
    dead = dead_letters(classify(messages))
    writer = dead.writeStream.format("parquet").option("path", folder)
    return resumable(writer, "dead-letters", checkpoint, cadence).start()
