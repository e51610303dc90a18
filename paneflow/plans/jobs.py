"""The three jobs, each as what it does with one batch of messages.

A batch is a replayed table or a stream's micro-batch: ``streaming.jobs`` calls the same
functions from ``foreachBatch``. Every write is keyed by the load and the batch's id (``sinks.loads``)
and replaces what an earlier try of that batch wrote; what other loads wrote stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import PARITY_PATTERN
from ..operators.carry import carried_batches, held_batches
from ..operators.quality import classify, dead_letters, good_rows
from ..operators.tap import raw_tap
from ..operators.windows import count_batches, with_window
from ..schema import (
    APPEND_TABLE,
    ARRIVAL,
    BAD_FIELD,
    BAD_JSON,
    BLANK,
    JDBC_JOB_WINDOW,
    KEYED_JOB_BATCH_ROWS,
    KEYED_JOB_WINDOW,
    NOT_OBJECT,
    OK,
    USER,
)
from ..session import written
from ..sinks import jdbc, keyed, ledger, table
from ..sinks.loads import DEFAULT_LOAD, batch_folder


VERDICTS = (OK, BLANK, BAD_JSON, NOT_OBJECT, BAD_FIELD)

#: A folder, or what opens a client with ``put(rows)`` and ``close()``.
KeyedStore = str | Callable[[], object]


@dataclass(frozen=True)
class SideOutputs:
    """What a job gives besides its target; None leaves an output out.

    ``dead_letters`` and ``tap`` are folders. ``report`` is called with the batch's id and its
    messages per verdict, which are counted while the batch is written, not by a job of their own (a
    task that runs again may count twice). ``panes`` is called with the batch's id and a table of the
    rows per pane.
    """

    dead_letters: str | None = None
    tap: str | None = None
    report: Callable[[int, dict[str, int]], None] | None = None
    panes: Callable[[int, DataFrame], None] | None = None


def _write_batch(rows: DataFrame, folder: str, batch_id: int, load_id: str) -> None:
    rows.write.mode("overwrite").parquet(batch_folder(folder, batch_id, load_id))


def _tell_panes(rows: DataFrame, batch_id: int, sides: SideOutputs, *pane: str) -> None:
    if sides.panes:
        sides.panes(batch_id, rows.groupBy(*pane).agg(F.count(F.lit(1)).alias("n")))


@contextmanager
def _checked(
    messages: DataFrame,
    batch_id: int,
    sides: SideOutputs,
    schema: T.StructType = USER,
    load_id: str = DEFAULT_LOAD,
    reused: bool = False,
) -> Iterator[DataFrame]:
    """The classified batch, its side outputs written.

    It is persisted if it is read more than once, so that the gate runs once; blocks lost
    with an executor are computed again from the source. What is done with it inside must run it whole.
    """
    if sides.tap:
        _write_batch(raw_tap(messages), sides.tap, batch_id, load_id)
    classified, seen = classify(messages, schema), Observation()
    if sides.report:
        classified = classified.observe(seen, *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS])
    held = reused or sides.dead_letters
    if held:
        classified = (classified if sides.dead_letters else classified.drop("value")).persist()
    try:
        if sides.dead_letters:
            _write_batch(dead_letters(classified), f"{sides.dead_letters}/messages", batch_id, load_id)
        yield classified
    finally:
        if held:
            classified.unpersist()
    if sides.report:
        sides.report(batch_id, {verdict: n for verdict, n in seen.get.items() if n})


def load_table(
    messages: DataFrame,
    batch_id: int,
    target: str = APPEND_TABLE,
    sides: SideOutputs = SideOutputs(),
    schema: T.StructType = USER,
    load_id: str = DEFAULT_LOAD,
) -> None:
    """Job A: good records to a table. No shuffle from the source to the files."""
    with _checked(messages, batch_id, sides, schema, load_id) as classified:
        table.append_batch(good_rows(classified), batch_id, target, load_id)


def jdbc_panes(good: DataFrame, window: str = JDBC_JOB_WINDOW, ts: str = ARRIVAL[0]) -> DataFrame:
    """Job B's rows with the pane they belong to. A pane is inserted from many tasks, so
    its rows stay where they are."""
    return with_window(good, window, ts)


def load_jdbc(
    messages: DataFrame,
    batch_id: int,
    target: jdbc.JdbcTarget | str,
    sides: SideOutputs = SideOutputs(),
    schema: T.StructType = USER,
    load_id: str = DEFAULT_LOAD,
    *,
    window: str = JDBC_JOB_WINDOW,
    ts: str = ARRIVAL[0],
    keep: Sequence[str] = (),
    **how,
) -> bool:
    """Job B: good records of the batch, in panes, to a database, all or nothing.

    ``target`` is the database, or the folder of a table with the same protocol (``sinks.ledger``). A batch
    that holds several windows, as after an outage, has a pane for each. ``keep`` names further columns
    that the target has, ``window_start`` or those of arrival.
    """
    with _checked(messages, batch_id, sides, schema, load_id) as classified:
        # The transfer has a task per connection. Here the gate runs at full width, once: on disk.
        panes = written(jdbc_panes(good_rows(classified), window, ts), "jdbc-panes")
    _tell_panes(panes, batch_id, sides, "window_start")
    rows = panes.select(*schema.fieldNames(), *keep)
    if isinstance(target, str):
        return ledger.append_batch(rows, batch_id, target, load_id)
    return jdbc.append_batch(rows, batch_id, target, load_id, **how)


def load_keyed(
    messages: DataFrame,
    batch_id: int,
    store: KeyedStore,
    sides: SideOutputs = SideOutputs(),
    *,
    window: str = KEYED_JOB_WINDOW,
    batch_rows: int = KEYED_JOB_BATCH_ROWS,
    pattern: str = PARITY_PATTERN,
    order: Sequence[str] = ARRIVAL,
    totals: str | None = None,
    now_us: int | None = None,
    load_id: str = DEFAULT_LOAD,
) -> T.StructType:
    """Job C: good records as puts, tagged with window and batch, to a keyed store.

    ``store`` is the folder of a log of puts, or opens a store's client in a task
    (``sinks.keyed.put_partitions``). ``totals`` is a folder for the rows per window so far; without it each
    batch of messages is counted by itself. With ``now_us``, the clock, records wait until their batch is
    full or their window ends. Gives the schema of the puts, which reading the store takes.
    """
    with _checked(messages, batch_id, sides, load_id=load_id, reused=True) as classified:
        good = good_rows(classified)
        put_aside(good, batch_id, sides, load_id)
        if totals is None:
            tagged = count_batches(good, window, batch_rows, order)
        elif now_us is not None:
            tagged = held_batches(good, window, batch_rows, totals, batch_id, now_us, order).drop("reason")
        else:
            tagged = carried_batches(good, window, batch_rows, totals, batch_id, order)
        return put_tagged(tagged.drop("rn"), batch_id, store, sides, load_id, pattern=pattern, order=order)


def put_aside(good: DataFrame, batch_id: int, sides: SideOutputs, load_id: str = DEFAULT_LOAD) -> None:
    """The records that no put can be made of, as dead letters."""
    if sides.dead_letters:
        _write_batch(keyed.incomplete_rows(good), f"{sides.dead_letters}/records", batch_id, load_id)


def put_tagged(
    tagged: DataFrame,
    batch_id: int,
    store: KeyedStore,
    sides: SideOutputs = SideOutputs(),
    load_id: str = DEFAULT_LOAD,
    *,
    pattern: str = PARITY_PATTERN,
    order: Sequence[str] = ARRIVAL,
) -> T.StructType:
    """Write rows that have their window and batch; the incomplete ones are left out (``put_aside``)."""
    _tell_panes(tagged, batch_id, sides, "window_start", "batch_no")
    puts = keyed.keyed_puts(tagged, ["window_start", "batch_no"], pattern, order)
    if callable(store):
        keyed.put_partitions(puts, store, order=order)
    else:
        keyed.append_batch(puts, batch_id, store, load_id)
    return puts.schema
