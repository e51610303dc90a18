"""Early panes: the trigger that fires without clearing.

Contract, per window, with rows in arrival order, a limit of N rows and an interval I.
``c`` counts the rows since the last firing, ``d`` is the deadline, at first unset:

* before a row: if ``d`` is at or before the row's time, fire ``interval`` at ``d``
  (on a tie the timer goes first);
* the row: add it; if ``c`` reaches N fire ``count`` at the row's time, else if ``d`` is
  unset set it to the row's time + I;
* end of the window: if ``d`` is before the end, fire ``interval`` at ``d``; then, if rows
  came since the last firing, fire ``window_end``;
* a firing sets ``c`` to 0 and unsets ``d``; the pane holds all rows since the start of
  the window.

A pane is given as ``(window_start, pane_no, fired_at, reason, n_rows, last row)``: its
contents are the window's first ``n_rows`` rows, and writing those out for each pane would
grow with the square of the window.

How it is spread: a window's rows are numbered and cut into blocks of ``block_rows``. The
state on entering a block follows from the block before, so blocks are chained in three
steps. (1) Each block, by itself, works out what it does for every state it could be
entered in; between two firings there are at most N rows, so its first N rows as possible
starts cover all of them. (2) Those tables (N entries, whatever the data) are combined in
groups of ``FAN`` until one group per window is left, and the entry states are handed back
down. (3) Each block, entered in its now known state, lists its panes. A window that fits
one block, as nearly all do, skips steps 1 and 2.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..schema import ARRIVAL, DEFAULT_FIRE_INTERVAL
from ..session import read_slot, write_slot, written
from .numbering import SLICE_ROWS
from .windows import duration_micros, numbered_in_window, with_window

COUNT, INTERVAL, WINDOW_END = "count", "interval", "window_end"

BLOCK_ROWS = 1_000_000
#: Blocks combined by one task; each brings a table of N entries.
FAN = 32

UNSET = np.iinfo(np.int64).max


def panes_by_count(
    rows: DataFrame,
    size: str,
    limit: int,
    order: Sequence[str] = ARRIVAL,
    *,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Panes of the trigger when the interval never comes first (I at least the window):
    one per ``limit`` rows, and one at the end for a rest."""
    numbered = numbered_in_window(rows, size, order, last=True, slice_rows=slice_rows)
    full = F.col("rn") % limit == 0
    return numbered.filter(full | F.col("is_last")).select(
        "window_start",
        F.expr(f"(rn + {limit - 1}) div {limit}").alias("pane_no"),
        F.when(full, COUNT).otherwise(WINDOW_END).alias("reason"),
        F.col("rn").alias("n_rows"),
        F.col(order[-1]).alias("last_id"),
    )


# --- inside a task: one block of a window, as numpy arrays --------------------------
# A state is (c, d): rows since the last firing and the deadline; c = 0 means d is unset.


def _next_start(at: np.ndarray, limit: int, interval: int) -> np.ndarray:
    """For a pane that begins at row i, the row the next one begins at (len(at): none here
    by the timer, or the row after the block)."""
    by_time = np.searchsorted(at, at + interval, side="left")
    return np.minimum(np.arange(len(at)) + limit, by_time)


def block_table(at: np.ndarray, limit: int, interval: int) -> dict[str, np.ndarray]:
    """What a full block (at least ``limit`` rows) does, per row a pane may begin at:
    the state it is left in and the panes fired."""
    size = len(at)
    following = _next_start(at, limit, interval)
    # Follow the panes from every row at once, twice as far each time.
    start = np.where(following < size, following, np.arange(size))
    fired = (following < size).astype(np.int64)
    while not np.array_equal(further := start[start], start):
        fired += fired[start]
        start = further
    start, fired = start[:limit], fired[:limit]
    # The pane open at the end either fills up exactly on the last row or stays open.
    fills = (start + limit == size) & (at[-1] < at[start] + interval)
    return {
        "head": at[:limit],
        "c": np.where(fills, 0, size - start),
        "d": np.where(fills, UNSET, at[start] + interval),
        "fired": fired + fills,
    }


def through_block(
    table: dict[str, np.ndarray], c: np.ndarray, d: np.ndarray, fired: np.ndarray, limit: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Take states through a full block, by its table."""
    by_count = limit - c
    by_time = np.searchsorted(table["head"], d, side="left")
    begin = np.where(c == 0, 0, np.minimum(by_count, by_time))
    first_fires = (c > 0).astype(np.int64)
    return table["c"][begin], table["d"][begin], fired + first_fires + table["fired"][begin]


class Replay(NamedTuple):
    """Panes fired, in order: piece, time, whether by count, and the row after the pane's last; then the
    state that each piece is left in."""

    piece: np.ndarray
    at: np.ndarray
    by_count: np.ndarray
    upto: np.ndarray
    c: np.ndarray
    d: np.ndarray


def _chain(begin: np.ndarray, following: np.ndarray, end: int) -> np.ndarray:
    """All rows reached from ``begin`` by ``following``, sorted; ``end`` leads nowhere.

    Pointer doubling: what is reached in 2^k steps, and a table of 2^k steps, give the next 2^k.
    """
    hop, reached = np.append(following, end), begin[begin < end]
    fresh = reached
    while len(fresh):
        fresh = hop[reached]
        fresh = fresh[fresh < end]
        reached = np.concatenate([reached, fresh])
        hop = hop[hop]
    return np.sort(reached)


def replay(at: np.ndarray, edges: np.ndarray, c: np.ndarray, d: np.ndarray, limit: int, interval: int) -> Replay:
    """Take states (c, d), one for each piece, through the pieces of the sorted rows between ``edges``."""
    size, first, last = len(at), edges[:-1], edges[1:]
    piece = np.repeat(np.arange(len(first)), last - first)
    stop = last[piece]
    full = np.arange(size) + limit
    timed = np.minimum(np.searchsorted(at, at + interval, side="left"), stop)
    fills, expires = full <= timed, (full > timed) & (timed < stop)
    upto = np.minimum(full, timed)

    # The pane that is open on entering a piece.
    filled = first + limit - c
    expired = np.clip(np.searchsorted(at, d, side="left"), first, last)
    entered = c > 0
    entry_fills = entered & (filled <= expired)
    entry_expires = entered & ~entry_fills & (expired < last)
    begin = np.where(entry_fills, filled, np.where(entry_expires, expired, np.where(entered, last, first)))

    starts = _chain(np.where(begin < last, begin, size), np.where(upto < stop, upto, size), size)
    fired = starts[fills[starts] | expires[starts]]
    entry = np.flatnonzero(entry_fills | entry_expires)
    by_entry = np.where(entry_fills, filled, expired)[entry]
    pieces = np.concatenate([entry, piece[fired]])
    ends = np.concatenate([by_entry, upto[fired]])
    times = np.concatenate(
        [
            np.where(entry_fills[entry], at[np.clip(by_entry - 1, 0, size - 1)], d[entry]) if size else d[entry],
            np.where(fills[fired], at[np.minimum(full[fired], size) - 1], at[fired] + interval) if size else at[fired],
        ]
    )
    counted = np.concatenate([entry_fills[entry], fills[fired]])
    order = np.lexsort((ends, pieces))

    still = entered & ~entry_fills & ~entry_expires
    c_out, d_out = np.where(still, c + last - first, 0), np.where(still, d, UNSET)
    open_ = starts[~(fills[starts] | expires[starts])]
    c_out[piece[open_]], d_out[piece[open_]] = stop[open_] - open_, at[open_] + interval
    return Replay(pieces[order], times[order], counted[order], ends[order], c_out, d_out)


def _table(row) -> dict[str, np.ndarray]:
    return {name: np.asarray(getattr(row, name)) for name in ("head", "c", "d", "fired")}


_TABLE_FIELDS = "window_us long, block long, head array<long>, c array<long>, d array<long>, fired array<long>"
_ENTRY_FIELDS = "window_us long, block long, entry_c long, entry_d long, entry_fired long"


def _block_tables(blocks: DataFrame, limit: int, interval: int) -> DataFrame:
    def table(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = block_table(np.sort(rows["at_us"].to_numpy()), limit, interval)
        return pd.DataFrame([{"window_us": key[0], "block": key[1], **made}])

    return blocks.select("window_us", "block", "at_us").groupBy("window_us", "block").applyInPandas(
        table, _TABLE_FIELDS
    )


def _combined(tables: DataFrame, limit: int) -> DataFrame:
    """One table per ``FAN`` successive ones."""

    def combine(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        chain = [_table(row) for row in group.sort_values("block").itertuples()]
        head, (c, d, fired) = chain[0]["head"], (chain[0][k] for k in ("c", "d", "fired"))
        for table in chain[1:]:
            c, d, fired = through_block(table, c, d, fired, limit)
        made = {"head": head, "c": c, "d": d, "fired": fired}
        return pd.DataFrame([{"window_us": key[0], "block": key[1], **made}])

    above = F.expr(f"block div {FAN}").alias("above")
    return tables.groupBy("window_us", above).applyInPandas(combine, _TABLE_FIELDS)


def _entries(tables: DataFrame, entries: DataFrame | None, limit: int) -> DataFrame:
    """Entry state of each block and of the one after, from that of its group; none is no state."""

    def chain(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        state = tuple(
            np.array([group[name].iloc[0]], dtype=np.int64)
            for name in ("entry_c", "entry_d", "entry_fired")
        )
        found = []
        for row in group.itertuples():
            found.append((row.window_us, row.block, *(int(part[0]) for part in state)))
            state = through_block(_table(row), *state, limit)
        # Also the entry of the block after: it may be a window's last, which has no table.
        found.append((key[0], found[-1][1] + 1, *(int(part[0]) for part in state)))
        return pd.DataFrame(found, columns=["window_us", "block", "entry_c", "entry_d", "entry_fired"])

    above = F.expr(f"block div {FAN}")
    grouped = tables.withColumn("above", above)
    if entries is not None:
        grouped = grouped.join(entries.withColumnRenamed("block", "above"), ["window_us", "above"], "left")
        grouped = grouped.fillna({"entry_c": 0, "entry_d": UNSET, "entry_fired": 0})
    else:
        grouped = (
            grouped.withColumn("entry_c", F.lit(0).cast("long"))
            .withColumn("entry_d", F.lit(UNSET))
            .withColumn("entry_fired", F.lit(0).cast("long"))
        )
    # A block that begins a group is named by its own group and by the one before.
    return grouped.groupBy("window_us", "above").applyInPandas(chain, _ENTRY_FIELDS).distinct()


def _entry_states(passing: DataFrame, highest: int, limit: int, interval: int, earlier: DataFrame) -> DataFrame:
    """Entry state of every block that comes after one of the ``passing`` blocks, and of the windows' first
    blocks, which are entered in the state of ``earlier``."""
    levels = [written(_block_tables(passing, limit, interval), "block-tables")]
    while highest >= FAN:
        levels.append(written(_combined(levels[-1], limit), "block-tables"))
        highest //= FAN
    entries = earlier.select("window_us", F.lit(0).cast("long").alias("block"), "entry_c", "entry_d", "entry_fired")
    for tables in reversed(levels):
        entries = written(_entries(tables, entries, limit), "block-entries")
    return entries


def _replayed(
    blocks: DataFrame, order: Sequence[str], limit: int, interval: int, width: int, block_rows: int, go_on: bool
) -> DataFrame:
    """The panes of all blocks; ``blocks`` has the state in which each is entered.

    The blocks of a partition run through one task in order, an Arrow batch at a time with the open
    pane carried along, so neither many small windows nor a large one cost more than their rows, and
    a batch is replayed by whole arrays, however many panes it has. At a window's last block the open
    pane fires, or with ``go_on`` the state it is left in is given as a row without a reason, ``c`` and
    the deadline in ``fired_us``.
    """
    row_id = order[-1]
    id_type = to_arrow_type(blocks.schema[row_id].dataType)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), id_type, pa.int64()]
    names = ["window_us", "pane_no", "fired_us", "reason", "n_rows", "last_id", "c"]

    def rows_of(*columns) -> pa.RecordBatch:
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def closed(window, pane_no, n_rows, ids, is_last, c, d) -> pa.RecordBatch:
        """What the last blocks of windows give at their end."""
        mine = np.flatnonzero(is_last if go_on else is_last & (c > 0))
        window, pane_no, n_rows, c, d = (x[mine] for x in (window, pane_no, n_rows, c, d))
        ids = ids.take(pa.array(mine))
        if go_on:
            return rows_of(window, pane_no, d, pa.nulls(len(mine), pa.string()), n_rows, ids, c)
        timed = d < window + width
        fired = np.where(timed, d, window + width)
        return rows_of(window, pane_no + 1, fired, np.where(timed, INTERVAL, WINDOW_END).tolist(), n_rows, ids, np.zeros(len(mine), np.int64))

    def replay_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The piece that may go on in the next batch: its key, then what ``closed`` takes.
        held: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {n: batch[n].to_numpy(zero_copy_only=False) for n in batch.schema.names if n not in (*order[1:], "entry_id")}
            windows, numbers, at, ids = column["window_us"], column["block"], column["at_us"], batch[row_id]
            turns = np.flatnonzero((np.diff(windows) != 0) | (np.diff(numbers) != 0)) + 1
            edges = np.concatenate([[0], turns, [len(at)]])
            first = edges[:-1]
            c, d, pane_no = (column[n][first].copy() for n in ("entry_c", "entry_d", "entry_fired"))
            n_rows = numbers[first] * block_rows + column["entry_n"][first]
            before = batch["entry_id"].take(pa.array(first))
            if held is not None:
                if held[0] == (windows[0], numbers[0]):
                    pane_no[0], n_rows[0], c[0], d[0] = held[2][0], held[3][0], held[6][0], held[7][0]
                    before = pa.concat_arrays([held[4], before.slice(1)])
                else:
                    yield closed(*held[1:])
            found = replay(at, edges, c, d, limit, interval)
            nth = np.arange(len(found.piece)) - np.searchsorted(found.piece, found.piece, side="left")
            none = found.upto == first[found.piece]
            last = pc.if_else(pa.array(none), before.take(pa.array(found.piece)), ids.take(pa.array(np.maximum(found.upto - 1, 0))))
            if len(found.piece):
                yield rows_of(
                    windows[first][found.piece], pane_no[found.piece] + nth + 1, found.at, np.where(found.by_count, COUNT, INTERVAL).tolist(),
                    n_rows[found.piece] + found.upto - first[found.piece], last, np.zeros(len(found.piece), np.int64),
                )
            state = (
                windows[first], pane_no + np.bincount(found.piece, minlength=len(first)), n_rows + np.diff(edges),
                ids.take(pa.array(edges[1:] - 1)), column["is_last"][first].astype(bool), found.c, found.d,
            )
            yield closed(*(x[:-1] for x in state))
            held = ((windows[-1], numbers[-1]), *(x[-1:] for x in state))
        if held is not None:
            yield closed(*held[1:])

    spark_type = blocks.schema[row_id].dataType.simpleString()
    return (
        blocks.repartition("window_us", "block")
        .sortWithinPartitions("window_us", "block", "at_us", *order[1:])
        .mapInArrow(
            replay_all,
            f"window_us long, pane_no long, fired_us long, reason string, n_rows long, last_id {spark_type}, c long",
        )
    )


def _no_state(rows: DataFrame, row_id: str) -> DataFrame:
    """The state of windows of which no row came so far: none."""
    row_type = rows.schema[row_id].dataType.simpleString()
    kind = f"window_us long, entry_c long, entry_d long, entry_fired long, entry_n long, entry_id {row_type}"
    return rows.sparkSession.createDataFrame([], kind)


def _found(
    rows: DataFrame, size: str, limit: int, interval: str, order: Sequence[str], block_rows: int, slice_rows: int,
    earlier: DataFrame | None,
) -> DataFrame:
    """The panes, in microseconds; with ``earlier``, the windows' states so far, those after the rows as well."""
    ts, row_id = order[0], order[-1]
    block_rows = max(block_rows, limit)
    width, gap = duration_micros(size), duration_micros(interval)
    go_on = earlier is not None
    earlier = earlier if go_on else _no_state(rows, row_id)
    # Only arrival and id go on, never the payload.
    rows = with_window(rows.select(*order), size, ts)
    slim = [
        F.unix_micros(F.col("window_start").cast("timestamp")).alias("window_us"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("at_us"),
        *order[1:],
    ]
    counts = rows.groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))
    # At most (all rows / block_rows) windows.
    large = written(counts.filter(F.col("n") > block_rows), "large-windows")
    largest = large.agg(F.max("n")).first()[0]

    whole = rows if largest is None else rows.join(large, "window_start", "left_anti")
    blocks = whole.select(*slim, F.lit(0).cast("long").alias("block"), F.lit(True).alias("is_last"))
    if go_on:
        blocks = blocks.join(earlier, "window_us", "left")
    else:  # no window began in a state
        nothing = {f.name: F.lit(None).cast(f.dataType) for f in earlier.schema.fields if f.name != "window_us"}
        blocks = blocks.withColumns(nothing)
    if largest is not None:
        split = rows.join(large, "window_start").drop("window_start")
        numbered = written(
            numbered_in_window(split, size, order, slice_rows=slice_rows)
            .withColumn("block", F.expr(f"(rn - 1) div {block_rows}"))
            .select(*slim, "block", (F.expr(f"(block + 1) * {block_rows}") >= F.col("n")).alias("is_last")),
            "pane-blocks",
        )
        passing = numbered.filter(~F.col("is_last"))
        highest = (largest - 1) // block_rows - 1
        entries = _entry_states(passing, highest, limit, gap, earlier)
        # The last row before a block, for a timer that fires ahead of its first row.
        arrival = F.struct("at_us", *order[1:])
        before = passing.groupBy("window_us", (F.col("block") + 1).alias("block")).agg(
            F.max(arrival)[row_id].alias("entry_id")
        )
        first = earlier.select("window_us", F.lit(0).cast("long").alias("block"), "entry_id")
        entered = entries.join(before.unionByName(first), ["window_us", "block"], "left")
        entered = entered.join(earlier.select("window_us", "entry_n"), "window_us", "left")
        blocks = blocks.unionByName(numbered.join(entered, ["window_us", "block"], "left"))
    blocks = blocks.fillna({"entry_c": 0, "entry_d": UNSET, "entry_fired": 0, "entry_n": 0})
    return _replayed(blocks, order, limit, gap, width, block_rows, go_on)


def _in_time(found: DataFrame, rows: DataFrame, ts: str) -> DataFrame:
    time_type = rows.schema[ts].dataType

    def time(name: str):
        return F.timestamp_micros(F.col(name)).cast(time_type)

    return found.select(
        time("window_us").alias("window_start"),
        "pane_no",
        time("fired_us").alias("fired_at"),
        "reason",
        "n_rows",
        "last_id",
    )


def panes(
    rows: DataFrame,
    size: str,
    limit: int,
    interval: str = DEFAULT_FIRE_INTERVAL,
    order: Sequence[str] = ARRIVAL,
    *,
    block_rows: int = BLOCK_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Panes of the trigger with a row limit and an interval (the contract above)."""
    found = _found(rows, size, limit, interval, order, block_rows, slice_rows, None)
    return _in_time(found, rows, order[0])


def carried_panes(
    rows: DataFrame,
    size: str,
    limit: int,
    interval: str,
    folder: str,
    batch_id: int,
    now_us: int,
    order: Sequence[str] = ARRIVAL,
    *,
    block_rows: int = BLOCK_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The panes that fire in a micro-batch that ends at ``now_us``, windows going on from those before.

    A window's state is five numbers and an id, in a written table (``session.slot``). After the rows the
    clock fires what is due: deadlines that passed, and the open panes of windows that ended. Rows that come
    later still count on and fire with the micro-batch they come in. The result is to be used before the
    next micro-batch is begun.
    """
    row_id = order[-1]
    kind = _no_state(rows, row_id).schema
    earlier = read_slot(rows.sparkSession, folder, "pane-states", batch_id - 1, kind)
    replayed = write_slot(_found(rows, size, limit, interval, order, block_rows, slice_rows, earlier), folder, "pane-found", batch_id)
    after = replayed.filter("reason is null").select(
        "window_us", F.col("c").alias("entry_c"), F.col("fired_us").alias("entry_d"), F.col("pane_no").alias("entry_fired"),
        F.col("n_rows").alias("entry_n"), F.col("last_id").alias("entry_id"),
    )
    states = earlier.join(after, "window_us", "left_anti").unionByName(after)
    end = F.col("window_us") + duration_micros(size)
    due = (F.col("entry_c") > 0) & ((end <= now_us) | (F.col("entry_d") <= now_us))
    timed = write_slot(states.withColumn("due", due), folder, "pane-due", batch_id)
    rested = {
        "entry_c": F.when(F.col("due"), 0).otherwise(F.col("entry_c")).cast("long"),
        "entry_d": F.when(F.col("due"), F.lit(UNSET)).otherwise(F.col("entry_d")),
        "entry_fired": F.col("entry_fired") + F.col("due").cast("long"),
    }
    write_slot(timed.withColumns(rested).select(*kind.names), folder, "pane-states", batch_id)
    by_clock = timed.filter("due").select(
        "window_us",
        (F.col("entry_fired") + 1).alias("pane_no"),
        F.least("entry_d", end).alias("fired_us"),
        F.when(F.col("entry_d") < end, INTERVAL).otherwise(WINDOW_END).alias("reason"),
        F.col("entry_n").alias("n_rows"),
        F.col("entry_id").alias("last_id"),
    )
    fired = replayed.filter("reason is not null").drop("c").unionByName(by_clock)
    return _in_time(fired, rows, order[0])
