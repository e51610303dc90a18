"""Row numbers in a group, without a task that holds an unbounded group.

``row_number() over (partition by window ...)`` puts a whole window in one task. So the windows
are counted first, from the arrival times alone and summed before the shuffle, and the counts say
what to do with each row:

* A window that is not large is numbered by the plain window function.
* A large window is cut into slices of time, which are counted in turn. The counts add up to a
  starting number per slice, and only the rows of one slice are numbered together.
* A slice that is still too large, as when a third of all messages share one timestamp, is laid
  out by range of the whole order, which splits between any two rows.

The first two are one shuffle of the rows; the third concerns the rows of such slices only. What
is looked up on the way are tables of the large windows and their slices, written first, so that
the planner knows their size and broadcasts them while they are small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Rows one task may sort and number together.
SLICE_ROWS = 2_000_000

#: How many slices a large window is cut into.
MIN_SLICES, MAX_SLICES = 60, 10_000

METHODS = ("auto", "groups", "slices", "range")

_SLICE = "_slice"
_POSITION = "_position"
_PART = "_part"
#: ``monotonically_increasing_id`` keeps the partition above this bit.
_PART_SHIFT = 33


def _offsets(counts: DataFrame, groups: Sequence[str], part: str) -> DataFrame:
    """Per part of a group: the rows ``_before`` it, and ``_total``, those of the group."""
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumn(
        "_total", F.sum("_n").over(Window.partitionBy(*groups))
    )


def _plain(rows: DataFrame, groups: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    window = Window.partitionBy(*groups).orderBy(*order)
    numbered = rows.withColumn("rn", F.row_number().over(window).cast("long"))
    if last:
        numbered = numbered.withColumn("is_last", F.lead(F.lit(1)).over(window).isNull())
    return numbered


def _by_slice(
    rows: DataFrame, groups: Sequence[str], order: Sequence[str], offsets: DataFrame, last: bool
) -> DataFrame:
    """Rows of slices found in ``offsets`` by slice, those of other groups by group."""
    known = offsets.select(*groups, _SLICE, F.col(_SLICE).alias(_PART), "_before", "_total")
    placed = rows.join(known, [*groups, _SLICE], "left")
    numbered = _plain(placed, [*groups, _PART], order, last)
    numbered = numbered.withColumn("rn", F.coalesce("_before", F.lit(0)) + F.col("rn"))
    if last:
        in_slices = F.col("rn") == F.col("_total")
        numbered = numbered.withColumn("is_last", F.coalesce(in_slices, F.col("is_last")))
    return numbered.drop(_PART, "_before", "_total")


def _by_range(
    rows: DataFrame, groups: Sequence[str], order: Sequence[str], parts: int, last: bool
) -> DataFrame:
    # The layout depends on sampling, so it is written before it is counted: every
    # later stage, and every retry, sees the same positions.
    laid_out = written(
        rows.repartitionByRange(parts, *groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn(_POSITION, F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright(_POSITION, _PART_SHIFT)),
        "numbered",
    )
    spans = laid_out.groupBy(*groups, _PART).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_POSITION).alias("_first")
    )
    offsets = _offsets(spans, groups, _PART).select(*groups, _PART, "_before", "_first", "_total")
    offsets = written(offsets, "range-offsets")
    numbered = laid_out.join(offsets, [*groups, _PART]).withColumn(
        "rn", F.col("_before") + F.col(_POSITION) - F.col("_first") + 1
    )
    if last:
        numbered = numbered.withColumn("is_last", F.col("rn") == F.col("_total"))
    return numbered.drop(_PART, _POSITION, "_before", "_first", "_total")


def _shuffle_partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _slice_counts(rows: DataFrame, groups: Sequence[str], slice_start: Column) -> DataFrame:
    """The offsets of the slices."""
    counts = rows.withColumn(_SLICE, slice_start).groupBy(*groups, _SLICE).agg(F.count(F.lit(1)).alias("_n"))
    return _offsets(counts, groups, _SLICE)


def _by_counts(
    rows: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    slice_start: Callable[[int], Column],
    slice_rows: int,
    last: bool,
) -> DataFrame:
    sizes = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    # At most (all rows / slice_rows) groups.
    large = written(sizes.filter(F.col("_size") > slice_rows), "large-groups")
    largest = large.agg(F.max("_size")).first()[0]
    if largest is None:
        return _plain(rows, groups, order, last)

    start = slice_start(max(MIN_SLICES, min(4 * ceil(largest / slice_rows), MAX_SLICES)))
    in_large = rows.join(large.select(*groups), list(groups), "left_semi")
    return _by_slices(rows, in_large, groups, order, start, slice_rows, last)


def _by_slices(
    rows: DataFrame,
    to_slice: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    start: Column,
    slice_rows: int,
    last: bool,
) -> DataFrame:
    """Slices of the groups in ``to_slice``; one of more than ``slice_rows`` rows is laid out by range."""
    offsets = written(_slice_counts(to_slice, groups, start), "slice-offsets")
    crowded = F.col("_n") > slice_rows
    crowd = offsets.filter(crowded).agg(F.sum("_n")).first()[0]
    sliced = rows.withColumn(_SLICE, start)
    if crowd is None:
        return _by_slice(sliced, groups, order, offsets, last)

    key = [*groups, _SLICE]
    split = written(
        offsets.filter(crowded).select(*key, F.col("_before").alias("_ahead"), F.col("_total").alias("_all")),
        "crowded-slices",
    )
    parts = max(_shuffle_partitions(rows), ceil(crowd / slice_rows))
    hot = _by_range(sliced.join(split, key), key, order, parts, False).withColumn(
        "rn", F.col("_ahead") + F.col("rn")
    )
    if last:
        hot = hot.withColumn("is_last", F.col("rn") == F.col("_all"))
    rest = _by_slice(sliced.join(split, key, "left_anti"), groups, order, offsets, last)
    return rest.unionByName(hot.drop("_ahead", "_all"))


def number_rows(
    rows: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    slice_start: Callable[[int], Column],
    *,
    last: bool = False,
    method: str = "auto",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``rn`` (1, 2, ... per group in ``order``) and, if asked for, ``is_last``.

    ``order`` is unique in a group. ``slice_start(n)`` is the start of a row's slice when a group
    is cut into about n; it does not decrease along ``order``. ``method`` other than ``auto``
    treats all rows in one of the three ways.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    if method == "groups":
        return _plain(rows, groups, order, last)
    if method == "range":
        return _by_range(rows, groups, order, _shuffle_partitions(rows), last)
    if method == "slices":
        return _by_slices(rows, rows, groups, order, slice_start(MIN_SLICES), slice_rows, last).drop(_SLICE)
    numbered = _by_counts(rows, groups, order, slice_start, slice_rows, last)
    return numbered.drop(_SLICE)
