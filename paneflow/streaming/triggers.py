"""What moves windows on: the clock, and the watermark.

A micro-batch only comes when there is input. ``with_clock`` adds a tick a second to a stream, so that
a query is called at every trigger, also while its topics are silent, and can fire what is due by the
clock: the rest of a window at its end, a pane at its deadline. What fires is found by the operators of
``operators.carry`` and ``operators.panes`` on all tasks, from written tables and not from the state of
a single task. Such a query always has a next micro-batch, so it does not end by itself, and waiting for
it to have processed all there is (``processAllAvailable``) does not end either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ARRIVAL

#: Marks the rows of the clock.
TICK = "_tick"


def with_clock(stream: DataFrame) -> DataFrame:
    """The stream's rows and a tick a second, told apart by ``TICK``."""
    ticks = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    return stream.withColumn(TICK, F.lit(False)).union(ticks.select(*nothing, F.lit(True).alias(TICK)))


def declared_windows(rows: DataFrame, size: str, lateness: str, ts: str = ARRIVAL[0]) -> DataFrame:
    """Window counts by the watermark, each given once: when later messages move the watermark past its
    end. Rows later than ``lateness`` are not in them, nor are windows still open; where every row must
    count use ``streaming.jobs.start_window_counts``. A row without a time is an error."""
    missing = F.raise_error(F.lit(f"a message has no arrival time ({ts})"))
    return (
        rows.withColumn(ts, F.coalesce(F.col(ts), missing).cast("timestamp"))
        .withWatermark(ts, lateness)
        .groupBy(F.window(ts, size))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "n")
    )
