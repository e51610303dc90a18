"""One named query per operator, over the test tables.

Each takes a session and a folder of parquet tables and gives a DataFrame. Those of sinks and
jobs write below the shared folder and read back what they wrote.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import FIXED_PATTERN, cell_rows, complete, json_bytes, json_html_safe, json_plain, row_key
from ..operators.carry import ended_windows, held_batches
from ..operators.panes import carried_panes, panes, panes_by_count
from ..operators.quality import (
    blank_filter,
    classify,
    dead_letter_counts,
    good_rows,
    json_gate,
)
from ..operators.tap import raw_tap
from ..operators.windows import (
    batch_summary,
    count_batches,
    each_batch,
    keep_latest,
    pane_counts,
    running_count,
    tumbling_counts,
    window_lists,
)
from ..schema import JDBC_JOB_WINDOW, KEYED_JOB_WINDOW, USER
from ..session import scratch_path, written
from ..sinks import kafka, keyed, ledger, table
from ..sources.replay import message_stream
from ..streaming.jobs import (
    read_window_counts,
    read_window_reducers,
    start_table_job,
    start_window_counts,
    start_window_reducers,
)
from . import jobs
from .messages import messages

FIELDS = USER.fieldNames()

# Parameters the queries and their reference SQL share.
WINDOW, BATCH_ROWS = "1 hour", 10
LIST_WINDOW, LIST_ROWS = "1 day", 100
PANE_ROWS, PANE_INTERVAL = 5, "7 minutes"

Query = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(events(spark, sf_dir))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts, uid, name, code`` of the good messages."""
    return good_rows(classify(event_messages(spark, sf_dir)))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


# --- sources, gate, bind -------------------------------------------------------------


def source_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(spark, sf_dir).select("event_id", "value")


def tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_tap(event_messages(spark, sf_dir))


def not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blank_filter(event_messages(spark, sf_dir)).select("event_id", "value")


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_gate(event_messages(spark, sf_dir)).select("event_id", "verdict")


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letter_counts(classify(event_messages(spark, sf_dir)))


def incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per verdict as a keyed store sees them."""
    classified = classify(event_messages(spark, sf_dir))
    verdict = keyed.keyed_verdict().alias("verdict")
    return classified.groupBy(verdict).agg(F.count(F.lit(1)).alias("n"))


def user_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select("event_id", *FIELDS)


# --- encoders, keys, cells -----------------------------------------------------------


def encoded_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select("event_id", json_plain(FIELDS).alias("json"))


def encoded_html_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select("event_id", json_html_safe(FIELDS).alias("json"))


def encoded_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select("event_id", F.hex(json_bytes(FIELDS)).alias("hex"))


def text_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select("conv_id", "turn", json_plain(["role", "text"]).alias("json"))


def text_html_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select(
        "conv_id", "turn", json_html_safe(["role", "text"]).alias("json")
    )


def _event_keys(spark: SparkSession, sf_dir: str, **pattern: str) -> DataFrame:
    uid = F.col("user_id").cast("string")
    return events(spark, sf_dir).withColumn("uid", uid).select(
        "event_id", row_key(**pattern).alias("rowkey")
    )


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_keys(spark, sf_dir)


def keys_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_keys(spark, sf_dir, pattern=FIXED_PATTERN)


def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _event_keys(spark, sf_dir).groupBy("rowkey").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_rows(users(spark, sf_dir).filter(complete()), ["event_id"])


# --- windows, batches, panes ---------------------------------------------------------


def tumbling_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(events(spark, sf_dir), JDBC_JOB_WINDOW)


def tumbling_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(events(spark, sf_dir), KEYED_JOB_WINDOW)


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("ts", "event_id", F.col("user_id").cast("string").alias("uid"))
    listed = window_lists(rows, LIST_WINDOW, ["uid"], list_rows=LIST_ROWS)
    uids = F.array_join(F.col("records.uid"), ",").alias("uids")
    return listed.select("window_start", "list_no", "n", uids)


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pane_counts(events(spark, sf_dir), WINDOW, BATCH_ROWS)


def _batches(method: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = events(spark, sf_dir).select("ts", "event_id")
        return batch_summary(count_batches(rows, WINDOW, BATCH_ROWS, method=method))

    return query


def batch_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("ts", "event_id", "user_id", "event_type")
    members = count_batches(rows, WINDOW, BATCH_ROWS)
    return members.select("event_id", "user_id", "event_type", "window_start", "batch_no")


def counted_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panes_by_count(events(spark, sf_dir).select("ts", "event_id"), WINDOW, PANE_ROWS)


def timed_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panes(events(spark, sf_dir).select("ts", "event_id"), WINDOW, PANE_ROWS, PANE_INTERVAL)


#: Gets a micro-batch, the folder it goes on from, its id and the clock in microseconds.
MicroBatch = Callable[[DataFrame, str, int, int], DataFrame]


def in_micro_batches(spark: SparkSession, sf_dir: str, fire: MicroBatch) -> DataFrame:
    """All that fires when the events come in three micro-batches, by time, and the clock then goes past
    the last window in one without rows."""
    rows = events(spark, sf_dir).select("ts", "event_id")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = rows.agg(F.min(at), F.max(at)).first()
    if first is None:
        first = last = 0
    cuts = [first + (last - first) * k // 3 for k in (1, 2)]
    ends = [*cuts, last + 1, last + 1 + 86_400_000_000]
    folder, fired = scratch_path(spark, "micro-batches"), []
    for batch_id, (begin, end) in enumerate(zip([first, *ends[:-1]], ends, strict=True)):
        batch = rows.filter((at >= begin) & (at < end))
        fired.append(written(fire(batch, folder, batch_id, end), "fired"))
    return reduce(DataFrame.unionByName, fired)


def batches_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fire(batch: DataFrame, folder: str, batch_id: int, now_us: int) -> DataFrame:
        return held_batches(batch, WINDOW, BATCH_ROWS, folder, batch_id, now_us)

    return batch_summary(in_micro_batches(spark, sf_dir, fire))


def panes_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fire(batch: DataFrame, folder: str, batch_id: int, now_us: int) -> DataFrame:
        return carried_panes(batch, WINDOW, PANE_ROWS, PANE_INTERVAL, folder, batch_id, now_us)

    return in_micro_batches(spark, sf_dir, fire)


def windows_ended(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fire(batch: DataFrame, folder: str, batch_id: int, now_us: int) -> DataFrame:
        return ended_windows(batch, WINDOW, folder, batch_id, now_us)

    return in_micro_batches(spark, sf_dir, fire)


def ids_of(start, list_no, batch):
    """A list as one row; a function of the caller's kind."""
    ids = ",".join(map(str, batch["user_id"].to_pylist()))
    return pa.RecordBatch.from_pydict(
        {"window_start": batch["window_start"].slice(0, 1), "list_no": [list_no], "n": [batch.num_rows], "uids": [ids]}
    )


def lists_by_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("ts", "event_id", "user_id")
    time_type = rows.schema["ts"].dataType.simpleString()
    parts = count_batches(rows, LIST_WINDOW, LIST_ROWS)
    return each_batch(parts, ids_of, f"window_start {time_type}, list_no long, n long, uids string")


def counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_count(events(spark, sf_dir).select("ts", "event_id"), WINDOW).select("event_id", "c")


def last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("ts", "event_id", "event_type")
    kept = keep_latest(rows, WINDOW)
    return kept.select("window_start", F.col("event_id").alias("last_id"), "event_type")


# --- sinks and jobs ------------------------------------------------------------------


def _append_target(spark: SparkSession, label: str) -> str:
    place = scratch_path(spark, label)
    name = f"hive_db.user_tbl_{place.rsplit('-', 1)[1]}"
    table.create_append_table(spark, name, location=place)
    return name


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _append_target(spark, "table")
    table.append_batch(users(spark, sf_dir), 0, target)
    return table.read_table(spark, target)


def jdbc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch staged, committed with its entry in the ledger, and run again, by the protocol of the JDBC
    sink on tables of files."""
    folder = scratch_path(spark, "ledger")
    rows = users(spark, sf_dir).select(*FIELDS)
    for _ in range(2):
        ledger.append_batch(rows, 0, folder)
    return ledger.read_rows(spark, folder, rows.schema)


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "keyed")
    puts = keyed.keyed_puts(users(spark, sf_dir))
    keyed.append_batch(puts, 0, folder)
    stored = keyed.read_puts(spark, folder, puts.schema)
    return keyed.latest_puts(stored).select("rowkey", "info.*")


def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Puts in two logs, each merged into the table of the store, the later one twice."""
    store, puts = scratch_path(spark, "keyed-store"), keyed.keyed_puts(users(spark, sf_dir))
    for part in (0, 1, 1):
        log = scratch_path(spark, "keyed-log")
        keyed.append_batch(puts.filter(F.pmod("event_id", F.lit(2)) == part), 0, log)
        keyed.merge(spark, log, puts.schema, store, digits=1)
    return keyed.read_merged(spark, store, puts.schema).select("rowkey", "info.*")


def kafka_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = kafka.kafka_frame(users(spark, sf_dir), "uid", FIELDS)
    return frame.select("key", F.hex("value").alias("value"))


def table_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _append_target(spark, "table-job")
    jobs.load_table(event_messages(spark, sf_dir), 0, target)
    return table.read_table(spark, target)


def jdbc_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job B, run twice, into a table of files with a ledger, and the pane of each row kept."""
    folder, keep = scratch_path(spark, "jdbc-job"), ("event_id", "window_start")
    rows = event_messages(spark, sf_dir)
    for _ in range(2):
        jobs.load_jdbc(rows, 0, folder, keep=keep)
    time_type = rows.schema["ts"].dataType
    schema = T.StructType([*USER.fields, rows.schema["event_id"], T.StructField("window_start", time_type)])
    return ledger.read_rows(spark, folder, schema)


def keyed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job C: the cells of the store, with the window and the batch that wrote them."""
    folder = scratch_path(spark, "keyed-job")
    schema = jobs.load_keyed(event_messages(spark, sf_dir), 0, folder)
    stored = keyed.latest_puts(keyed.read_puts(spark, folder, schema))
    return keyed.put_cells(stored, ["rowkey", "window_start", "batch_no"])


# --- streams -------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pattern matches the table, be it a file or a folder of files.
    return message_stream(spark, f"{sf_dir}/events*.parquet", events(spark, sf_dir).schema)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job A as a stream, stopped after a micro-batch and started again twice on its checkpoint: the
    second run takes the rest, the third finds nothing."""
    target = _append_target(spark, "stream-table")
    checkpoint, folder = scratch_path(spark, "stream-checkpoint"), scratch_path(spark, "stream-events")
    rows = events(spark, sf_dir)
    rows.repartition(3, "event_id").write.parquet(folder)

    def start(cadence: str | None):
        stream = message_stream(spark, folder, rows.schema, files_per_trigger=1)
        return start_table_job(messages(stream), checkpoint, target, cadence=cadence)

    query = start("1 hour")
    while query.isActive and not query.recentProgress:
        time.sleep(0.1)
    query.stop()
    for _ in range(2):
        start(None).awaitTermination()
    return table.read_table(spark, target)


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window, summed up over the micro-batches that had rows of it."""
    stream, place = _event_stream(spark, sf_dir), scratch_path(spark, "stream-windows")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    start_window_counts(stream, checkpoint, place, WINDOW, None).awaitTermination()
    return read_window_counts(spark, place, stream.schema["ts"].dataType)


def stream_reducers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counter and the last event of every window, from a stream of three micro-batches in any order."""
    rows = events(spark, sf_dir).select("ts", "event_id", "event_type")
    folder, place = scratch_path(spark, "stream-events"), scratch_path(spark, "stream-reducers")
    rows.repartition(3, "event_id").write.parquet(folder)
    stream = message_stream(spark, folder, rows.schema, files_per_trigger=1)
    start_window_reducers(stream, scratch_path(spark, "stream-checkpoint"), place, WINDOW, None).awaitTermination()
    return read_window_reducers(spark, place).select("window_start", "c", F.col("event_id").alias("last_id"), "event_type")


QUERIES: dict[str, Query] = {
    "source_messages": source_messages,
    "raw_tap": tap,
    "blank_filter": not_blank,
    "json_gate": gate,
    "dead_letter_counts": rejected,
    "keyed_verdict_counts": incomplete,
    "user_bind": user_bind,
    "to_json_plain": encoded_plain,
    "to_json_html_safe": encoded_html_safe,
    "to_json_bytes": encoded_bytes,
    "to_json_text_plain": text_plain,
    "to_json_text_html_safe": text_html_safe,
    "row_key": keys,
    "row_key_fixed": keys_fixed,
    "row_key_collisions": key_collisions,
    "to_cells": cells,
    "tumbling_5m": tumbling_jdbc,
    "tumbling_2m": tumbling_keyed,
    "window_collect": lists,
    "pane_counts": batch_counts,
    "count_batches": _batches("auto"),
    "count_batch_members": batch_members,
    "count_batches_two_phase": _batches("slices"),
    "count_batches_by_range": _batches("range"),
    "panes_count_only": counted_panes,
    "panes_count_interval": timed_panes,
    "held_batches": batches_held,
    "carried_panes": panes_carried,
    "ended_windows": windows_ended,
    "window_function": lists_by_function,
    "running_count": counter,
    "keep_latest": last_event,
    "sink_table_append": table_append,
    "sink_jdbc_batch": jdbc_rows,
    "sink_keyed_upsert": keyed_upsert,
    "sink_keyed_merge": keyed_merge,
    "kafka_sink_frame": kafka_rows,
    "job_table": table_job,
    "job_jdbc": jdbc_job,
    "job_keyed": keyed_job,
    "stream_resume": stream_resume,
    "stream_windows": stream_windows,
    "stream_reducers": stream_reducers,
}
