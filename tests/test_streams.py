import time
import uuid

import pyarrow as pa
import pytest
from helpers import GOLDEN, messages_frame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from paneflow.operators.windows import keep_latest, tumbling_counts
from paneflow.plans.jobs import SideOutputs, load_keyed
from paneflow.sinks import table
from paneflow.sinks.jdbc import JdbcTarget
from paneflow.sources import line_stream, message_stream
from paneflow.streaming import jobs
from paneflow.streaming.triggers import declared_windows


def stored(spark, tmp_path, values, files):
    """The messages as a folder of ``files`` parquet files."""
    folder = str(tmp_path / "messages")
    frame = messages_frame(spark, values)
    for part in range(files):
        frame.filter(f"event_id % {files} = {part}").coalesce(1).write.mode("append").parquet(folder)
    return folder, frame.schema


def wait_for(query, folder, done, spark, seconds=120):
    """Wait until the rows of a folder fulfil ``done``, then stop the query."""
    until, rows = time.time() + seconds, []
    try:
        while time.time() < until:
            assert query.exception() is None
            try:
                rows = spark.read.parquet(folder).collect()
            except AnalysisException:  # nothing is there
                pass
            if done(rows):
                return rows
            time.sleep(0.5)
        raise AssertionError(f"after {seconds} s: {rows}")
    finally:
        query.stop()


@pytest.fixture
def target(spark, tmp_path):
    name = f"stream_db.user_tbl_{uuid.uuid4().hex}"
    table.create_append_table(spark, name, location=str(tmp_path / "table"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_a_stopped_stream_goes_on_where_it_was(spark, tmp_path, target):
    folder, schema = stored(spark, tmp_path, GOLDEN + ["bad", ""], 3)
    sides = SideOutputs(dead_letters=str(tmp_path / "dead"))
    checkpoint = str(tmp_path / "checkpoint")

    def start(cadence):
        source = message_stream(spark, folder, schema, files_per_trigger=1)
        return jobs.start_table_job(source, checkpoint, target, sides, cadence)

    query = start("1 hour")
    until = time.time() + 60
    while not query.recentProgress and time.time() < until:
        time.sleep(0.2)
    query.stop()
    assert 0 < table.read_table(spark, target).count() < 16
    for _ in range(2):
        start(None).awaitTermination()
        assert sorted(r.uid for r in table.read_table(spark, target).collect()) == [
            str(1000 + n) for n in range(1, 17)
        ]
    assert spark.read.parquet(f"{sides.dead_letters}/messages").count() == 2


def test_another_checkpoint_adds_rows(spark, tmp_path, target):
    for k, lines in enumerate((GOLDEN[:10], GOLDEN[10:14])):
        folder, schema = stored(spark, tmp_path / str(k), lines, 1)
        for _ in range(2):
            source = message_stream(spark, folder, schema)
            jobs.start_table_job(source, str(tmp_path / f"c{k}"), target, cadence=None).awaitTermination()
    assert table.read_table(spark, target).count() == 14


def test_late_rows_count_in_their_window(spark, tmp_path):
    frame = messages_frame(spark, GOLDEN)
    folder, place = str(tmp_path / "messages"), str(tmp_path / "counts")
    for part in ("event_id >= 8", "event_id < 8"):  # the earlier rows come last
        frame.filter(part).coalesce(1).write.mode("append").parquet(folder)
        source = message_stream(spark, folder, frame.schema, files_per_trigger=1)
        jobs.start_window_counts(source, str(tmp_path / "c"), place, "5 seconds", None).awaitTermination()
    counted = jobs.read_window_counts(spark, place, frame.schema["ts"].dataType)
    assert sorted(r.n for r in counted.collect()) == [1, 5, 5, 5]


def test_keyed_job_as_a_stream(spark, tmp_path):
    folder, schema = stored(spark, tmp_path, GOLDEN, 1)
    store = str(tmp_path / "store")
    source = message_stream(spark, folder, schema)
    jobs.start_keyed_job(source, str(tmp_path / "c"), store, cadence=None).awaitTermination()
    puts = spark.read.parquet(store)
    assert sorted((r.batch_no, r["count"]) for r in puts.groupBy("batch_no").count().collect()) == [(0, 10), (1, 6)]


def test_batches_go_on_over_micro_batches(spark, tmp_path):
    folder, schema = stored(spark, tmp_path, GOLDEN, 3)
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "c")
    source = message_stream(spark, folder, schema, files_per_trigger=1)
    jobs.start_keyed_job(source, checkpoint, store, cadence=None).awaitTermination()
    puts = spark.read.parquet(store)
    assert puts.select("batch_id").distinct().count() == 3
    assert sorted((r.batch_no, r["count"]) for r in puts.groupBy("batch_no").count().collect()) == [(0, 10), (1, 6)]
    # The last micro-batch run again, as after a failure before its commit.
    last = puts.filter("batch_id = 2").collect()
    again = messages_frame(spark, GOLDEN).filter("event_id in ({})".format(",".join(str(r.event_id) for r in last)))
    load_keyed(again, 2, store, totals=f"{checkpoint}-totals", load_id=last[0].load_id)
    assert sorted(map(str, spark.read.parquet(store).filter("batch_id = 2").collect())) == sorted(map(str, last))


def test_jdbc_job_hands_over_a_window_at_a_time(spark, tmp_path):
    folder, schema = stored(spark, tmp_path, GOLDEN + ["bad"], 1)
    seen = []

    class Connection:
        def __getattr__(self, name):
            return lambda *args: 0 if name == "getInt" else self

    jobs.start_jdbc_job(
        message_stream(spark, folder, schema),
        str(tmp_path / "c"),
        JdbcTarget("jdbc:x", "d"),
        cadence=None,
        connect=lambda spark, target: Connection(),
        write=lambda rows, target, name, mode: seen.append((name, rows.count())),
    ).awaitTermination()
    ((name, n),) = seen
    assert name.startswith("user_tbl_stage_") and n == 16


def test_dead_letters_and_taps_as_streams(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text("\n".join(GOLDEN + ["bad", "[1]"]))
    lines = line_stream(spark, str(tmp_path / "lines"), files_per_trigger=1)
    dead = str(tmp_path / "dead")
    jobs.start_dead_letters(lines, str(tmp_path / "c"), dead, None).awaitTermination()
    assert sorted(r.verdict for r in spark.read.parquet(dead).collect()) == ["bad_json", "not_object"]
    jobs.start_console_tap(lines, str(tmp_path / "c2"), None).awaitTermination()


def clocked(spark, tmp_path):
    folder, schema = stored(spark, tmp_path, GOLDEN, 1)
    return message_stream(spark, folder, schema).withColumn("ts", F.current_timestamp())


def test_ten_by_count_and_six_by_the_clock(spark, tmp_path):
    store = str(tmp_path / "store")
    query = jobs.start_keyed_job_by_count(clocked(spark, tmp_path), str(tmp_path / "c"), store, cadence="1 second", window="6 seconds")
    puts = wait_for(query, store, lambda rows: len(rows) == 16, spark)
    batches = {}
    for r in puts:
        batches.setdefault(r.batch_no, set()).add(r.event_id)
    assert batches == {0: set(range(10)), 1: set(range(10, 16))}
    # The ten came at once, the six when the window ended, without any new message.
    assert len({r.batch_id for r in puts if r.batch_no == 0}) == 1
    assert {r.batch_id for r in puts if r.batch_no == 0} < {r.batch_id for r in puts}


def test_a_query_on_the_clock_goes_on_after_a_stop(spark, tmp_path):
    """Records that wait for their batch are there again when the query is started anew."""
    store, checkpoint, folder = str(tmp_path / "store"), str(tmp_path / "c"), str(tmp_path / "messages")
    frame = messages_frame(spark, GOLDEN, start="2124-01-01 00:00:00")  # a window that does not end
    for part in ("event_id < 4", "event_id >= 4"):
        frame.filter(part).coalesce(1).write.mode("append").parquet(folder)
        source = message_stream(spark, folder, frame.schema)
        query = jobs.start_keyed_job_by_count(source, checkpoint, store, cadence="1 second", window="6 hours")
        wait_for(query, store, lambda rows, p=part: len(rows) == (10 if ">" in p else 0) and query.lastProgress and query.lastProgress.batchId > 0, spark)
    assert {r.event_id for r in spark.read.parquet(store).collect()} == set(range(10))


def test_early_panes_by_interval_and_window_end(spark, tmp_path):
    place = str(tmp_path / "panes")
    query = jobs.start_early_panes(clocked(spark, tmp_path), str(tmp_path / "c"), place, "8 seconds", 10, "1 second", "1 second")
    first, last = sorted(wait_for(query, place, lambda rows: len(rows) == 2, spark), key=lambda r: r.pane_no)
    assert (first.reason, first.n_rows, first.last_id) == ("count", 10, 9)
    # The rest fires after the interval, or at the end if the window ends before that.
    assert last.reason in ("interval", "window_end") and (last.n_rows, last.last_id) == (16, 15)


def test_a_silent_window_is_given_at_its_end(spark, tmp_path):
    place = str(tmp_path / "ends")
    query = jobs.start_window_ends(clocked(spark, tmp_path), str(tmp_path / "c"), place, "4 seconds", "1 second")
    assert [r.n for r in wait_for(query, place, len, spark)] == [16]


def test_a_function_over_the_windows_of_a_stream(spark, tmp_path):
    place = str(tmp_path / "parts")

    def total(start, batch_no, batch):
        return pa.RecordBatch.from_pydict({"n": [batch.num_rows], "uids": [[r["uid"] for r in batch["record"].to_pylist()] if "record" in batch.schema.names else batch["value"].to_pylist()]})

    query = jobs.start_pane_function(
        clocked(spark, tmp_path), str(tmp_path / "c"), place, "4 seconds", total, "n long, uids array<string>", 10, "1 second"
    )
    rows = wait_for(query, place, lambda rows: len(rows) == 2, spark)
    assert sorted(r.n for r in rows) == [6, 10] and sorted(x for r in rows for x in r.uids) == sorted(GOLDEN)


def test_reducers_whatever_the_order(spark, tmp_path):
    frame = messages_frame(spark, GOLDEN)
    folder, place, checkpoint = str(tmp_path / "messages"), str(tmp_path / "reduced"), str(tmp_path / "c")
    for part in ("event_id between 6 and 9", "event_id > 9", "event_id < 6"):
        frame.filter(part).coalesce(1).write.mode("append").parquet(folder)
        source = message_stream(spark, folder, frame.schema, files_per_trigger=1)
        jobs.start_window_reducers(source, checkpoint, place, "5 seconds", None).awaitTermination()
    got = sorted((r.window_start, r.c, r.event_id, r.value) for r in jobs.read_window_reducers(spark, place).collect())
    kept = {r.window_start: r for r in keep_latest(frame, "5 seconds").collect()}
    counts = {r.window_start: r.n for r in tumbling_counts(frame, "5 seconds").collect()}
    assert got == [(w, counts[w], kept[w].event_id, kept[w].value) for w in sorted(kept)]


def test_a_stream_leaves_no_intermediates(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("paneflow.session.scratch_root", lambda spark: str(tmp_path / "scratch"))
    folder, schema = stored(spark, tmp_path, GOLDEN, 3)
    source = message_stream(spark, folder, schema, files_per_trigger=1)
    jobs.start_keyed_job(source, str(tmp_path / "c"), str(tmp_path / "store"), cadence=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "store")).count() == 16
    assert not list((tmp_path / "scratch").rglob("*.parquet"))


def test_watermarked_windows_are_written_once(spark, tmp_path):
    folder, schema = stored(spark, tmp_path, GOLDEN, 1)
    counted = declared_windows(message_stream(spark, folder, schema), "5 seconds", "0 seconds")
    place = str(tmp_path / "windows")
    writer = counted.writeStream.format("parquet").option("path", place).outputMode("append")
    jobs.resumable(writer, "windows", str(tmp_path / "c"), None).start().awaitTermination()
    # 16 seconds of messages: the watermark has passed three windows of five.
    assert [r.n for r in spark.read.parquet(place).collect()] == [5, 5, 5]
