import time
import uuid
from collections import Counter

import pytest
from helpers import GOLDEN, messages_frame
from pyspark.errors import AnalysisException

from paneflow import __main__ as main
from paneflow.sources import kafka

COMMON = ["--servers", "h:1", "--topics", "test_.*"]


@pytest.fixture
def topic(spark, tmp_path, monkeypatch):
    """Files in the place of the connector, with a topic's record columns."""
    folder = str(tmp_path / "records")
    messages_frame(spark, GOLDEN).selectExpr(
        "'t' as topic", "0 as partition", "event_id as offset", "ts as timestamp", "cast(value as binary) value"
    ).write.parquet(folder)
    asked = []

    def stream(session, options):
        asked.append(options)
        return kafka.topics_frame(session.readStream.schema(session.read.parquet(folder).schema).parquet(folder))

    monkeypatch.setattr(kafka, "topic_stream", stream)
    return asked


def run(spark, *argv):
    query = main.start(spark, main.arguments().parse_args(argv))
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_table_job(spark, tmp_path, topic):
    name = f"main_{uuid.uuid4().hex}"
    run(spark, "table", *COMMON, "--checkpoint", f"{tmp_path}/c", "--table", name, "--max-offsets", "100",
        "--cadence", "1 second", "--dead-letters", f"{tmp_path}/dead")
    assert topic[0]["subscribePattern"] == "test_.*" and topic[0]["maxOffsetsPerTrigger"] == "100"
    assert spark.table(name).count() == 16
    spark.sql(f"DROP TABLE {name}")


def test_keyed_job(spark, tmp_path, topic):
    store = f"{tmp_path}/store"
    run(spark, "keyed", *COMMON, "--checkpoint", f"{tmp_path}/c", "--store", store, "--cadence", "1 second", "--plain-clock")
    puts = spark.read.parquet(store)
    assert sorted((r.batch_no, r["count"]) for r in puts.groupBy("batch_no").count().collect()) == [(0, 10), (1, 6)]
    assert puts.filter("rowkey like '%_2024-01-01 00:00:03_1004'").count() == 1


def test_keyed_job_that_fires_by_count(spark, tmp_path, topic, capsys):
    """Such a query has the clock as a source, so it is not waited for but looked at, then stopped."""
    store = f"{tmp_path}/store"
    given = main.arguments().parse_args(
        ["keyed", *COMMON, "--checkpoint", f"{tmp_path}/c", "--store", store, "--cadence", "1 second", "--fire-by-count", "--dead-letters", f"{tmp_path}/dead"]
    )
    query, until, rows = main.start(spark, given), time.time() + 120, []
    try:
        while len(rows) < 16 and time.time() < until:
            assert query.exception() is None
            time.sleep(0.5)
            try:
                rows = spark.read.parquet(store).collect()
            except AnalysisException:  # nothing is there
                pass
    finally:
        query.stop()
    assert sorted(Counter(r.batch_no for r in rows).items()) == [(0, 10), (1, 6)]
    out = capsys.readouterr().out
    assert "16 ok" in out and "2 panes of 16 rows" in out and "batch_no 1, n 6" in out


def test_what_a_job_needs_is_asked_for(capsys):
    with pytest.raises(SystemExit):
        main.arguments().parse_args(["jdbc", *COMMON, "--checkpoint", "c"])
    assert "--url" in capsys.readouterr().err
    given = main.arguments().parse_args(["jdbc", *COMMON, "--checkpoint", "c", "--url", "u", "--driver", "d"])
    assert (given.table, given.cadence) == ("user_tbl", "5 minutes")
