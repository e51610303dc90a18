import json
import re
import uuid
from pathlib import Path

import pytest
from file_database import FileDatabase
from helpers import GOLDEN, messages_frame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from paneflow.operators.quality import classify, good_rows
from paneflow.plans import jobs
from paneflow.plans.jobs import SideOutputs
from paneflow.sinks import jdbc, kafka, keyed, ledger, table
from paneflow.sources import kafka as topics
from paneflow.sources import line_table

FIELDS = ["uid", "name", "code"]
DEFECTS = ["", "oops", "[1]", '{"uid":[1]}', '{"uid":"7"}']


def golden(spark):
    return good_rows(classify(messages_frame(spark, GOLDEN)))


@pytest.fixture
def target(spark, tmp_path):
    name = f"sink_db.user_tbl_{uuid.uuid4().hex}"
    table.create_append_table(spark, name, location=str(tmp_path / "table"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_a_batch_written_twice_is_there_once(spark, target):
    rows = golden(spark)
    table.append_batch(rows, 4, target)
    table.append_batch(rows, 4, target)
    table.append_batch(rows.limit(3), 5, target)
    stored = table.read_table(spark, target)
    assert stored.columns == FIELDS
    assert stored.count() == 19
    assert {r.batch_id for r in spark.table(target).select("batch_id").distinct().collect()} == {4, 5}


def test_tables_take_nulls_and_plain_appends_add_up(spark, target, tmp_path):
    rows = good_rows(classify(messages_frame(spark, ['{"uid":"1"}', "{}"])))
    table.append_batch(rows, 0, target)
    assert sorted(map(repr, table.read_table(spark, target).collect())) == [
        "Row(uid='1', name=None, code=None)",
        "Row(uid=None, name=None, code=None)",
    ]
    plain = f"plain_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {plain} (code STRING, uid STRING, name STRING) USING parquet LOCATION '{tmp_path}/plain'")
    table.append_rows(golden(spark).select("uid", "name", "code"), plain)
    table.append_rows(golden(spark).select("uid", "name", "code"), plain)
    assert spark.table(plain).filter("uid = '1003' and code = '3'").count() == 2
    spark.sql(f"DROP TABLE {plain}")


def test_table_job_with_all_side_outputs(spark, target, tmp_path):
    reports = []
    sides = SideOutputs(str(tmp_path / "dead"), str(tmp_path / "tap"), lambda *told: reports.append(told))
    jobs.load_table(messages_frame(spark, GOLDEN + DEFECTS), 0, target, sides)
    assert table.read_table(spark, target).count() == 17
    dead = spark.read.parquet(f"{sides.dead_letters}/messages")
    assert sorted((r.event_id, r.verdict) for r in dead.collect()) == [
        (16, "blank"), (17, "bad_json"), (18, "not_object"), (19, "bad_field")
    ]
    assert spark.read.parquet(sides.tap).count() == 21
    assert reports == [(0, {"ok": 17, "blank": 1, "bad_json": 1, "not_object": 1, "bad_field": 1})]


class Ledgered:
    """A database's connection as far as the sink uses it, with a log of what it ran."""

    def __init__(self, ledger, fail_on=None):
        self.ledger, self.fail_on = ledger, fail_on
        self.pending, self.log = [], []

    def setAutoCommit(self, flag):
        assert flag is False

    def createStatement(self):
        return self

    def executeQuery(self, sql):
        self.log.append(sql)
        self.asked = tuple(re.search(r"load_id = '(.+)' and batch_id = (.+)", sql).groups())
        return self

    def next(self):
        return True

    def getInt(self, column):
        return int(self.asked in self.ledger)

    def executeUpdate(self, sql):
        if self.fail_on and self.fail_on in sql:
            raise RuntimeError("connection lost")
        self.log.append(sql)
        self.pending.append(sql)

    def commit(self):
        for sql in self.pending:
            if sql.startswith("insert into user_tbl_batches"):
                self.ledger.add(re.search(r"values \('(.+)', (.+)\)", sql).groups())
        self.pending = []

    def rollback(self):
        self.pending = []

    def close(self):
        self.log.append("close")


TARGET = jdbc.JdbcTarget("jdbc:x://host/db", "org.example.Driver", "u", "secret", rows_per_statement=10)


def run_jdbc(spark, ledger, batch_id=3, fail_on=None, load_id="load"):
    written = []
    connection = Ledgered(ledger, fail_on)
    done = jobs.load_jdbc(
        messages_frame(spark, GOLDEN + DEFECTS),
        batch_id,
        TARGET,
        load_id=load_id,
        connect=lambda spark, target: connection,
        write=lambda rows, target, name, mode: written.append((rows.columns, rows.count(), name, mode)),
    )
    return done, written, connection.log


def test_jdbc_batch_is_staged_and_committed_with_its_ledger_entry(spark):
    ledger = set()
    done, written, log = run_jdbc(spark, ledger)
    staging = TARGET.staging_table(3, "load")
    assert done and ledger == {("load", "3")} and re.fullmatch(r"user_tbl_stage_[0-9a-f]{12}_3", staging)
    assert written == [(FIELDS, 17, staging, "overwrite")]
    assert log == [
        "select count(*) from user_tbl_batches where load_id = 'load' and batch_id = 3",
        f"insert into user_tbl(uid, name, code) select uid, name, code from {staging}",
        "insert into user_tbl_batches(load_id, batch_id) values ('load', 3)",
        f"drop table if exists {staging}",
        "close",
    ]


def test_jdbc_batch_run_again_writes_nothing(spark):
    done, written, log = run_jdbc(spark, {("load", "3")})
    assert not done and not written and log[-2:] == [f"drop table if exists {TARGET.staging_table(3)}", "close"]
    ledger = {("load", "3")}
    assert run_jdbc(spark, ledger, load_id="other")[0] and ledger == {("load", "3"), ("other", "3")}


def test_jdbc_failure_leaves_the_ledger_alone(spark):
    ledger = set()
    with pytest.raises(RuntimeError):
        run_jdbc(spark, ledger, fail_on="user_tbl_batches(")
    assert not ledger
    assert run_jdbc(spark, ledger)[0] and ledger == {("load", "3")}


def test_a_driver_that_does_not_take_the_url_is_an_error(spark):
    # The driver class is at hand and refuses a foreign URL before it opens anything.
    target = jdbc.JdbcTarget("jdbc:x://host/db", "org.apache.hive.jdbc.HiveDriver", "u", "p")
    with pytest.raises(ConnectionError):
        jdbc.jvm_connection(spark, target)


def test_jdbc_options():
    options = TARGET.options()
    assert options["batchsize"] == "10" and options["numPartitions"] == "50"
    assert options["dbtable"] == "user_tbl" and options["password"] == "secret"
    assert "secret" not in repr(TARGET)
    assert jdbc.insert_statement("user_tbl", FIELDS) == "insert into user_tbl(uid, name, code) values (?, ?, ?)"


def test_keyed_store_keeps_the_last_put(spark, tmp_path):
    folder = str(tmp_path / "store")
    lines = ['{"uid":"1","name":"first","code":"a"}', '{"uid":"1","name":"second","code":"b"}']
    # Both have one parity key: a minute apart, the same second.
    frame = messages_frame(spark, lines).withColumn(
        "ts", F.expr("timestampadd(MINUTE, cast(event_id as int), timestamp'2024-01-01 10:00:00')")
    )
    for batch_id in (0, 1):
        puts = keyed.keyed_puts(good_rows(classify(frame.filter(f"event_id = {batch_id}"))))
        keyed.append_batch(puts, batch_id, folder)
        keyed.append_batch(puts, batch_id, folder)
    log = keyed.read_puts(spark, folder, puts.schema)
    assert log.count() == 2
    (put,) = keyed.latest_puts(log).collect()
    assert tuple(put.info) == ("1", "b", "second") and put.event_id == 1
    assert [tuple(r) for r in keyed.put_cells(keyed.latest_puts(log)).collect()] == [
        (put.rowkey, "info", "uid", "1"),
        (put.rowkey, "info", "code", "b"),
        (put.rowkey, "info", "Name", "second"),
    ]
    keyed.compact(spark, folder, puts.schema, str(tmp_path / "compacted"))
    compacted = keyed.read_puts(spark, str(tmp_path / "compacted"), puts.schema)
    assert compacted.drop("load_id", "batch_id").collect() == keyed.latest_puts(log).select(puts.columns).collect()


def test_a_new_load_adds_to_the_old_one(spark, target, tmp_path):
    sides = SideOutputs(str(tmp_path / "dead"), str(tmp_path / "tap"))
    store = str(tmp_path / "store")
    for load, lines in (("first", [*GOLDEN[:10], "bad"]), ("second", [*GOLDEN[10:14], "[1]"])):
        frame = messages_frame(spark, lines)
        for _ in range(2):
            jobs.load_table(frame, 0, target, sides, load_id=load)
            schema = jobs.load_keyed(frame, 0, store, load_id=load)
    assert table.read_table(spark, target).count() == 14
    assert spark.read.parquet(sides.tap).count() == 16
    assert spark.read.parquet(f"{sides.dead_letters}/messages").count() == 2
    assert keyed.read_puts(spark, store, schema).count() == 14
    small = str(tmp_path / "small")
    keyed.compact(spark, store, schema, small)
    jobs.load_keyed(messages_frame(spark, GOLDEN[14:]), 0, small)
    assert keyed.latest_puts(keyed.read_puts(spark, small, schema)).count() == 16
    with pytest.raises(ValueError):
        table.append_batch(golden(spark), 0, target, "no'id")


def test_jdbc_job_tells_its_panes(spark, tmp_path):
    told, database = [], FileDatabase(spark, str(tmp_path))
    sides = SideOutputs(panes=lambda batch_id, panes: told.extend((batch_id, r.n) for r in panes.orderBy("window_start").collect()))
    frame = messages_frame(spark, GOLDEN).withColumn("ts", F.expr("timestampadd(MINUTE, cast(event_id as int), ts)"))
    how = {"window": "8 minutes", "connect": database.connect, "write": database.write}
    for load in ("a", "a", "b"):
        jobs.load_jdbc(frame, 7, TARGET, sides, load_id=load, **how)
    assert sum(n for _, n in told) == 48 and len(told) >= 6
    assert database.rows(TARGET.table).count() == 32


def test_keyed_job_dead_letters_the_incomplete(spark, tmp_path):
    sides = SideOutputs(dead_letters=str(tmp_path / "dead"))
    schema = jobs.load_keyed(messages_frame(spark, GOLDEN + DEFECTS), 0, str(tmp_path / "store"), sides)
    puts = keyed.read_puts(spark, str(tmp_path / "store"), schema)
    batches = puts.groupBy("window_start", "batch_no").count().collect()
    assert sorted((r.batch_no, r["count"]) for r in batches) == [(0, 10), (1, 6)]
    (dead,) = spark.read.parquet(f"{sides.dead_letters}/records").collect()
    assert (dead.event_id, dead.uid, dead.verdict) == (20, "7", "incomplete")


def test_put_partitions_sends_each_key_once(spark, tmp_path):
    folder = str(tmp_path)

    class FileStore:
        """A store's client that keeps each call as a file."""

        def put(self, rows):
            text = json.dumps([(r.rowkey, *r.info) for r in rows])
            Path(folder, f"{uuid.uuid4().hex}.json").write_text(text)

        def close(self):
            Path(folder, f"{uuid.uuid4().hex}.closed").touch()

    puts = keyed.keyed_puts(golden(spark))
    older = puts.withColumn("ts", F.expr("ts - interval 1 day"))
    keyed.put_partitions(puts.union(older), FileStore, rows_per_put=5)
    calls = [json.loads(file.read_text()) for file in tmp_path.glob("*.json")]
    assert max(map(len, calls)) <= 5 and list(tmp_path.glob("*.closed"))
    sent = sorted(put for call in calls for put in call)
    # The older puts have the same keys and lose.
    assert sorted(uid for _, uid, *_ in sent) == [str(1000 + n) for n in range(1, 17)]
    jobs.load_keyed(messages_frame(spark, GOLDEN + DEFECTS), 0, FileStore)
    again = [put for file in tmp_path.glob("*.json") for put in json.loads(file.read_text())]
    assert len(again) == 32 and sorted(again) == sorted(sent * 2)


def test_kafka_options_and_frame(spark):
    options = kafka.producer_options("h1:1,h2:2")
    assert options["kafka.acks"] == "all" and options["kafka.bootstrap.servers"] == "h1:1,h2:2"
    assert options["kafka.max.request.size"] == "10485760" and options["kafka.sasl.mechanism"] == "GSSAPI"
    assert all(key.startswith("kafka.") for key in options)
    consumer = topics.consumer_options("h:1", "test_.*", max_offsets_per_trigger=5, min_partitions=64)
    assert consumer["subscribePattern"] == "test_.*" and consumer["startingOffsets"] == "latest"
    assert consumer["maxOffsetsPerTrigger"] == "5" and consumer["minPartitions"] == "64"
    assert consumer["kafka.sasl.kerberos.service.name"] == "kafka"
    plain = topics.consumer_options("h:1", "t", security=topics.sasl_plain("module required;"))
    assert plain["kafka.sasl.jaas.config"] == "module required;" and plain["kafka.sasl.mechanism"] == "PLAIN"
    frame = kafka.kafka_frame(golden(spark), "uid", FIELDS)
    assert frame.dtypes == [("key", "string"), ("value", "binary")]
    assert json.loads(bytes(frame.first().value)) == json.loads(GOLDEN[0])


def test_kafka_records_become_messages(spark):
    records = spark.createDataFrame(
        [("t", 0, 5, bytearray("{\"uid\":\"\u00e9\"}".encode()), 1), ("t", 1, 6, None, 2)],
        "topic string, partition int, offset long, value binary, at int",
    ).selectExpr("*", "timestamp_seconds(at) as timestamp")
    rows = classify(topics.topics_frame(records)).orderBy("offset").collect()
    assert rows[0].record.uid == "\u00e9" and rows[1].verdict == "blank"


def test_keyed_job_on_records_of_topics(spark, tmp_path):
    frame = messages_frame(spark, GOLDEN).selectExpr(
        "'t' as topic",
        "cast(event_id % 2 as int) as partition",
        "event_id div 2 as offset",
        "timestamp'2024-01-01 10:00:00' as timestamp",
        "cast(value as binary) as value",
    )
    store, order = str(tmp_path / "store"), topics.TOPIC_ARRIVAL
    schema = jobs.load_keyed(topics.topics_frame(frame), 0, store, order=order)
    puts = keyed.read_puts(spark, store, schema)
    assert sorted((r.batch_no, r["count"]) for r in puts.groupBy("batch_no").count().collect()) == [(0, 10), (1, 6)]
    assert keyed.latest_puts(puts, order).count() == 16
    first = {tuple(r) for r in puts.filter("batch_no = 0").select("partition", "offset").collect()}
    assert first == {(0, n) for n in range(8)} | {(1, 0), (1, 1)}


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException):
        topics.topic_stream(spark, topics.consumer_options("h:1", "t"))


def test_lines_of_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(GOLDEN))
    assert good_rows(classify(line_table(spark, str(tmp_path)))).count() == 16


def test_ledger_shows_whole_batches_once(spark, tmp_path):
    folder, rows = str(tmp_path / "t"), golden(spark).select(*FIELDS)
    assert [ledger.append_batch(rows, b, folder, load) for load, b in (("a", 0), ("a", 0), ("a", 1), ("b", 0))] == [True, False, True, True]
    assert ledger.append_batch(rows.limit(0), 2, folder, "a") and not ledger.append_batch(rows, 2, folder, "a")
    assert ledger.read_rows(spark, folder, rows.schema).count() == 48
    assert {(r.load_id, r.batch_id): r.n_rows for r in ledger.read_ledger(spark, folder).collect()} == {
        ("a", 0): 16, ("a", 1): 16, ("a", 2): 0, ("b", 0): 16}
    # A batch that stopped between its rows and its entry is not seen, and is replaced when it runs again.
    rows.limit(5).write.parquet(f"{folder}/rows/load_id=a/batch_id=3")
    assert ledger.read_rows(spark, folder, rows.schema).count() == 48
    assert ledger.append_batch(rows.limit(3), 3, folder, "a")
    assert ledger.read_rows(spark, folder, rows.schema).count() == 51
    assert not list((tmp_path / "t" / "staging").rglob("*.parquet"))


def test_jdbc_job_into_a_table_with_a_ledger(spark, tmp_path):
    seen, folder = [], str(tmp_path / "t")
    sides = SideOutputs(report=lambda b, counts: seen.append(counts), panes=lambda b, panes: seen.append(panes.collect()[0].n))
    for _ in range(2):
        jobs.load_jdbc(messages_frame(spark, GOLDEN + DEFECTS), 7, folder, sides)
    assert ledger.read_rows(spark, folder, golden(spark).select(*FIELDS).schema).count() == 17
    assert seen == [{"ok": 17, "blank": 1, "bad_json": 1, "not_object": 1, "bad_field": 1}, 17] * 2


def test_verdicts_are_counted_without_a_job_of_their_own(spark, target):
    frame, counts = messages_frame(spark, GOLDEN + DEFECTS).repartition(3), []
    status = spark.sparkContext.statusTracker()

    def jobs_of(sides, group):
        spark.sparkContext.setJobGroup(group, group)
        jobs.load_table(frame, 0, target, sides)
        return len(status.getJobIdsForGroup(group))

    plain = jobs_of(SideOutputs(), uuid.uuid4().hex)
    assert jobs_of(SideOutputs(report=lambda b, c: counts.append(c)), uuid.uuid4().hex) == plain
    assert counts == [{"ok": 17, "blank": 1, "bad_json": 1, "not_object": 1, "bad_field": 1}]


def test_merged_store_rewrites_and_reads_only_what_it_must(spark, tmp_path):
    base, log = str(tmp_path / "base"), str(tmp_path / "log")
    puts = keyed.keyed_puts(messages_frame(spark, GOLDEN).transform(lambda m: good_rows(classify(m))))
    keyed.append_batch(puts, 0, log)
    for _ in range(2):
        keyed.merge(spark, log, puts.schema, base)
    merged = keyed.read_merged(spark, base, puts.schema)
    assert sorted(map(str, merged.collect())) == sorted(map(str, keyed.latest_puts(puts).select(puts.columns).collect()))
    key, n = merged.first().rowkey, merged.count()
    one = keyed.read_merged(spark, base, puts.schema, key)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert [r.rowkey for r in one.collect()] == [key] and "PartitionFilters: [isnotnull(salt" in plan
    # A later and an earlier put of that key: the later one wins, other partitions keep their files.
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "base").rglob("*.parquet")}
    small, later = str(tmp_path / "small"), puts.filter(F.col("rowkey") == key)
    changed = later.withColumn("info", F.col("info").withField("Name", F.lit("new")))
    both = changed.withColumn("event_id", F.col("event_id") + 1).unionByName(
        changed.withColumn("event_id", F.col("event_id") - 100).withColumn("info", F.col("info").withField("Name", F.lit("old")))
    )
    keyed.append_batch(both, 0, small)
    keyed.merge(spark, small, puts.schema, base)
    assert keyed.read_merged(spark, base, puts.schema, key).first().info.Name == "new"
    assert keyed.read_merged(spark, base, puts.schema).count() == n
    same = [p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]]
    assert len(same) == len([p for p in files if f"salt={key[:2]}" not in str(p)]) > 0
