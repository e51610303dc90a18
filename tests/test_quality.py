import pytest
from helpers import messages_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneflow.operators.quality import (
    blank_filter,
    classify,
    dead_letter_counts,
    dead_letters,
    good_rows,
    json_gate,
)
from paneflow.operators.tap import raw_tap

NONE = (None, None, None)

CASES = [
    (None, "blank", None),
    ("", "blank", None),
    ("   ", "blank", None),
    ("\t\n", "blank", None),
    ("\u2003\u3000", "blank", None),
    ("\u00a0", "bad_json", None),
    ("not json", "bad_json", None),
    ('{"uid":"1"', "bad_json", None),
    ('{"uid":"1",}', "bad_json", None),
    ('{"uid":00012}', "bad_json", None),
    ('{"uid":00012,"code":1.50}', "bad_json", None),
    ('{"uid":"1"} trailing', "bad_json", None),
    ('{"uid":"1"}{"uid":"2"}', "bad_json", None),
    ('{"uid":"1"},{"uid":"2"}', "bad_json", None),
    ('{"uid":"1"}] junk', "bad_json", None),
    ('{"uid":"1"},{"__sealed_by__":"1"}] junk', "bad_json", None),
    ('{"uid":"1"},"x"] junk', "bad_json", None),
    ("1,2", "bad_json", None),
    ('1,"x"] junk', "bad_json", None),
    ("[1", "bad_json", None),
    ("null", "not_object", None),
    ("123", "not_object", None),
    ('"s"', "not_object", None),
    ('"{s"', "not_object", None),
    ("[1]", "not_object", None),
    ('[{"uid":"1"}]', "not_object", None),
    ('{"uid":{"a":1}}', "bad_field", None),
    ('{"uid":[1,2]}', "bad_field", None),
    ('{"uid":{}}', "bad_field", None),
    ('{"uid":[]}', "bad_field", None),
    ('{"name":"a","code":[null]}', "bad_field", None),
    ('{"uid":"{\\"a\\":1}"}', "ok", ('{"a":1}', None, None)),
    ('{"uid":"[1"}', "ok", ("[1", None, None)),
    ('{"uid":"1","name":"a","code":"x"}', "ok", ("1", "a", "x")),
    (' \t{"uid":"1"}\n', "ok", ("1", None, None)),
    ("{}", "ok", NONE),
    ('{"x":1}', "ok", NONE),
    ('{"x":{"uid":1}}', "ok", NONE),
    ('{"UID":"1"}', "ok", NONE),
    ('{"uid":null}', "ok", NONE),
    ('{"uid":1001,"name":true}', "ok", ("1001", "true", None)),
    ('{"uid":"1","uid":"2"}', "ok", ("2", None, None)),
    ("{'uid':'q'}", "ok", ("q", None, None)),
    ('{uid:"u"}', "ok", ("u", None, None)),
    ('{"uid":12345678901234567890123}', "ok", ("12345678901234567890123", None, None)),
    # Number literals keep their text, strings that hold numbers are left alone.
    ('{"uid":1e3}', "ok", ("1e3", None, None)),
    ('{"uid":1.50,"name":"v1.50, 2e1","code":-0}', "ok", ("1.50", "v1.50, 2e1", "-0")),
    ('{"uid":1e400,"name":"a"}', "ok", ("1e400", "a", None)),
    ('{"a1":"\\"2.5\\"","uid":-2.50E+3,"code":"x-1.0"}', "ok", ("-2.50E+3", None, "x-1.0")),
    ("{uid:1.0,name:'it\\'s 1.0'}", "ok", ("1.0", "it's 1.0", None)),
]


@pytest.fixture(scope="module")
def classified(spark):
    return classify(messages_frame(spark, [value for value, _, _ in CASES])).persist()


def test_every_defect_has_its_verdict(classified):
    found = {r.event_id: r for r in classified.collect()}
    for n, (value, verdict, record) in enumerate(CASES):
        assert found[n].verdict == verdict, value
        assert (tuple(found[n].record) if found[n].record else None) == record, value
        assert found[n].value == value


def test_good_and_dead_are_all(classified):
    good, dead = good_rows(classified), dead_letters(classified)
    assert good.columns == ["event_id", "ts", "uid", "name", "code"]
    assert dead.columns == ["event_id", "ts", "value", "verdict"]
    ids = [r.event_id for r in good.union(dead.select(good.columns[:2] + [F.lit(None)] * 3)).collect()]
    assert sorted(ids) == list(range(len(CASES)))
    assert sum(r.n for r in dead_letter_counts(classified).collect()) == dead.count()


def test_gate_gives_the_same_verdicts(spark, classified):
    gate = json_gate(messages_frame(spark, [value for value, _, _ in CASES]))
    assert gate.columns == ["event_id", "ts", "value", "verdict"]
    mine = {r.event_id: r.verdict for r in gate.collect()}
    assert mine == {r.event_id: r.verdict for r in classified.collect()}


def test_blank_filter_and_tap_see_every_message(spark):
    frame = messages_frame(spark, [value for value, _, _ in CASES])
    assert blank_filter(frame).count() == sum(verdict != "blank" for _, verdict, _ in CASES)
    lines = [r.line for r in raw_tap(frame).collect()]
    assert lines[0] == "kafka-info:> null" and len(lines) == len(CASES)
    assert lines[6] == "kafka-info:> not json"


def test_other_schemas(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.DateType())])
    frame = messages_frame(
        spark, ['{"id":7,"at":"2024-05-01"}', '{"id":"7x"}', '{"id":null}', '{"at":"soon"}', '{"id":[1]}']
    )
    rows = classify(frame, schema).orderBy("event_id").collect()
    assert [r.verdict for r in rows] == ["ok", "bad_field", "ok", "bad_field", "bad_field"]
    assert rows[0].record.id == 7 and str(rows[0].record["at"]) == "2024-05-01"
    assert good_rows(classify(frame, schema)).dtypes[2:] == [("id", "bigint"), ("at", "date")]


def test_long_texts_are_parsed_whole(spark):
    text = ' 1.5 "\\' * 200_000
    literal = text.replace("\\", "\\\\").replace('"', '\\"')
    frame = messages_frame(spark, [f'{{"name":"{literal}","uid":2.50}}', f'{{"name":"{literal}"}} x'])
    good, bad = classify(frame).orderBy("event_id").collect()
    assert good.record.name == text and good.record.uid == "2.50"
    assert bad.verdict == "bad_json"


def test_the_parse_is_not_copied_into_filters(spark):
    frame = messages_frame(spark, ["{}"])
    plan = good_rows(classify(frame)).filter("uid is not null and ts > '2024-01-01'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("__sealed_by__),true), (allowSingleQuotes") <= 1
    filters = [line for line in text.splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[]":, \\\'ab1.e-null\n', max_size=14), min_size=30, max_size=30))
def test_every_message_has_one_verdict(spark, values):
    rows = classify(messages_frame(spark, values)).collect()
    assert len(rows) == len(values)
    for row in rows:
        assert row.verdict in {"blank", "bad_json", "not_object", "bad_field", "ok"}
        assert (row.record is not None) == (row.verdict == "ok")


def test_what_is_no_number_is_no_json(spark):
    lines = ['{"uid":NaN}', '{"uid":Infinity}', '{"uid":-Infinity}', '{"uid":"NaN"}', '{"uid":1e999}']
    rows = classify(messages_frame(spark, lines)).orderBy("event_id").collect()
    assert [r.verdict for r in rows] == ["bad_json"] * 3 + ["ok"] * 2
    assert rows[3].record.uid == "NaN" and rows[4].record.uid == "1e999"
