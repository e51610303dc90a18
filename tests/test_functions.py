import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from paneflow.functions import (
    FIXED_PATTERN,
    cell_rows,
    cell_struct,
    complete,
    json_bytes,
    json_html_safe,
    json_plain,
    row_key,
)

FIELDS = ["uid", "name", "code"]
RECORDS = [
    ("1", "a<b>&c=d'e", "x"),
    ("2", None, 'quote " slash / back \\ \\u003c'),
    (None, None, None),
    ("3", "line\u2028para\u2029", "tab\tnew\ncr\r\b\f"),
    ("4", "\x0b\x1f\x01", "\\u000B"),
    ("5", "\u00e9\u4e2d\U0001f600", ""),
]


def encoded(spark, expression):
    frame = spark.createDataFrame(RECORDS, "uid string, name string, code string")
    return [r[0] for r in frame.select(expression).collect()]


def test_plain_json_is_the_record_without_nulls(spark):
    for record, text in zip(RECORDS, encoded(spark, json_plain(FIELDS))):
        assert json.loads(text) == {k: v for k, v in zip(FIELDS, record) if v is not None}
    texts = encoded(spark, json_plain(FIELDS))
    assert texts[0] == '{"uid":"1","name":"a<b>&c=d\'e","code":"x"}'
    assert texts[2] == "{}"
    assert "line\\u2028para\\u2029" in texts[3] and "tab\\tnew\\ncr\\r\\b\\f" in texts[3]


def test_control_characters_are_escaped_in_lower_case(spark):
    text = encoded(spark, json_plain(FIELDS))[4]
    assert text == '{"uid":"4","name":"\\u000b\\u001f\\u0001","code":"\\\\u000B"}'


def test_html_safe_json_escapes_five_characters(spark):
    safe = encoded(spark, json_html_safe(FIELDS))
    assert safe[0] == '{"uid":"1","name":"a\\u003cb\\u003e\\u0026c\\u003dd\\u0027e","code":"x"}'
    for record, text in zip(RECORDS, safe):
        assert not set("<>&='") & set(text)
        assert json.loads(text) == {k: v for k, v in zip(FIELDS, record) if v is not None}


def test_bytes_are_the_html_safe_text(spark):
    for text, data in zip(encoded(spark, json_html_safe(FIELDS)), encoded(spark, json_bytes(FIELDS))):
        assert bytes(data) == text.encode("utf-8")


def keys(spark, **pattern):
    times = [dt.datetime(2024, 3, 5, h, m, 7) for h, m in ((9, 30), (9, 45), (21, 30))]
    rows = [(t, "u") for t in times] + [(times[0], None)]
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, uid string")
    return [r[0] for r in frame.select(row_key(**pattern)).collect()]


def test_parity_keys_recur_within_the_hour_and_across_noon(spark):
    first, later, evening, nobody = keys(spark)
    time = "2024-03-05 09:03:07"
    assert first == f"{hashlib.md5(time.encode()).hexdigest()[:5]}_{time}_u"
    assert first == later == evening
    assert nobody.endswith(f"_{time}_null")


def test_fixed_keys_tell_minutes_and_half_days_apart(spark):
    found = keys(spark, pattern=FIXED_PATTERN)
    assert len(set(found)) == 4
    assert found[2].split("_")[1] == "2024-03-05 21:30:07"


def test_cells(spark):
    frame = spark.createDataFrame([("1", "n", "c"), ("2", None, "c")], "uid string, name string, code string")
    whole = frame.filter(complete())
    rows = [tuple(r) for r in cell_rows(whole, ["uid"]).collect()]
    assert rows == [("1", "info", "uid", "1"), ("1", "info", "code", "c"), ("1", "info", "Name", "n")]
    assert whole.select(cell_struct().alias("info")).schema["info"].dataType.fieldNames() == ["uid", "code", "Name"]
    assert frame.select(F.count(F.when(complete(), 1))).first()[0] == 1
