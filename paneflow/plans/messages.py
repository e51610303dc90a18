"""Messages made from the ``events`` table: good lines and every kind of bad one."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Both expressions read the same in Spark and in an ANSI engine.
LINE_SQL = """concat('{"uid":"', user_id, '","name":"', event_type, '","code":"', event_id, '"}')"""

VALUE_SQL = """case event_id % 20
  when 0 then '' when 1 then '   ' when 2 then null
  when 3 then substr(v, 1, length(v)-1)
  when 4 then concat(v, ' trailing')
  when 5 then 'null' when 6 then '123' when 7 then '[1,2]'
  when 8 then '{"uid":{"a":1},"name":"n","code":"c"}'
  when 9 then '{}'
  when 10 then concat('{"uid":', user_id, ',"name":true,"code":null}')
  when 11 then concat('{"uid":"', user_id, '"}')
  when 12 then concat('{"uid":"', user_id, '","extra":[1],"name":"n","code":"c"}')
  when 13 then '"{s"' when 14 then '{"uid":["x"]}'
  when 15 then concat(v, v)
  else v end"""


def messages(events: DataFrame) -> DataFrame:
    """``event_id`` (tie-breaker), ``ts`` (arrival) and ``value`` (the text)."""
    return events.selectExpr("event_id", "ts", "user_id", f"{LINE_SQL} as v").selectExpr(
        "event_id", "ts", f"{VALUE_SQL} as value"
    )
