"""The same results in plain SQL, for another engine to check the queries against."""

from __future__ import annotations

from .messages import LINE_SQL, VALUE_SQL

MESSAGES = f"""messages as (
  select event_id, ts, {VALUE_SQL} as value
  from (select *, {LINE_SQL} as v from events) t)"""

JUDGED = rf"""{MESSAGES},
parsed as (
  select *, coalesce(json_valid(value), false) as valid from messages),
typed as (
  select *, case when valid then json_type(value) end as kind,
         case when valid then coalesce(json_type(value, '$.uid') in ('OBJECT', 'ARRAY'), false)
                           or coalesce(json_type(value, '$.name') in ('OBJECT', 'ARRAY'), false)
                           or coalesce(json_type(value, '$.code') in ('OBJECT', 'ARRAY'), false)
              end as nested
  from parsed),
judged as (
  select event_id, ts, value,
         case when value is null or regexp_full_match(value, '\s*') then 'blank'
              when not valid then 'bad_json'
              when kind <> 'OBJECT' then 'not_object'
              when nested then 'bad_field'
              else 'ok' end as verdict
  from typed)"""

USERS = f"""{JUDGED},
users as (
  select event_id, ts,
         case when verdict = 'ok' then json_extract_string(value, '$.uid') end as uid,
         case when verdict = 'ok' then json_extract_string(value, '$.name') end as name,
         case when verdict = 'ok' then json_extract_string(value, '$.code') end as code
  from judged where verdict = 'ok')"""

COMPLETE = "uid is not null and name is not null and code is not null"


def _field(column: str) -> str:
    return f"""case when {column} is not null then '"{column}":' || to_json({column})::varchar end"""


PLAIN = "'{' || concat_ws(',', " + ", ".join(_field(c) for c in ("uid", "name", "code")) + ") || '}'"
TEXT_PLAIN = "'{' || concat_ws(',', " + ", ".join(_field(c) for c in ("role", "text")) + ") || '}'"


def _html_safe(json: str) -> str:
    for character, code in (("<", "3c"), (">", "3e"), ("&", "26"), ("=", "3d"), ("''", "27")):
        json = rf"replace({json}, '{character}', '\u00{code}')"
    return json


def _row_key(uid: str, clock: str = "%I:%m:%S") -> str:
    time = f"strftime(ts, '%Y-%m-%d {clock}')"
    return f"substr(md5({time}), 1, 5) || '_' || {time} || '_' || coalesce({uid}, 'null')"


EVENT_KEY = _row_key("user_id::varchar")

NUMBERED = """numbered as (
  select *, row_number() over (partition by window_start order by ts, event_id) as rn,
         count(*) over (partition by window_start) as size
  from (select *, time_bucket(interval '1 hour', ts) as window_start from events) t)"""

BATCHES = f"""with {NUMBERED}
select window_start, (rn - 1) // 10 as batch_no, count(*) as n,
       arg_min(event_id, rn) as first_id, arg_max(event_id, rn) as last_id
from numbered group by all"""

TIMED_PANES = """
with recursive e as (
  select event_id, ts, w, row_number() over (partition by w order by ts, event_id) rn,
         count(*) over (partition by w) n
  from (select event_id, ts, time_bucket(interval '1 hour', ts) w from events) t),
r as (
  select w, rn, n, ts, event_id, null::bigint prev_id, null::timestamp ifire, (1>=5) cfire,
         case when 1>=5 then 0 else 1 end c,
         case when 1>=5 then null else ts + interval '7 minutes' end d
  from e where rn = 1
  union all
  select e.w, e.rn, e.n, e.ts, e.event_id, r.event_id, case when r.d <= e.ts then r.d end,
         (case when r.d <= e.ts then 0 else r.c end) + 1 >= 5,
         case when (case when r.d <= e.ts then 0 else r.c end) + 1 >= 5 then 0
              else (case when r.d <= e.ts then 0 else r.c end) + 1 end,
         case when (case when r.d <= e.ts then 0 else r.c end) + 1 >= 5 then null
              when r.d is null or r.d <= e.ts then e.ts + interval '7 minutes' else r.d end
  from r join e on e.w = r.w and e.rn = r.rn + 1),
p as (
  select w, ifire fired_at, 'interval' reason, rn-1 n_rows, prev_id last_id from r where ifire is not null
  union all select w, ts, 'count', rn, event_id from r where cfire
  union all select w, d, 'interval', rn, event_id from r
            where rn = n and d is not null and d < w + interval '1 hour'
  union all select w, w + interval '1 hour', 'window_end', rn, event_id from r
            where rn = n and c > 0 and (d is null or d >= w + interval '1 hour'))
select w window_start, row_number() over (partition by w order by fired_at, n_rows) pane_no,
       fired_at, reason, n_rows, last_id from p"""

KEYED_ROWS = f"""{USERS},
tagged as (
  select *, (row_number() over (partition by window_start order by ts, event_id) - 1) // 10 as batch_no
  from (select *, time_bucket(interval '2 minutes', ts) as window_start from users) t),
puts as (
  select *, {_row_key('uid')} as rowkey from tagged where {COMPLETE}),
stored as (
  select rowkey, arg_max(uid, (ts, event_id)) as uid, arg_max(code, (ts, event_id)) as code,
         arg_max(name, (ts, event_id)) as name, arg_max(window_start, (ts, event_id)) as window_start,
         arg_max(batch_no, (ts, event_id)) as batch_no
  from puts group by rowkey)"""


def _tumbling(size: str) -> str:
    return f"select time_bucket(interval '{size}', ts) as window_start, count(*) as n from events group by 1"


def _cells(source: str, keep: str) -> str:
    parts = [
        f"select {keep}, 'info' as family, '{qualifier}' as qualifier, {column} as value from {source}"
        for column, qualifier in (("uid", "uid"), ("code", "code"), ("name", "Name"))
    ]
    return " union all ".join(parts)


USER_ROWS = f"with {USERS} select uid, name, code from users"

ORACLES: dict[str, str] = {
    "source_messages": f"with {MESSAGES} select event_id, value from messages",
    "raw_tap": f"with {MESSAGES} select 'kafka-info:> ' || coalesce(value, 'null') as line from messages",
    "blank_filter": rf"with {MESSAGES} select event_id, value from messages "
    r"where value is not null and not regexp_full_match(value, '\s*')",
    "json_gate": f"with {JUDGED} select event_id, verdict from judged",
    "dead_letter_counts": f"with {JUDGED} select verdict, count(*) as n from judged "
    "where verdict <> 'ok' group by verdict",
    "keyed_verdict_counts": f"with {USERS} select verdict, count(*) as n from ("
    "select verdict from judged where verdict <> 'ok' union all "
    f"select case when {COMPLETE} then 'ok' else 'incomplete' end from users) t group by verdict",
    "user_bind": f"with {USERS} select event_id, uid, name, code from users",
    "to_json_plain": f"with {USERS} select event_id, {PLAIN} as json from users",
    "to_json_html_safe": f"with {USERS} select event_id, {_html_safe(PLAIN)} as json from users",
    "to_json_bytes": f"with {USERS} select event_id, hex(encode({_html_safe(PLAIN)})) as hex from users",
    "to_json_text_plain": f"select conv_id, turn, {TEXT_PLAIN} as json from conversations",
    "to_json_text_html_safe": f"select conv_id, turn, {_html_safe(TEXT_PLAIN)} as json from conversations",
    "row_key": f"select event_id, {EVENT_KEY} as rowkey from events",
    "row_key_fixed": f"select event_id, {_row_key('user_id::varchar', '%H:%M:%S')} as rowkey from events",
    "row_key_collisions": f"select {EVENT_KEY} as rowkey, count(*) as n from events group by 1 having count(*) > 1",
    "to_cells": f"with {USERS}, whole as (select * from users where {COMPLETE}) {_cells('whole', 'event_id')}",
    "tumbling_5m": _tumbling("5 minutes"),
    "tumbling_2m": _tumbling("2 minutes"),
    "window_collect": """
with numbered as (
  select *, row_number() over (partition by window_start order by ts, event_id) as rn
  from (select *, time_bucket(interval '1 day', ts) as window_start from events) t)
select window_start, (rn - 1) // 100 as list_no, count(*) as n,
       string_agg(user_id::varchar, ',' order by rn) as uids
from numbered group by all""",
    "pane_counts": f"with {NUMBERED} select window_start, (rn - 1) // 10 as batch_no, count(*) as n "
    "from numbered group by all",
    "count_batches": BATCHES,
    "count_batch_members": f"with {NUMBERED} select event_id, user_id, event_type, window_start, "
    "(rn - 1) // 10 as batch_no from numbered",
    "count_batches_two_phase": BATCHES,
    "count_batches_by_range": BATCHES,
    "panes_count_only": f"with {NUMBERED} select window_start, (rn + 4) // 5 as pane_no, "
    "case when rn % 5 = 0 then 'count' else 'window_end' end as reason, rn as n_rows, "
    "event_id as last_id from numbered where rn % 5 = 0 or rn = size",
    "panes_count_interval": TIMED_PANES,
    "running_count": f"with {NUMBERED} select event_id, rn as c from numbered",
    "keep_latest": f"with {NUMBERED} select window_start, event_id as last_id, event_type "
    "from numbered where rn = size",
    "sink_table_append": USER_ROWS,
    "sink_jdbc_batch": USER_ROWS,
    "sink_keyed_upsert": f"""with {KEYED_ROWS} select rowkey, uid, code, name as "Name" from stored""",
    "kafka_sink_frame": f"with {USERS} select uid as key, hex(encode({_html_safe(PLAIN)})) as value from users",
    "job_table": USER_ROWS,
    "job_jdbc": f"with {USERS} select event_id, time_bucket(interval '5 minutes', ts) as window_start, "
    "uid, name, code from users",
    "job_keyed": f"with {KEYED_ROWS} {_cells('stored', 'rowkey, window_start, batch_no')}",
    "stream_resume": USER_ROWS,
    "stream_windows": _tumbling("1 hour"),
}

# The same rows by other plans: in micro-batches, by functions, merged.
ORACLES |= {
    "held_batches": ORACLES["count_batches"],
    "carried_panes": ORACLES["panes_count_interval"],
    "ended_windows": _tumbling("1 hour"),
    "window_function": ORACLES["window_collect"],
    "sink_keyed_merge": ORACLES["sink_keyed_upsert"],
    "stream_reducers": f"with {NUMBERED} select window_start, size as c, event_id as last_id, event_type from numbered where rn = size",
}
