"""The record type and the fixed values the jobs share."""

from __future__ import annotations

from pyspark.sql import types as T

#: The default record: three nullable strings. Operators take any flat schema.
USER = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
    ]
)

#: Arrival order: time first, then a unique tie-breaker.
ARRIVAL = ("ts", "event_id")

# Window sizes, firing limits and cadence the jobs run with.
TABLE_JOB_CADENCE = "10 seconds"
JDBC_JOB_WINDOW = "5 minutes"
KEYED_JOB_WINDOW = "2 minutes"
KEYED_JOB_BATCH_ROWS = 10
DEFAULT_BATCH_ROWS = 1000
DEFAULT_FIRE_INTERVAL = "60 seconds"

# Names of the targets.
APPEND_TABLE = "hive_db.user_tbl"
JDBC_TABLE = "user_tbl"
KEYED_TABLE = "user_info"
CELL_FAMILY = "info"
#: column -> qualifier, in the order the cells are put.
CELL_QUALIFIERS = {"uid": "uid", "code": "code", "name": "Name"}

# The message verdicts.
OK = "ok"
BLANK = "blank"
BAD_JSON = "bad_json"
NOT_OBJECT = "not_object"
BAD_FIELD = "bad_field"
INCOMPLETE = "incomplete"
