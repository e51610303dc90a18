"""Salted time row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time patterns of the row key. The parity pattern has the month where
# the minute should be and a 12-hour clock, so its keys recur within an hour.
PARITY_PATTERN = "yyyy-MM-dd hh:MM:ss"
FIXED_PATTERN = "yyyy-MM-dd HH:mm:ss"
SALT_LENGTH = 5


def row_key(ts: str = "ts", uid: str = "uid", pattern: str = PARITY_PATTERN) -> Column:
    """``<first five hex digits of md5(time)>_<time>_<uid>``; a null uid reads ``null``.

    The time is a column, not the clock, so a replayed row gets the key it had before.
    """
    time = F.date_format(F.col(ts), pattern)
    salt = F.substring(F.md5(time), 1, SALT_LENGTH)
    return F.concat(salt, F.lit("_"), time, F.lit("_"), F.coalesce(F.col(uid), F.lit("null")))
