"""Records as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the encoder writes as escapes.
LINE_SEPARATORS = {"\u2028": "\\u2028", "\u2029": "\\u2029"}
HTML_CHARACTERS = {
    "<": "\\u003c",
    ">": "\\u003e",
    "&": "\\u0026",
    "=": "\\u003d",
    "'": "\\u0027",
}
#: Control characters whose hex code has a letter; the encoder writes it in lower case.
LETTERED_CONTROLS = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def _escaped(text: Column, escapes: dict[str, str]) -> Column:
    for character, escape in escapes.items():
        text = F.replace(text, F.lit(character), F.lit(escape))
    return text


def _lower_case_controls(text: Column) -> Column:
    lowered = text
    for code in LETTERED_CONTROLS:
        # An even run of backslashes before \u00XX is escaped text, not an escape.
        pattern = r"(?<!\\)((?:\\\\)*)\\u00" + code
        lowered = F.regexp_replace(lowered, pattern, r"$1\\u00" + code.lower())
    return F.when(text.rlike(r"\\u00[01][A-F]"), lowered).otherwise(text)


def json_plain(columns: Sequence[str]) -> Column:
    """JSON object of the columns, null fields left out, HTML characters as they are."""
    return _escaped(_lower_case_controls(F.to_json(F.struct(*columns))), LINE_SEPARATORS)


def json_html_safe(columns: Sequence[str]) -> Column:
    """As ``json_plain``, with ``< > & = '`` escaped.

    JSON's own syntax has none of the five, so replacing over the whole text
    touches values (and field names) only.
    """
    return _escaped(json_plain(columns), HTML_CHARACTERS)


def json_bytes(columns: Sequence[str]) -> Column:
    """The HTML-safe form as UTF-8 bytes, ready for a Kafka value."""
    return F.encode(json_html_safe(columns), "UTF-8")
