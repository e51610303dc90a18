"""The quality gate: one verdict per message, and the record of the good ones.

A message is ``blank``, ``bad_json`` (not one complete JSON value), ``not_object``,
``bad_field`` (a field of the record holds an object, an array or a value of the wrong
type) or ``ok``. All of it is column expressions, valid on batches and streams.

A JSON object, the usual case, is parsed once: that one parse tells whether the text is
complete and gives the fields. Further parses run only on the rows that need them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BAD_FIELD, BAD_JSON, BLANK, NOT_OBJECT, OK, USER

BLANK_TEXT = r"\A\p{javaWhitespace}*\z"
OBJECT_START = r"\A\p{javaWhitespace}*\{"
OBJECT_END = r"\}[ \t\r\n]*\z"

#: The gate's parser takes unquoted names and single quotes.
LENIENT = {
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
    "allowUnquotedControlChars": "true",
    "allowNonNumericNumbers": "false",
}

#: What parsing makes of a number literal it may have written differently: of a fraction or
#: an exponent, of one too large for a double, of a minus zero.
REWRITTEN_NUMBER = r"\A(-?[0-9]+\.[0-9]+(E-?[0-9]+)?|\"?-?Infinity\"?|0)\z"
#: From the end of the last match: any text and whole strings, then a number literal.
#: Possessive throughout, so long texts neither backtrack nor recurse.
NUMBER_LITERAL = (
    r"(?s)\G((?:"
    r"[^\"'\w$-]++"
    r"|\"(?:[^\"\\]++|\\.)*+\""
    r"|'(?:[^'\\]++|\\.)*+'"
    r"|[A-Za-z_$][\w$-]*+"
    r")*+)(-?[0-9][0-9.eE+-]*+)"
)

_SEAL = "__sealed_by__"


def is_blank(value: Column) -> Column:
    """Null, empty, or nothing but what Java counts as whitespace."""
    return value.isNull() | value.rlike(BLANK_TEXT)


def blank_filter(messages: DataFrame, value: str = "value") -> DataFrame:
    return messages.filter(~is_blank(F.col(value)))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def _text_fields(schema: T.StructType, *more: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*schema.fieldNames(), *more)])


def _fields_of(schema: T.StructType, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, kind) for n in schema.fieldNames()])


def _starts_with(text: Column, character: str) -> Column:
    return F.coalesce(F.startswith(text, F.lit(character)), F.lit(False))


def _judged(messages: DataFrame, schema: T.StructType, value: str) -> DataFrame:
    """Add ``_parsed`` (the sealed array) and ``verdict``."""
    text = F.col(value)
    names = schema.fieldNames()
    seal = F.xxhash64(text).cast("string")
    sealed_object = F.concat(F.lit("["), text, F.lit(f',{{"{_SEAL}":"'), seal, F.lit('"}]'))
    object_array = T.ArrayType(_text_fields(schema, _SEAL))
    is_object = _starts_with(text, "{") | F.coalesce(text.rlike(OBJECT_START), F.lit(False))

    # Text cut off or followed by more seldom ends like an object; a failing parse is dear.
    ends = F.endswith(text, F.lit("}")) | text.rlike(OBJECT_END)

    parsed = messages.withColumn(
        "_parsed", F.when(is_object & ends, F.from_json(sealed_object, object_array, LENIENT))
    )
    first = F.get("_parsed", F.lit(0))
    # What follows the message in the array is the seal and nothing else.
    one_object = F.coalesce(F.slice("_parsed", 2, 2)[_SEAL] == F.array(seal), F.lit(False))

    # The parses below sit in arms of the verdict that few rows reach.
    sealed_value = F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]'))
    values = F.from_json(sealed_value, T.ArrayType(T.StringType()), LENIENT)
    one_value = F.coalesce(F.slice(values, 2, 2) == F.array(seal), F.lit(False))

    # A field's text that begins with a bracket is a nested value or a string that
    # looks like one; typed parses, which are null for anything else, tell them apart.
    def nested(bracket: str, kind: T.DataType) -> Column:
        typed = F.from_json(text, _fields_of(schema, kind), LENIENT)
        return _any([_starts_with(first[n], bracket) for n in names]) & (F.to_json(typed) != "{}")

    has_nested = nested("{", T.MapType(T.StringType(), T.StringType())) | nested(
        "[", T.ArrayType(T.StringType())
    )

    misfits = [
        first[f.name].isNotNull() & first[f.name].try_cast(f.dataType).isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    of_object = F.when(~one_object, BAD_JSON).when(has_nested, BAD_FIELD)
    if misfits:
        of_object = of_object.when(_any(misfits), BAD_FIELD)
    verdict = (
        F.when(is_object, of_object.otherwise(OK))
        .when(is_blank(text), BLANK)
        .when(one_value, NOT_OBJECT)
        .otherwise(BAD_JSON)
    )
    return parsed.withColumn("verdict", verdict)


def _record(schema: T.StructType, value: str) -> Column:
    """The record of a judged message, number literals as they were written.

    Where parsing may have rewritten a number, the message's numbers are quoted and the
    (already accepted) message is parsed again.
    """
    first = F.get("_parsed", F.lit(0))
    quoted = F.regexp_replace(F.col(value), NUMBER_LITERAL, '$1"$2"')
    rewritten = _any(
        [F.coalesce(first[n].rlike(REWRITTEN_NUMBER), F.lit(False)) for n in schema.fieldNames()]
    )
    as_text = F.when(rewritten, F.from_json(quoted, _text_fields(schema), LENIENT)).otherwise(
        F.struct(*[first[n].alias(n) for n in schema.fieldNames()])
    )
    return F.when(F.col("verdict") == OK, as_text)


def classify(messages: DataFrame, schema: T.StructType = USER, value: str = "value") -> DataFrame:
    """Add ``verdict`` and ``record`` (a struct of ``schema``, null unless ``ok``).

    ``from_json`` alone accepts text after the value. So the message is put in an array
    with a closing element that carries a hash of the message: only if the whole text
    is one value does the array have exactly two elements, the second being that seal,
    and no message can contain the seal of itself.
    """
    judged = _judged(messages, schema, value).withColumn("_text", _record(schema, value))
    fields = [F.col("_text")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]
    result = F.struct(
        F.col("verdict"), F.when(F.col("_text").isNotNull(), F.struct(*fields)).alias("record")
    )
    return _sealed_off(judged, messages.columns, result)


def _sealed_off(rows: DataFrame, columns: list[str], result: Column) -> DataFrame:
    """The columns and the fields of ``result``, computed once.

    A filter on a plain column would be pushed below it with the whole parse copied into
    the filter, once per mention. A generator's output is not: filters on the message's own
    columns still go down to the scan, those on the result stay above.
    """
    return rows.select(*columns, F.inline(F.array(result)))


def good_rows(classified: DataFrame, value: str = "value") -> DataFrame:
    """The bound records, next to the message's other columns."""
    rest = [c for c in classified.columns if c not in (value, "verdict", "record")]
    return classified.filter(F.col("verdict") == OK).select(*rest, "record.*")


def dead_letters(classified: DataFrame) -> DataFrame:
    """The messages that no record came of, as they were, with the reason."""
    return classified.filter(F.col("verdict") != OK).drop("record")


def json_gate(messages: DataFrame, schema: T.StructType = USER, value: str = "value") -> DataFrame:
    """Every message with its verdict."""
    judged = _judged(messages, schema, value)
    return _sealed_off(judged, messages.columns, F.struct("verdict"))


def dead_letter_counts(classified: DataFrame) -> DataFrame:
    return (
        classified.filter(F.col("verdict") != OK)
        .groupBy("verdict")
        .agg(F.count(F.lit(1)).alias("n"))
    )
