"""Quality rules: measures of one text, and the frequency of lines across documents.

A line is normalised (words joined by one blank, lower case) and hashed. Per host, the number
of distinct documents that hold it is counted. Documents of the same normalised lines in the same
order are one, both here and in the number of the host's documents: copies so do not make their
own lines look like boilerplate. Documents that differ in a line are several, also near copies,
since those cannot be told by lines from documents that are mostly boilerplate. A line in more
than ``max_share`` of the host's documents, and in at least ``min_docs`` of them, is above the
limit. Its occurrences are removed; a document is rejected if under ``min_left`` of its words
remain, or if it fails the base rules.

Cases: a null text has no words and fails; a null host counts as the empty one; a line without
words is never removed, and documents without other lines are one; rows that are equal in id, host
and text get equal results, one each; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import SPACES, SPACES_CLASS, let, packed, text_key, unpacked
from paneflow.session import written

#: Signs that count as symbols.
SYMBOLS = "[#*$%&|<>]"


class Limits(NamedTuple):
    min_words: int = 50
    max_repeat_percent: int = 50
    max_share: float = 0.10
    min_docs: int = 20
    min_left: float = 0.20


def words(text: Column) -> Column:
    """The runs of characters other than white space; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"{SPACES_CLASS}+"))


def _repeated(parts: Column) -> Column:
    """Number of words that lie in a window of three that occurs twice or more."""

    def windows(h):
        count = F.greatest(F.size(h) - 2, F.lit(0))
        return F.sort_array(
            F.transform(
                F.slice(h, F.lit(1), count),
                lambda x, i: F.struct(F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("i")),
            )
        )

    def places(s):
        again = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(p):
        gaps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    hashes = F.transform(parts, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: let(windows(h), lambda s: let(places(s), covered)))


def measures(text: Column) -> Column:
    """One struct in an array, for ``inline``, which keeps the words from being split per column."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")

    def row(parts):
        return F.struct(
            F.size(parts).cast("long").alias("n_words"),
            F.char_length(F.array_join(parts, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            _repeated(parts).cast("long").alias("n_repeat_words"),
        )

    return F.transform(F.array(words(text)), row)


def normalised(line: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(line, f"{SPACES_CLASS}+", " "), F.lit(" ")))


def _keys(docs: DataFrame, text: str, host: str, doc_id: str) -> list[Column]:
    return [
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(F.col(doc_id), F.col(host), F.col(text)).alias("row_key"),
    ]


def line_entries(text: Column) -> Column:
    """(line, n_words) of every line with words; ``line`` is a hash."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), normalised), lambda line: line != "")
    entry = lambda line: F.struct(text_key(line).alias("line"), F.size(F.split(line, " ")).alias("n_words"))
    return let(lines, lambda found: F.transform(found, entry))


def profiles(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, host, row_key, the measures and ``lines``: what is asked of the texts, read once and written."""
    rows = docs.select(*_keys(docs, text, host, doc_id), F.inline(measures(F.col(text))), line_entries(F.col(text)).alias("lines"))
    return written(rows, "quality-profiles")


def frequent_lines(lines: DataFrame, hosts: DataFrame, limits: Limits) -> DataFrame:
    """(host, line, n_docs) of the lines above the limit; ``hosts`` has each host's ``host_docs``.

    ``same`` stands for the document.
    """
    counts = lines.groupBy("host", "line").agg(F.count_distinct("same").alias("n_docs")).filter(F.col("n_docs") >= limits.min_docs)
    return counts.join(hosts, "host").filter(F.col("n_docs") > F.col("host_docs") * limits.max_share).select("host", "line", "n_docs")


def removals(profile: DataFrame, limits: Limits) -> DataFrame:
    """(lost_id, lost_key, removed_words, removed_lines) of the documents that lose lines."""
    profile = profile.select("doc_id", "host", "row_key", F.xxhash64("lines.line").alias("same"), "lines")
    lines = profile.select("doc_id", "host", "row_key", "same", F.posexplode("lines").alias("place", "entry")).select("doc_id", "host", "row_key", "same", "place", "entry.*")
    hosts = profile.groupBy("host").agg(F.count_distinct("same").alias("host_docs"))
    # written first: these are the hot keys, and the planner sees how few they are
    found = written(frequent_lines(lines, hosts, limits).select("host", "line"), "quality-lines")
    hit = lines.drop("same").join(found, ["host", "line"])
    hit = hit.select("doc_id", "row_key", "place", "line", "n_words").distinct()
    return hit.groupBy(F.col("doc_id").alias("lost_id"), F.col("row_key").alias("lost_key")).agg(
        F.sum("n_words").cast("long").alias("removed_words"), F.collect_set("line").alias("removed_lines")
    )


def _verdict(limits: Limits) -> tuple[Column, Column, Column]:
    """(removed words, failed, depleted) of a profile joined with its removals."""
    removed = F.coalesce("removed_words", F.lit(0).cast("long"))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    return removed, failed, F.col("n_words") - removed < F.col("n_words") * limits.min_left


def _with_removals(profile: DataFrame, limits: Limits) -> DataFrame:
    same = F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("row_key") == F.col("lost_key"))
    return profile.drop("lines").join(removals(profile, limits), same, "left")


def judged(docs: DataFrame, limits: Limits = Limits(), text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, the measures, base_failed, kept and removed_words: one row per row of ``docs``."""
    removed, failed, depleted = _verdict(limits)
    return _with_removals(profiles(docs, text, host, doc_id), limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), removed.alias("removed_words"),
    )


def kept_documents(docs: DataFrame, limits: Limits = Limits(), text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` for the documents kept, with the frequent lines cut out of their texts.

    A column ``n_chars`` is brought up to date.
    """
    _, failed, depleted = _verdict(limits)
    kept = _with_removals(profiles(docs, text, host, doc_id), limits).filter(~failed & ~depleted)
    # equal rows have equal verdicts
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("row_key").alias("kept_key"), "removed_lines").dropDuplicates(["kept_id", "kept_key"])
    rows = docs.select(*_keys(docs, text, host, doc_id), packed(docs))
    out = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("row_key") == F.col("kept_key")))
    old = F.col("row").getField(text)
    left = F.filter(F.split(old, "\n"), lambda line: ~F.array_contains(F.col("removed_lines"), text_key(normalised(line))))
    new = F.when(F.col("removed_lines").isNull(), old).otherwise(F.array_join(left, "\n"))
    out = out.withColumn("row", F.col("row").withField(f"`{text}`", new))
    if "n_chars" in docs.columns:
        out = out.withColumn("row", F.col("row").withField("n_chars", F.char_length(F.col("row").getField(text)).cast(docs.schema["n_chars"].dataType)))
    return unpacked(out, docs)
