"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of all bytes over its actual share. Each document is
repeated a Poisson number of times with that mean, found by inverting the distribution at a
number in [0, 1) hashed from the seed and the document's id; the copies are then put in the order
of a second hash, which is a global shuffle. A rate above ``STEP`` is met by summing independent
Poisson numbers of equal means, so that no probability underflows.

Cases: a null source counts as the empty one; a null text has one byte like an empty one; rows
of one id are repeated equally often; a source without a weight in ``weights`` is left out; a
null id is hashed as the empty string; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import packed, unpacked
from paneflow.session import written

#: The largest mean inverted in one step.
STEP = 64.0


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, text: str = "text", source: str = "source") -> DataFrame:
    """(source, n_bytes, rate): a source's mean number of copies.

    Without ``weights`` the target share of a source goes as its bytes to ``power``.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    sums = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).agg(F.sum(size).alias("n_bytes"))
    if weights is None:
        sums = sums.withColumn("weight", F.pow("n_bytes", F.lit(power)))
    else:
        given = docs.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, weight double")
        sums = sums.join(given, "source").filter("weight > 0")
    totals = sums.agg(F.sum("n_bytes").alias("all_bytes"), F.sum("weight").alias("all_weights"))
    share = F.col("weight") / F.col("all_weights")
    return sums.crossJoin(totals).select("source", "n_bytes", (share * F.col("all_bytes") / F.col("n_bytes")).alias("rate"))


def with_steps(rate_table: DataFrame) -> DataFrame:
    """Adds ``steps`` and ``cdf``, the cumulated probabilities of one step's Poisson law."""
    split = rate_table.withColumn("steps", F.ceil(F.col("rate") / STEP).cast("int")).withColumn("mean", F.col("rate") / F.col("steps"))
    last = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 40).cast("int")
    start = F.exp(-F.col("mean"))
    grown = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * F.col("mean") / k).alias("p"),
            (acc["c"] + acc["p"] * F.col("mean") / k).alias("c"),
            F.array_append(acc["cdf"], acc["c"] + acc["p"] * F.col("mean") / k).alias("cdf"),
        ),
    )
    return split.select("source", "rate", "steps", grown["cdf"].alias("cdf"))


def copies(seed: int) -> Column:
    """Poisson number of a row with ``doc_id``, ``steps`` and ``cdf``."""

    def one(step):
        u = uniform(F.lit(seed), F.col("id"), step)
        return F.aggregate(F.array(u), F.lit(0), lambda n, x: n + F.size(F.filter(F.col("cdf"), lambda c: c <= x)))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.col("steps")), one), F.lit(0), lambda n, x: n + x)


def replicated(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, seed: int = 11, doc_id: str = "doc_id", text: str = "text", source: str = "source", whole: bool = True) -> DataFrame:
    """(id, source_name, copy, place, row): one row per copy, in shuffled order.

    ``whole=False`` leaves ``row``, the columns of the document, out.
    """
    # written first, so that the planner knows how small the table is
    table = written(with_steps(rates(docs, weights, power, text, source)), "source-rates")
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), *([packed(docs)] if whole else []))
    counted = rows.join(table, "source").withColumn("n", copies(seed)).drop("cdf", "steps", "rate").filter("n > 0")
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
    each = each.withColumn("place", F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("copy"))))
    return each.withColumnRenamed("source", "source_name").orderBy("place")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, each document as often as drawn, in shuffled order."""
    return unpacked(replicated(docs, **options), docs)
