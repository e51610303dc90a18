"""Shards of near equal bytes by sampled splitters.

Records are ordered by the hash of their text, so that equal texts are neighbours, and then by a
hash with their id. Keys are sampled with a chance in proportion to size; quantiles of the sample
are the splitters of ranges, several to a shard. The bytes of each range are then counted; ranges
that turned out overfull are sampled again and subdivided, a group of equal texts too, by the
second hash. A range that is still overfull holds one row many times; its rows are alike, and are numbered
where they lie, in as many tasks as there are. With the ranges' counts known, a record's place in the whole order follows from its
place in its range, and the shard from that: the bytes before the record's middle, as a share of
all. A shard so differs from the mean by no more than its records on the two borders.

What the driver holds is bounded by parameters: ``SAMPLE`` keys a range and the counts of the
ranges. Cases: a null text has no bytes and the checksum of an empty one; equal rows are
interchangeable and get slots of their own; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneflow.llm.common import packed
from paneflow.llm.mixing import uniform
from paneflow.session import written

SHARDS = 40
#: Ranges to a shard, sampled keys to a range.
RANGES, SAMPLE = 8, 24
#: A range over so many times the mean is subdivided, in so many rounds at most.
OVERFULL, ROUNDS = 2.0, 4
#: Bytes that a record counts for besides its text.
RECORD_BYTES = 16


def record_columns(doc_id: str, text: str) -> dict[str, Column]:
    return {
        "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES,
        "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit(""))),
        "k1": F.xxhash64(F.col(text)),
        "k2": F.xxhash64(F.col(doc_id), F.col(text)),
    }


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, checksum and the key (k1, k2) of the order."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), *[c.alias(n) for n, c in record_columns(doc_id, text).items()])


def ranks(k1: np.ndarray, k2: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """How many of the sorted splitters (s1, s2) are at most (k1, k2)."""
    low, high = np.searchsorted(s1, k1, "left"), np.searchsorted(s1, k1, "right")
    tied = np.nonzero(low < high)[0]
    for value in np.unique(k1[tied]):
        rows = tied[k1[tied] == value]
        a, b = low[rows[0]], high[rows[0]]
        low[rows] = a + np.searchsorted(s2[a:b], k2[rows], "right")
    return low


def in_ranges(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """Adds ``part``, the range of each record."""
    held = rows.sparkSession.sparkContext.broadcast(splitters)

    @F.pandas_udf("int")
    def part(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        s1, s2 = held.value[:, 0].copy(), held.value[:, 1].copy()
        for k1, k2 in batches:
            yield pd.Series(ranks(k1.to_numpy(), k2.to_numpy(), s1, s2).astype(np.int32))

    return rows.withColumn("part", part("k1", "k2"))


def sampled(rows: DataFrame, step: float, seed: int) -> np.ndarray:
    """(k1, k2, weight) sorted: each record with a chance of size / step, and weight max(size, step).

    The sum of sizes over ``step`` is the expected number of keys, and bounds what is collected.
    """
    drawn = rows.filter(uniform(F.lit(seed), F.col("k2")) * F.lit(step) < F.col("size"))
    found = drawn.select("k1", "k2", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("w")).toPandas()
    keys = np.stack([found["k1"].to_numpy(np.int64), found["k2"].to_numpy(np.int64)], 1) if len(found) else np.zeros((0, 2), np.int64)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    return keys[order], found["w"].to_numpy(float)[order]


def quantiles(keys: np.ndarray, weights: np.ndarray, pieces: int) -> np.ndarray:
    """The keys that cut the weights into ``pieces`` equal parts."""
    if not len(keys) or pieces < 2:
        return np.zeros((0, 2), np.int64)
    cuts = np.searchsorted(np.cumsum(weights), weights.sum() * np.arange(1, pieces) / pieces)
    return np.unique(keys[np.minimum(cuts, len(keys) - 1)], axis=0)


def part_counts(parted: DataFrame) -> pd.DataFrame:
    return parted.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("k1").alias("lo"), F.max("k1").alias("hi"), F.min("k2").alias("lo2"), F.max("k2").alias("hi2")).orderBy("part").toPandas()


def splitters_of(rows: DataFrame, shards: int = SHARDS, ranges: int = RANGES, seed: int = 5) -> tuple[np.ndarray, pd.DataFrame]:
    """Splitters and the counts of the ranges between them; overfull ranges are subdivided."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    pieces = shards * ranges
    limit, step = OVERFULL * total / pieces, total / (pieces * SAMPLE)
    splitters = quantiles(*sampled(rows, step, seed), pieces)
    for round_ in range(1, ROUNDS + 1):
        parted = in_ranges(rows, splitters)
        counts = part_counts(parted)
        several = (counts["lo"] < counts["hi"]) | (counts["lo2"] < counts["hi2"])
        over = counts[(counts["bytes"] > limit) & several]
        if round_ == ROUNDS or not len(over):
            break
        keys, weights = sampled(parted.filter(F.col("part").isin([int(p) for p in over["part"]])), step, seed + round_)
        at = ranks(keys[:, 0].copy(), keys[:, 1].copy(), splitters[:, 0].copy(), splitters[:, 1].copy())
        more = [quantiles(keys[at == p], weights[at == p], int(np.ceil(2 * b / limit))) for p, b in zip(over["part"], over["bytes"], strict=True)]
        grown = np.unique(np.concatenate([splitters, *more]), axis=0)
        if len(grown) == len(splitters):
            break
        splitters = grown
    return splitters, counts


def numbered_alike(rows: DataFrame) -> DataFrame:
    """Adds ``run_bytes`` and ``run_rows`` to rows that are alike in each ``part``, without bringing them together."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a place on disk stays what it is, whatever is run again
    laid = rows.repartition(tasks).sortWithinPartitions("part").withColumn("pos", F.monotonically_increasing_id())
    laid = written(laid.withColumn("piece", F.shiftright("pos", 33)), "shard-alike")
    spans = laid.groupBy("part", "piece").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    ahead = F.sum("n").over(Window.partitionBy("part").orderBy("piece")) - F.col("n")  # a row to a task
    spans = written(spans.select("part", "piece", "first_pos", ahead.alias("ahead")), "shard-spans")
    found = laid.join(spans, ["part", "piece"]).withColumn("run_rows", F.col("ahead") + F.col("pos") - F.col("first_pos") + 1)
    return found.withColumn("run_bytes", F.col("run_rows") * F.col("size")).drop("pos", "piece", "first_pos", "ahead")


def placed(rows: DataFrame, splitters: np.ndarray, counts: pd.DataFrame, shards: int) -> DataFrame:
    """Adds ``shard`` and ``at``, the place in the whole order."""
    total = int(counts["bytes"].sum()) or 1
    ahead = counts[["part"]].assign(bytes_ahead=counts["bytes"].cumsum() - counts["bytes"], rows_ahead=counts["rows"].cumsum() - counts["rows"])
    table = rows.sparkSession.createDataFrame([tuple(map(int, x)) for x in ahead.itertuples(index=False)], "part int, bytes_ahead long, rows_ahead long")
    run = Window.partitionBy("part").orderBy("k1", "k2").rowsBetween(Window.unboundedPreceding, 0)
    parted = in_ranges(rows, splitters)
    alike = (counts["lo"] == counts["hi"]) & (counts["lo2"] == counts["hi2"]) & (counts["bytes"] > OVERFULL * total / max(1, len(counts)))
    hot = [int(p) for p in counts["part"][alike]]
    cold = parted.filter(~F.col("part").isin(hot)) if hot else parted
    ordered = cold.select("*", F.sum("size").over(run).alias("run_bytes"), F.count("*").over(run).alias("run_rows"))
    if hot:
        ordered = ordered.unionByName(numbered_alike(parted.filter(F.col("part").isin(hot))))
    # as many rows as ranges: a bound set by the parameters
    whole = ordered.join(F.broadcast(table), "part")
    middle = (F.col("bytes_ahead") + F.col("run_bytes") - F.col("size") / 2) * F.lit(float(shards)) / F.lit(float(total))
    shard = F.least(F.floor(middle).cast("int"), F.lit(shards - 1))
    whole = whole.withColumn("shard", shard).withColumn("at", F.col("rows_ahead") + F.col("run_rows") - 1)
    return whole.drop("part", "bytes_ahead", "rows_ahead", "run_bytes", "run_rows")


def slotted(whole: DataFrame, first: DataFrame) -> DataFrame:
    """Adds law, slot and grown_shard; ``first`` has one row per shard."""
    out = whole.join(F.broadcast(first), "shard").withColumn("slot", F.col("at") - F.col("first_at"))
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def first_places(whole: DataFrame) -> DataFrame:
    return whole.groupBy("shard").agg(F.min("at").alias("first_at"))


def sharded(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = written(records(docs, doc_id, text), "shard-records")
    whole = written(placed(rows, *splitters_of(rows, shards, ranges), shards), "shard-places")
    return slotted(whole, first_places(whole)).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def sharded_documents(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with size, text_crc32, law, shard and slot, which replace any of that name.

    The splitters and first places come from the records' keys; the texts are moved once.
    """
    keys = written(records(docs, doc_id, text), "shard-records")
    splitters, counts = splitters_of(keys, shards, ranges)
    first = first_places(placed(keys, splitters, counts, shards))
    rows = docs.select(packed(docs), *[c.alias(n) for n, c in record_columns(doc_id, text).items()])
    added = ["size", "text_crc32", "law", "shard", "slot"]
    mine = [c for c in docs.columns if c.lower() not in added]
    out = slotted(placed(rows, splitters, counts, shards), written(first, "shard-first"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in mine], *added)
