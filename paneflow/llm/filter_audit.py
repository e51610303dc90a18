"""What each of five filters removes in every order of application, by incremental retraction.

All files of a folder run through one stream as available-now micro-batches. State keyed by the
text holds the least id seen so far and how many documents have it, by part and label. The documents
of a micro-batch that have their text's least id are counted by the filters that their own text
fails (their mask), all others with the filter of copies in the mask as well. Where a smaller id
arrives than those of earlier micro-batches, the documents that held the least id are taken out of
the counter of their earlier mask and put into the one with the filter of copies. Each micro-batch
writes such changes of the part counters; their sum are the counters, at any time those of the files
read so far. All orders follow from them: whether a filter removes a document depends on its mask and
on the set of filters before only.

State is a log: a micro-batch reads what those before it wrote, a short row per text, part and label,
and adds its own, both below its id, so that one that runs again replaces what it wrote. It is read once
a micro-batch, so a load is dealt into few large ones (``MICRO_BATCHES``). Copies are summed up before
they meet by text: a group of any size is a row per part and label there. Nothing is collected.

Cases: a null text is empty, a null part the empty string; a document without an id never counts as
a copy, nor others as copies of it; rows that repeat an id and a text are no copies of each other;
a document is good or toxic if any of its label rows says so; files without rows give no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneflow.llm.common import _ODD, chunks, mixed
from paneflow.session import scratch_path, written

FILTERS = "ABCDE"
#: The filter of copies, and its bit in a mask.
COPIES = 1 << FILTERS.index("E")
#: Kinds of UTF-8 bytes: white space, capitals, signs, first bytes of a code point.
_BYTES = np.arange(256)
_SPACE = (_BYTES == 32) | (_BYTES >= 9) & (_BYTES <= 13)
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_SIGN = np.isin(_BYTES, np.frombuffer(b"#$%&*|", np.uint8))
_POINT = (_BYTES & 0xC0) != 0x80
#: Files are dealt out over so many micro-batches.
MICRO_BATCHES = 4

COUNTS = "part string, mask int, flags int, n long"
#: A row of a micro-batch by text, part and label, or (``old``) one of before whose id is the least no more:
#: documents with an id and without one, the least id and how many have it, the text's least ids before and now.
STATE = "key binary, part string, mask int, flags int, old boolean, known long, free long, least long, held long, before long, now long"


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit hash) of every word, case kept; a word ends at white space or its document's end."""
    inside = ~_SPACE[flat]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[heads] = inside[heads]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(starts[at])
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    powers = np.cumprod(np.full(int(place.max()) + 1, _ODD))
    hashes = mixed(np.add.reduceat((flat[at].astype(np.uint64) + np.uint64(1)) * powers[place], first))
    return np.searchsorted(offsets, at[first], "right") - 1, hashes


def text_masks(texts: pa.Array) -> np.ndarray:
    """For each text the bits of the filters that it fails by itself."""
    found = np.zeros(len(texts), np.int32)
    for first, last, flat, offsets in chunks(texts):
        n = last - first
        doc, hashes = word_hashes(flat, offsets)
        n_words = np.bincount(doc, minlength=n)
        # equal words of a document are neighbours
        told = hashes ^ mixed(doc.astype(np.uint64))
        order = np.argsort(told)
        new = np.ones(len(told), bool)
        new[1:] = np.diff(told[order]) != 0
        n_distinct = np.bincount(doc[order][new], minlength=n)

        def count(kind, offsets=offsets, flat=flat):
            ahead = np.concatenate([[0], np.cumsum(kind[flat])])
            return ahead[offsets[1:]] - ahead[offsets[:-1]]

        fails = [n_words < 200, 100 * n_distinct < 50 * n_words, 100 * count(_CAPITAL) > 2 * count(_POINT), count(_SIGN) > 0]
        found[first:last] = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
    return found


def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's documents with their masks in place of their texts."""
    for batch in batches:
        mask = pa.array(text_masks(batch["text"]), pa.int32())
        yield pa.RecordBatch.from_arrays([batch["key"], batch["doc_id"], batch["part"], mask], ["key", "doc_id", "part", "mask"])


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, flags) of the documents that have a label: 1 for good, 2 for toxic."""
    flags = F.when(F.col("quality") == 1, 1).otherwise(0), F.when(F.col("toxic") == 1, 2).otherwise(0)
    best = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return best.agg((F.max(flags[0]) + F.max(flags[1])).alias("flags")).filter("flags > 0")


def summed(facts: DataFrame) -> DataFrame:
    """The rows of a micro-batch by text, part and label."""
    one = facts.groupBy("key", "part", "mask", "flags", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct(F.col("doc_id").alias("least"), F.col("n").alias("held"))))
    free = F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)
    sums = one.groupBy("key", "part", "mask", "flags").agg(F.sum("n").alias("n"), F.sum(free).alias("free"), first.alias("first"))
    return sums.select("key", "part", "mask", "flags", F.lit(False).alias("old"), (F.col("n") - F.col("free")).alias("known"), "free", "first.*")


def updated(rows: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """The micro-batch's rows with their text's least ids, and the earlier rows that a smaller id replaces."""
    if earlier is not None:
        leading = earlier.filter((F.col("least") == F.col("now")) & ~F.col("old")).withColumn("old", F.lit(True))
        rows = rows.unionByName(leading.select(rows.columns))
    text = Window.partitionBy("key")
    before = F.min(F.when(F.col("old"), F.col("least"))).over(text)
    fresh = F.min(F.when(~F.col("old"), F.col("least"))).over(text)
    found = rows.withColumns({"before": before, "fresh": fresh}).withColumn("now", F.least("before", "fresh"))
    replaced = (F.col("least") == F.col("before")) & (F.col("now") < F.col("before"))
    return found.filter(~F.col("old") | replaced).drop("fresh")


def changes(state: DataFrame) -> DataFrame:
    """(part, mask, flags, n) by which a micro-batch's rows change the counters."""
    lead = F.when(F.col("least") == F.col("now"), F.col("held")).otherwise(0)
    copied = F.col("mask").bitwiseOR(COPIES)

    def entry(mask, n):
        return F.struct(mask.alias("mask"), n.alias("n"))

    taken = F.array(entry(F.col("mask"), -F.col("held")), entry(copied, F.col("held")))
    added = F.array(entry(F.col("mask"), F.col("free") + lead), entry(copied, F.col("known") - lead))
    each = state.select("part", "flags", F.inline(F.when(F.col("old"), taken).otherwise(added)))
    return each.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).filter("n <> 0")


def logged(spark: SparkSession, folder: str, kind: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch_id long").parquet(f"{folder}/{kind}")


def as_pattern(path: str) -> str:
    """A pattern that only ``path`` matches: a stream reads a single file by pattern only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def audit_batch(batch: DataFrame, batch_id: int, flags: DataFrame, folder: str) -> None:
    """One micro-batch of documents: its state and changes written below its id."""
    spark = batch.sparkSession
    facts = batch.select(
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        "text",
    ).mapInArrow(masked, "key binary, doc_id long, part string, mask int")
    labelled = facts.join(flags, "doc_id", "left").withColumn("flags", F.coalesce("flags", F.lit(0)))
    earlier = logged(spark, folder, "state", STATE).filter(F.col("batch_id") < batch_id) if batch_id else None
    place = f"batch_id={int(batch_id)}"
    updated(summed(labelled), earlier).write.mode("overwrite").parquet(f"{folder}/state/{place}")
    mine = logged(spark, folder, "state", STATE).filter(F.col("batch_id") == batch_id)
    changes(mine).write.mode("overwrite").parquet(f"{folder}/changes/{place}")


def run_changes(spark: SparkSession, path: str, labels: DataFrame, files_per_trigger: int | None = None, folder: str | None = None) -> str:
    """Stream the files below ``path`` that were not read before; gives the folder of state and changes.

    With the ``folder`` of an earlier run only new files are read.
    """
    stored = spark.read.parquet(path)
    if files_per_trigger is None:
        files_per_trigger = -(-len(stored.inputFiles()) // MICRO_BATCHES) or 1
    folder = folder or scratch_path(spark, "audit")
    flags = written(label_flags(labels), "audit-labels")
    docs = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(as_pattern(path))
    writer = docs.writeStream.foreachBatch(lambda batch, batch_id: audit_batch(batch, batch_id, flags, folder))
    writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return folder


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """(part, mask, flags, n) of the files read so far."""
    log = logged(spark, folder, "changes", COUNTS)
    return log.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).filter("n <> 0")


def _stations() -> Column:
    """Every filter after every set of others: its bit, the set's bits, the orders in which that happens."""
    found: dict[tuple[int, int], list[str]] = {}
    for order in permutations(FILTERS):
        before = 0
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            found.setdefault((bit, before), []).append("".join(order))
            before |= bit
    listed = [{"bit": b, "before": p, "step": p.bit_count() + 1, "orders": o} for (b, p), o in found.items()]
    return F.from_json(F.lit(json.dumps(listed)), "array<struct<bit:int,before:int,step:int,orders:array<string>>>")


def audit(counted: DataFrame) -> DataFrame:
    """A row per part, order and step, from the counters."""
    cells = F.collect_list(F.struct("mask", "flags", F.col("n").cast("long").alias("n"))).alias("cells")  # at most 128
    parts = counted.groupBy("part").agg(cells).withColumn("at", F.explode(_stations()))
    bit, before = F.col("at.bit"), F.col("at.before")

    def total(test, times=lambda c: F.lit(1)):
        one = lambda c: F.when(test(c), c["n"] * times(c)).otherwise(F.lit(0).cast("long"))
        return F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + one(c))

    def fails(c):
        return c["mask"].bitwiseAND(bit) != 0

    def gone(c):
        return c["mask"].bitwiseAND(before) != 0

    def removed(c):
        return fails(c) & ~gone(c)

    # of the orders of all five filters, one in as many as fail has this one first
    orders = len(list(permutations(FILTERS)))
    sums = parts.select(
        "part", "at.orders", F.col("at.step").alias("step"),
        total(lambda c: ~fails(c) & ~gone(c)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda c: fails(c) & gone(c)).alias("redundant"),
        total(lambda c: c["mask"] == bit).alias("unique_fails"),
        total(lambda c: removed(c) & (c["flags"].bitwiseAND(1) != 0)).alias("good_lost"),
        total(lambda c: removed(c) & (c["flags"].bitwiseAND(2) != 0)).alias("toxic_lost"),
        total(fails, lambda c: F.floor(F.lit(orders) / F.bit_count(c["mask"]))).alias("shapley"),
    )
    rest = [c for c in sums.columns if c not in ("part", "orders")]
    return sums.select("part", F.explode("orders").alias("filter_order"), *rest)


def audited(spark: SparkSession, path: str, labels: DataFrame, files_per_trigger: int | None = None) -> DataFrame:
    """part, filter_order, step and the counts, from the document files below ``path``."""
    return audit(counters(spark, run_changes(spark, path, labels, files_per_trigger)))
