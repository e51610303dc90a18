"""Hard negatives by exact integer products, several candidates to a multiplication.

Components become integers, floor(scale * x). A block of candidates is packed: each component is
biased so that none is negative, and the components of several candidates are put into separate
fields of one wide integer, as wide as the largest possible product sum. One multiplication with
an anchor's (biased) component then serves them all, the sums of the fields never meet, and the
scores are unpacked from the fields and the biases taken out again. The wide integers are doubles as
long as two fields or more fit 53 bits, in which whole numbers and their sums are exact, or else one
field does; beyond that they are Python's integers of any width. Scores are exact in every case.

How it is spread: candidates are dealt evenly over groups (their place on disk decides, so repeated
rows are spread too), every group is one stay in a task, with at most ``GROUP_VALUES`` components on the
average, and all anchors pass by it, an Arrow batch at a time. A group gives each anchor's best few; these
are ranked over the groups. There are two such passes, the first for the positives, whose scores the
second needs. Anchors, a share of the rows, move once per group, candidates once a pass. Nothing is
broadcast or collected.

Cases: rows with a null label or vector, or with a component that is null or not finite, take no part;
shorter vectors count as filled up with zeros; equal anchors count once; other equal rows are rows of
their own; an anchor's other rows are those with another id; a null id comes last in ties and is no
anchor; scores beyond a long are cut off at its ends; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneflow.session import written

#: Groups at least, and components to a group on the average.
GROUPS, GROUP_VALUES = 64, 1 << 23
#: Scores that a task holds at once.
SCORES = 1 << 22
#: Bits in which a double's whole numbers are exact.
EXACT_BITS = 53
LONG = 2**63 - 1


class Rule(NamedTuple):
    """How many positives and negatives, and the percentages of a positive's score that a negative lies between."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256


def as_whole(numbers: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers as doubles, longs or Python's integers."""
    if kind is not object or numbers.dtype == object:
        return numbers.astype(kind)
    return np.array([int(x) for x in numbers.flat], object).reshape(numbers.shape)


class Packed:
    """A block of candidates, a row of whole numbers each, as columns of wide integers."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.low = int(rows.min()) if rows.size else 0
        self.high = int(rows.max()) if rows.size else 0
        self.words: dict[tuple[int, int], np.ndarray] = {}

    def packed(self, width: int, fields: int) -> np.ndarray:
        """(components, words): field k of the words holds the k-th part of the candidates."""
        if (width, fields) not in self.words:
            n, d = self.rows.shape
            size = -(-n // fields)
            kind = object if self.rows.dtype == object or width * fields > EXACT_BITS else float
            words = np.zeros((d, size), kind)
            for k in range(fields):
                part = as_whole(self.rows[k * size : (k + 1) * size], kind) - self.low
                words[:, : len(part)] += part.T * (1 << (width * k))
            self.words = {(width, fields): words}
        return self.words[width, fields]

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """(anchors, candidates): the inner products."""
        (n, d), m = self.rows.shape, len(anchors)
        if not n or not m or not d:
            return np.zeros((m, n), np.int64)
        low, high = int(anchors.min()), int(anchors.max())
        width = max(1, (d * (high - low) * (self.high - self.low)).bit_length())
        largest = d * max(abs(low), abs(high)) * max(abs(self.low), abs(self.high))
        exact = width <= EXACT_BITS and 4 * largest < LONG
        fields = EXACT_BITS // width if exact else 4
        whole = np.int64 if exact else object
        words = self.packed(width, fields)
        lifted = as_whole(anchors, words.dtype.type if exact else object) - low
        sums = as_whole(lifted @ words, whole)
        mask = (1 << width) - 1
        found = np.concatenate([(sums >> (width * k)) & mask for k in range(fields)], axis=1)[:, :n]
        # taking the biases out: (a + low)(c + low') summed up
        found += (self.low * as_whole(lifted, whole).sum(axis=1))[:, None]
        found += (low * (as_whole(self.rows, whole) - self.low).sum(axis=1))[None, :]
        return found + d * low * self.low


def whole_numbers(vectors: pa.Array, scale: int, width: int = 0) -> np.ndarray:
    """floor(scale * x) as a matrix; rows are filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = np.diff(vectors.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = np.floor(flat * scale)
    if np.abs(out).max(initial=0) < 2.0**EXACT_BITS:
        return out
    return np.array([[int(x) for x in row] for row in out], object).reshape(out.shape)


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] >= width else np.concatenate([rows, np.zeros((len(rows), width - rows.shape[1]), rows.dtype)], axis=1)


def best(scores: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k places of highest score, ties in the order of the places."""
    if len(scores) > k:
        if scores.dtype == object:
            bound = sorted(scores, reverse=True)[k - 1]
        else:
            bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        top = scores >= bound
        scores, places = scores[top], places[top]
    order = np.argsort(-scores, kind="stable")[:k]
    return scores[order], places[order]


class Group:
    """The candidates of a group, in the order of their ids."""

    def __init__(self, batches: list[pa.RecordBatch], scale: int):
        rows = pa.Table.from_batches(batches)
        self.block = Packed(whole_numbers(rows["v"], scale))
        self.known = rows["vec_id"].is_valid().to_numpy()
        self.numbers = rows["vec_id"].fill_null(0).to_numpy()
        self.at = rows["at"].to_numpy()
        self.labels = rows["label"].to_pandas().to_numpy()

    def scored(self, batch: pa.RecordBatch, scale: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each anchor's place in the batch and its scores."""
        anchors = whole_numbers(batch["v"], scale, self.block.rows.shape[1])
        if anchors.shape[1] > self.block.rows.shape[1]:
            self.block = Packed(widened(self.block.rows, anchors.shape[1]))
        step = max(1, SCORES // max(1, len(self.at)))
        for first in range(0, len(anchors), step):
            for k, scores in enumerate(self.block.scores(anchors[first : first + step]), first):
                yield k, scores

    def found(self, k: int, scores: np.ndarray, places: np.ndarray) -> list[tuple]:
        return [
            (k, max(-LONG - 1, min(LONG, int(s))), int(self.numbers[p]) if self.known[p] else None, int(self.at[p]))
            for s, p in zip(scores, places, strict=True)
        ]


def positives_in(group: Group, batch: pa.RecordBatch, rule: Rule) -> list[tuple]:
    """(anchor's place, score, id, at) of the best rows of the anchors' labels."""
    out, labels, ids = [], batch["label"].to_pylist(), batch["vec_id"].to_pylist()
    for k, scores in group.scored(batch, rule.scale):
        places = np.flatnonzero((group.labels == labels[k]) & ~(group.known & (group.numbers == ids[k])))
        out += group.found(k, *best(scores[places], places, rule.positives))
    return out


def negatives_in(group: Group, batch: pa.RecordBatch, rule: Rule) -> list[tuple]:
    """((anchor's place, number of its positive), score, id, at) of the best rows between the limits."""
    out, labels, wanted = [], batch["label"].to_pylist(), batch["wanted"].to_pylist()
    for k, scores in group.scored(batch, rule.scale):
        limits = [(-(-rule.low * w // 100), rule.high * w // 100) for w in wanted[k]]
        inside = (scores >= min(a for a, _ in limits)) & (scores <= max(b for _, b in limits))
        places = np.flatnonzero(inside & (group.labels != labels[k]))
        mine = scores[places]
        for number, (low, high) in enumerate(limits):
            fit = (mine >= low) & (mine <= high)
            out += group.found((k, number), *best(mine[fit], places[fit], rule.negatives))
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(group, whether candidates, rows) of rows sorted by group, candidates first."""
    for batch in batches:
        group, anchor = batch["part"].to_numpy(), batch["is_anchor"].to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((np.diff(group) != 0) | (np.diff(anchor.astype(int)) != 0)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:], strict=False):
            if begin < end:
                yield int(group[begin]), not anchor[begin], batch.slice(begin, end - begin)


def _passed(rows: DataFrame, anchors: DataFrame, groups: int, rule: Rule, second: bool) -> DataFrame:
    """All anchors past all groups: (anchor, number, score, id, at), each group's best."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        here, group = None, None
        for number, candidates, batch in _runs(batches):
            if number != here:
                here, held, group = number, [], None
            if candidates:
                held.append(batch)
                continue
            if not held:  # a group without candidates
                continue
            group = group or Group(held, rule.scale)
            found = (negatives_in if second else positives_in)(group, batch, rule)
            at = batch["at"].to_pylist()
            keys = [f[0] if second else (f[0], 0) for f in found]
            columns = [[at[k] for k, _ in keys], [n for _, n in keys], *([f[i] for f in found] for i in (1, 2, 3))]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "number", "score", "id", "at"])

    everywhere = anchors.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), "is_anchor": F.lit(True)})
    here = rows.withColumns({"part": F.pmod("at", F.lit(groups)).cast("int"), "is_anchor": F.lit(False)})
    both = here.unionByName(everywhere, allowMissingColumns=True).repartition(groups, "part")
    order = ["part", "is_anchor", F.col("vec_id").asc_nulls_last(), "at"]
    return both.sortWithinPartitions(*order).mapInArrow(work, "anchor long, number int, score long, id long, at long")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """The best of all groups, with their ``rank``."""
    order = Window.partitionBy("anchor", "number").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "at")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def usable(vectors: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and v of the rows that take part, with ``at``, their place on disk."""
    scaled = lambda x: x.cast("double") * scale
    finite = F.forall(F.col(embedding), lambda x: F.coalesce(F.abs(scaled(x)) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.filter(F.col(label).isNotNull() & F.col(embedding).isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("v")
    )
    return written(rows.withColumn("at", F.monotonically_increasing_id()), "negative-rows")


def mined(vectors: DataFrame, is_anchor: Column, rule: Rule = Rule(), groups: int = GROUPS,
          vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a test of ``vec_id``.
    """
    rows = usable(vectors, rule.scale, vec_id, embedding, label)
    values = rows.agg(F.sum(F.size("v"))).first()[0] or 0
    groups = max(groups, -(-values // GROUP_VALUES))
    anchors = written(rows.filter(is_anchor).groupBy("vec_id", "label", "v").agg(F.min("at").alias("at")), "negative-anchors")

    positives = written(_ranked(_passed(rows, anchors, groups, rule, False), rule.positives), "negative-positives")
    # at most ``rule.positives`` to an anchor
    pairs = F.array_sort(F.collect_list(F.struct("rank", "score", "id")))
    wanted = positives.groupBy(F.col("anchor").alias("at")).agg(pairs.alias("pairs"))
    asked = written(anchors.join(wanted, "at").withColumn("wanted", F.col("pairs.score")), "negative-asked")

    found = _ranked(_passed(rows, asked.drop("pairs"), groups, rule, True), rule.negatives)
    pair = F.get("pairs", F.col("number"))
    return found.withColumnRenamed("at", "negative_at").join(asked.select(F.col("at").alias("anchor"), "vec_id", "pairs"), "anchor").select(
        F.col("vec_id").alias("anchor_id"), pair["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), pair["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
