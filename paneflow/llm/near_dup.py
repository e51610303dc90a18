"""Near-duplicate classes by weighted min-hash of TF-IDF shingles.

1. A shingle is a run of five words. Its weight in a document is its count there times
   ``1 + IDF_SCALE * log10(documents / document frequency)``. Frequencies are kept in a table of
   ``DF_CELLS`` hashed cells: its size does not depend on the corpus, and the frequency that
   shingles sharing a cell add to one another is a fixed share of the number of documents.
2. Improved consistent weighted sampling gives each document ``PASSES * BINS`` samples. In each
   pass a shingle falls into one bin by its hash and only competes there; an empty bin takes the
   sample of the next one that is not. Equal texts are one document from here on.
3. ``BAND_ROWS`` samples make a band, which is a bucket. First each bucket's least document is
   compared with the others of the bucket, which joins a group of near copies at a linear cost. Pairs
   are dropped if too few of their samples agree, and else verified on their texts by weighted
   Jaccard similarity, ``sum(min) / sum(max)`` of the weights: ``SIMILARITY`` or more is a link.
4. A bucket that is not one class by then is compared in full. It is dealt by hash into blocks of
   about ``BLOCK_BYTES``, and each pair of blocks is one small group of rows. Where samples agree, the
   texts are added and the pairs verified in the task, which gives only the links that join
   something: fewer than it has documents. A pair is looked at in the first band that it shares.
5. Classes are the connected components of the links.

So no step gives pairs by the square of a bucket, and no bucket is left out. The time of step 4 does
grow with the square of the documents of a bucket that are alike but no near copies; any number of
tasks can share it.

Cases: a text of one to four words is one shingle; texts without a word, and null ones, are in
classes of their own; equal texts are one class; rows of one id and one text are one document;
rows of one id and several texts link those texts' classes; rows without an id are left out;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import chunks, components, mixed, packed, shingles_of, unpacked, words_of
from paneflow.session import written

WORDS, SIMILARITY = 5, 0.8
DF_CELLS, DF_SLICES, IDF_SCALE = 1 << 20, 16, 0.1
#: Samples: 30 in ten bands of three. A pair of similarity 0.8 shares a band with chance 0.999.
PASSES, BINS, BAND_ROWS = 5, 6, 3
#: Of 30 samples a pair at 0.8 agrees in 24 on average; under 15 is five deviations off.
LEAST_AGREEING = 15
#: A block's bytes, with ``DOC_BYTES`` more for each document: at most 1,024 documents, on average.
BLOCK_BYTES, DOC_BYTES = 1 << 20, 1 << 10


def _by_document(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, shingle, count), sorted by document and shingle."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.nonzero(first)[0]
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def weighted_shingles(flat, offsets, idf: np.ndarray | None):
    """(doc, shingle, weight) of some documents; without ``idf`` the weights are counts."""
    doc, h, count = _by_document(*shingles_of(words_of(flat, offsets), WORDS))
    return doc, h, count if idf is None else count * idf[(h & np.uint64(DF_CELLS - 1)).astype(np.int64)]


# ---- document frequencies --------------------------------------------------------------------


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(DF_CELLS, np.int64)
    for batch in batches:
        for _, _, flat, offsets in chunks(batch.column(0)):
            _, h, _ = weighted_shingles(flat, offsets, None)
            np.add.at(total, (h & np.uint64(DF_CELLS - 1)).astype(np.int64), 1)
    yield _rows(dict(enumerate(total.reshape(DF_SLICES, -1))))


def _rows(slices: dict[int, np.ndarray]) -> pa.RecordBatch:
    keys = pa.array(list(slices), pa.int32())
    return pa.RecordBatch.from_arrays([keys, pa.array([x.tobytes() for x in slices.values()], pa.binary())], ["slice", "cells"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(cells, np.int64)
    if total:
        yield _rows(total)


def frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many documents have a shingle in each cell. What comes to the driver is 8 MB, always."""
    kind = "slice int, cells binary"
    parts = docs.select(text).mapInArrow(_cells, kind)
    some = parts.repartition(DF_SLICES * 4, "slice", F.pmod(F.xxhash64("cells"), F.lit(4))).mapInArrow(_summed, kind)
    total = np.zeros((DF_SLICES, DF_CELLS // DF_SLICES), np.int64)
    for k, cells in some.repartition(DF_SLICES, "slice").mapInArrow(_summed, kind).collect():
        total[k] += np.frombuffer(cells, np.int64)
    return total.reshape(-1)


def idf_table(counts: np.ndarray, n_docs: int) -> np.ndarray:
    return (1 + IDF_SCALE * np.log10(np.maximum(1.0, n_docs / np.maximum(counts, 1)))).astype(np.float32)


# ---- samples -----------------------------------------------------------------------------------


def _unit(h: np.ndarray) -> np.ndarray:
    """A number in (0, 1] from the upper bits."""
    return ((h >> np.uint64(40)).astype(np.float32) + np.float32(1)) * np.float32(2.0**-24)


def samples(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """n_docs x (PASSES * BINS) samples; a document without shingles has zeros."""
    out = np.zeros((n_docs, PASSES, BINS), np.uint64)
    log_w = np.log(weight.astype(np.float32))
    for p in range(PASSES):
        seed = mixed(h + np.uint64((p + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        u = [_unit(seed)]
        for _ in range(4):
            seed = mixed(seed + np.uint64(0xD1B54A32D192ED03))
            u.append(_unit(seed))
        r = -np.log(u[0] * u[1])  # Gamma(2, 1)
        t = np.floor(log_w / r + u[4])
        log_a = np.log(-np.log(u[2] * u[3])) - r * (t - u[4]) - r
        cell = doc * BINS + (mixed(h ^ np.uint64(p + 77)) % np.uint64(BINS)).astype(np.int64)
        least = np.full(n_docs * BINS, np.inf, np.float32)
        np.minimum.at(least, cell, log_a)
        best = np.nonzero(log_a == least[cell])[0]
        best = best[np.lexsort((h[best], cell[best]))]  # a tie goes to the lesser hash
        best = best[np.append(True, cell[best][1:] != cell[best][:-1])[: len(best)]]
        got = mixed(h[best] + t[best].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        out.reshape(n_docs, -1)[doc[best], p * BINS + cell[best] % BINS] = got
    for k in range(1, BINS):  # densification: from the next bin that had a sample
        if k == 1:
            had = out.copy()
        empty = out == 0
        out[empty] = mixed(np.roll(had, -k, axis=2)[empty] + np.uint64(k)) * (np.roll(had, -k, axis=2)[empty] != 0)
    return out.reshape(n_docs, -1)


def _signer(idf):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, flat, offsets in chunks(batch.column(2)):
                found = samples(*weighted_shingles(flat, offsets, idf.value), last - first)
                has = found.any(axis=1)
                bands = found.reshape(last - first, -1, BAND_ROWS)
                key = np.zeros(bands.shape[:2], np.uint64)
                for k in range(BAND_ROWS):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
                key = mixed(key + np.arange(bands.shape[1], dtype=np.uint64))
                low = (found & np.uint64(0xFFFF)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array([row.tobytes() if ok else None for row, ok in zip(low, has, strict=True)], pa.binary()),
                        pa.array([row.view(np.int64) if ok else None for row, ok in zip(key, has, strict=True)], pa.list_(pa.int64())),
                        pa.array(np.diff(offsets) + DOC_BYTES, pa.int64()),
                    ],
                    ["doc_id", "same", "samples", "bands", "bytes"],
                )

    return sign


# ---- pairs -------------------------------------------------------------------------------------


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs with enough equal samples."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(batch.num_rows, -1) for k in (2, 3))
            keep = (a == b).sum(axis=1) >= LEAST_AGREEING
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in (0, 1)], ["a", "b"])


def similarity(doc, h, w, x: int, y: int) -> float:
    """Weighted Jaccard similarity of documents x and y of sorted (doc, shingle, weight)."""
    rows = [slice(*np.searchsorted(doc, [d, d + 1])) for d in (x, y)]
    hx, hy, wx, wy = h[rows[0]], h[rows[1]], w[rows[0]], w[rows[1]]
    if not len(hx) or not len(hy):
        return 0.0
    at = np.minimum(np.searchsorted(hy, hx), len(hy) - 1)
    common = hy[at] == hx
    both = np.minimum(wx[common], wy[at[common]]).sum()
    return float(both / (wx.sum() + wy.sum() - both))


def _verifier(idf):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                part = batch.slice(start, 16)
                texts = pa.concat_arrays([part.column(2), part.column(3)])
                n = part.num_rows
                doc, h, w = _shingles_in_parts(texts, idf.value)
                links = [similarity(doc, h, w, k, n + k) >= SIMILARITY - 1e-6 for k in range(n)]
                yield pa.RecordBatch.from_arrays([part.column(k).filter(pa.array(links, pa.bool_())) for k in (0, 1)], ["a", "b"])

    return verify


# ---- pairs of blocks ---------------------------------------------------------------------------

BLOCK_KEY = ["band", "low", "high"]
BLOCK_ROWS = "band long, low long, high long, second boolean, node long, root long, samples binary, bands array<long>"


class Group:
    """The documents of a pair of blocks of one bucket; those of the second block come last."""

    def __init__(self, rows: pa.Table):
        self.rows, self.n = rows, rows.num_rows
        self.samples = np.frombuffer(b"".join(rows["samples"].to_pylist()), "<u2").reshape(self.n, -1)
        self.bands = np.array(rows["bands"].to_pylist(), np.int64)
        self.classes = rows["root"].to_numpy().copy()
        self.band = int(np.nonzero(self.bands[0] == rows["band"][0].as_py())[0][0])
        self.one_block = rows["low"][0].as_py() == rows["high"][0].as_py()
        self.firsts = self.n if self.one_block else self.n - sum(rows["second"].to_pylist())

    def partners(self, i: int) -> np.ndarray:
        """The later documents of other classes that agree with document i and share no earlier band."""
        start = i + 1 if self.one_block else self.firsts
        js = start + np.nonzero(self.classes[start:] != self.classes[i])[0]
        js = js[(self.samples[js] == self.samples[i]).sum(axis=1) >= LEAST_AGREEING]
        return js[~(self.bands[js, : self.band] == self.bands[i, : self.band]).any(axis=1)]

    def join(self, i: int, js: np.ndarray) -> np.ndarray:
        """Takes the classes of ``js`` into that of i; one of ``js`` for each class."""
        taken, at = np.unique(self.classes[js], return_index=True)
        self.classes[np.isin(self.classes, taken)] = self.classes[i]
        return js[at]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Group]:
    """Groups of rows sorted by ``BLOCK_KEY``; one may go on over batches."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if rows.num_rows == 0:
            continue
        keys = np.stack([rows[name].to_numpy() for name in BLOCK_KEY])
        cuts = [0, *(np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1).tolist()]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield Group(rows.slice(start, end - start))
        held = rows.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield Group(held)


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each group that have a partner there, or are one."""
    for group in _groups(batches):
        wanted = np.zeros(group.n, bool)
        for i in range(group.firsts):
            js = group.partners(i)
            wanted[js] = True
            wanted[i] |= len(js) > 0
        if wanted.any():
            yield from group.rows.filter(pa.array(wanted)).combine_chunks().to_batches()


def _block_links(idf):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            doc, h, w = _shingles_in_parts(group.rows["text"], idf.value)
            ends = np.searchsorted(doc, np.arange(group.n + 1))
            terms, ids = np.unique(h, return_inverse=True)
            total, sizes = np.add.reduceat(w, ends[:-1]), np.diff(ends)
            mine, node, out = np.zeros(len(terms)), group.rows["node"].to_numpy(), []
            for i in range(group.firsts):
                js = group.partners(i)
                if not len(js):
                    continue
                own = slice(ends[i], ends[i + 1])
                mine[ids[own]] = w[own]
                offsets = np.cumsum(sizes[js]) - sizes[js]
                at = np.repeat(ends[js] - offsets, sizes[js]) + np.arange(sizes[js].sum())
                both = np.add.reduceat(np.minimum(mine[ids[at]], w[at]), offsets)
                mine[ids[own]] = 0
                near = js[both / (total[i] + total[js] - both) >= SIMILARITY - 1e-6]
                if len(near):
                    out += [(node[i], node[j]) for j in group.join(i, near)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return links


def _shingles_in_parts(texts: pa.Array, idf: np.ndarray):
    """``weighted_shingles`` of all texts, some at a time."""
    parts = []
    for first, _, flat, offsets in chunks(texts):
        doc, h, w = weighted_shingles(flat, offsets, idf)
        parts.append((doc + first, h, w.astype(np.float64)))
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def _full_links(open_: DataFrame, sampled: DataFrame, held: DataFrame, idf) -> DataFrame:
    """Links (a, b) that join the classes of each bucket of ``open_`` (band, node, root, bytes)."""
    sizes = open_.groupBy("band").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), "blocks")
    rows = open_.join(sizes, "band").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).alias("second"), "node", "root"
    ).join(sampled.select("node", "samples", "bands"), "node")
    order = [*BLOCK_KEY, "second", "node"]
    alike = rows.select(*order, "root", "samples", "bands").repartition(*BLOCK_KEY).sortWithinPartitions(*order).mapInArrow(_promising, BLOCK_ROWS)
    alike = written(alike, "near-alike").join(held, "node").select(*order, "root", "samples", "bands", "text")
    return alike.repartition(*BLOCK_KEY).sortWithinPartitions(*order).mapInArrow(_block_links(idf), "a long, b long")


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): each (doc_id, node) and the links (a, b) between nodes.

    A node is the least id of an equal text; links are verified, and join all that belongs together.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.sha2(F.col(text), 256)).alias("same"), F.col(text).alias("text")).filter("doc_id is not null")
    idf = spark.sparkContext.broadcast(idf_table(frequencies(rows), rows.count()))
    signed = written(rows.mapInArrow(_signer(idf), "doc_id long, same binary, samples binary, bands array<long>, bytes long"), "near-samples")
    texts = signed.filter("samples is not null").groupBy("same").agg(F.min("doc_id").alias("node"), *(F.first(name).alias(name) for name in ("samples", "bands", "bytes")))
    texts = written(texts, "near-texts")
    members = signed.join(texts.select("same", "node"), "same", "left").select("doc_id", F.coalesce("node", "doc_id").alias("node")).distinct()
    members = written(members, "near-members")
    several = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    links = written(members.join(several.select("doc_id", "a"), "doc_id").filter("node <> a").select("a", F.col("node").alias("b")), "near-links")

    buckets = texts.select("node", "bytes", F.explode("bands").alias("band"))
    least = buckets.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("last")).filter("least < last")
    state = written(buckets.join(least.select("band", "least"), "band").select("band", "node", "bytes", "least"), "near-buckets")
    sampled = written(texts.join(state.select("node").distinct(), "node", "left_semi").select("node", "same", "samples", "bands"), "near-candidate-samples")
    held = rows.join(sampled.select(F.col("node").alias("doc_id"), "same"), ["doc_id", "same"], "left_semi").dropDuplicates(["doc_id", "same"])
    held = written(held.select(F.col("doc_id").alias("node"), "text"), "near-candidates")

    asked = state.filter("node > least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    near = written(_with_both(asked, sampled, "samples").mapInArrow(_agreeing, "a long, b long"), "near-pairs")
    links = links.union(written(_with_both(near, held, "text").mapInArrow(_verifier(idf), "a long, b long"), "near-least-links"))

    rooted = state.join(components(links, "near"), "node", "left").select("band", "node", "bytes", F.coalesce("root", "node").alias("root"))
    rooted = written(rooted, "near-rooted")
    open_ = rooted.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("band")
    open_ = written(rooted.join(open_, "band"), "near-open")
    return members, links.union(written(_full_links(open_, sampled, held, idf), "near-full-links"))


def _with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """a, b, and the named value of each."""
    first = values.select(F.col("node").alias("a"), F.col(name).alias("x"))
    second = values.select(F.col("node").alias("b"), F.col(name).alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id): class_id is the least id of the class; one row per id."""
    members, links = linked(docs, doc_id, text)
    roots = components(links, "near-classes")
    named = members.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    return named.groupBy("doc_id").agg(F.min("root").alias("class_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` of which there is one to a class: that of the least id.

    Rows without an id are kept, as they are in no class.
    """
    kept = written(classes(docs, doc_id, text).filter("doc_id = class_id").select(F.col("doc_id").alias("kept")), "near-kept")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), packed(docs))
    first = rows.filter("id is not null").join(kept, F.col("id") == F.col("kept"), "left_semi").groupBy("id").agg(F.first("row").alias("row"))
    return unpacked(first.select("row").union(rows.filter("id is null").select("row")), docs)
