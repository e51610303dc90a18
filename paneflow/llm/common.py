"""Helpers of the text operators: row identity, classes of linked rows, words as hashes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.session import written

#: The white space that parts words: blank and the five controls from tab to carriage return.
SPACES = " \t\n\x0b\f\r"
SPACES_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of text that a task handles at once.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that no added column can clash with theirs."""
    return F.struct(*[F.col(f"`{name.replace('`', '``')}`") for name in df.columns]).alias("row")


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of ``row``."""
    return df.select([F.col("row").getField(name).alias(name) for name in like.columns])


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; null for a null text."""
    return F.unhex(F.md5(text))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside nested lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node it is linked to.

    Each round takes the least root among neighbours and then follows the root's own
    root; a round is written to the shared folder, which cuts the lineage.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = written(both, f"{label}-links")
    roots = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")),
        f"{label}-roots",
    )
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        up = roots.select(F.col("node").alias("low"), F.col("root").alias("up"))
        step = lower.join(up, "low").select("node", F.least("low", "up").alias("root"), (F.least("low", "up") < F.col("root")).alias("moved"))
        step = written(step, f"{label}-roots")
        roots = step.select("node", "root")
        if step.filter("moved").isEmpty():
            return roots


# ---- words as hashes, a chunk of documents at a time ---------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Word bytes: letters, digits and all bytes beyond ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


class Words(NamedTuple):
    """Word hashes of some documents in order; ``ends[i]`` is one past document i's last word."""

    hashes: np.ndarray
    doc: np.ndarray
    ends: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, offsets


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) for runs of rows of about ``size`` bytes; a long text is one run."""
    flat, offsets = bytes_of(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last, flat[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(flat: np.ndarray, offsets: np.ndarray, prefix: int | None = None) -> Words:
    """Lower-case words (ASCII case, and that of Latin-1 letters) as 64-bit hashes.

    With ``prefix`` only so many first bytes of a word count.
    """
    low = _LOWER[flat]
    if len(flat) > 1:  # the two-byte capitals U+00C0 to U+00DE
        capital = (flat[1:] >= 0x80) & (flat[1:] <= 0x9E) & (flat[:-1] == 0xC3) & (flat[1:] != 0x97)
        low[1:][capital] += 32
    inside = _IN_WORD[flat]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[heads] = inside[heads]
    at = np.nonzero(inside)[0]
    if not len(at):
        return Words(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64))
    first = np.nonzero(starts[at])[0]
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    powers = np.cumprod(np.full(int(place.max()) + 1, _ODD))
    terms = (low[at].astype(np.uint64) + np.uint64(1)) * powers[place]
    if prefix is not None:
        terms[place >= prefix] = 0
    hashes = mixed(np.add.reduceat(terms, first))
    doc = np.searchsorted(offsets, at[first], "right") - 1
    return Words(hashes, doc, np.cumsum(np.bincount(doc, minlength=len(offsets) - 1)))


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every run of ``size`` words; a document with fewer words has one run of all."""
    w, doc, ends = words
    n = len(w) - size + 1
    counts = np.diff(np.append(0, ends))
    short = np.nonzero((counts > 0) & (counts < size))[0]
    out_doc, out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if n > 0:
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total = mixed(total * _ODD + w[k : k + n]) if k == size - 1 else total * _ODD + w[k : k + n]
        whole = doc[:n] == doc[size - 1 :]
        out_doc.append(doc[:n][whole])
        out.append(total[whole])
    for d in short.tolist():
        total = np.zeros(1, np.uint64)
        for x in w[ends[d] - counts[d] : ends[d]]:
            total = total * _ODD + x
        out_doc.append(np.array([d]))
        out.append(mixed(total))
    return np.concatenate(out_doc), np.concatenate(out)
