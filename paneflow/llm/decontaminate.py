"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND.

The index is built from the items and does not grow with the training data. An impact is a
term's share of the score that the item gives to itself, so 1 is a whole item. Every document is
cut into overlapping passages of twice the length of the longest item, so that each stretch as
long as an item lies whole in one passage; each passage is a query, and all items that score
``THRESHOLD`` or more are retrieved. Two bounds, neither of which loses an item, come first: a
term's impacts are split into its items' strong terms and the rest, and a passage is searched only
if, for some item, the strong terms found plus all of its weak terms could reach the threshold.
Searched passages go through block-max WAND: cursors on the postings of the passage's terms, a
pivot where the terms' greatest impacts reach the threshold, and whole blocks skipped where their
own greatest impacts do not.

A retrieved item is verified by runs of five words: the share of its question's (all sentences
but the last) and of its answer's runs (the last sentence) found in the document. It leaks at
``SIMILARITY`` or more of both, or of the whole item's.
Overlap is that with the whole document, but an item whose sentences stand further apart than a
passage is only verified if one of the passages retrieves it.

The index is built and broadcast for at most ``ITEMS`` items and ``ITEM_BYTES`` bytes of text at a
time; more items are searched block after block, each against all documents. Document frequencies,
the mean length and the longest item are those of all items, so that scores and passages do not
depend on the blocks.

Cases: items without a word and null texts find nothing; an item of one sentence has it as
question and as answer; a part of under five words is one run of all its words; equal items are
found each; repeated rows of documents are searched each; a null document id is given back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import Words, chunks, packed, shingles_of, unpacked, words_of
from paneflow.session import written

K1, B = 1.2, 0.75
#: Least score, as a share of the item's own; share of strong impacts; runs of words; similarity.
THRESHOLD, WEAK = 0.5, 0.25
WORDS, SIMILARITY = 5, 0.8
#: Postings to a block.
BLOCK = 16
#: Items and bytes of one index.
ITEMS, ITEM_BYTES = 20_000, 16 << 20


class Totals(NamedTuple):
    """What an index takes from all items, of which it may hold some."""

    n: int  # items with words
    mean: float  # of their words
    span: int  # words of the longest item
    df: dict[int, int]  # items by term, for the terms of the items held


class Index(NamedTuple):
    ids: list  # of items
    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # n + 1 places in the postings, by term
    items: np.ndarray  # of the postings, ascending within a term
    impacts: np.ndarray
    greatest: np.ndarray  # by term
    strong: np.ndarray  # of the postings
    weak_sum: np.ndarray  # by item
    runs: list  # by item: (question, answer, whole) as sorted hashes, with the length of each run
    span: int  # words of the longest item


def _hashes(text: str) -> Words:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return words_of(raw, np.array([0, len(raw)], np.int64))


def _runs(text: str) -> tuple[int, np.ndarray]:
    words = _hashes(text)
    return min(WORDS, len(words.hashes)), np.unique(shingles_of(words, WORDS)[1])


def parts_of(text: str) -> tuple[str, str]:
    """Question and answer: all sentences but the last, and the last."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if len(_hashes(s).hashes)]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, text)


def build(items: list[tuple], totals: Totals | None = None) -> Index:
    """The index of (id, text) pairs, which are all items unless ``totals`` are given."""
    items = sorted(((i, t) for i, t in items if t and len(_hashes(t).hashes)), key=lambda x: (x[0] is None, x[0]))
    found = [np.unique(_hashes(t).hashes, return_counts=True) for _, t in items]
    sizes = np.array([c.sum() for _, c in found], float)
    terms, df = np.unique(np.concatenate([t for t, _ in found] or [np.zeros(0, np.uint64)]), return_counts=True)
    n_items, mean, span = len(items), sizes.mean() if len(sizes) else 0.0, int(sizes.max()) if len(sizes) else 0
    if totals is not None:
        n_items, mean, span = totals[:3]
        df = np.array([totals.df[t] for t in terms.tolist()], np.int64)
    idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
    rows = []
    weak_sum = np.zeros(len(items))
    for n, (t, c) in enumerate(found):
        at = np.searchsorted(terms, t)
        score = idf[at] * c * (K1 + 1) / (c + K1 * (1 - B + B * sizes[n] / mean))
        score = score / score.sum()
        rising = np.argsort(score)
        weak = np.zeros(len(t), bool)
        weak[rising[np.cumsum(score[rising]) <= WEAK]] = True
        weak_sum[n] = score[weak].sum()
        rows.append((at, np.full(len(t), n), score, ~weak))
    at, owner, impact, strong = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, int),) * 4
    order = np.lexsort((owner, at))
    first = np.append(0, np.cumsum(np.bincount(at, minlength=len(terms)))).astype(np.int64)
    impact = impact[order].astype(float)
    greatest = np.maximum.reduceat(impact, first[:-1]) if len(terms) else np.zeros(0)
    runs = [tuple(_runs(p) for p in (*parts_of(t), t)) for _, t in items]
    return Index([i for i, _ in items], terms, first, owner[order], impact, greatest, strong[order].astype(bool), weak_sum, runs, span)


def search(index: Index, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
    """(item, score) of all items whose impacts for the distinct ``terms`` sum to the threshold or more."""
    end = len(index.ids)
    lists = []
    for t in terms:
        a, b = int(index.first[t]), int(index.first[t + 1])
        items, impacts = index.items[a:b].tolist(), index.impacts[a:b].tolist()
        blocks = [max(impacts[k : k + BLOCK]) for k in range(0, b - a, BLOCK)]
        lists.append((items, impacts, blocks, float(index.greatest[t])))
    at = [0] * len(lists)
    now = [x[0][0] for x in lists]
    order = sorted(range(len(lists)), key=now.__getitem__)
    found = []
    least = threshold - 1e-9
    while True:
        total, pivot = 0.0, -1
        for k, c in enumerate(order):
            if now[c] == end:
                break
            total += lists[c][3]
            if total >= least:
                pivot = k
                break
        if pivot < 0:
            return found
        item = now[order[pivot]]
        while pivot + 1 < len(order) and now[order[pivot + 1]] == item:
            pivot += 1
        bound, edge = 0.0, end
        for c in order[: pivot + 1]:  # the blocks that hold the pivot's item, and where the first of them ends
            items, _, blocks, _ = lists[c]
            k = at[c]
            while (k // BLOCK + 1) * BLOCK <= len(items) and items[(k // BLOCK + 1) * BLOCK - 1] < item:
                k = (k // BLOCK + 1) * BLOCK
            if k < len(items):
                bound += blocks[k // BLOCK]
                edge = min(edge, items[min((k // BLOCK + 1) * BLOCK, len(items)) - 1] + 1)
        if bound < least:  # nothing up to the end of these blocks, nor before the next list's item
            target = max(item + 1, min(edge, now[order[pivot + 1]] if pivot + 1 < len(order) else end))
        elif now[order[0]] == item:
            score = sum(lists[c][1][at[c]] for c in order[: pivot + 1])
            if score >= least:
                found.append((item, score))
            target = item + 1
        else:
            target = item
        for c in order[: pivot + 1]:
            items = lists[c][0]
            while at[c] < len(items) and items[at[c]] < target:
                at[c] += 1
            now[c] = items[at[c]] if at[c] < len(items) else end
        order.sort(key=now.__getitem__)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for counts[0] numbers, then those of the next."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def candidates(index: Index, words: Words) -> list[tuple[int, int, int, float]]:
    """(doc, first word, item, score) of what the passages of some documents retrieve.

    Passage k of a document holds its words from k * span to (k + 2) * span.
    """
    if not len(index.terms) or not len(words.hashes):
        return []
    n_terms, n_items = len(index.terms), len(index.ids)
    term = np.minimum(np.searchsorted(index.terms, words.hashes), n_terms - 1)
    hit = np.nonzero(index.terms[term] == words.hashes)[0]
    term, doc = term[hit], words.doc[hit]
    counts = np.diff(np.append(0, words.ends))
    ahead = np.append(0, np.cumsum(-(-counts // index.span)))
    number = (hit - (words.ends - counts)[doc]) // index.span
    passage = ahead[doc] + number

    def in_passages(chosen: np.ndarray) -> np.ndarray:
        """Distinct passage * n_terms + term of the chosen hits, each in its own passage and the one before."""
        before = chosen & (number > 0)
        keys = np.concatenate([passage[chosen] * n_terms + term[chosen], (passage[before] - 1) * n_terms + term[before]])
        return np.unique(keys)

    # the strong impacts found, by passage and item
    counted = np.append(0, np.cumsum(index.strong))
    keys = in_passages((counted[index.first[1:]] > counted[index.first[:-1]])[term])
    t = keys % n_terms
    n = np.diff(index.first)[t]
    posting, owner = _spread(index.first[t], n), np.repeat(keys // n_terms, n)
    strong = index.strong[posting]
    posting, owner = posting[strong], owner[strong]
    pairs, inverse = np.unique(owner * n_items + index.items[posting], return_inverse=True)
    sums = np.bincount(inverse, index.impacts[posting], len(pairs))
    may = np.unique(pairs[sums + index.weak_sum[pairs % n_items] >= THRESHOLD - 1e-9] // n_items)
    if not len(may):
        return []
    open_ = np.zeros(int(ahead[-1]) + 1, bool)
    open_[may] = True
    keys = in_passages(open_[passage] | (open_[passage - 1] & (number > 0)))
    out = []
    for p in may.tolist():
        a, b = np.searchsorted(keys, [p * n_terms, (p + 1) * n_terms])
        d = int(np.searchsorted(ahead, p, "right")) - 1
        first = (p - int(ahead[d])) * index.span
        out += [(d, first, item, score) for item, score in search(index, (keys[a:b] % n_terms).tolist())]
    return out


def _share(part: tuple[int, np.ndarray], hashes: np.ndarray) -> float:
    size, wanted = part
    n = len(hashes) - size + 1
    if not size or n <= 0:
        return 0.0
    runs = shingles_of(Words(hashes, np.zeros(len(hashes), np.int64), np.array([len(hashes)])), size)[1]
    return float(np.isin(wanted, runs).mean())


def leaks_of(index: Index, words: Words) -> list[tuple[int, int, float, float, float, float]]:
    """(doc, item, score, question, answer and whole overlap), verified; the best passage of each."""
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for doc, start, item, score in candidates(index, words):
        best[doc, item] = max(best.get((doc, item), (0.0, 0)), (score, -start))
    counts = np.diff(np.append(0, words.ends))
    out = []
    for (doc, item), (score, _) in sorted(best.items()):
        own = words.hashes[words.ends[doc] - counts[doc] : words.ends[doc]]
        question, answer, whole = (_share(part, own) for part in index.runs[item])
        if min(question, answer) >= SIMILARITY or whole >= SIMILARITY:
            out.append((doc, item, score, question, answer, whole))
    return out


_OUT = "row long, item_id long, score double, question_overlap double, answer_overlap double, overlap double"


def _finder(held):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "overlap"]
        for batch in batches:
            ids = batch.column(0)
            for first, _, flat, offsets in chunks(batch.column(1)):
                found = leaks_of(index, words_of(flat, offsets))
                if found:
                    doc, item, *rest = zip(*found, strict=True)
                    columns = [ids.take(pa.array([first + d for d in doc])), pa.array([index.ids[i] for i in item], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(x, pa.float64()) for x in rest], names)

    return find


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            hashes = _hashes(text).hashes
            terms = np.unique(hashes).view(np.int64)
            columns = [np.full(len(terms), block), terms, np.where(np.arange(len(terms)) == 0, len(hashes), 0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["block", "term", "size"])


def item_blocks(items: DataFrame, item_id: str, text: str, limit: int = ITEMS, limit_bytes: int = ITEM_BYTES) -> Iterator[tuple[list[tuple], Totals | None]]:
    """The items, in lists whose number and bytes are bounded, with the totals of all where there are several lists."""
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // limit), -(-size * 2 // limit_bytes))
    if blocks == 1:
        yield [tuple(r) for r in rows.collect()], None
        return
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    # one row of each item has its size
    terms = rows.filter("text is not null").select(block.alias("block"), "text").mapInArrow(_item_terms, "block long, term long, size long")
    terms = written(terms, "item-terms")
    found = terms.filter("size > 0").agg(F.count("*"), F.avg("size"), F.max("size")).first()
    df = written(terms.groupBy("term").agg(F.count("*").alias("df")), "item-frequencies")
    for k in range(blocks):
        own = df.join(terms.filter(F.col("block") == k).select("term").distinct(), "term")
        held = {t % (1 << 64): c for t, c in own.collect()}
        yield [tuple(r) for r in rows.filter(block == k).collect()], Totals(found[0], found[1] or 0.0, found[2] or 0, held)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", limit: int = ITEMS) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, overlap), one row per leak."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for block, totals in item_blocks(items, item_id, item_text, limit):
        # bounded by ITEMS and ITEM_BYTES
        held = spark.sparkContext.broadcast(build(block, totals))
        found = rows.mapInArrow(_finder(held), _OUT.replace("row long", "doc_id long"))
        out = found if out is None else out.union(found)
    return out


def clean_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a leak; a row without an id is judged by its text."""
    rows = docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"), packed(docs))
    found = leaks(rows, items, "key", "text", **options)
    bad = written(found.select(F.col("doc_id").alias("key")).distinct(), "leaking")
    return unpacked(rows.join(bad, "key", "left_anti"), docs)
