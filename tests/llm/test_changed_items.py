"""Benchmark items that are in a document with some words changed, and columns of clashing names."""

import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paneflow.llm import chat, decontaminate, secrets, toxicity
from paneflow.llm.common import words_of

ITEMS = pq.read_table("/root/testdata/sf0.001/benchmark.parquet", columns=["item_id", "text"]).to_pylist()
WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def plain_runs(text):
    words = WORD.findall(text.lower())
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def plainly_held(item, document):
    """The rule, on words: four fifths of the runs of question and answer, or of the whole item."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", item) if WORD.search(s.lower())]
    parts = [" ".join(sentences[:-1]), sentences[-1]] if len(sentences) > 1 else [item, item]
    words = WORD.findall(document.lower())

    def share(part):
        wanted = plain_runs(part)
        size = len(next(iter(wanted)))
        return len(wanted & {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}) / len(wanted)

    return min(map(share, parts)) >= 0.8 or share(item) >= 0.8


def with_changes(item, places):
    """The item with some words replaced, between words that no item has."""
    spans = [m.span() for m in re.finditer(WORD.pattern, item, re.IGNORECASE)]
    for k in sorted(places, reverse=True):
        start, end = spans[k]
        item = f"{item[:start]}changed{k}{item[end:]}"
    filler = " ".join(f"filler{k}" for k in range(150))
    return f"{filler} {item} {filler}"


def found(documents):
    raw = [d.encode() for d in documents]
    offsets = np.append(0, np.cumsum([len(d) for d in raw])).astype(np.int64)
    index = decontaminate.build([(r["item_id"], r["text"]) for r in ITEMS])
    words = words_of(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return {(doc, index.ids[item]) for doc, item, *_ in decontaminate.leaks_of(index, words)}


def n_words(item):
    return len(WORD.findall(item.lower()))


@pytest.mark.parametrize("changes", [0, 1, 2])
def test_changed_items_are_found_as_the_rule_says(changes):
    pick = random.Random(changes)
    cases = []
    for row in ITEMS:
        n = n_words(row["text"])
        for places in [[k] for k in range(n)] if changes == 1 else [pick.sample(range(n), changes) for _ in range(1 if not changes else 8)]:
            cases.append((row["item_id"], row["text"], with_changes(row["text"], places)))
    got = found([document for _, _, document in cases])
    want = {(k, item) for k, (item, text, document) in enumerate(cases) if plainly_held(text, document)}
    assert got == want
    # A changed word takes five runs at most: a fifth of those of 29 words.
    sure = {(k, item) for k, (item, text, _) in enumerate(cases) if n_words(text) >= 25 * changes + 4}
    assert sure <= got and (changes == 2 or sure)


def test_columns_of_clashing_names_change_nothing(spark):
    item = ITEMS[0]["text"]
    rows = [(1, item), (2, 'password = "abcdefgh12345678"'), (3, None), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    names = ["item_id", "score", "overlap", "key", "row", "spans", "n_hex", "severity", "grade", "toxic", "id", "features"]
    clashing = docs.select("*", *(F.lit("clash").alias(name) for name in names))
    items = spark.createDataFrame([(0, item)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, toxic int, quality int")
    more = items.withColumn("doc_id", F.lit("clash")).withColumn("block", F.lit("clash"))
    marked = labels.withColumn("text", F.lit("clash")).withColumn("grade", F.lit("clash"))

    def same(one, other):
        assert one.columns == other.columns
        got = sorted(map(str, other.collect()))
        assert sorted(map(str, one.collect())) == got
        return got

    assert len(same(decontaminate.leaks(docs, items), decontaminate.leaks(clashing, more))) == 1
    assert len(same(secrets.digests(secrets.scanned(docs)), secrets.digests(secrets.scanned(clashing)))) == len(rows)
    assert len(same(toxicity.graded(docs, labels), toxicity.graded(clashing, marked))) == len(rows)
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ok"), (2, 0, "user", None)], "conv_id long, turn int, role string, text string")
    turns = turns.withColumn("parts", chat.text_parts(F.col("text")))
    extra = turns.select("*", *(F.lit("clash").alias(name) for name in ["body", "files", "piece", "place", "ends", "formatted"]))
    assert len(same(chat.digests(chat.formatted_chats(turns)), chat.digests(chat.formatted_chats(extra)))) == 2
