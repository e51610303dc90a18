import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from paneflow.llm import filter_audit as audit

LABELS = "doc_id long, quality int, toxic int"


def brute_masks(rows):
    """rows: (doc_id, text, part); the failed filters of each."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for d, t, p in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t],
        }
        out.append((d, p or "", {f for f, bad in fails.items() if bad}))
    return out


def brute_audit(rows, good, toxic):
    masks, out = brute_masks(rows), set()
    for part in {p for _, p, _ in masks}:
        mine = [(d, f) for d, p, f in masks if p == part]
        removed_in = {}
        for order in map("".join, permutations("ABCDE")):
            for k, x in enumerate(order):
                before = set(order[:k])
                here = [d for d, f in mine if x in f and not f & before]
                removed_in[x] = removed_in.get(x, 0) + len(here)
                out.add((
                    part, order, k + 1, sum(not f & (before | {x}) for _, f in mine), len(here), sum(x in f and bool(f & before) for _, f in mine),
                    sum(f == {x} for _, f in mine), sum(d in good for d in here), sum(d in toxic for d in here),
                ))
        out = {(*r, removed_in[r[1][r[2] - 1]]) if r[0] == part and len(r) == 9 else r for r in out}
    return out


def spark_audit(spark, folder, labels, **how):
    return set(map(tuple, audit.audited(spark, folder, labels, **how).collect()))


def triples(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


@pytest.fixture(scope="module")
def many(spark, documents):
    """A group of copies over all files, the least id neither first nor last, in two parts; large ids first."""
    copies = spark.range(3000, 3300).selectExpr(
        "4000 - id as doc_id", "repeat('SAME # text ', 120) as text", "'en' as lang", "concat('src', id % 2) as source", "0L as n_chars"
    )
    return documents.unionByName(copies)


@pytest.mark.parametrize("files", [1, 2, 9])
def test_orders_by_brute_force(spark, many, tmp_path, files):
    folder = str(tmp_path / "docs")
    many.repartition(9, "doc_id").sortWithinPartitions("doc_id").write.parquet(folder)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    extra = spark.createDataFrame([(d, q, t) for d in range(700, 1000, 7) for q, t in ((1, 0), (0, 1))], LABELS)
    labels = labels.unionByName(extra)
    known = labels.collect()
    good, toxic = {r.doc_id for r in known if r.quality == 1}, {r.doc_id for r in known if r.toxic == 1}
    assert spark_audit(spark, folder, labels, files_per_trigger=files) == brute_audit(triples(many), good, toxic)


def test_a_smaller_id_that_comes_later_takes_counts_back(spark, tmp_path):
    """After each of three loads of the same folder the counters are those of the files so far."""
    docs, run = str(tmp_path / "docs"), str(tmp_path / "run")
    labels = spark.createDataFrame([(5, 1, 1)], LABELS)
    loads = [[(9, "x", "b"), (9, "x", "b"), (7, "y", "a")], [(5, "x", "a"), (8, "x", "b")], [(5, "x", "b"), (2, "y", None), (None, "x", "a")]]
    so_far = []
    for load in loads:
        so_far += load
        spark.createDataFrame(load, "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(docs)
        audit.run_changes(spark, docs, labels, folder=run)
        counted = {}
        for r in audit.counters(spark, run).collect():
            counted[r.part, r.mask, r.flags] = r.n
        expected = {}
        for d, p, f in brute_masks(so_far):
            key = p, sum(1 << "ABCDE".index(x) for x in f), 3 if d == 5 else 0
            expected[key] = expected.get(key, 0) + 1
        assert counted == expected
    # The last micro-batch run again, as after a failure before its commit.
    flags = audit.label_flags(labels)
    audit.audit_batch(spark.createDataFrame(loads[2], "doc_id long, text string, source string"), 2, flags, run)
    assert {(r.part, r.mask, r.flags): r.n for r in audit.counters(spark, run).collect()} == expected


def test_odd_documents(spark, odd, empty, tmp_path):
    labels = spark.createDataFrame([(None, 1, 1), (1, None, 1), (2, 1, None), (2, 1, 1)], LABELS).selectExpr("*", "'z' as mask")
    folder = str(tmp_path / "odd")
    odd.write.parquet(folder)
    assert spark_audit(spark, folder, labels) == brute_audit(triples(odd), {2}, {1, 2})
    nothing = str(tmp_path / "empty")
    empty.write.parquet(nothing)
    assert spark_audit(spark, nothing, labels.limit(0)) == set()


def test_masks_of_texts(documents):
    texts = [r.text for r in documents.select("text").collect()] + ["", None, "é" * 199 + " É", "A" * 2 + "b" * 98, "A" * 3 + "b" * 97, " \n", "a b " * 210]
    got = audit.text_masks(pa.array(texts))
    rows = [(None, t, "") for t in texts]
    assert got.tolist() == [sum(1 << "ABCDE".index(x) for x in f) for _, _, f in brute_masks(rows)]
    assert audit.text_masks(pa.array([], pa.string())).tolist() == [] and got.dtype == np.int32
