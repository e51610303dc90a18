import re
from collections import Counter, defaultdict

import numpy as np
from oracle_check import oracle_rows

import corpus_pipeline
from paneflow.llm import near_dup
from paneflow.llm.oracles import ORACLES
from paneflow.session import written


def test_stages(spark, odd, empty):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 50 and {"doc_id", "text", "shard", "slot"} <= set(out.columns)
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs_out = stage(spark, docs, sf)
            assert docs_out.columns == docs.columns, name
            docs_out.count()


def table_of(docs):
    return sorted(((r.doc_id, r.text, r.source, r.n_chars) for r in docs.collect()), key=repr)


def by_rules(rows):
    """Rows that pass the rules, without the lines that over 10 % and 20 or more of a host's documents have."""
    plain = lambda t: [" ".join(line.lower().split()) for line in (t or "").split("\n")]
    hosts, holders = defaultdict(set), defaultdict(set)
    for _, t, host, _ in rows:
        same = tuple(x for x in plain(t) if x)
        hosts[host].add(same)
        for x in same:
            holders[host, x].add(same)
    hot = {k for k, v in holders.items() if len(v) >= 20 and len(v) > 0.1 * len(hosts[k[0]])}
    out = []
    for d, t, host, _ in rows:
        words, pairs = (t or "").split(), [(line, x) for line, x in zip((t or "").split("\n"), plain(t), strict=True)]
        threes = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {i + j for i in range(len(words) - 2) if threes[tuple(words[i : i + 3])] > 1 for j in range(3)}
        lost = sum(len(x.split()) for _, x in pairs if (host, x) in hot)
        if len(words) >= 50 and 2 * len(covered) <= len(words) and len(words) - lost >= 0.2 * len(words):
            left = "\n".join(line for line, x in pairs if (host, x) not in hot)
            out.append((d, left, host, len(left)))
    return out


def one_of_each(rows, idf):
    """The row of least id of each class of links at 0.8."""
    weights = []
    for _, t, _, _ in rows:
        raw = np.frombuffer(t.encode(), np.uint8)
        _, h, w = near_dup.weighted_shingles(raw, np.array([0, len(raw)], np.int64), idf)
        weights.append(dict(zip(h.tolist(), w.astype(float).tolist(), strict=True)))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(weights):
        for j in range(i):
            both = sum(min(w, weights[j][h]) for h, w in x.items() if h in weights[j])
            if both and both >= 0.8 * (sum(x.values()) + sum(weights[j].values()) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, row in enumerate(rows):
        least[root(i)] = min(least.get(root(i), row), row, key=lambda r: r[0])
    return list(least.values())


def test_stages_by_brute_force(spark, documents, tmp_path):
    sf = str(tmp_path)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items.toPandas().to_parquet(f"{sf}/benchmark.parquet")
    leak = items.orderBy("item_id").first().text
    prose = lambda k: "\n".join(" ".join(f"w{k}x{i}x{j}" for j in range(12)) for i in range(8))
    more = [(10_000 + k, prose(k) + "\nRead  more HERE\n" + prose(1000 + k), "en", "shared", 1) for k in range(40)]
    more += [(10_100 + k, prose(3) + f"\nread more here\ncopy {k}", "en", "shared", 1) for k in range(3)]
    more += [(10_200, prose(77) + " " + leak, "en", "shared", 1), (10_201, "too short", "en", "shared", 1)]
    rows = documents.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"))
    rows.toPandas().to_parquet(f"{sf}/documents.parquet")
    plain = lambda t: " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower()))
    wanted = {
        "quality_rules": lambda rows, docs: by_rules(rows),
        "near_duplicates": lambda rows, docs: one_of_each(rows, near_dup.idf_table(near_dup.frequencies(docs), docs.count())),
        "decontamination": lambda rows, docs: [r for r in rows if not any(plain(i.text) in plain(r[1]) for i in items.collect())],
    }
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = table_of(docs)
        out = written(stage(spark, docs, sf), f"test-{name}")
        after = table_of(out)
        if name == "mixing":
            (tmp_path / "mixed").mkdir()
            docs.toPandas().to_parquet(f"{sf}/mixed/documents.parquet")
            columns, copies = oracle_rows(f"{sf}/mixed", ORACLES["op7_source_mixing"])
            number = Counter(row[columns.index("doc_id")] for row in copies)
            want = sorted((r for r in before for _ in range(number[r[0]])), key=repr)
        else:
            want = sorted(wanted[name](before, docs), key=repr)
            assert len(want) < len(before), name
        assert after == want, name
        docs = out
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert table_of(out) == table_of(docs)
    slots = defaultdict(list)
    for r in out.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
