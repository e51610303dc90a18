import numpy as np
import pytest
from pyspark.sql import functions as F

from paneflow.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every, rule=hard.Rule()):
    def finite(v):
        return v is not None and all(x is not None and abs(x * rule.scale) < float("inf") for x in v)

    rows = [(i, [int(np.floor(x * rule.scale)) for x in v], label) for i, v, label in rows if label is not None and finite(v)]
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a in {(i, tuple(v), label) for i, v, label in rows if i is not None and i % every == 0}:
        scored = [(sum(x * y for x, y in zip(a[1], v, strict=False)), i, label) for i, v, label in rows]
        positives = sorted((s for s in scored if s[2] == a[2] and s[1] != a[0]), key=key)[: rule.positives]
        for p, positive, _ in positives:
            fit = sorted((s for s in scored if s[2] != a[2] and rule.low * p <= 100 * s[0] <= rule.high * p), key=key)
            out += [(a[0], positive, r, n, p, s) for r, (s, n, _) in enumerate(fit[: rule.negatives], 1)]
    return sorted(out, key=repr)


def mined(df, every, **how):
    return sorted(map(tuple, hard.mined(df, F.col("vec_id") % every == 0, **how).collect()), key=repr)


def numbers(seed, n, d, scale=1.0, labels=4):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) * scale).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("groups", [1, 3, 64])
def test_by_brute_force(spark, groups):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert mined(rows, 20, groups=groups) == brute([tuple(r) for r in rows.collect()], 20)


def test_large_numbers_stay_exact(spark):
    """Ranges of two fields to a word, of one, and beyond a double."""
    for scale in (0.3, 40.0, 3e3, 1e5, 8e5):
        rows = numbers(1, 120, 9, scale)
        assert mined(spark.createDataFrame(rows, SCHEMA), 10) == brute(rows, 10)


def test_odd_rows(spark):
    rows = numbers(2, 60, 4)
    nan, inf = float("nan"), float("inf")
    rows += [(100, None, 1), (110, [1.0, nan], 1), (120, [inf], 1), (130, [None, 1.0], 1), (140, [1.0], None), (150, [], 1), (160, [2.0], 2), (170, [1.0] * 7, 3)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0, 1.0], 2), (180, [1e308], 1)]
    rows += [(20, *rows[20][1:])] * 30 + [(61, [0.5, 0.5, 0.5, 0.5], 0)] * 30  # an anchor and a candidate many times over
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as at", "1 as part", "true as is_anchor")
    assert mined(df, 10) == brute(rows, 10)
    assert mined(df.limit(0), 10) == []


def test_packed_products():
    rng = np.random.default_rng(3)
    for bits in (1, 6, 12, 20, 26, 40, 70):
        low, high = -(1 << bits), 1 << bits
        draw = lambda n: np.array([[int(rng.integers(-(2**20), 2**20)) * (high - low) // 2**21 for _ in range(5)] for _ in range(n)], object if bits > 50 else float)
        rows, anchors = draw(7), draw(3)
        got = hard.Packed(rows).scores(anchors)
        assert [[int(x) for x in r] for r in got] == [[sum(int(x) * int(y) for x, y in zip(a, c, strict=True)) for c in rows] for a in anchors]
    # two candidates share a word where their sums fit
    block = hard.Packed(np.array([[1.0, 2.0], [3.0, 4.0], [5.0, -6.0]]))
    block.scores(np.array([[1.0, 1.0]]))
    assert next(iter(block.words.values())).shape[1] < 3
