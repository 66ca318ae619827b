"""Hard-negative mining against scores of all pairs."""

import random
from math import floor, inf, isfinite, nan

import numpy as np
import pytest

from crmweave.llm import hard_negatives
from crmweave.llm.hard_negatives import mine
from crmweave.llm.queries import op11_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=50, positives=5, negatives=3):
    def clip(x):
        return min(max(x, -(1 << 63)), (1 << 63) - 1)

    held = [
        (i, label, [clip(floor(256 * float(np.float32(x)))) for x in v])
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and isfinite(x) for x in v)
    ]

    def order(scored):
        return sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))

    out = []
    for a, (anchor, label, vector) in enumerate(held):
        if anchor is None or anchor % every:
            continue
        scored = [
            (clip(sum(x * y for x, y in zip(vector, other))), i, of == label)
            for b, (i, of, other) in enumerate(held) if a != b
        ]
        for p, positive, _ in order([s for s in scored if s[2]])[:positives]:
            found = order([s for s in scored if not s[2] and 50 * p <= 100 * s[0] <= 95 * p])[:negatives]
            out += [(anchor, positive, r, n, p, s) for r, (s, n, _) in enumerate(found, 1)]
    return sorted(out, key=str)


def found(df, **options):
    result = mine(df, "vec_id % 50 = 0", **options)
    assert result.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, result.collect()), key=str)


def vectors(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    labels = rng.integers(0, 6, n)
    values = (centres[labels] + spread * rng.normal(size=(n, width))) / 8
    return [(int(i), [float(np.float32(x)) for x in v], int(k)) for i, (v, k) in enumerate(zip(values, labels))]


@pytest.mark.parametrize("width,spread", [(1, 1.0), (3, 0.4), (24, 1.0)])
def test_mining(spark, width, spread):
    rows = vectors(700, width, width, spread)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("1 AS VEC_ID", "*", "'x' AS row", "2 AS `a.b`")
    want = brute(rows)
    assert want and found(df) == want


def test_small_blocks_change_nothing(spark, monkeypatch):
    rows = vectors(400, 8, 1)
    want = brute(rows)
    monkeypatch.setattr(hard_negatives, "VECTORS", 30)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", 1)
    assert found(spark.createDataFrame(rows, SCHEMA)) == want


def test_blocks_meet_whatever_task_they_come_to(spark, monkeypatch):
    rows = vectors(400, 8, 5)
    want = brute(rows)
    monkeypatch.setattr(hard_negatives, "VECTORS", 30)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    # Groups this small would else be put back into one task.
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        assert want and found(spark.createDataFrame(rows, SCHEMA)) == want
    finally:
        spark.conf.set(name, before)


def test_odd_rows_ties_and_repeats(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)], rng.randint(0, 2)) for i in range(160)]
    rows += [rows[0], rows[7], rows[50], (None, [0.5] * 4, 1), (None, [0.5] * 4, 2), (200, None, 1), (201, [0.1], None)]
    rows += [(250, [0.0] * 4, 1), (300, [], 1), (350, [0.5], 0), (202, [nan, 1.0], 0), (203, [inf, 1.0], 0)]
    rows += [(204, [None, 1.0, 1.0, 1.0], 0), (205, [0.5] * 9, 1), (400, [-0.5] * 4, 2)]
    want = brute(rows)
    assert want and found(spark.createDataFrame(rows, SCHEMA)) == want


def test_values_of_any_size(spark):
    rows = [(i, [2e6 * (i % 7 - 3), 1e6 * (i % 11) + 9 * i, -0.3], i % 3) for i in range(120)]
    want = brute(rows)
    assert max(r[4] for r in want) > 1 << 53 and found(spark.createDataFrame(rows, SCHEMA)) == want
    rows += [(i, [1e30, 1e30 * (i % 3 - 1), 0.5], i % 3) for i in range(120, 170)]
    want = brute(rows)
    assert want and found(spark.createDataFrame(rows, SCHEMA)) == want


def test_access_stops_early_and_misses_nothing():
    rng = np.random.default_rng(4)
    rows = rng.integers(-300, 300, (4000, 3))
    lists = hard_negatives.Lists(rows, 300)
    anchor = np.array([250, -3, 120])
    scores = rows @ anchor
    seen = [len(new) for new, _, _ in lists.accesses(anchor)]
    assert sum(seen) == 4000
    read = 0
    original = lists.accesses

    def counted(a):
        nonlocal read
        for new, of, threshold in original(a):
            read += len(new)
            yield new, of, threshold

    lists.accesses = counted
    everything = np.ones(4000, bool)
    windows = [(int(scores.max()) // 2, int(scores.max()) * 95 // 100), (-(10**9), 10**9)]
    got = hard_negatives.first_in_windows(lists, anchor, everything, windows, 3)
    for (low, high), (at, of) in zip(windows, got):
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        want = sorted(inside, key=lambda i: (-scores[i], i))[:3]
        assert at.tolist() == list(want) and of.tolist() == scores[want].tolist()
    assert read < 2500


def test_nothing_to_mine(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(df) == []
    assert found(spark.createDataFrame([(1, [0.5], 0), (2, [0.5], 1)], SCHEMA)) == []
    assert found(spark.createDataFrame([(50, [0.5], 0)], SCHEMA)) == []


def test_a_label_may_be_the_largest_integer(spark, tmp_path):
    rows = [(i, v, 2**31 - 1 - k) for i, v, k in vectors(60, 4, 6)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in rows]
    assert sorted(map(tuple, op11_hard_negatives(spark, str(tmp_path)).collect()), key=str) == brute(moved)
