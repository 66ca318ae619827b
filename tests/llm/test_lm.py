"""Language-model scores: counts by brute force, the model by its sums and by held-out texts."""

import random
import re
import zlib
from collections import Counter
from math import isclose, log10

import numpy as np
import pyarrow as pa
import pytest

from crmweave.llm import maxent_lm as lm

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def brute(rows):
    counts = Counter(t for i, text in rows if not is_held(i) for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        words = tokens(text)
        base = sum(log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in words)
        out.append((i, is_held(i), len(words), sum(counts[t] > 0 for t in words), total, base))
    return sorted(out, key=str)


def found(df):
    result = lm.score_documents(df)
    assert result.columns == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=str)


def same(got, want):
    assert len(got) == len(want)
    got, want = (sorted(x, key=lambda r: (str(r[:5]), r[5])) for x in (got, want))
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and g[6] <= 1e-6


def chain(rng, n):
    """Words that follow each other by a rule more often than not."""
    word, out = rng.randrange(40), []
    for _ in range(n):
        word = (word * 7 + 3) % 40 if rng.random() < 0.7 else rng.randrange(40)
        out.append(f"w{word}")
    return out


@pytest.fixture(autouse=True)
def small_table(monkeypatch):
    monkeypatch.setattr(lm, "PART", 4096)


@pytest.mark.parametrize("block", [7, 1 << 21])
def test_counts_equal_brute_force(docs_of, monkeypatch, block):
    rng = random.Random(1)
    monkeypatch.setattr(lm, "BLOCK", block)
    rows = [(i, " ".join(chain(rng, rng.choice([0, 1, 9, 60])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "Straße ÉA éa w1\x0bW1"), (None, "w1 odd"), (None, None)]
    rows += [(7, rows[7][1]), (7, "other words"), (104, "w1 " * 3000)]
    same(found(docs_of(rows)), brute(rows))


def test_nothing_to_learn(docs_of):
    assert found(docs_of([])) == []
    held = next(i for i in range(99) if is_held(i))
    rows = [(held, "never seen"), (held, None)]
    same(found(docs_of(rows)), brute(rows))


def test_the_model_beats_counts_and_knows_the_order(docs_of, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(chain(rng, 80))) for i in range(300)]
    shuffled = []
    for i, text in rows:
        if is_held(i):
            words = text.split()
            rng.shuffle(words)
            shuffled.append((i + 10**6 * next(k for k in range(1, 99) if is_held(i + 10**6 * k)), " ".join(words)))
    monkeypatch.setattr(lm, "BLOCK", 1000)
    got = {r[0]: r for r in found(docs_of(rows + shuffled))}
    held = [r for i, r in got.items() if r[1] and i < 10**6]
    assert len(held) >= 15 and sum(r[6] for r in held) > 0.75 * sum(r[5] for r in held)
    assert all(got[i][6] > got[j][6] for (i, _), (j, _) in zip([x for x in rows if is_held(x[0])], shuffled))


def test_probabilities_sum_to_one(docs_of):
    """Over all known words and one unknown per slot of the last class, after any history."""
    rng = random.Random(3)
    rows = [(i, " ".join(chain(rng, 50) + [f"rare{rng.randrange(2000)}" for _ in range(30)])) for i in range(120)]
    ready, known = lm.prepare(docs_of(rows))
    bias = known.bias()
    weights = lm.train(ready, bias)
    assert weights.shape == (lm.ROWS, lm.SLOTS) and np.abs(weights).max() > 0.1
    for before, second in ((lm.START, lm.START), (3, lm.START), (5, 9), (lm.HEAD + 4, 2)):
        history = [np.array([x], np.uint16) for x in (before, second)]
        scored = []
        for context in range(lm.CLASSES + 1):
            rows_ = lm.feature_rows(np.array([context], np.uint16), *history)
            events = lm.Events(np.array([context]), rows_, np.array([0]), np.array([0]))
            scored.append(lm.scores_of(events, slice(0, 1), bias, weights)[0])
        joint = scored[lm.ROOT][:, None] * np.array(scored[: lm.CLASSES])
        slots = joint.ravel()
        words = slots[: len(known.head)].sum()
        tail_total = known.tail_tokens + 0.1 * (known.tail_distinct + 1)
        counts = Counter(t for i, text in rows if not is_held(i) for t in tokens(text) if t)
        by_slot = np.zeros(lm.SLOTS)
        for word, c in counts.items():
            if word.encode() not in known.head:
                by_slot[zlib.crc32(word.encode()[-2:]) % lm.SLOTS] += c + 0.1
        assert np.allclose(by_slot + 0.1, tail_total)
        tail = (slots[lm.HEAD :] * (by_slot + 0.1) / tail_total).sum()
        assert isclose(words + tail, 1, abs_tol=1e-4)


def test_gradient_is_observed_less_expected():
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 200, 300).astype(np.uint16)
    bias = np.log(rng.dirichlet(np.ones(lm.SLOTS), lm.CLASSES + 1)).astype(np.float32)
    weights = rng.normal(size=(lm.ROWS, lm.SLOTS)).astype(np.float32) * 0.3
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([[False, True, False]]), pa.array([[100, 120, 80]], pa.list_(pa.int32())),
         pa.array([symbols.tobytes()])], ["held", "lengths", "symbols"])
    learned = list(lm._learned(iter([batch])))

    def likelihood(w):
        return sum(
            np.log(lm.scores_of(e, slice(None), bias, w).astype(float))[e.which, e.target].sum()
            for _, e in learned
        )

    [got] = lm.gradient(bias, weights)(iter([batch]))
    events = learned[0][1]
    for row, slot in zip(events.rows[0][events.which][:8], events.target[:8]):
        step = np.zeros_like(weights)
        step[row, slot] = 0.05
        slope = (likelihood(weights + step) - likelihood(weights - step)) / 0.1
        assert isclose(slope, got[row, slot], rel_tol=0.02, abs_tol=0.02)
    zero = np.zeros_like(weights)
    [both] = lm.first_gradient(bias)(iter([batch]))
    [plain] = lm.gradient(bias, zero)(iter([batch]))
    assert np.allclose(both[:, : lm.SLOTS] - both[:, lm.SLOTS :], plain, atol=1e-3)


@pytest.mark.parametrize("below", [1, 50, 40_000_000])
def test_distinct_keys(below):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, below, 3000).astype(np.uint32)
    keys[:1000] = keys[1000:2000]
    want, want_which = np.unique(keys, return_inverse=True)
    found, which = lm.distinct(keys, below)
    assert found.dtype == keys.dtype and found.tolist() == want.tolist() and which.tolist() == want_which.tolist()


def test_events_are_not_found_by_an_indirect_sort(monkeypatch):
    """Nor is a gradient that takes its table two values at a time another than the plain one."""
    rng = np.random.default_rng(4)
    symbols, lengths = rng.integers(0, 1024, 900).astype(np.uint16) // 3, [500, 1, 399]
    weights = rng.normal(size=(lm.ROWS, 32)).astype(np.float32)
    bias = np.log(rng.dirichlet(np.ones(32), 33)).astype(np.float32)
    monkeypatch.setattr(np, "unique", None)
    columns = {"held": [[False, True, False]], "lengths": [lengths], "symbols": [symbols.tobytes()]}
    [found] = lm.gradient(bias, weights)(iter(pa.table(columns).to_batches()))
    want = np.zeros((lm.ROWS, 32))
    for text in (symbols[:500], symbols[501:]):
        before = second = lm.START
        for symbol in map(int, text):
            for context, target in ((lm.ROOT, symbol // 32), (symbol // 32, symbol % 32)):
                rows = lm.feature_rows(*(np.array([x], np.uint32) for x in (context, before, second)))
                scores = np.exp(bias[context] + sum(weights[r[0]].astype(float) for r in rows))
                for r in rows:
                    want[r[0], target] += 1
                    want[r[0]] -= scores / scores.sum()
            before, second = symbol, before
    assert np.abs(found - want).max() < 1e-3
