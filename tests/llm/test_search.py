"""Ranked lexical search against plain evaluation of the formula."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from crmweave.llm import lexical_search
from crmweave.llm.lexical_search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total, number = sum(sum(c.values()) for _, c in held), len(held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc, counts in held:
            m = 100 - 25 + 25 * sum(counts.values()) * number // total
            score = 0
            for t in terms(text):
                if t in counts:
                    w = floor(1000 * log((2 * number + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["É", "straße", "İx", "A-b", "x_y", "9", " ", "\x00"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 300])))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, " ,;"), (1003, docs[4][1]), (4, docs[4][1]), (4, "w1 w2 other"),
             (None, docs[7][1]), (1004, "w5 " * 9000)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 12])))) for i in range(25)]
    items += [(3, items[3][1]), (5, "w1 W1 w299"), (90, None), (91, ""), (92, "nowhere"), (93, docs[8][1]), (None, "w7")]
    return docs, items


@pytest.mark.parametrize("k", [1, 3, 20])
def test_search(spark, docs_of, corpus, k):
    docs, items = corpus
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS ITEM_ID", "2 AS query")
    assert rows_of(search(docs_of(docs).repartition(3), asked, k)) == brute(docs, items, k)


def test_blocks_and_rounds_change_nothing(spark, docs_of, corpus, monkeypatch):
    docs, items = corpus
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(lexical_search, "ROUND_QUERIES", 10)
    monkeypatch.setattr(lexical_search, "BLOCK_DOCUMENTS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        found = rows_of(search(docs_of(docs).coalesce(1), asked, 5))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute(docs, items, 5)


def test_accumulators_stop(corpus):
    """Late terms open no accumulators once they cannot matter, and the first k stay exact."""
    rng = np.random.default_rng(0)
    n = 5000
    terms_, rows = [], []
    for t, share in enumerate([0.01, 0.02, 0.5, 0.9]):
        hit = np.flatnonzero(rng.random(n) < share)
        terms_.append(np.full(len(hit), t))
        rows.append(hit)
    terms_, rows = np.concatenate(terms_), np.concatenate(rows)
    norms = np.full(n, 100)
    block = lexical_search.Block(terms_, rows, rng.integers(1, 4, len(rows)), norms)
    query = [(0, 4000), (1, 3500), (2, 600), (3, 90)]
    hits, scores = block.rank(query, 1, 20)
    assert 20 <= len(hits) < 200
    full = np.zeros(n, np.int64)
    for t, w in query:
        a, b, _ = block.spans[t]
        full[block.rows[a:b]] += block.parts[a:b] * w
    ids = np.arange(n)
    none = np.zeros(n, bool)
    want = lexical_search.first_rows((full, none, ids), 20)
    got = lexical_search.first_rows((scores, none[hits], hits), 20)
    assert all((a == b).all() for a, b in zip(want, got))


def test_nothing_to_search(spark, docs_of):
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    docs = docs_of([(1, "a b"), (2, "c")])
    assert rows_of(search(docs_of([]), items)) == []
    assert rows_of(search(docs, items.limit(0))) == []
    assert rows_of(search(docs, items)) == brute([(1, "a b"), (2, "c")], [(1, "a")], 20)


def test_lengths_of_any_size():
    n = np.array([1, 1 << 40], np.int64)
    got = lexical_search.length_norms(n, 1 << 30, 1 << 50).tolist()
    assert got == [75 + 25 * int(x) * (1 << 30) // (1 << 50) for x in n]
