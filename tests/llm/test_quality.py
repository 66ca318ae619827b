"""The line model against brute force, and its accuracy on held-out documents."""

import zlib
from itertools import product

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from crmweave.llm import quality


def test_marginals_equal_all_labelings():
    rng = np.random.default_rng(1)
    per_text = np.array([3, 1, 5, 2])
    evidence, moves = rng.normal(size=per_text.sum()), rng.normal(size=(2, 2))
    good, sums, total = quality.marginals(evidence, moves, per_text)
    at, want_sums, totals = 0, np.zeros((2, 2)), []
    for n in per_text:
        mass, chance = 0.0, np.zeros(n)
        pairs = np.zeros((2, 2))
        for labels in product((0, 1), repeat=int(n)):
            weight = np.exp(sum(evidence[at + i] * y for i, y in enumerate(labels))
                            + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
            mass += weight
            chance += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                pairs[a, b] += weight
        assert np.allclose(good[at : at + n], chance / mass)
        want_sums += pairs / mass
        totals.append(np.log(mass))
        at += n
    assert np.allclose(sums, want_sums) and np.allclose(sorted(total), sorted(totals))


def test_lines_are_described():
    texts = ["Good line.\nA | B | A", "", "\n", "NO!! NO!!"]
    features, lengths, per_text = quality.line_features(texts)
    assert per_text.tolist() == [2, 1, 2, 1] and lengths.tolist() == [10, 9, 0, 0, 0, 9]
    column = dict(zip(quality.FEATURES, features.T))
    assert column["ends_stop"].tolist() == [1, 0, 0, 0, 0, 0]
    assert column["bar"][1] == pytest.approx(2 / 9) and column["any_shout"][5] == 1
    assert column["repeated"].tolist() == [0, 0, 0, 0, 0, 0.5] and column["distinct"][5] == 0.5
    wide = quality.with_neighbours(features, per_text)
    n = len(quality.FEATURES)
    assert (wide[0, n : 2 * n] == 0).all() and (wide[0, 2 * n :] == features[1]).all()
    assert (wide[1, 2 * n :] == 0).all() and (wide[1, n : 2 * n] == features[0]).all()
    alone = [quality.line_features([t])[0] for t in texts]
    assert np.allclose(np.concatenate(alone), features)


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_documents(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    tested = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.quality for r in tested) / len(tested)
    bad = [r.predicted for r in tested if r.quality == 0]
    assert right >= 0.96 and sum(bad) <= 0.2 * len(bad)
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").select(docs.columns)
    assert quality.keep_good(good, labels).count() >= 0.98 * good.count()


def test_held_out_labels_are_not_learned_from(spark, docs_of):
    rows = [(i, "Fine words here." if i % 2 else "BAD!! BAD!! BAD!!") for i in range(60)]
    truth = [(i, i % 2, 0) for i in range(60)]
    held = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1}
    wrong = [(i, 1 - q if i in held else q, t) for i, q, t in truth]
    schema = "doc_id bigint, quality int, toxic int"
    found = [
        sorted(map(tuple, quality.score_documents(docs_of(rows), spark.createDataFrame(x, schema)).collect()))
        for x in (truth, wrong)
    ]
    assert found[0] == found[1] and all(p == i % 2 for i, _, _, p in found[0])


def test_odd_input(spark, docs_of):
    schema = "doc_id bigint, quality int, toxic int"
    rows = [(1, None), (2, ""), (None, "x"), (3, "A line.\n" * 3000), (3, "A line.\n" * 3000)]
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(1, 1, 0), (1, 1, None), (None, 0, 0), (2, None, 0), (3, 7, 0)], schema)
    for labels in (none, one):
        scored = quality.score_documents(docs_of(rows), labels).collect()
        assert len(scored) == 5 and len({r.score for r in scored}) == 1
        assert {r.doc_id: r.held_out for r in scored}[None] is False
    assert quality.score_documents(docs_of([]), one).count() == 0
    df = docs_of(rows)
    assert quality.keep_good(df, one).columns == df.columns
    assert quality.keep_good(df.withColumn("n", F.lit(1)), none).count() == 5
