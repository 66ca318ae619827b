"""The pipeline stage by stage against brute force over the smallest data set."""

import re

import __spark_entry__
import corpus_pipeline
from conftest import DATA
from test_dedup import brute_components, brute_fingerprint

from crmweave.llm import packing


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == columns
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        kept[name] = {r.doc_id for r in rows}
        assert len(rows) == len(kept[name])
    good = kept["quality"]
    judged = [i for i in texts if i in labels]
    assert sum((i in good) == (labels[i] == 1) for i in judged) >= 0.95 * len(judged)

    groups = {}
    for i in good:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", texts[i]), []).append(i)
    best = {min(g, key=lambda i: (-len(texts[i]), i)) for g in groups.values()}
    assert kept["exact_dedup"] == best

    prints = {i: brute_fingerprint(texts[i], 4) for i in best}
    root = brute_components(sorted(best), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert kept["near_dedup"] == set(root.values())

    def words(text):
        return " ".join(re.findall(r"[^\W_]+", text.lower()))

    held = {i for i in kept["near_dedup"] if any(f" {words(t)} " in f" {words(texts[i])} " for t in items)}
    assert held and kept["decontamination"] == kept["near_dedup"] - held

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in packed} == kept["decontamination"]
    total = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-total // packing_capacity()) + 2
    run = corpus_pipeline.run(spark, DATA)
    assert run.count() == len(packed) and {r.doc_id for r in run.collect()} == kept["decontamination"]


def packing_capacity():
    assert packing.pack_documents.__defaults__[0] == corpus_pipeline.SEQUENCE
    return corpus_pipeline.SEQUENCE


def test_every_query_is_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d", n)} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5
