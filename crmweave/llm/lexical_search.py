"""Ranked lexical search: accumulator-limited evaluation, one term at a time.

Documents become postings of the terms that the queries name, in one pass without a shuffle;
from these come the corpus statistics. Each task then ranks its documents in blocks. A query's
terms are taken rarest first; a document gets an accumulator when a term meets it, until the
bounds of the terms still to come cannot lift a new one to the kth partial score. From there on
only the accumulators there are go on, exactly. Each task hands on k rows a query at most.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crmweave.llm.common import bounded_batches, documents
from crmweave.session import write_table

# Every ASCII byte but letters and digits separates terms; capitals are lowered.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
# The constants of the ranking formula.
SCALE, LENGTH_BASE, LENGTH_SHARE, SATURATION, TF_SCALE = 1000, 75, 25, 12, 10**9
# Queries are answered in rounds of so many queries, or bytes of their texts.
ROUND_QUERIES, ROUND_BYTES = 1000, 8 << 20
# A task ranks its documents in blocks of so many postings or documents.
BLOCK_POSTINGS, BLOCK_DOCUMENTS = 1 << 21, 1 << 16

Best = tuple[np.ndarray, np.ndarray, np.ndarray]  # scores, whether the id is null, ids


def terms_of(text: str) -> list[bytes]:
    """Terms ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split()


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` for every document with a term; ``terms`` are in vocabulary."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            lengths, terms, counts, ends = [], [], [], [0]
            for text in texts:
                words = terms_of(text.as_py())
                known = np.array([i for i in map(vocabulary.get, words) if i is not None], np.int32)
                own, tfs = np.unique(known, return_counts=True)
                lengths.append(len(words))
                terms.append(own)
                counts.append(tfs)
                ends.append(ends[-1] + len(own))
            offsets = pa.array(ends, pa.int32())
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (terms, counts)]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in flat]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"]
            )

    schema = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
    return docs.mapInArrow(listed, schema).where("n > 0")


def length_norms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """The length part of the formula, in whole numbers of any size."""
    if len(n) and int(n.max()) * LENGTH_SHARE * documents >= 1 << 62:
        parts = [LENGTH_SHARE * int(x) * documents // terms for x in n]
        return LENGTH_BASE + np.array(parts, np.int64)
    return LENGTH_BASE + LENGTH_SHARE * n * documents // terms


def first_rows(best: Best, k: int) -> Best:
    """The k highest scores, equal ones by ascending id, rows without an id last."""
    scores, last, ids = best
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= kth
        scores, last, ids = scores[near], last[near], ids[near]
    order = np.lexsort((ids, last, -scores))[:k]
    return scores[order], last[order], ids[order]


class Block:
    """Postings of some documents, by term, with what each adds to a score before its weight."""

    def __init__(self, terms: np.ndarray, rows: np.ndarray, tfs: np.ndarray, norms: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.rows, terms, tfs = rows[order], terms[order], tfs[order].astype(np.int64)
        self.parts = TF_SCALE * tfs // (SCALE * tfs + SATURATION * norms[self.rows])
        starts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, int)
        ends = np.r_[starts[1:], len(terms)]
        most = np.maximum.reduceat(self.parts, starts) if len(starts) else []
        names = terms[starts].tolist()
        self.spans = {t: (a, b, int(m)) for t, a, b, m in zip(names, starts, ends, most)}
        self.size = len(norms)

    def rank(self, query: list[tuple[int, int]], least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores above 0 of every document that can be among the first k.

        ``query`` has terms and the weight of each, rarest first. ``least`` is a score that
        the kth result is known to reach.
        """
        met = [(*self.spans[t], w) for t, w in query if t in self.spans and w]
        rest = sum(most * w for _, _, most, w in met)
        scores, opened = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        found, growing = 0, True
        for a, b, most, weight in met:
            rows, add = self.rows[a:b], self.parts[a:b] * weight
            if growing and found >= k and rest >= least:
                partial = scores[opened]
                least = max(least, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            growing = growing and rest >= least
            if growing:
                found += len(rows) - int(opened[rows].sum())
                opened[rows] = True
            else:
                survive = opened[rows]
                rows, add = rows[survive], add[survive]
            scores[rows] += add
            rest -= most * weight
        hits = np.flatnonzero(opened & (scores > 0))
        return hits, scores[hits]


def _ranked(
    postings: DataFrame, queries: list[list[tuple[int, int]]], documents: int, terms: int, k: int
) -> DataFrame:
    """``(query, doc_id, score)``: of each task, the first k documents of each query."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        best: list[Best] = [none] * len(queries)
        held: list[pa.RecordBatch] = []

        def take() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, n, names, tfs = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns)
            last = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            rows = np.repeat(np.arange(len(ids)), names.value_lengths().to_numpy())
            norms = length_norms(n.to_numpy(), documents, terms)
            block = Block(names.flatten().to_numpy(), rows, tfs.flatten().to_numpy(), norms)
            for i, query in enumerate(queries):
                kth = int(best[i][0][-1]) if len(best[i][0]) == k else 1
                at, scores = block.rank(query, kth, k)
                if len(at):
                    new = (scores, last[at], ids[at])
                    best[i] = first_rows(tuple(np.concatenate(x) for x in zip(best[i], new)), k)

        size = number = 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten())
            number += len(batch)
            if size >= BLOCK_POSTINGS or number >= BLOCK_DOCUMENTS:
                take()
                held, size, number = [], 0, 0
        if number:
            take()
        counts = [len(b[0]) for b in best]
        scores, last, ids = (np.concatenate(x) if x else none[i] for i, x in enumerate(zip(*best)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best), dtype=np.int32), counts)),
             pa.array(ids.astype(np.int64), mask=last.astype(bool)), pa.array(scores.astype(np.int64))],
            ["query", "doc_id", "score"],
        )

    return postings.mapInArrow(ranked, "query int, doc_id bigint, score bigint")


def _rounds(items: DataFrame) -> Iterator[list[tuple]]:
    """``(item_id, terms and their counts)`` of the items, some at a time."""
    held, size = [], 0
    for item, text in items.toLocalIterator():
        held.append((item, Counter(terms_of(text))))
        size += len(text)
        if len(held) >= ROUND_QUERIES or size >= ROUND_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _search_round(rows: DataFrame, asked: list[tuple], k: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in asked for t in terms))}
    postings = write_table(_postings(rows, vocabulary), "postings")
    documents, terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most one row per term that the round's queries name.
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = {r["term"]: r["count"] for r in held.collect()}
    weight = {t: floor(SCALE * log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
    queries = []
    for _, counts in asked:
        known = [(vocabulary[t], n) for t, n in counts.items() if vocabulary[t] in df]
        known.sort(key=lambda x: (df[x[0]], x[0]))
        queries.append([(t, n * weight[t]) for t, n in known])
    found = _ranked(postings, queries, documents, terms, k)
    first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    names = F.array(*[F.lit(item) for item, _ in asked])
    return found.select(F.element_at(names, F.col("query") + 1).alias("item_id"), "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the first ``k`` documents of each item.

    ``rank`` starts at 1; equal scores come by ascending ``doc_id``, rows without an id last.
    A document or item that is null or has no term finds nothing and is not found, and such
    documents do not count in the statistics. Every row of ``docs`` is a document of its own,
    also rows that repeat. An item that repeats with its text counts once; unlike texts under
    one id are each ranked, under that id. Ids of documents are integers. Only ``doc_id`` and
    ``text``, and ``item_id`` and ``text``, are read, whole. Without documents or items there
    are no rows. Items are taken in rounds of 1,000 or 8 MB, each a pass over ``docs``.
    """
    rows = bounded_batches(documents(docs).selectExpr("CAST(doc_id AS bigint) AS doc_id", "text"))
    asked = documents(items, "item_id").distinct()
    parts = [write_table(_search_round(rows, part, k), "ranked") for part in _rounds(asked)]
    if parts:
        return reduce(DataFrame.unionByName, parts)
    item = asked.schema["doc_id"].dataType.simpleString()
    empty = f"CAST(NULL AS {item}) AS item_id", "CAST(0 AS int) AS rank", "doc_id", "CAST(0 AS bigint) AS score"
    return rows.where("false").selectExpr(*empty)
