"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

A word is a class given its history, and a slot in that class given both; each of the two is a
softmax over 32 weights per feature, and a feature (the word before, the two words before, and
the word before last alone, a skip) hashes to a row of one weight table of fixed size. Frequent
words have slots of their own. All others share the slots of one class by how they end, and are
told apart there by their smoothed counts, so that all known words and one unknown per slot
sum to one.

Texts become blocks of numbered words once; counts of all words come from one shuffle of what each
block has, and go back to the blocks by another. Training is rounds of a gradient that every
task sums over its blocks and that is added up by parts of the table; only the summed table,
8 MB whatever the input, passes the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count
from math import log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import bounded_batches, documents
from crmweave.session import write_table

# Classes, and slots of each; the last class holds the words without a slot of their own.
CLASSES = SLOTS = 32
TAIL, HEAD = CLASSES - 1, (CLASSES - 1) * SLOTS
# Context of the class itself; slots have their class as context.
ROOT = CLASSES
# What stands before the first word.
START = CLASSES * SLOTS
# Rows of the weight table, and rows that are added up together.
ROWS, PART = 1 << 16, 128
# Words of a block, words whose events are gathered, and distinct events scored at once.
BLOCK, EVENTS, SCORED = 1 << 21, 1 << 20, 1 << 12
# Fixed value: what is added to every count.
SMOOTHING = 0.1
# Rounds after the first, and how far each of them goes.
ROUNDS, FIRST_STEP, STEP, LEAST_MASS, LIMIT = 3, 0.6, 0.5, 2.0, 8.0
END = b""


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


BLOCKS = (
    "block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, tokens binary,"
    " words array<binary>, counts array<int>"
)


def _encoded(docs: DataFrame) -> DataFrame:
    """Blocks of documents, with words numbered per block.

    ``counts`` has how often the block's training documents hold each of its ``words``; the end
    of a text is the empty word.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count((TaskContext.get().partitionId()) << 32)

        def block(ids: list, held: list, parts: list, words: list) -> pa.RecordBatch:
            lengths = np.array([len(p) for p in parts], np.int32)
            tokens = np.concatenate(parts)
            learned = tokens[np.repeat(~np.array(held), lengths)]
            columns = [
                pa.array([next(number)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int32())),
                pa.array([tokens.tobytes()], pa.binary()), pa.array([words], pa.list_(pa.binary())),
                pa.array([np.bincount(learned, minlength=len(words)).astype(np.int32)], pa.list_(pa.int32())),
            ]
            names = ["block", "doc_ids", "held", "lengths", "tokens", "words", "counts"]
            return pa.RecordBatch.from_arrays(columns, names)

        def fresh() -> tuple[list, list, list, dict]:
            return [], [], [], defaultdict(count().__next__)

        ids, held, parts, seen = fresh()
        size = 0
        for batch in batches:
            for doc_id, text, out in zip(batch.column(0), batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                words.append(END)
                parts.append(np.fromiter(map(seen.__getitem__, words), np.int32, len(words)))
                ids.append(doc_id.as_py())
                held.append(out.as_py())
                size += len(words)
                if size >= BLOCK:
                    yield block(ids, held, parts, list(seen))
                    ids, held, parts, seen = fresh()
                    size = 0
        if parts:
            yield block(ids, held, parts, list(seen))

    return docs.mapInArrow(encoded, BLOCKS)


@dataclass(frozen=True)
class Vocabulary:
    """What is known of the training words: bounded tables only."""

    tokens: int  # N
    distinct: int  # V
    head: dict[bytes, int]  # symbol of each frequent word
    head_counts: list[int]
    tail_tokens: np.ndarray  # per slot of the last class
    tail_distinct: np.ndarray

    def bias(self) -> np.ndarray:
        """Per context the log probability of each of its slots without any history."""
        mass = np.zeros((CLASSES, SLOTS))
        mass.ravel()[: len(self.head_counts)] = np.maximum(self.head_counts, SMOOTHING)
        mass[TAIL] = self.tail_tokens + SMOOTHING * (self.tail_distinct + 1)
        both = np.vstack([mass, mass.sum(axis=1)])
        total = np.maximum(both.sum(axis=1, keepdims=True), SMOOTHING)
        with np.errstate(divide="ignore"):
            return np.maximum(np.log(both / total), -60).astype(np.float32)


TAIL_SLOT = f"CAST(pmod(crc32(substring(word, -2, 2)), {SLOTS}) AS int)"


def _vocabulary(counts: DataFrame) -> Vocabulary:
    tokens, distinct, ends = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"),
        F.coalesce(F.sum(F.when(F.length("word") == 0, F.col("c"))), F.lit(0)),
    ).first()
    frequent = counts.where("length(word) > 0").orderBy(F.desc("c"), "word").limit(HEAD - 1).collect()
    head = {END: 0} | {bytes(r["word"]): i for i, r in enumerate(frequent, 1)}
    tail = counts.join(_symbols(counts.sparkSession, head), "word", "left_anti")
    by_slot = tail.selectExpr(f"{TAIL_SLOT} AS slot", "c").groupBy("slot").agg(F.sum("c"), F.count("*"))
    sums, kinds = np.zeros(SLOTS), np.zeros(SLOTS)
    for slot, n, k in by_slot.collect():
        sums[slot], kinds[slot] = n, k
    return Vocabulary(tokens, distinct, head, [ends, *[r["c"] for r in frequent]], sums, kinds)


def _symbols(spark, head: dict[bytes, int]) -> DataFrame:
    """``(word, symbol)`` of the frequent words, fewer than a thousand."""
    rows = [(bytearray(w), s) for w, s in head.items()]
    return F.broadcast(spark.createDataFrame(rows, "word binary, symbol int"))


READY = (
    "doc_ids array<bigint>, held array<boolean>, lengths array<int>, symbols binary,"
    " known array<bigint>, base array<double>, tail array<double>"
)


def _ready(encoded: DataFrame, words: DataFrame, known: Vocabulary) -> DataFrame:
    """Blocks of symbols, with what each document's counts say on their own.

    ``words`` has ``(at, pos, c, symbol)``, at the block, for each word of each block.
    """
    total, scale = known.tokens + SMOOTHING * (known.distinct + 1), 1 / log(10)
    tail_total = known.tail_tokens + SMOOTHING * (known.tail_distinct + 1)

    def made(left: pa.Table, right: pa.Table) -> pa.Table:
        size = len(right)
        c, symbol = np.zeros(size), np.zeros(size, np.uint16)
        pos = right["pos"].to_numpy()
        c[pos], symbol[pos] = right["c"].to_numpy(), right["symbol"].to_numpy()
        tokens = np.frombuffer(left["tokens"][0].as_buffer(), np.int32)
        lengths = left["lengths"].combine_chunks().flatten().to_numpy()
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        base = np.log((c + SMOOTHING) / total) * scale
        tail = np.zeros(size)
        last = symbol >= HEAD
        tail[last] = np.log((c[last] + SMOOTHING) / tail_total[symbol[last] - HEAD]) * scale
        per_doc = lambda x: np.add.reduceat(x[tokens], starts)
        columns = [
            pa.array([symbol[tokens].tobytes()], pa.binary()),
            pa.array([per_doc((c > 0).astype(np.int64))], pa.list_(pa.int64())),
            pa.array([per_doc(base)], pa.list_(pa.float64())),
            pa.array([per_doc(tail)], pa.list_(pa.float64())),
        ]
        kept = [left[n].combine_chunks() for n in ("doc_ids", "held", "lengths")]
        names = ["doc_ids", "held", "lengths", "symbols", "known", "base", "tail"]
        return pa.table([*kept, *columns], names=names)

    blocks = encoded.select("block", "doc_ids", "held", "lengths", "tokens").groupBy("block")
    return blocks.cogroup(words.groupBy("at")).applyInArrow(made, READY)


def feature_rows(context: np.ndarray, before: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    """The table's row of each of the three features of each event."""
    one, two, both = (context.astype(np.uint64) * np.uint64(4) + np.uint64(i) for i in range(3))
    odd = np.uint64(0x9E3779B97F4A7C15)
    rows = []
    for key, history in ((one, before), (two, second), (both, before.astype(np.uint64) * 1031 + second)):
        x = (key * np.uint64(1 << 21) + history.astype(np.uint64)) * odd
        x ^= x >> np.uint64(29)
        rows.append((x * odd >> np.uint64(48)).astype(np.uint16))
    return rows


@dataclass
class Events:
    """Two events a word: its class after the history, and its slot within the class.

    Events that share context and history share their features, so they are kept once:
    ``which`` says for each word which of them is its own.
    """

    context: np.ndarray
    rows: list[np.ndarray]
    which: np.ndarray
    target: np.ndarray

    def slices(self) -> Iterator[slice]:
        return (slice(at, at + SCORED) for at in range(0, len(self.context), SCORED))


def distinct(keys: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` of whole numbers with the inverse, in a fraction of its time.

    Keys below a small number are marked in a table; others are sorted with their places in tow.
    """
    if below <= 2 * EVENTS:
        seen = np.zeros(below, bool)
        seen[keys] = True
        return np.flatnonzero(seen).astype(keys.dtype), (np.cumsum(seen, dtype=np.int32) - 1)[keys]
    low = np.uint64(32)
    both = np.sort(keys.astype(np.uint64) << low | np.arange(len(keys), dtype=np.uint64))
    ordered = (both >> low).astype(keys.dtype)
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    which = np.empty(len(keys), np.int64)
    which[both.astype(np.uint32)] = np.cumsum(first) - 1
    return ordered[first], which


def events_of(symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[slice, Events]]:
    """Events of the words of some texts, some at a time, classes and slots apart."""
    before = np.r_[np.uint16(START), symbols[:-1]]
    before[starts] = START
    second = np.r_[np.uint16(START), before[:-1]]
    second[starts] = START
    wide = np.uint32(START + 1)
    for at in range(0, len(symbols), EVENTS):
        part = slice(at, at + EVENTS)
        kind, slot = np.divmod(symbols[part], np.uint16(SLOTS))
        history = before[part] * wide + second[part]
        for contexts, target in ((1, kind), (CLASSES, slot)):
            own = kind if contexts > 1 else np.uint16(0)
            alike, which = distinct(own * wide * wide + history, contexts * int(wide) ** 2)
            alike, second_of = np.divmod(alike, wide)
            context_of, before_of = np.divmod(alike, wide)
            if contexts == 1:
                context_of = np.full(len(alike), ROOT, np.uint32)
            rows = feature_rows(context_of, before_of, second_of)
            yield part, Events(context_of, rows, which, target)


def scores_of(events: Events, part: slice, bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per distinct event the probability of each slot. Weights are limited, so none overflows."""
    scores = bias[events.context[part]]
    for rows in events.rows:
        # Rows are 16-bit numbers, all in the table, so that nothing is clipped.
        scores += weights.take(rows[part], axis=0, mode="clip")
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch, int]]:
    for batch in batches:
        for i in range(len(batch)):
            symbols = np.frombuffer(batch.column("symbols")[i].as_buffer(), np.uint16)
            lengths = batch.column("lengths")[i].values.to_numpy()
            yield symbols, lengths, batch, i


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[slice, Events]]:
    """Events of the training documents."""
    for symbols, lengths, batch, i in _texts(batches):
        learn = ~batch.column("held")[i].values.to_numpy(zero_copy_only=False)
        own = lengths[learn]
        if len(own):
            yield from events_of(symbols[np.repeat(learn, lengths)], np.r_[0, np.cumsum(own)[:-1]])


def first_gradient(bias: np.ndarray) -> Callable:
    """Observed and expected counts of every weight while all weights are zero."""
    plain = np.exp(bias)
    plain /= plain.sum(axis=1, keepdims=True)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        observed = np.zeros(ROWS * SLOTS, np.int64)
        contexts = np.zeros(ROWS * (CLASSES + 1), np.int64)
        for _, events in _learned(batches):
            number = np.bincount(events.which, minlength=len(events.context))
            for rows in events.rows:
                wide = rows.astype(np.int64)
                np.add.at(observed, wide[events.which] * SLOTS + events.target, 1)
                np.add.at(contexts, wide * (CLASSES + 1) + events.context, number)
        expected = contexts.reshape(ROWS, -1) @ plain
        yield np.hstack([observed.reshape(ROWS, SLOTS), expected])

    return summed


def gradient(bias: np.ndarray, weights: np.ndarray) -> Callable:
    """Observed less expected counts of every weight."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        total = np.zeros((ROWS, SLOTS), np.float32)
        # Two floats to a complex number take half the places.
        pairs, lanes = total.reshape(-1).view(np.complex64), np.arange(SLOTS // 2)
        for _, events in _learned(batches):
            number = np.bincount(events.which, minlength=len(events.context)).astype(np.float32)
            for rows in events.rows:
                places = rows.astype(np.int64)[events.which] * SLOTS + events.target
                np.add.at(total.reshape(-1), places, np.float32(1))
            for part in events.slices():
                expected = scores_of(events, part, bias, weights)
                expected *= number[part, None]
                for rows in events.rows:
                    places = rows[part].astype(np.int64)[:, None] * (SLOTS // 2) + lanes
                    np.subtract.at(pairs, places.ravel(), expected.view(np.complex64).ravel())
        yield total

    return summed


def _total(blocks: DataFrame, summed: Callable, width: int) -> np.ndarray:
    """The table that ``summed`` gives for the blocks of a task, added up over all tasks.

    There are as many tasks as the cluster has cores, and each hands on the table in parts.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in summed(batches):
            cut = table.astype(np.float32).reshape(ROWS // PART, -1)
            some = np.flatnonzero(cut.any(axis=1))
            columns = [pa.array(some, pa.int32()), pa.array([cut[i].tobytes() for i in some], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "values"])

    def added(group: pa.Table) -> pa.Table:
        total = np.zeros(PART * width)
        for value in group["values"]:
            total += np.frombuffer(value.as_buffer(), np.float32)
        values = pa.array([total.astype(np.float32).tobytes()], pa.binary())
        return pa.table([group["part"].slice(0, 1), values], names=["part", "values"])

    schema = "part int, values binary"
    spread = blocks.coalesce(blocks.sparkSession.sparkContext.defaultParallelism)
    found = spread.mapInArrow(parts, schema).groupBy("part").applyInArrow(added, schema)
    table = np.zeros((ROWS // PART, PART * width), np.float32)
    for part, values in found.collect():
        table[part] = np.frombuffer(values, np.float32)
    return table.reshape(ROWS, width)


def train(ready: DataFrame, bias: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The weight table.

    The first round takes its gradient at zero from all training documents. Each later round
    takes its share of the blocks, so that together they go over all of them once more. A
    weight moves by its gradient over its mass, the larger of its observed and expected counts.
    """
    counts = _total(ready.select("held", "lengths", "symbols"), first_gradient(bias), 2 * SLOTS)
    observed, expected = counts[:, :SLOTS], counts[:, SLOTS:]
    mass = np.maximum(observed, expected)
    weights = FIRST_STEP * (observed - expected) / (mass + LEAST_MASS)
    for i in range(rounds):
        share = ready.where(F.pmod(F.xxhash64("symbols"), F.lit(rounds)) == i)
        moved = _total(share.select("held", "lengths", "symbols"), gradient(bias, weights), SLOTS)
        weights += STEP * moved / (mass / rounds + LEAST_MASS)
        np.clip(weights, -LIMIT, LIMIT, out=weights)
    return weights


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _scored(ready: DataFrame, bias: np.ndarray, weights: np.ndarray) -> DataFrame:
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, lengths, batch, i in _texts(batches):
            starts = np.r_[0, np.cumsum(lengths)[:-1]]
            logs = np.zeros(len(symbols))
            for words, events in events_of(symbols, starts):
                by_slot = [scores_of(events, part, bias, weights) for part in events.slices()]
                logs[words] += np.log(np.concatenate(by_slot)[events.which, events.target])
            model = np.add.reduceat(logs, starts) / log(10) + batch.column("tail")[i].values.to_numpy()
            take = lambda name: batch.column(name)[i].values
            columns = [take("doc_ids"), take("held"), pa.array(lengths, pa.int64()), take("known")]
            yield pa.RecordBatch.from_arrays(
                [*columns, take("base"), pa.array(model)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return ready.mapInArrow(scored, SCORES)


def prepare(docs: DataFrame, folds: int = 10) -> tuple[DataFrame, Vocabulary]:
    """Blocks of symbols of all documents, and the vocabulary of the training ones."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    rows = documents(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held.alias("held"))
    encoded = write_table(_encoded(bounded_batches(rows)), "encoded")
    each = encoded.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "of"))
    each = each.select("block", "pos", F.col("of.words").alias("word"), F.col("of.counts").alias("n"))
    counts = each.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0")
    counts = write_table(counts, "word-counts")
    known = _vocabulary(counts)
    symbol = F.coalesce("symbol", F.lit(HEAD) + F.expr(TAIL_SLOT))
    words = each.join(counts, "word", "left").join(_symbols(docs.sparkSession, known.head), "word", "left")
    words = words.select(F.col("block").alias("at"), "pos", F.coalesce("c", F.lit(0)).alias("c"), symbol.alias("symbol"))
    return write_table(_ready(encoded, words, known), "symbols"), known


def score_documents(docs: DataFrame, folds: int = 10, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Rows whose ``crc32(doc_id as text)`` is divisible by ``folds`` are held out; the model and all
    counts come from the others, all of them, whole. ``base_score`` is the log10 probability by
    smoothed counts, ``score`` that of the model. A null text counts as empty, which is one end
    token. Rows without an id are learned from. Repeated rows are learned from and scored as
    often as they occur. Without training rows all words are unknown. Ids are integers; only
    ``doc_id`` and ``text`` are read.
    """
    ready, known = prepare(docs, folds)
    bias = known.bias()
    scored = _scored(ready, bias, train(ready, bias, rounds))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(known.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
