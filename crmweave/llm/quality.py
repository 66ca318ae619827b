"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is good or bad. Its evidence is what the line itself and the two lines next to it
look like; neighbouring labels are tied by transition weights. Forward-backward gives each
line's chance to be good, and the mean of those, weighted by line length, is the document's
quality, which a one-dimensional logistic curve turns into the chance of label 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import bounded_batches, documents, pick

# The sample that the field is fitted on: so many labelled documents, of so many lines at most.
TRAIN_DOCUMENTS, TRAIN_LINES = 3000, 100
# Steps of each of the three fits.
STEPS = 100
# Rows with this remainder of crc32(id) by FOLDS are never learned from.
FOLDS, HELD_OUT = 3, 1

# Character classes that lines are described by.
UPPER, LOWER, DIGIT, SPACE, STOP, COMMA, SHOUT, BAR, SYMBOL, KINDS = range(10)


def _kinds() -> np.ndarray:
    kinds = np.full(0x250, LOWER, np.uint8)
    for code in range(len(kinds)):
        c = chr(code)
        if c.isspace() or code < 32:
            kinds[code] = SPACE
        elif c.isdigit():
            kinds[code] = DIGIT
        elif c.isupper():
            kinds[code] = UPPER
        elif not c.isalpha():
            kinds[code] = SYMBOL
    for c, kind in ((".", STOP), ("?", STOP), ("!", SHOUT), ("|", BAR), (",", COMMA), (";", COMMA),
                    (":", COMMA), ("'", COMMA), ('"', COMMA), ("-", COMMA), ("(", COMMA), (")", COMMA)):
        kinds[ord(c)] = kind
    return kinds


KIND_OF = _kinds()
FEATURES = [
    "one", "upper", "digit", "space", "stop", "comma", "shout", "bar", "symbol", "any_shout",
    "any_bar", "any_symbol", "word_length", "log_words", "repeated", "distinct", "ends_stop",
]


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features per line, characters per line, and lines per text.

    Lines end at line feeds. All lines of all texts are described at once: characters are
    counted by line and class, and words compared by hashes of their characters.
    """
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    per_text = np.array([t.count("\n") + 1 for t in texts], np.int64)
    breaks = np.flatnonzero(codes == 10)
    n = len(breaks) + 1
    ends = np.append(breaks, len(codes))
    starts = np.append(0, breaks + 1)
    lengths = ends - starts
    # The line feed itself counts for the line it ends, as white space; it is taken out again.
    line = np.repeat(np.arange(n), np.append(lengths[:-1] + 1, lengths[-1]))
    kind = KIND_OF[np.minimum(codes, len(KIND_OF) - 1)]
    counts = np.bincount(line * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS).astype(float)
    counts[:-1, SPACE] -= 1
    chars = np.maximum(lengths, 1)
    letters = np.maximum(counts[:, UPPER] + counts[:, LOWER], 1)

    space = kind == SPACE
    begins = np.flatnonzero(~space & np.append(True, space[:-1]))
    word_line = line[begins]
    words = np.bincount(word_line, minlength=n).astype(float)
    repeated, distinct = np.zeros(n), np.ones(n)
    if len(begins):
        place = np.arange(len(codes), dtype=np.uint64)
        word_of = np.cumsum(np.bincount(begins, minlength=len(codes))) - 1
        offset = place - place[begins][np.maximum(word_of, 0)]
        with np.errstate(over="ignore"):
            mixed = (codes.astype(np.uint64) + np.uint64(1)) * MIX[offset & np.uint64(63)]
            mixed[space] = 0
            hashes = np.add.reduceat(mixed, begins)
            keyed = hashes * np.uint64(0x9E3779B97F4A7C15) ^ word_line.astype(np.uint64)
        same = (hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])
        repeated = np.bincount(word_line[1:][same], minlength=n) / np.maximum(words, 1)
        at = np.argsort(keyed)
        fresh = at[np.append(True, np.diff(keyed[at]) != 0)]
        distinct = np.where(words > 0, np.bincount(word_line[fresh], minlength=n) / np.maximum(words, 1), 1)
    # The last character of a line that is not white space.
    seen = np.where(space, -1, np.arange(len(codes)))
    last = np.maximum.accumulate(seen) if len(seen) else seen
    tail = last[np.maximum(ends - 1, 0)] if len(last) else np.full(n, -1)
    ends_stop = np.zeros(n)
    inside = (lengths > 0) & (tail >= starts)
    ends_stop[inside] = kind[tail[inside]] == STOP

    described = np.column_stack([
        np.ones(n),
        counts[:, UPPER] / letters,
        *(counts[:, k] / chars for k in (DIGIT, SPACE, STOP, COMMA, SHOUT, BAR, SYMBOL)),
        *(np.minimum(counts[:, k], 3) / 3 for k in (SHOUT, BAR, SYMBOL)),
        np.minimum(chars / np.maximum(words, 1), 20) / 20,
        np.log1p(words) / 8,
        repeated,
        distinct,
        ends_stop,
    ])
    return described, lengths.astype(float), per_text


# Odd multipliers for the places of a word's characters.
MIX = np.random.default_rng(7).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """A line's features, those of the line before and of the line after (zero: none)."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    firsts = np.append(0, np.cumsum(per_text)[:-1])
    before[firsts] = 0
    after[np.cumsum(per_text) - 1] = 0
    return np.hstack([features, before, after])


@dataclass
class Model:
    """Weights of label good, transition weights, and the curve from quality to chance."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float


def marginals(
    evidence: np.ndarray, moves: np.ndarray, per_text: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward: each line's chance of good, chances of moves summed, log partition.

    ``evidence`` is the score of good over bad per line. Texts are taken together, line by
    line, longest text first.
    """
    order = np.argsort(-per_text, kind="stable")
    firsts = (np.append(0, np.cumsum(per_text)[:-1]))[order]
    sizes = per_text[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    score = np.column_stack([np.zeros(len(evidence)), evidence])
    forward = np.zeros((len(evidence), 2))
    backward = np.zeros((len(evidence), 2))
    for t in range(longest):
        at = firsts[: active[t]] + t
        if t == 0:
            forward[at] = score[at]
        else:
            back = forward[at - 1]
            forward[at] = score[at] + np.logaddexp(
                back[:, :1] + moves[0], back[:, 1:] + moves[1]
            )
    sums = np.zeros((2, 2))
    total = np.zeros(len(sizes))
    lasts = firsts + sizes - 1
    total = np.logaddexp(forward[lasts, 0], forward[lasts, 1])
    for t in range(longest - 2, -1, -1):
        k = active[t + 1]
        at = firsts[:k] + t
        ahead = score[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
        joint = forward[at][:, :, None] + moves + ahead[:, None, :] - total[:k, None, None]
        sums += np.exp(joint).sum(axis=0)
    good = 1 / (1 + np.exp(np.clip(forward[:, 0] + backward[:, 0] - forward[:, 1] - backward[:, 1], -500, 500)))
    return good, sums, total


def _ascend(features: np.ndarray, labels: np.ndarray, per_text: np.ndarray, steps: int,
            weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raise the conditional likelihood of line labels by Adam; a small penalty on weights."""
    n = len(labels)
    inner = np.ones(n, bool)
    inner[np.cumsum(per_text) - 1] = False  # a line with a line after it
    at = np.flatnonzero(inner)
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (labels[at], labels[at + 1]), 1)
    seen = features.T @ labels
    theta = np.append(weights, moves.ravel())
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        good, sums, _ = marginals(features @ theta[:-4], theta[-4:].reshape(2, 2), per_text)
        slope = np.append(seen - features.T @ good, (seen_moves - sums).ravel()) / n - 1e-4 * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta + 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def quality_of(good: np.ndarray, lengths: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Mean chance of good per text, weighted by line length; all lines empty: plain mean."""
    firsts = np.append(0, np.cumsum(per_text)[:-1])
    weight = np.add.reduceat(lengths, firsts)
    plain = np.add.reduceat(good, firsts) / per_text
    return np.where(weight > 0, np.add.reduceat(good * lengths, firsts) / np.maximum(weight, 1), plain)


def _curve(quality: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton's method, the two labels weighing what they weigh."""
    x = np.column_stack([quality, np.ones(len(quality))])
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (labels - p) - 1e-2 * theta
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        theta = theta + np.linalg.solve(bend, slope)
    return float(theta[0]), float(theta[1])


def fit(features: np.ndarray, lengths: np.ndarray, per_text: np.ndarray, labels: np.ndarray) -> Model:
    """Fit on documents with labels alone.

    Lines first take their document's label. A second fit frees the lines of bad documents
    that the first one takes for good, but for the worst line of each.
    """
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        flat = np.log((share * len(labels) + 1) / ((1 - share) * len(labels) + 1))
        return Model(np.zeros(features.shape[1] * 3), np.zeros((2, 2)), 0.0, float(flat))
    wide = with_neighbours(features, per_text)
    lines = np.repeat(labels, per_text).astype(int)
    weights, moves = np.zeros(wide.shape[1]), np.zeros((2, 2))
    weights, moves = _ascend(wide, lines, per_text, STEPS, weights, moves)
    bad_doc = lines == 0
    for _ in range(2):
        good = marginals(wide @ weights, moves, per_text)[0]
        firsts = np.append(0, np.cumsum(per_text)[:-1])
        worst = np.repeat(np.minimum.reduceat(good, firsts), per_text)
        freed = np.where(bad_doc, (good > 0.5) & (good > worst), 1).astype(int)
        weights, moves = _ascend(wide, freed, per_text, STEPS, weights, moves)
    good = marginals(wide @ weights, moves, per_text)[0]
    slope, offset = _curve(quality_of(good, lengths, per_text), labels)
    return Model(weights, moves, slope, offset)


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    """Chance of label 1 per text."""
    if not texts:
        return np.zeros(0)
    features, lengths, per_text = line_features(texts)
    wide = with_neighbours(features, per_text)
    good = marginals(wide @ model.weights, model.moves, per_text)[0]
    quality = quality_of(good, lengths, per_text)
    return 1 / (1 + np.exp(-np.clip(model.slope * quality + model.offset, -500, 500)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label may not be learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT


def learn(docs: DataFrame, labels: DataFrame, documents_at_most: int = TRAIN_DOCUMENTS) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out.

    The sample is the ``documents_at_most`` ids with the smallest hash, less those with more
    than ``TRAIN_LINES`` lines; tasks turn its texts into line features, which alone come to
    the driver. Labels other than 0 and 1, and null ids, are passed over; of several labels of
    one id the smaller counts. Without both labels every text gets the one chance.
    """
    known = pick(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents_at_most)
    texts = documents(docs).join(F.broadcast(sample), "doc_id")  # bounded by the parameter
    rows = bounded_batches(texts)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [i for i, text in enumerate(batch.column(1)) if text.as_py().count("\n") < TRAIN_LINES]
            if not short:
                continue
            ids, texts, quality = batch.take(pa.array(short)).columns
            features, lengths, per_text = line_features(texts.to_pylist())
            at = np.cumsum(per_text)[:-1]
            blobs = [np.split(x.astype(np.float32), at) for x in (features, lengths)]
            columns = [pa.array([x.tobytes() for x in blob], pa.binary()) for blob in blobs]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.string()), quality.cast(pa.int32()), *columns],
                ["doc_id", "quality", "features", "lengths"],
            )

    schema = "doc_id string, quality int, features binary, lengths binary"
    found = rows.select("doc_id", "text", "quality").mapInArrow(described, schema).collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    width = len(FEATURES)
    features = [np.frombuffer(r["features"], np.float32).reshape(-1, width) for r in found]
    lengths = [np.frombuffer(r["lengths"], np.float32) for r in found]
    empty = np.zeros((0, width))
    return fit(
        np.concatenate([empty, *features]),
        np.concatenate([np.zeros(0), *lengths]),
        np.array([len(x) for x in lengths], np.int64),
        np.array([r["quality"] for r in found], np.int64),
    )


def scorer(model: Model) -> Callable[[Column], Column]:
    """A column function: the chance of label 1 of a text; null counts as empty."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            texts = part.fillna("").tolist()
            scores = [score_texts(texts[i : i + 200], model) for i in range(0, len(texts), 200)]
            yield pd.Series(np.concatenate(scores) if scores else [], dtype="float64")

    return scored


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, without a shuffle of texts.

    The score depends on the whole text alone. An empty or null text has one empty line;
    repeated rows and null ids stay (a null id is not held out); only ``doc_id`` and ``text``
    of ``docs`` are read. An empty table gives no rows.
    """
    of = scorer(learn(docs, labels))
    rows = bounded_batches(documents(docs)).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), of(F.col("text")).alias("score")
    )
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted to have label 1, with all their columns."""
    of = scorer(learn(docs, labels))
    inner = [f"c{i}" for i in range(len(docs.columns))]
    text = F.coalesce(F.col(inner[docs.columns.index("text")]).cast("string"), F.lit(""))
    rows = bounded_batches(docs.toDF(*inner)).withColumn("__score", of(text))
    return rows.where("__score >= 0.5").select(*inner).toDF(*docs.columns)
