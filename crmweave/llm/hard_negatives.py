"""Hard-negative mining by Fagin's threshold algorithm over blocks of vectors.

Vectors are dealt over blocks, and every block of anchors meets every block of vectors once. In
a block each dimension has a list of the rows in order of their component. For an anchor, all
lists are read side by side, from the end that its component's sign prefers; a row met in any
list is scored at once in whole numbers. What no list has shown yet scores the threshold at most,
the anchor's product with the values last read; once that is strictly below the kth score of
every window, the rest of the block cannot matter. Blocks' first rows are then merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crmweave.llm.common import pick
from crmweave.session import write_table

# Rows of a block of vectors, and of a block of anchors.
VECTORS, ANCHORS = 8192, 4096
# Depth of the first sorted access; each further one doubles it.
FIRST_DEPTH = 64
# Whole numbers below this are exact in doubles; beyond it Python's own are used.
EXACT = 1 << 53
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """One row per vector; shorter vectors end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


class Lists:
    """The rows of a block, and for each dimension their order."""

    def __init__(self, rows: np.ndarray, largest: int):
        self.size, width = rows.shape
        reach = int(np.abs(rows.astype(float)).max(initial=0)) + 1
        fits = reach * (largest + 1) * max(1, width) < EXACT
        self.rows = rows.astype(float) if fits else rows.astype(object)
        self.order = np.argsort(rows.T, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.rows.T, self.order, axis=1)

    def accesses(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """``(rows met first, their scores, threshold of all rows not met)``, ever deeper."""
        anchor = anchor.astype(self.rows.dtype)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            yield np.arange(self.size), np.zeros(self.size, self.rows.dtype), -np.inf
            return
        met = np.zeros(self.size, bool)
        depth, n = 0, self.size
        while depth < n:
            deeper = min(n, max(FIRST_DEPTH, 2 * depth))
            fresh = np.zeros(n, bool)
            fresh[self.order[up, n - deeper : n - depth].ravel()] = True
            fresh[self.order[down, depth:deeper].ravel()] = True
            fresh &= ~met
            met |= fresh
            rows = np.flatnonzero(fresh)
            threshold = anchor[up] @ self.values[up, n - deeper] + anchor[down] @ self.values[down, deeper - 1]
            scores = self.rows[rows] @ anchor
            if scores.dtype == object:
                scores, threshold = (np.clip(x, LEAST_LONG, MOST_LONG) for x in (scores, threshold))
            yield rows, scores, -np.inf if met.all() else threshold
            depth = deeper


def highest(rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by their row."""
    places = np.arange(len(scores))
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= kth)
    return places[np.lexsort((rows[places], -scores[places]))][:k]


def first_in_windows(
    lists: Lists, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[float, float]], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per window ``(rows, scores)``: its k highest scores among the allowed rows."""
    rows, scores = np.zeros(0, np.int64), np.zeros(0, lists.rows.dtype)
    ceiling = min(high for _, high in windows)
    for new, of, threshold in lists.accesses(anchor):
        fits = allowed[new]
        rows, scores = np.append(rows, new[fits]), np.append(scores, of[fits])
        # No kth score lies above the ceiling, so a higher threshold need not be looked at.
        if threshold >= ceiling:
            continue
        for low, high in windows:
            inside = scores[(scores >= low) & (scores <= high)]
            kth = np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else low
            if threshold >= kth:
                break
        else:
            break
    found = []
    for low, high in windows:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        at = inside[highest(rows[inside], scores[inside], k)]
        found.append((rows[at], scores[at]))
    return found


def _sorted_block(block: pa.Table) -> pa.Table:
    """Rows by id, rows without one last, then by row number, so that ties go by place."""
    order = [("vec_id", "ascending"), ("row", "ascending")]
    return block.sort_by(order)


def _meet(anchors: DataFrame, vectors: DataFrame) -> Column:
    """Blocks of anchors and of vectors, every pair of blocks one group.

    Both sides number their blocks in one type: keys of unlike types hash apart, and a group's
    two sides would come to different tasks.
    """
    blocks = lambda df, size: max(1, -(-df.count() // size))
    na, nv = blocks(anchors, ANCHORS), blocks(vectors, VECTORS)
    own = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("a", own(na)).withColumn("v", each(nv))
    right = vectors.withColumn("v", own(nv)).withColumn("a", each(na))
    return left.groupBy("a", "v").cogroup(right.groupBy("a", "v"))


POSITIVE = "row bigint, positive_id bigint, positive_row bigint, positive_score bigint"


def _positives(anchors: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """``(row, positives)`` per anchor: its first k other rows of the same label."""

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        right = _sorted_block(right)
        asked = matrix(left["vector"])
        held = matrix(right["vector"], asked.shape[1])
        asked = matrix(left["vector"], held.shape[1])
        lists = Lists(held, int(np.abs(asked.astype(float)).max(initial=0)))
        label, number = right["label"].to_numpy(), right["row"].to_numpy()
        takes, at, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, (row, own) in enumerate(zip(left["row"].to_pylist(), left["label"].to_pylist())):
            allowed = (label == own) & (number != row)
            rows, found = first_in_windows(lists, asked[i], allowed, [(-np.inf, np.inf)], k)[0]
            takes += [row] * len(rows)
            at.append(rows)
            scores.append(found.astype(np.int64))
        met = np.concatenate(at)
        ids = right["vec_id"].take(pa.array(met)).combine_chunks()
        columns = [pa.array(takes, pa.int64()), ids, pa.array(number[met]), pa.array(np.concatenate(scores))]
        return pa.table(columns, names=["row", "positive_id", "positive_row", "positive_score"])

    found = _meet(anchors, vectors).applyInArrow(nearest, POSITIVE)
    first = Window.partitionBy("row").orderBy(
        F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_row"
    )
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
    positive = F.struct("place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    # At most k of them.
    return found.groupBy("row").agg(F.array_sort(F.collect_list(positive)).alias("positives"))


NEGATIVE = (
    "row bigint, place int, anchor_id bigint, positive_id bigint, positive_score bigint,"
    " negative_id bigint, negative_row bigint, negative_score bigint"
)


def _negatives(anchors: DataFrame, vectors: DataFrame, k: int, least: int, most: int) -> DataFrame:
    """The first k rows of another label in each anchor's window below each positive."""

    def hardest(left: pa.Table, right: pa.Table) -> pa.Table:
        right = _sorted_block(right)
        asked = matrix(left["vector"])
        held = matrix(right["vector"], asked.shape[1])
        asked = matrix(left["vector"], held.shape[1])
        lists = Lists(held, int(np.abs(asked.astype(float)).max(initial=0)))
        label, number = right["label"].to_numpy(), right["row"].to_numpy()
        heads, at, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, anchor in enumerate(left.select(["row", "vec_id", "label", "positives"]).to_pylist()):
            windows = [
                (p, (-(-least * p["score"] // 100), most * p["score"] // 100)) for p in anchor["positives"]
            ]
            windows = [(p, w) for p, w in windows if w[0] <= w[1]]
            if not windows:
                continue
            found = first_in_windows(lists, asked[i], label != anchor["label"], [w for _, w in windows], k)
            for (p, _), (rows, of) in zip(windows, found):
                heads += [(anchor["row"], p["place"], anchor["vec_id"], p["id"], p["score"])] * len(rows)
                at.append(rows)
                scores.append(of.astype(np.int64))
        met = np.concatenate(at)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        parts = list(zip(*heads)) or [()] * len(kinds)
        columns = [pa.array(list(p), kind) for p, kind in zip(parts, kinds)]
        columns += [right["vec_id"].take(pa.array(met)).combine_chunks(), pa.array(number[met])]
        names = ["row", "place", "anchor_id", "positive_id", "positive_score"]
        names += ["negative_id", "negative_row", "negative_score"]
        return pa.table([*columns, pa.array(np.concatenate(scores))], names=names)

    found = _meet(anchors, vectors).applyInArrow(hardest, NEGATIVE)
    first = Window.partitionBy("row", "place").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_row"
    )
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchor: str = "vec_id % 50 = 0",
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components count as ``floor(256 * x)``, scores are inner products with the anchor. An
    anchor's positives are its first other rows of the same label; a positive's negatives are
    the first rows of another label whose score is within ``least`` to ``most`` percent of the
    positive's. Equal scores come by ascending ``vec_id``, rows without one last. Rows with a
    null label or vector, or with any null or non-finite component, take no part. Repeated rows
    are rows of their own. Shorter vectors count as ending in zeros; components and scores
    beyond 64 bits count as the nearest long. A positive without negatives has no rows, nor has
    an empty table. ``anchor`` is a condition on ``vec_id``; only ``vec_id``, ``embedding`` and
    ``label`` are read.
    """
    rows = pick(vectors, "vec_id", "embedding", "label")
    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: (x > float("-inf")) & (x < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.transform(wide, lambda x: F.floor(x * 256)).alias("vector"),
    )
    rows = write_table(rows, "vectors")
    anchors = rows.where(anchor)
    near = write_table(_positives(anchors, rows, positives), "positives")
    asked = write_table(anchors.join(near, "row"), "anchors")
    found = _negatives(asked, rows, negatives, least, most)
    return found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
