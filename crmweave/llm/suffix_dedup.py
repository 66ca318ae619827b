"""Suffix-array dedup: remove what is covered by a string of 100 bytes that starts earlier too.

Texts are cut into blocks, and blocks into segments: the windows of 100 bytes whose smallest
k-gram, by hash, is the same place (its anchor) make one segment, as windowing fingerprints do.
Equal windows have equal anchors, so only anchors that occur twice in the corpus matter, and all
segments of one anchor go to one shard. A shard keeps each distinct segment once (of copies the
first stays, the others are covered whole), sorts the suffixes of those that share an anchor by
Larsson-Sadakane refinement, and finds equal windows as neighbours with a common prefix of 100
bytes, by Kasai's rule. Segments of an anchor that is too frequent for one shard are dealt over
all shards; the sorted windows these leave are cut at common splitters by Spark's range
partitioning, and the runs of different shards merged by binary search.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import bounded_batches, documents, tasks
from crmweave.session import write_table

WINDOW = 100
# k-grams that anchors are chosen from; a window has WINDOW - GRAM + 1 of them.
GRAM = 32
# Bytes of text in a block (a longer text is a block of its own), and of segments in a shard.
BLOCK, SHARD = 2 << 20, 4 << 20
# An anchor that occurs more often is dealt over all shards.
HOT = 50_000
# Windows handled at once; places within a piece fit in PLACE_BITS.
PIECE, PLACE_BITS = 1 << 21, 22
# A byte that UTF-8 text does not have.
END = 0xFF
LAST_ID = np.iinfo(np.int64).max

_ODD = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD
)]


# ---- texts in blocks ---------------------------------------------------------------------

BLOCKS = "block bigint, ids array<bigint>, sizes array<bigint>, bytes binary"


def _block(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    joined = b"".join(texts)
    packed = pa.compress(joined, codec="zstd", asbytes=True) if joined else b""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
            pa.array([packed], pa.binary()),
        ],
        ["block", "ids", "sizes", "bytes"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gather texts of a task into compressed blocks; block numbers are unique."""
    number = TaskContext.get().partitionId() << 32
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            ids.append(doc_id)
            texts.append(text.encode("utf-8", "replace"))
            size += len(texts[-1])
            if size >= BLOCK or len(ids) >= 1 << 16:
                yield _block(number, ids, texts)
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield _block(number, ids, texts)


def _unpacked(sizes: list[int], packed: bytes) -> bytes:
    total = sum(sizes)
    return pa.decompress(packed, decompressed_size=total, codec="zstd", asbytes=True) if total else b""


# ---- segments ------------------------------------------------------------------------------


def _grams(buffer: bytes) -> np.ndarray:
    """64-bit hash of the k-gram at every place, from four overlapping words."""
    n = len(buffer) - GRAM + 1
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    mixed = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(GRAM // 8):
            mixed += words[8 * i : 8 * i + n] * _ODD[i]
            mixed ^= mixed >> np.uint64(31)
            mixed *= _ODD[4]
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    extra = width - have
    return np.minimum(values[:-extra], values[extra:]) if extra else values


def segments(buffer: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first window, last window, hash of the anchor)`` of the segments of joined texts.

    ``ends`` are the ends of the texts; a window lies in one text. The anchor of a window is its
    k-gram of the smallest hash, the leftmost of equal ones; it depends on the window's bytes
    alone. Every window is in exactly one segment.
    """
    firsts, lasts, anchors = [], [], []
    for at in range(0, len(buffer) - WINDOW + 1, PIECE):
        piece = buffer[at : at + PIECE + WINDOW - 1]
        hashes = _grams(piece)
        place = np.arange(len(hashes), dtype=np.uint64)
        keyed = (hashes >> np.uint64(PLACE_BITS)) << np.uint64(PLACE_BITS) | place
        least = _sliding_least(keyed, WINDOW - GRAM + 1)
        anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        starts = np.arange(at, at + len(anchor))
        text = np.searchsorted(ends, starts, side="right")
        whole = starts + WINDOW <= ends[np.minimum(text, len(ends) - 1)]
        starts, anchor, text = starts[whole], anchor[whole], text[whole]
        if not len(starts):
            continue
        new = np.append(True, (np.diff(anchor) != 0) | (np.diff(text) != 0))
        begins = np.flatnonzero(new)
        firsts.append(starts[begins])
        lasts.append(starts[np.append(begins[1:], len(starts)) - 1])
        anchors.append(hashes[anchor[begins]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(anchors)


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, block, hashes, times)``: a block's distinct anchors, and how often each occurs."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                buffer = _unpacked(row["sizes"], row["bytes"])
                hashes, times = np.unique(segments(buffer, np.cumsum(row["sizes"]))[2], return_counts=True)
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(1, buckets))
                parts = np.split(order, cut)
                filled = [b for b in range(buckets) if len(parts[b])]
                counts = np.minimum(times, 65535).astype(np.uint16)
                yield _rows({
                    "bucket": (filled, pa.int32()),
                    "block": ([row["block"]] * len(filled), pa.int64()),
                    "hashes": ([hashes[parts[b]].tobytes() for b in filled], pa.binary()),
                    "times": ([counts[parts[b]].tobytes() for b in filled], pa.binary()),
                })

    rows = blocks.select("block", "sizes", "bytes")
    return rows.mapInArrow(listed, "bucket int, block bigint, hashes binary, times binary")


def _repeated(anchors: DataFrame, buckets: int, hot: int) -> DataFrame:
    """``(block, hashes, hot, n)``: of each block the anchors that occur twice in the corpus.

    A block sends each anchor once, however often it occurs, so a bucket's size follows from
    how hashes spread and not from how often a text is repeated.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
        times = np.concatenate([np.frombuffer(r["times"], np.uint16) for r in rows]).astype(np.int64)
        row_of = np.repeat(np.arange(len(rows)), [len(r["times"]) // 2 for r in rows])
        order = np.argsort(hashes)
        ranked = hashes[order]
        begins = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        total = np.add.reduceat(times[order], begins)
        spread = np.repeat(total, np.diff(np.append(begins, len(order))))
        again = order[spread > 1]
        heat = (spread > hot)[spread > 1]
        by_row = np.argsort(row_of[again], kind="stable")
        again, heat = again[by_row], heat[by_row]
        for part in np.split(np.arange(len(again)), np.flatnonzero(np.diff(row_of[again])) + 1):
            if len(part):
                yield _rows({
                    "block": ([rows[row_of[again[part[0]]]]["block"]], pa.int64()),
                    "hashes": ([hashes[again[part]].tobytes()], pa.binary()),
                    "hot": ([heat[part].tobytes()], pa.binary()),
                    "n": ([int(times[again[part]].sum())], pa.int64()),
                    "n_hot": ([int(heat[part].sum())], pa.int64()),
                })

    schema = "block bigint, hashes binary, hot binary, n bigint, n_hot bigint"
    return anchors.repartition(buckets, "bucket").mapInArrow(found, schema)


SEGMENTS = (
    "shard int, block bigint, lengths array<int>, anchors array<bigint>, hot array<boolean>,"
    " bytes binary, content array<int>, doc array<int>, id array<bigint>, start array<bigint>"
)


def _segments(blocks: DataFrame, repeated: DataFrame, shards: int) -> DataFrame:
    """Segments with a repeated anchor, by shard; in a block a content is sent once."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                buffer = _unpacked(row["sizes"], row["bytes"])
                ends = np.cumsum(row["sizes"])
                first, last, anchor = segments(buffer, ends)
                known = np.concatenate([np.frombuffer(x, np.uint64) for x in row["hashes"]])
                heat = np.concatenate([np.frombuffer(x, bool) for x in row["hot"]])
                order = np.argsort(known)
                known, heat = known[order], heat[order]
                at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                wanted = np.flatnonzero(known[at] == anchor)
                doc = np.searchsorted(ends, first[wanted], side="right")
                begin = np.append(0, ends[:-1])[doc]
                shards_of: dict[int, tuple] = {}
                for i, d, b in zip(wanted.tolist(), doc.tolist(), begin.tolist()):
                    lo = int(first[i])
                    content = buffer[lo : int(last[i]) + WINDOW]
                    hot = bool(heat[at[i]])
                    # A hot anchor's segments go where their content decides.
                    key = _text_number(content) if hot else int(anchor[i])
                    seen, lengths, anchors, hots, which, docs, starts = shards_of.setdefault(
                        key % shards, ({}, [], [], [], [], [], [])
                    )
                    number = seen.get(content)
                    if number is None:
                        number = seen[content] = len(seen)
                        lengths.append(len(content))
                        anchors.append(int(anchor[i].view(np.int64)))
                        hots.append(hot)
                    which.append(number)
                    docs.append(d)
                    starts.append(lo - b)
                ids = row["ids"]
                parts = list(shards_of.items())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _ in parts], pa.int32()),
                        pa.array([row["block"]] * len(parts), pa.int64()),
                        pa.array([p[1] for _, p in parts], pa.list_(pa.int32())),
                        pa.array([p[2] for _, p in parts], pa.list_(pa.int64())),
                        pa.array([p[3] for _, p in parts], pa.list_(pa.bool_())),
                        pa.array([b"".join(p[0]) for _, p in parts], pa.binary()),
                        pa.array([p[4] for _, p in parts], pa.list_(pa.int32())),
                        pa.array([p[5] for _, p in parts], pa.list_(pa.int32())),
                        pa.array([[ids[d] for d in p[5]] for _, p in parts], pa.list_(pa.int64())),
                        pa.array([p[6] for _, p in parts], pa.list_(pa.int64())),
                    ],
                    ["shard", "block", "lengths", "anchors", "hot", "bytes", "content", "doc", "id", "start"],
                )

    # At most one row per bucket and block is gathered.
    lists = repeated.groupBy("block").agg(
        F.collect_list(F.struct("hashes", "hot")).alias("found")
    ).select("block", "found.hashes", "found.hot")
    return blocks.join(lists, "block").mapInArrow(sent, SEGMENTS)


def _text_number(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "big")


# ---- suffix arrays -------------------------------------------------------------------------


def suffix_array(text: bytes) -> np.ndarray:
    """Suffixes in order of at least their first ``WINDOW`` bytes (Larsson and Sadakane, 2007).

    The first sort is by eight bytes. Then each group of suffixes not told apart yet is sorted
    by the rank of what follows after as many bytes as are already sorted, which doubles that
    number; suffixes alone in their group are not touched again.
    """
    n = len(text)
    padded = text + bytes(8)
    key = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
    array = np.argsort(key, kind="stable")
    ranked = key[array]
    head = np.append(True, ranked[1:] != ranked[:-1])
    rank = np.zeros(n + 1, np.int64)  # of the empty suffix: 0; others from 1
    rank[array] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    depth = 8
    while depth < WINDOW:
        alone = head & np.append(head[1:], True)
        open_at = np.flatnonzero(~alone)
        if not len(open_at):
            break
        suffix = array[open_at]
        after = rank[np.minimum(suffix + depth, n)]
        # Ranks are group starts, so sorting by (rank, rank after) keeps groups in place.
        joint = rank[suffix] << 32 | after
        order = np.argsort(joint, kind="stable")
        array[open_at] = suffix[order]
        joint = joint[order]
        head[open_at] = np.append(True, joint[1:] != joint[:-1])
        rank[array] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
        depth *= 2
    return array


def common_prefixes(text: bytes, array: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix and the one before it in ``array``, up to an END byte.

    Kasai's rule in text order: the prefix at i is that at i - 1 less one, wherever the byte
    before i and the byte before its neighbour agree and the neighbour moves along. Only the
    other places are compared, eight bytes at a time.
    """
    n = len(text)
    codes = np.frombuffer(text, np.uint8)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (before[1:] == before[:-1] + 1) & (codes[:-1] != END)
    asked = np.flatnonzero(~follows & (before >= 0))
    words = np.ndarray((n,), "<u8", text + bytes([END] * 8), strides=(1,))
    length = np.zeros(n, np.int64)
    one, other = asked.copy(), before[asked]
    while len(asked):
        x, y = words[one].astype(np.uint64), words[other].astype(np.uint64)
        differ = x ^ y
        # The top bit of a byte of ``stop`` is set from the first byte that ends the match on.
        stop = differ.view(np.uint8).reshape(-1, 8) != 0
        stop |= x.view(np.uint8).reshape(-1, 8) == END
        more = ~stop.any(axis=1)
        length[asked] += np.where(more, 8, stop.argmax(axis=1))
        asked, one, other = asked[more], one[more] + 8, other[more] + 8
        inside = (one < n) & (other < n)
        asked, one, other = asked[inside], one[inside], other[inside]
    # Places that follow take their value from the last one compared.
    source = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    prefix = np.maximum(length[source] - (np.arange(n) - source), 0)
    prefix[before < 0] = 0
    return prefix[array]


def equal_windows(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(class, content, offset)`` of every window of the contents, in suffix order.

    Windows of one class are equal; no window crosses the end of its content.
    """
    text = bytes([END]).join([*contents, b""])
    lengths = np.array([len(c) for c in contents])
    begins = np.append(0, np.cumsum(lengths + 1)[:-1])
    array = suffix_array(text)
    prefix = common_prefixes(text, array)
    content = np.repeat(np.arange(len(contents)), lengths + 1)
    offset = np.arange(len(text)) - begins[content]
    whole = offset + WINDOW <= lengths[content]
    inside = whole[array]
    fresh = np.cumsum(prefix < WINDOW)
    windows = array[inside]
    return fresh[inside], content[windows], offset[windows]


# ---- shards --------------------------------------------------------------------------------

FOUND = (
    "kind string, block bigint, doc array<int>, lo array<bigint>, hi array<bigint>,"
    " windows binary, id array<bigint>, run bigint"
)


def _covered(rows: list[dict], shard: int) -> Iterator[pa.RecordBatch]:
    """Byte ranges to remove, per block; of hot anchors, also the windows that stay for now."""
    number: dict[bytes, int] = {}
    contents: list[bytes] = []
    anchors, hot = [], []
    parts = []
    for row in rows:
        at, mine = 0, []
        for length, anchor, heat in zip(row["lengths"], row["anchors"], row["hot"]):
            content = row["bytes"][at : at + length]
            at += length
            known = number.get(content)
            if known is None:
                known = number[content] = len(contents)
                contents.append(content)
                anchors.append(anchor)
                hot.append(heat)
            mine.append(known)
        n = len(row["content"])
        ids = [LAST_ID if i is None else i for i in row["id"]]
        parts.append((np.array(mine)[row["content"]], np.full(n, row["block"]), np.array(row["doc"]),
                      np.array(ids, np.int64), np.array(row["start"])))
    content, block, doc, doc_id, start = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((start, doc, block, doc_id, content))
    content, block, doc, doc_id, start = (x[order] for x in (content, block, doc, doc_id, start))
    first = np.append(True, content[1:] != content[:-1])
    at = np.flatnonzero(first)  # the first occurrence of each content, in order of contents
    sizes = np.array([len(c) for c in contents])
    copies = np.flatnonzero(~first)
    removed = [(block[copies], doc[copies], start[copies], start[copies] + sizes[content[copies]])]

    # Only contents that share an anchor can have windows in common.
    anchors, hot = np.array(anchors, np.int64), np.array(hot, bool)
    _, group, members = np.unique(anchors, return_inverse=True, return_counts=True)
    joint = np.flatnonzero((members[group] > 1) | hot)
    if len(joint):
        cls, which, offset = equal_windows([contents[i] for i in joint])
        place = at[joint[which]]
        begin = start[place] + offset
        order = np.lexsort((begin, doc[place], block[place], doc_id[place], cls))
        stays = np.append(True, np.diff(cls[order]) != 0)
        later = np.zeros(len(order), bool)
        later[order[~stays]] = True
        removed.append((block[place[later]], doc[place[later]], begin[later], begin[later] + WINDOW))
        left = np.flatnonzero(~later & hot[joint[which]])  # still in suffix order
        for i in range(0, len(left), 4096):
            some = left[i : i + 4096]
            for b in np.unique(block[place[some]]):
                of = some[block[place[some]] == b]
                windows = [contents[joint[which[j]]][offset[j] : offset[j] + WINDOW] for j in of]
                yield _found("window", b, doc[place[of]], begin[of], begin[of] + WINDOW,
                             b"".join(windows), doc_id[place[of]], shard)
    block, doc, lo, hi = (np.concatenate(x) for x in zip(*removed))
    order = np.lexsort((lo, doc, block))
    block, doc, lo, hi = block[order], doc[order], lo[order], hi[order]
    for part in np.split(np.arange(len(block)), np.flatnonzero(np.diff(block)) + 1):
        if len(part):
            d, a, b = merge_ranges(doc[part], lo[part], hi[part])
            yield _found("removed", block[part[0]], d, a, b, b"", [], shard)


def _found(kind: str, block: int, doc, lo, hi, windows: bytes, ids, run: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind]),
            pa.array([int(block)], pa.int64()),
            pa.array([np.asarray(doc, np.int32)], pa.list_(pa.int32())),
            pa.array([np.asarray(lo, np.int64)], pa.list_(pa.int64())),
            pa.array([np.asarray(hi, np.int64)], pa.list_(pa.int64())),
            pa.array([windows], pa.binary()),
            pa.array([np.asarray(ids, np.int64)], pa.list_(pa.int64())),
            pa.array([run], pa.int64()),
        ],
        ["kind", "block", "doc", "lo", "hi", "windows", "id", "run"],
    )


def merge_ranges(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of byte ranges sorted by ``(doc, lo)``; ranges that touch become one."""
    if not len(doc):
        return doc, lo, hi
    # The furthest end so far, within a document.
    shift = (doc - doc[0]).astype(np.int64) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + shift) - shift
    new = np.append(True, (doc[1:] != doc[:-1]) | (lo[1:] > reach[:-1]))
    begins = np.flatnonzero(new)
    return doc[begins], lo[begins], reach[np.append(begins[1:], len(doc)) - 1]


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gather the rows of a shard, which follow each other, and work on them together."""
    shard, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard and held:
                yield from _covered(held, shard)
                held = []
            shard = row["shard"]
            held.append(row)
    if held:
        yield from _covered(held, shard)


def merge_runs(runs: list[list[tuple]]) -> list[tuple]:
    """Merge sorted runs of ``(window, order...)``; returns the entries that are not the first.

    A run is looked up in the one it is merged into by binary search; of equal windows the
    smaller stays.
    """
    later = []
    while len(runs) > 1:
        runs.sort(key=len)
        small, large = runs[0], runs[1]
        keys = [entry[0] for entry in large]
        fresh = []
        for entry in small:
            i = bisect_left(keys, entry[0])
            if i < len(keys) and keys[i] == entry[0]:
                later.append(max(entry, large[i]))
                large[i] = min(entry, large[i])
            else:
                fresh.append((i, entry))
        merged, at = [], 0
        for i, entry in fresh:
            merged += large[at:i]
            merged.append(entry)
            at = i
        runs = [merged + large[at:], *runs[2:]]
    return later


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[int, list[tuple]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            runs.setdefault(r["run"], []).append((r["window"], r["id"], r["block"], r["doc"], r["lo"]))
    by_block: dict[int, list] = {}
    for _, _, block, doc, lo in merge_runs([sorted(run) for run in runs.values()]):
        by_block.setdefault(block, []).append((doc, lo, lo + WINDOW))
    for block, ranges in by_block.items():
        doc, lo, hi = (np.array(x) for x in zip(*sorted(ranges)))
        yield _found("removed", block, *merge_ranges(doc, lo, hi), b"", [], 0)


def _hot_windows(found: DataFrame, shards: int) -> DataFrame:
    """Ranges to remove among the windows of hot anchors, across shards."""
    listed = found.where("kind = 'window'").selectExpr(
        "run", "block", "windows", "posexplode(arrays_zip(doc, lo, id)) AS (i, at)"
    )
    single = listed.selectExpr(
        f"substring(windows, i * {WINDOW} + 1, {WINDOW}) AS window",
        "run", "block", "at.doc AS doc", "at.lo AS lo", "at.id AS id",
    )
    return single.repartitionByRange(shards, "window").mapInArrow(_merged, FOUND)


# ---- results -------------------------------------------------------------------------------

RESULT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string,"
    " spans array<struct<start:bigint,end:bigint>>"
)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for row in batch.to_pylist():
            buffer = _unpacked(row["sizes"], row["bytes"])
            sizes = np.array(row["sizes"], np.int64)
            begins = np.append(0, np.cumsum(sizes)[:-1])
            parts = [(np.array(f["doc"]), np.array(f["lo"]), np.array(f["hi"])) for f in row["found"] or []]
            ranges: dict[int, list] = {}
            if parts:
                doc, lo, hi = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((lo, doc))
                for d, a, b in zip(*(x.tolist() for x in merge_ranges(doc[order], lo[order], hi[order]))):
                    ranges.setdefault(d, []).append((a, b))
            removed, spans, shas = [], [], []
            for i, (begin, size) in enumerate(zip(begins.tolist(), sizes.tolist())):
                of = ranges.get(i, [])
                digest, at = hashlib.sha256(), 0
                for a, b in of:
                    digest.update(buffer[begin + at : begin + a])
                    at = b
                digest.update(buffer[begin + at : begin + size])
                removed.append(sum(b - a for a, b in of))
                spans.append([{"start": a, "end": b} for a, b in of])
                shas.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(sizes),
                    pa.array(removed, pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array(shas),
                    pa.array(spans, span),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` per row of ``docs``.

    ``spans`` are the maximal removed byte ranges. Earlier means a smaller ``doc_id``, and in
    one document a smaller start; rows without an id come last, and rows that share an id are
    documents of their own, in the order they are read. A null text is empty; texts are looked
    at whole, as UTF-8; only ``doc_id``, an integer, and ``text`` are read.
    """
    rows = bounded_batches(documents(docs)).select(F.col("doc_id").cast("bigint"), "text")
    blocks = write_table(rows.mapInArrow(_blocks, BLOCKS), "blocks")
    width = tasks(docs)
    repeated = write_table(_repeated(_anchors(blocks, width), width, hot), "repeated")
    n, n_hot = repeated.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_hot"), F.lit(0))).first()
    shards = max(width, n * (WINDOW + GRAM) // SHARD)
    sent = _segments(blocks, repeated, shards)
    sent = sent.repartition(shards, "shard").sortWithinPartitions("shard")
    found = write_table(sent.mapInArrow(_by_shard, FOUND), "covered")
    ranges = found.where("kind = 'removed'")
    if n_hot:
        ranges = ranges.union(_hot_windows(found, shards))
    # At most one row per shard and block is gathered.
    lists = ranges.groupBy("block").agg(F.collect_list(F.struct("doc", "lo", "hi")).alias("found"))
    joined = blocks.join(lists, "block", "left").select("ids", "sizes", "bytes", "found")
    return joined.mapInArrow(_results, RESULT)
