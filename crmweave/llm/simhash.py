"""SimHash near-dedup: fingerprints of word shingles, compared in bit slices.

Fingerprints that differ in at most r of 64 bits agree on at least two of r + 2 blocks, so they
meet in a cell of one pair of blocks. Within a cell the 64 bits lie as planes, one bit of 64
fingerprints per machine word; distances of 64 pairs are counted at once by carry-save counters,
and a word is abandoned once all its pairs exceed the radius. A cell yields no more links than
it has fingerprints: each is tied to one of its group. Components of the links are the groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import bounded_batches, documents, tasks, text_hash
from crmweave.llm.components import components
from crmweave.session import write_table

BITS, SEED = 64, 42
# Cells of more fingerprints are dealt over tiles, and pairs of tiles compared.
TILE = 2048
# Cells up to this size are compared shifted against themselves, many at once.
SMALL = 32
# So many fingerprints are compared with a large cell at once.
QUERIES = 256
# Chunk of shingles whose hashes are held at once, whatever the length of a text.
CHUNK = 1 << 15
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
# Planes in an order that takes distant bits first, so that unlike pairs are given up soon.
ORDER = np.arange(BITS).reshape(8, 8).T.ravel()


def fingerprint(text: str, shingle: int) -> int:
    """Unsigned 64-bit SimHash over all word shingles, repeats included.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A text with fewer words is one
    shingle; one without words has the fingerprint zero.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(ends), CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK])
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, fp)`` per row of ``docs``; ``fp`` is the fingerprint as a signed long."""
    return _fingerprinted(documents(docs), shingle)


def _fingerprinted(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` with ``fp`` in place of their last column, the text."""
    rows = bounded_batches(rows)
    kept = [f"{c.name} {c.dataType.simpleString()}" for c in rows.schema[:-1]]
    names = [*rows.columns[:-1], "fp"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, texts = batch.columns
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*others, pa.array(fps.view(np.int64))], names)

    return rows.mapInArrow(made, ", ".join([*kept, "fp bigint"]))


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: word w of plane b holds bit b of the values 64 w to 64 w + 63."""
    padded = np.zeros(-(-len(values) // BITS) * BITS, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def within(differences: Callable[[int, np.ndarray | None], np.ndarray], words: int, radius: int) -> np.ndarray:
    """Which of 64 pairs per word differ in at most ``radius`` bits, as bits of the words.

    ``differences(b, alive)`` gives plane b of the differing bits for the words ``alive`` (None:
    all). Counters start so high that they overflow when a pair exceeds the radius.
    """
    width = (radius + 1).bit_length()
    start = (1 << width) - 1 - radius
    counter = [np.full(words, ALL if start >> i & 1 else 0, np.uint64) for i in range(width)]
    over = np.zeros(words, np.uint64)
    alive: np.ndarray | None = None
    for step, b in enumerate(ORDER, 1):
        carry = differences(b, alive)
        for digit in counter:
            both = digit & carry
            digit ^= carry
            carry = both
        over |= carry
        if step % 4 == 0 and step > radius:
            near = over != ALL
            if not near.all():
                alive = np.flatnonzero(near) if alive is None else alive[near]
                counter, over = [digit[near] for digit in counter], over[near]
                if not len(alive):
                    break
    result = np.zeros(words, np.uint64)
    if alive is None:
        return ~over
    result[alive] = ~over
    return result


def bits_at(mask: np.ndarray) -> np.ndarray:
    """Places of the set bits of a row of words."""
    return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))


def near_rows(values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(i, places)`` for each value i that others from its word on are near to; earlier ones
    have found i already."""
    planes = planes_of(values)
    n, words = len(values), planes.shape[1]
    for at in range(0, n, QUERIES):
        first = at // BITS
        bits = values[at : at + QUERIES] >> np.arange(BITS, dtype=np.uint64)[:, None] & np.uint64(1)
        masks = np.where(bits == 1, ALL, np.uint64(0))
        rest = planes[:, first:]
        across = words - first

        def differ(b: int, alive: np.ndarray | None) -> np.ndarray:
            if alive is None:
                return (rest[b][None, :] ^ masks[b][:, None]).ravel()
            return rest[b][alive % across] ^ masks[b][alive // across]

        near = within(differ, masks.shape[1] * across, radius).reshape(-1, across)
        for i in np.flatnonzero(np.bitwise_count(near).sum(axis=1) > 1):
            places = bits_at(near[i]) + first * BITS
            places = places[(places < n) & (places != at + i)]
            if len(places):
                yield at + int(i), places


def near_pairs(values: np.ndarray, cell: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All near pairs within many small cells at once; ``cell`` is sorted.

    The planes are compared with themselves shifted by 1, 2, ... places.
    """
    planes = planes_of(values)
    size = int(np.diff(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])).max(initial=1))
    ones, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lag in range(1, size):
        same = np.flatnonzero(cell[lag:] == cell[:-lag])
        if not len(same):
            break
        mask = np.zeros(planes.shape[1] * BITS, np.uint8)
        mask[same] = 1
        wanted = np.packbits(mask, bitorder="little").view(np.uint64)
        words = np.flatnonzero(wanted)
        here = planes[:, words]
        after = np.where(words + 1 < planes.shape[1], words + 1, words)
        shifted = here >> np.uint64(lag) | planes[:, after] << np.uint64(BITS - lag)
        diff = here ^ shifted
        near = within(lambda b, alive: diff[b] if alive is None else diff[b][alive], len(words), radius)
        full = np.zeros(planes.shape[1], np.uint64)
        full[words] = near & wanted[words]
        hit = bits_at(full)
        ones.append(hit)
        others.append(hit + lag)
    return np.concatenate(ones), np.concatenate(others)


def join_groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per place the smallest place that the links ``(a, b)`` reach."""
    tie = np.arange(n)
    while True:
        least = np.minimum(tie[a], tie[b])
        if (tie[a] == least).all() and (tie[b] == least).all():
            return tie
        np.minimum.at(tie, a, least)
        np.minimum.at(tie, b, least)
        tie = tie[tie]


def group_large(values: np.ndarray, radius: int) -> np.ndarray:
    """Per value the first of its group in one large cell."""
    tie = np.arange(len(values))
    for i, places in near_rows(values, radius):
        met = np.unique(tie[np.append(places, i)])
        if len(met) > 1:
            tie[np.isin(tie, met)] = met[0]
    return tie


def link_cells(cell: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(value, other value)`` of whole cells; ``cell`` is sorted.

    Each value is tied to the first of its group, so that links are as few as values.
    """
    edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
    sizes = np.repeat(np.diff(edges), np.diff(edges))
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    a, b = near_pairs(values[small], cell[small], radius)
    tie = join_groups(len(small), a, b)
    a = np.flatnonzero(tie != np.arange(len(small)))
    b = tie[a]
    ones, others = [small[a]], [small[b]]
    for at, end in zip(edges[:-1], edges[1:]):
        if end - at > SMALL:
            tie = group_large(values[at:end], radius)
            a = np.flatnonzero(tie != np.arange(end - at))
            b = tie[a]
            ones.append(at + a)
            others.append(at + b)
    return values[np.concatenate(ones)], values[np.concatenate(others)]


def _cells(fps: DataFrame, blocks: int, agree: int) -> DataFrame:
    """``(cell, fp)``: every fingerprint under each choice of ``agree`` of its blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    part = [
        F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        for a, b in zip(edges, edges[1:])
    ]
    chosen = combinations(range(blocks), agree)
    keys = [F.xxhash64(F.lit(i), *[part[j] for j in js]) for i, js in enumerate(chosen)]
    return fps.select(F.explode(F.array(*keys)).alias("cell"), "fp")


def _tiled(cells: DataFrame) -> DataFrame:
    """Cells with two fingerprints at least; a large one as pairs of tiles.

    A cell of n fingerprints has t = n / TILE tiles, and a fingerprint goes to the t pairs its
    tile is part of, so each comparison is a bounded group and none is left out.
    """
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    sized = cells.join(sizes, "cell")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    other = F.explode(F.sequence(F.lit(0), tiles - 1))
    dealt = sized.select("cell", "fp", own.alias("own"), other.alias("other"))
    pair = F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select(pair.alias("cell"), "fp")


def links(fps: DataFrame, radius: int, agree: int = 2) -> DataFrame:
    """``(a, b)``: links that join all of the distinct ``fp`` within the radius of each other.

    ``agree`` blocks of ``radius + agree`` make a cell: more of them make smaller cells, and
    more cells, without changing the groups that the links form. Two suit up to some 10^8
    fingerprints, three 10^11.
    """
    # The choices of blocks multiply the rows, so they are dealt out before.
    cells = _tiled(_cells(fps.repartition(tasks(fps), "fp"), radius + agree, agree))
    # A cell's key is a hash; two cells that share it are compared as one, which adds no links.
    # In order within a cell too, so that its first fingerprint is the same in every run.
    sorted_cells = cells.repartition(tasks(fps), "cell").sortWithinPartitions("cell", "fp")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_cell, held = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(cell: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            a, b = link_cells(cell, values, radius)
            columns = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in batches:
            cell = np.r_[held_cell, batch.column(0).to_numpy()]
            values = np.r_[held, batch.column(1).to_numpy().view(np.uint64)]
            # The last cell may go on in the next batch.
            last = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            if last >= HELD or (last and len(cell) - last > HELD):
                yield out(cell[:last], values[:last])
                cell, values = cell[last:], values[last:]
            held_cell, held = cell, values
        if len(held):
            yield out(held_cell, held)

    return sorted_cells.mapInArrow(linked, "a bigint, b bigint").distinct()


# So many fingerprints are gathered before cells are compared.
HELD = 1 << 16


def _labels(rows: DataFrame, radius: int, agree: int) -> DataFrame:
    """``(fp, label)`` for every fingerprint of ``rows``; groups of near ones share a label."""
    nodes = rows.select("fp").distinct()
    found = components(links(nodes, radius, agree))
    return nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", F.coalesce("label", "fp").alias("label")
    )


def near_groups(docs: DataFrame, shingle: int = 4, radius: int = 4, agree: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` has 16 lower-case hex digits; ``component_id`` is the smallest id that
    links of at most ``radius`` differing bits reach. Null and empty texts have the
    fingerprint zero and are linked like any other; repeated rows stay; a group without any
    id has a null component. Only ``doc_id`` and ``text`` are read, whole.
    """
    rows = write_table(fingerprints(docs, shingle), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labelled = write_table(_labels(rows, radius, agree).join(least, "fp"), "labels")
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    found = labelled.join(least, "label").select(F.col("fp").alias("__fp"), "component_id")
    joined = rows.join(found, F.col("fp") == F.col("__fp"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4, agree: int = 2) -> DataFrame:
    """One row of each group of ``near_groups``, with all columns of ``docs``.

    The smallest id of a group stays; where texts of one group share it, the one of the
    smallest content hash. A row is judged by its id and text, so unlike texts under one id are
    judged apart, also where the id is null, which comes after every id. Of repeated rows
    one stays. Without rows there are none.
    """
    keyed = documents(docs).select("doc_id", text_hash("text").alias("key"), "text")
    rows = write_table(_fingerprinted(keyed, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    labelled = _labels(rows, radius, agree).join(rows.groupBy("fp").agg(first), "fp")
    labelled = write_table(labelled, "labels")
    stays = labelled.groupBy("label").agg(F.min("first").alias("stays"))
    found = labelled.join(stays, "label").select(F.col("fp").alias("__fp"), "stays")
    judged = rows.join(found, F.col("fp") == F.col("__fp"))
    kept = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("key") == F.col("stays.key"))
    judged = judged.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), kept.alias("kept"))
    judged = write_table(judged, "judged")

    names = [f"c{i}" for i in range(len(docs.columns))]
    own, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    inner = docs.toDF(*names).withColumns(
        {"own_id": own, "own_key": text_hash(F.coalesce(text.cast("string"), F.lit("")))}
    )
    same = F.col("own_id").eqNullSafe(F.col("__id")) & (F.col("own_key") == F.col("__key"))
    stay = inner.join(judged.where("NOT kept"), same, "left_anti")
    if not judged.where("kept").groupBy("__id", "__key").count().where("count > 1").isEmpty():
        stay = stay.dropDuplicates(["own_id", "own_key"])
    return stay.select(*names).toDF(*docs.columns)
