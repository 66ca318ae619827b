"""Packing by minimum bin slack (Gupta and Ho, 1999).

A bin is filled around the longest length left: a subset-sum over the lengths still available,
kept as a bitset of reachable sums, finds the fullest combination, which is then removed. A
combination repeats until one of its lengths runs out, so as many bins as it still fits are
closed at once. The work on lengths depends on the capacity alone, not on the number of
documents: the driver sees one count per length, and returns one row per run of equal bins and
length. Spark numbers the pieces of each length and looks their places up in those rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crmweave.llm.common import bounded_batches, documents, with_slots
from crmweave.llm.token_count import byte_symbols
from crmweave.session import write_table

# A worker remembers the ids of so many short words.
REMEMBERED, SHORT = 1_000_000, 64
# Letters, then punctuation without ' (contractions) and < (special tokens).
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")


def fullest(lengths: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The combination of available ``(length, count)`` with the largest sum up to ``room``.

    Bit s of ``reached`` says that some combination has the sum s; the bitset before each
    step is kept, so that the combination can be read back. A length with several copies is
    added in powers of two. Long lengths come first, and stop as soon as ``room`` is reached.
    """
    mask = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length, count in lengths:
        count = min(count, room // length)
        take = 1
        while count > 0:
            take = min(take, count)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & mask
            count -= take
            take *= 2
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """``(first bin, bins, [(length, pieces in each bin)])`` per run of equal bins."""
    left = {n: c for n, c in counts.items() if c}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("a length is outside 1 to the capacity")
    runs, at = [], 0
    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        room = capacity - longest
        usable = sorted(((n, c) for n, c in rest.items() if c and n <= room), reverse=True)
        inside = fullest(usable, room) if room else {}
        inside[longest] = inside.get(longest, 0) + 1
        bins = min(left[n] // k for n, k in inside.items())
        runs.append((at, bins, sorted(inside.items(), reverse=True)))
        at += bins
        for n, k in inside.items():
            left[n] -= k * bins
            if not left[n]:
                del left[n]
    return runs


class _Words(dict):
    """Ids of a word as little-endian 32-bit numbers, from the library on first sight.

    Letters of Latin-1 and the punctuation behind them are separate pre-tokens, and lower case
    is all that normalising does to them, so such a word is put together from its two parts,
    and its letters go to the library's merge model directly.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.symbols = byte_symbols()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        simple = SIMPLE.fullmatch(text)
        if simple is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            packed = b"".join(i.to_bytes(4, "little") for i in ids)
        else:
            letters, rest = simple[1].lower(), simple[2]
            if rest or letters != text:
                packed = self[letters.encode()] + (self[rest.encode()] if rest else b"")
            else:
                mapped = "".join(map(self.symbols.__getitem__, word))
                tokens = self.tokenizer.model.tokenize(mapped)
                packed = b"".join(t.id.to_bytes(4, "little") for t in tokens)
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed


@lru_cache(maxsize=2)
def words(path: str) -> _Words:
    return _Words(path)


def encode(text: str, path: str) -> bytes:
    """Ids of a text. This vocabulary drops white space and no token, not even a special one,
    spans it, so words between ASCII white space are encoded one by one and remembered."""
    return b"".join(map(words(path).__getitem__, text.encode("utf-8", "replace").split()))


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each document's ids, cut at ``capacity``.

    Every row ends in ``end_id``, so an empty or null text is one piece of one id.
    """
    rows = bounded_batches(documents(docs))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(texts):
                packed = encode(text.as_py(), vocabulary) + end
                for number, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(row, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names,
            )

    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, order: list[str], capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is from 1 to ``capacity``.

    ``pieces`` is read three times, so it should be cheap or written.
    """
    spark = pieces.sparkSession
    # One row per length that occurs: at most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    used: dict[int, int] = {}
    places = []
    for first, bins, inside in plan_bins(counts, capacity):
        offset = 0
        for length, each in inside:
            begin = used.get(length, 0)
            used[length] = begin + bins * each
            places.append((length, begin, used[length], each, first, offset))
            offset += length * each
    schema = "at_length long, begin long, end long, each long, first long, first_offset long"
    runs = spark.createDataFrame(places, schema)
    ranked = with_slots(pieces, "length", order, "__rank")
    # The rows of ``runs`` are bounded by the capacity: each run uses up a length.
    joined = ranked.join(
        F.broadcast(runs),
        (F.col("length") == F.col("at_length"))
        & (F.col("__rank") >= F.col("begin"))
        & (F.col("__rank") < F.col("end")),
    )
    nth = F.col("__rank") - F.col("begin")
    return joined.select(
        *pieces.columns,
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (nth % F.col("each")) * F.col("length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece.

    Only a document with more than ``capacity`` ids is cut. A null text counts as empty,
    repeated rows are packed as often as they occur, null ids stay, an empty table gives no
    rows, and only ``doc_id`` and ``text`` are read.
    """
    pieces = write_table(token_pieces(docs, vocabulary, capacity, end_id), "pieces")
    return pack_pieces(pieces, ["doc_id", "piece", "ids_crc32"], capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: how many pieces and ids it has, and its pieces in order.

    A sequence holds at most as many pieces as its capacity has ids, so a group is bounded.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length")))
    return packed.groupBy("sequence_id").agg(
        F.count("*").alias("pieces"), F.sum("length").alias("n_ids"), inside.alias("contents")
    )
