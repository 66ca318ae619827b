"""Token counts of a byte-level BPE vocabulary, without making tokens.

A piece of text starts as one symbol per byte. A heap holds the adjacent pairs that the
vocabulary merges; the pair of the lowest rank is popped and merged in a linked list, until no
pair is left. The count is the number of initial symbols less the merges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import bounded_batches, documents

# Fixed value: the pattern by which this kind of vocabulary cuts text before merging.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# No symbol has this number, so a pair with it has no rank.
DEAD = 0xFFFFFFFF
# A worker remembers the counts of so many short pieces; longer ones are counted each time.
REMEMBERED, SHORT = 1_000_000, 64


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others for characters from U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Counter:
    """Counts the tokens of texts with one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids: dict[str, int] = {}
        number = lambda symbol: ids.setdefault(symbol, len(ids))
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.bytes = [number(symbol) for _, symbol in sorted(byte_symbols().items())]
        # (left, right) in one integer -> rank, and what the two become
        self.rank: dict[int, int] = {}
        self.becomes: list[int] = []
        for left, right in merges:
            self.rank.setdefault(number(left) << 32 | number(right), len(self.becomes))
            self.becomes.append(number(left + right))
        specials = [t["content"] for t in spec["added_tokens"]]
        longest = sorted(specials, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest))) if specials else None
        self.known: dict[str, int] = {}

    def piece(self, text: str) -> int:
        """Tokens of one piece: symbols less merges."""
        symbols = [self.bytes[b] for b in text.encode("utf-8", "surrogatepass")]
        count = len(symbols)
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        rank, becomes = self.rank, self.becomes
        # A heap entry is rank and place in one integer, the leftmost first among equal ranks.
        heap = [
            r << 40 | i
            for i, pair in enumerate(zip(symbols, symbols[1:]))
            if (r := rank.get(pair[0] << 32 | pair[1])) is not None
        ]
        heapify(heap)
        end = count
        while heap:
            entry = heappop(heap)
            r, i = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[i]
            if j >= end or rank.get(symbols[i] << 32 | symbols[j]) != r:
                continue  # one of the two has been merged meanwhile
            merged = symbols[i] = becomes[r]
            symbols[j] = DEAD
            count -= 1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (s := rank.get(merged << 32 | symbols[k])) is not None:
                    heappush(heap, s << 40 | i)
            if (h := before[i]) >= 0 and (s := rank.get(symbols[h] << 32 | merged)) is not None:
                heappush(heap, s << 40 | h)
        return count

    def plain(self, text: str) -> int:
        known, total = self.known, 0
        for piece in PIECES.findall(text):
            n = known.get(piece)
            if n is None:
                n = self.piece(piece)
                if len(piece) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = n
            total += n
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; a special token's string counts as that one token."""
        if self.specials is None:
            return self.plain(text)
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row; nothing is shuffled.

    ``vocabulary`` is the path of the JSON file, the same on every machine. A null or empty
    text has no tokens; repeated rows and null ids stay; only ``doc_id`` and ``text`` are
    read. Texts are counted whole.
    """
    rows = bounded_batches(documents(docs))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(vocabulary).count
        for batch in batches:
            ids, texts = batch.columns
            n_tokens = pa.array([of(text.as_py()) for text in texts], pa.int64())
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, n_bytes, n_tokens], names)

    names = ["doc_id", "n_bytes", "n_tokens"]
    found = rows.mapInArrow(counted, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
