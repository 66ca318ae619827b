"""Packing against the library's ids and brute-force subset sums."""

import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crmweave.llm import packing

PACKED = public_tokenizers.path("word_bpe_49k.json")


def brute_fullest(lengths, room):
    sums = {sum(n * k for (n, _), k in zip(lengths, ks))
            for ks in product(*[range(c + 1) for _, c in lengths])}
    return max(s for s in sums if s <= room)


def test_fullest_combination():
    rng = random.Random(1)
    for _ in range(200):
        lengths = sorted(((n, rng.randint(1, 3)) for n in rng.sample(range(1, 30), rng.randint(0, 5))), reverse=True)
        room = rng.randint(1, 60)
        lengths = [(n, c) for n, c in lengths if n <= room]
        chosen = packing.fullest(lengths, room)
        assert sum(n * k for n, k in chosen.items()) == brute_fullest(lengths, room)
        assert all(k <= dict(lengths)[n] for n, k in chosen.items())


def test_plans_use_every_piece_once():
    rng = random.Random(2)
    for capacity in (1, 7, 64, 512):
        counts = Counter(rng.randint(1, capacity) for _ in range(2000)) + Counter({capacity: 5})
        used, next_bin = Counter(), 0
        for first, bins, inside in packing.plan_bins(counts, capacity):
            assert first == next_bin and sum(n * k for n, k in inside) <= capacity
            next_bin += bins
            used.update({n: k * bins for n, k in inside})
        assert used == counts
        least = -(-sum(n * c for n, c in counts.items()) // capacity)
        assert next_bin <= least * 1.34 + 1  # two thirds full at worst here, mostly full
    assert packing.plan_bins({}, 9) == []
    with pytest.raises(ValueError):
        packing.plan_bins({10: 1}, 9)


def test_ids_equal_the_library():
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x180)] + [
        "<|endoftext|>", "<|startoftext|>", "  ", "　", "\x85", "'s", "日本", "😀", "é", "Σ", "İ", "ß"]
    library = Tokenizer.from_file(PACKED)
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randrange(20)))
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.encode(text, PACKED), "<u4").tolist() == want, text


@pytest.mark.parametrize("capacity", [16, 4096])
def test_documents_are_packed_whole(docs_of, prose, capacity):
    rows = prose + [(3, prose[3][1]), (None, "x"), (90, " ".join(["word"] * 9000))]
    found = packing.pack_documents(docs_of(rows), PACKED, capacity).collect()
    library = Tokenizer.from_file(PACKED)
    want = Counter()
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    inside = {}
    for r in found:
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in inside.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in found)
    assert len(inside) <= -(-total // capacity) + 2


def test_packing_nothing(docs_of):
    packed = packing.pack_documents(docs_of([]), PACKED)
    assert packed.count() == 0 and packing.sequences(packed).count() == 0


def test_sequences(docs_of, prose):
    packed = packing.pack_documents(docs_of(prose), PACKED, 64)
    rows = packing.sequences(packed).collect()
    assert sum(r.pieces for r in rows) == packed.count()
    assert all(r.n_ids <= 64 and [c.offset for c in r.contents][0] == 0 for r in rows)
