"""Exact, SimHash and suffix-array dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from crmweave.llm import components, exact_dedup, simhash, suffix_dedup

SPACES = re.compile(r"[\x20\x09-\x0D]")


def brute_components(nodes, near):
    root = {i: i for i in nodes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in nodes:
        for j in nodes:
            if j < i and near(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in nodes}


# Exact dedup


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACES.sub("", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        named = [m for m in members if m[0] is not None]
        keep = min(named, key=lambda m: (-len(m[1]), m[0]))[0] if named else None
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, sha) for i, _ in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [None, lambda c: F.substring(F.md5(c), 1, 1)])
def test_exact_groups(docs_of, prose, digest):
    """Also with a digest of 16 values, where nearly all groups collide."""
    rows = prose + [(3, prose[3][1]), (None, "one"), (None, "lonely"), (None, "lonely")]
    found = exact_dedup.duplicate_groups(docs_of(rows), **({"digest": digest} if digest else {}))
    assert sorted(map(tuple, found.collect()), key=str) == brute_exact(rows)


def test_exact_keeps_one_row_of_each_group(docs_of, prose):
    rows = prose + [(3, prose[3][1])]
    df = docs_of(rows)
    kept = exact_dedup.keep_unique(df)
    assert kept.columns == df.columns
    got = sorted((r[1], r[2]) for r in kept.collect())
    keep = {k for _, k, *_ in brute_exact(rows)}
    assert [i for i, _ in got] == sorted(keep)


def test_dedup_of_nothing(docs_of):
    empty = docs_of([])
    assert exact_dedup.duplicate_groups(empty).count() == 0
    assert exact_dedup.keep_unique(empty).count() == 0
    assert simhash.near_groups(empty).count() == 0
    assert simhash.keep_one_of_each(empty).count() == 0
    assert suffix_dedup.repeated_spans(empty).count() == 0


# SimHash


def brute_fingerprint(text, k):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_sliced_comparison(radius):
    rng = np.random.default_rng(radius)
    for n in (1, 2, 33, 64, 65, 300):
        values = rng.integers(0, 1 << 63, 8, dtype=np.uint64)[rng.integers(0, 8, n)]
        for _ in range(5):
            flipped = rng.random(n) < 0.6
            values[flipped] ^= np.uint64(1) << rng.integers(0, 64, flipped.sum()).astype(np.uint64)

        def near(i, j):
            return int(values[i] ^ values[j]).bit_count() <= radius

        want = brute_components(range(n), near)
        assert simhash.group_large(values, radius).tolist() == [want[i] for i in range(n)]
        cell = np.sort(rng.integers(0, max(1, n // 6), n))
        a, b = simhash.near_pairs(values, cell, radius)
        pairs = {(j, i) for i in range(n) for j in range(i) if cell[i] == cell[j] and near(i, j)}
        assert set(zip(a.tolist(), b.tolist())) == pairs


def test_small_tiles_miss_nothing(spark, monkeypatch):
    """Cells cut into many tiles give the same groups."""
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 62, 40)[rng.integers(0, 40, 400)] ^ (1 << rng.integers(0, 62, 400))
    values = np.unique(values).tolist()
    want = brute_components(values, lambda i, j: (i ^ j).bit_count() <= 4)
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    for tile in (3, 2048):
        monkeypatch.setattr(simhash, "TILE", tile)
        got = dict(components.components(simhash.links(fps, 4)).collect())
        assert {v: got.get(v, v) for v in values} == want


def test_near_groups(docs_of, prose):
    prints = {i: brute_fingerprint(t, 4) for i, t in prose}
    want = brute_components(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    rows = prose + [(3, prose[3][1]), (None, "all alone here")]
    found = [tuple(r) for r in simhash.near_groups(docs_of(rows)).collect()]
    expected = [(i, f"{prints[i]:016x}", want[i]) for i in [*prints, 3]]
    expected.append((None, f"{brute_fingerprint('all alone here', 4):016x}", None))
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_long_texts_are_whole(monkeypatch):
    text = " ".join(f"w{i % 97}x{i % 89}" for i in range(5000))
    whole = simhash.fingerprint(text, 4)
    assert whole == brute_fingerprint(text, 4)
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint(text, 4) == whole


def test_one_of_each_group_stays(docs_of, prose):
    """Unlike texts of one id are judged apart, also under a null id; repeated rows leave one."""
    rows = prose + [(3, prose[3][1]), (1, "a short unlike text of its own"), (None, "all alone here")]
    rows += [(None, prose[2][1]), (None, "all alone here")]
    prints = [brute_fingerprint(t, 4) for _, t in rows]
    group = brute_components(range(len(rows)), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    groups = {}
    for k, label in (group.items() if isinstance(group, dict) else enumerate(group)):
        groups.setdefault(label, []).append(rows[k])
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()]
    df = docs_of(rows)
    kept = simhash.keep_one_of_each(df)
    assert kept.columns == df.columns
    got = [(r[1], r[2]) for r in kept.collect()]
    assert sorted((i for i, _ in got), key=str) == sorted(want, key=str)
    assert (1, "a short unlike text of its own") in got and (None, "all alone here") in got


def test_components_of_a_long_chain_and_a_star(spark):
    rng = random.Random(2)
    nodes = list(range(300))
    rng.shuffle(nodes)
    edges = list(zip(nodes[:150], nodes[1:150])) + [(nodes[200], n) for n in nodes[201:]]
    edges += [(7, 7), (None, 3), edges[0]]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(components.components(df).collect())
    want = {n: min(nodes[:150]) for n in nodes[:150]} | {n: min(nodes[200:]) for n in nodes[200:]}
    assert got == want
    assert components.components(df.limit(0)).count() == 0


# Suffix arrays


def brute_spans(rows):
    """Rows in the order that counts; bytes covered by a window seen before."""
    seen, out = set(), []
    for i, t in rows:
        data = (t or "").encode()
        covered = bytearray(len(data))
        for at in range(len(data) - 99):
            window = data[at : at + 100]
            if window in seen:
                covered[at : at + 100] = b"\1" * 100
            seen.add(window)
        spans = [m.span() for m in re.finditer(b"\1+", bytes(covered))]
        kept = bytes(b for b, c in zip(data, covered) if not c)
        out.append((i, len(data), sum(covered), len(spans), hashlib.sha256(kept).hexdigest(), spans))
    return out


def repeats():
    rng = random.Random(9)
    passage = "".join(rng.choice("abcd é") for _ in range(400))
    rows = []
    for i in range(40):
        own = "".join(rng.choice("abcd é") for _ in range(rng.randint(0, 300)))
        a, n = rng.randrange(300), rng.randint(80, 160)
        rows.append((i, own + passage[a : a + n] + own[:150]))
    rows += [(40, "ab" * 300), (41, None), (42, ""), (43, passage[:99]), (44, passage[:100]),
             (45, "x" * 1000), (46, rows[0][1])]
    return rows


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2, 0])
def test_spans_covered_before(docs_of, hot):
    """With ``hot`` small, frequent anchors are dealt over shards and merged across them."""
    rows = repeats()
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    found = suffix_dedup.repeated_spans(docs_of(shuffled), hot=hot).collect()
    got = sorted((*r[:5], [tuple(s) for s in r.spans]) for r in found)
    assert got == brute_spans(rows)


def test_spans_of_rows_without_an_id(docs_of):
    """They come last; two rows of one id are documents of their own, and one of them stays."""
    text = "".join(random.Random(3).choices("abcdef ", k=300))
    rows = [(5, text), (5, text), (None, text)]
    found = suffix_dedup.repeated_spans(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("5", 0), ("5", 300), ("None", 300)]


def test_texts_longer_than_a_block(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 512)
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    buffer = (text + text[1000:3000]).encode()
    first, last, anchors = suffix_dedup.segments(buffer, np.array([len(buffer)]))
    assert (last - first + 1).sum() == len(buffer) - 99
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 21)
    whole = suffix_dedup.segments(buffer, np.array([len(buffer)]))
    assert set(anchors.tolist()) == set(whole[2].tolist())


def test_suffix_arrays():
    rng = random.Random(8)
    for letters in (b"ab", b"abcdefgh"):
        base = bytes(rng.choice(letters) for _ in range(300))
        text = base + bytes([suffix_dedup.END]) + base[40:220] + bytes([suffix_dedup.END])
        array = suffix_dedup.suffix_array(text)
        key = [text[i : i + 100] for i in array.tolist()]
        assert key == sorted(key) and sorted(array.tolist()) == list(range(len(text)))
        prefix = suffix_dedup.common_prefixes(text, array)
        for k in range(1, len(text)):
            i, j, n = int(array[k - 1]), int(array[k]), 0
            while max(i, j) + n < len(text) and text[i + n] == text[j + n] != suffix_dedup.END:
                n += 1
            assert prefix[k] == n
