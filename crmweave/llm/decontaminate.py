"""Benchmark decontamination: documents that hold a benchmark item, found by SimHash windows.

A window of a document has as many words as an item. One that shares too few word shingles with
all items of its length to be similar is passed over, which sums over shingle hits tell; every
other gets a SimHash fingerprint over its shingles. Bits are cut into few wide blocks.
Fingerprints within the radius are, on some block, within that block's share of it, so an
equi-join of windows with the item's blocks and all values so near to them meets all pairs
within the radius. Those are verified by the exact similarity of shingle multisets. Only
DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crmweave.llm.common import documents, text_hash
from crmweave.session import write_table

BITS = 64
SHINGLE, SIMILARITY = 5, 0.8
# Two windows of similarity 0.8 differ in 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 18
# Blocks of the index. An item has a row for each value near its own on a block: five blocks of
# 13 bits and 3 different ones make 1,600 rows, and unlike fingerprints meet in one of five cases.
BLOCKS = 5
# Up to so many rows of 16 bytes, item shingles and keys of hit texts are broadcast.
BROADCAST_ROWS = 500_000


# The SQL of the pieces; ``words`` and ``hashes`` are names of array columns.
def words_sql(text: str) -> str:
    """Runs of letters and digits, in lower case."""
    return rf"array_remove(split(lower({text}), r'[^\p{{L}}\p{{N}}]+'), '')"


def shingles_sql(words: str, k: int, make: str) -> str:
    """``make`` of every k words ``s`` in a row; empty if there are fewer words."""
    every = f"transform(sequence(1, size({words}) - {k - 1}), i -> {make.format(s=f'slice({words}, i, {k})')})"
    return f"if(size({words}) >= {k}, {every}, array())"


def hashes_sql(words: str, k: int) -> str:
    return shingles_sql(words, k, "xxhash64({s})")


def simhash_sql(hashes: str) -> str:
    """Bit b of the fingerprint is set if it is set in over half of the hashes."""
    ones = f"size(filter({hashes}, h -> getbit(h, b) = 1))"
    bit = f"if(2 * {ones} > size({hashes}), shiftleft(1L, b), 0L)"
    return f"aggregate(sequence(0, {BITS - 1}), 0L, (acc, b) -> acc | {bit})"


def blocks(radius: int) -> list[tuple[int, int, int]]:
    """First bit, end, and differing bits allowed in each block.

    One more than the allowed bits, summed over the blocks, is one more than the radius: if all
    blocks differed in more, the fingerprints would differ in more than the radius. A block
    that allows -1 bits, where the radius is small, meets nothing.
    """
    cut = lambda total, i: total * i // BLOCKS
    return [
        (cut(BITS, i), cut(BITS, i + 1), cut(radius + 1, i + 1) - cut(radius + 1, i) - 1)
        for i in range(BLOCKS)
    ]


def _bits(fingerprint: str, first: int, end: int) -> str:
    return f"(shiftrightunsigned({fingerprint}, {first}) & {(1 << (end - first)) - 1}L)"


def blocks_sql(fingerprint: str, radius: int) -> str:
    """Array of ``(number, value)`` of the blocks of the bits."""
    parts = [
        f"struct({i} AS number, {_bits(fingerprint, a, b)} AS value)"
        for i, (a, b, allowed) in enumerate(blocks(radius))
        if allowed >= 0
    ]
    return f"array({', '.join(parts)})"


def probes_sql(fingerprint: str, radius: int) -> str:
    """Array of ``(number, value)`` of all values within a block's share of the radius."""
    parts = []
    for i, (a, b, allowed) in enumerate(blocks(radius)):
        flips = [
            sum(1 << bit for bit in chosen)
            for n in range(allowed + 1)
            for chosen in combinations(range(b - a), n)
        ]
        value = f"{_bits(fingerprint, a, b)} ^ m"
        listed = f"array({', '.join(f'{f}L' for f in flips)})"
        if flips:
            parts.append(f"transform({listed}, m -> struct({i} AS number, {value} AS value))")
    return f"concat({', '.join(parts)})"


def first_met_sql(difference: str, number: str, radius: int) -> str:
    """Whether the blocks before ``number`` all differ by more than their share.

    A pair meets on every block within its share, and is taken from the first one only.
    """
    apart = [f"bit_count({_bits(difference, a, b)}) > {allowed}" for a, b, allowed in blocks(radius)]
    return f"forall(slice(array({', '.join(apart)}), 1, {number}), apart -> apart)"


def repeated_sql(array: str) -> str:
    """The elements that an array holds more than once."""
    again = "array_distinct(filter(s, (x, i) -> i > 0 AND x = get(s, i - 1)))"
    return f"transform(array(array_sort({array})), s -> {again})[0]"


def shared_sql(one: str, other: str, repeated: str) -> str:
    """How many elements two arrays share, repeats counted as often as both have them.

    ``repeated`` is an array of those that both hold more than once; only they are counted.
    """
    least = f"least(size(filter({one}, y -> y = x)), size(filter({other}, y -> y = x)))"
    more = f"aggregate({repeated}, 0, (acc, x) -> acc + {least} - 1)"
    return f"size(array_intersect({one}, {other})) + {more}"


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` for broadcast if it is known to have few rows; otherwise the planner shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def _windows(hits: DataFrame, k: int, similarity: float) -> DataFrame:
    """``(key, n, start)`` of the windows with enough hits to be as similar as asked.

    ``hits`` has ``(key, size, n, pos)``: the shingle at ``pos`` of a text of ``size`` words is
    one of an item of n words. A window shares at most its hits with any item, so with h hits, w
    shingles of its own and i of the item the similarity is at most h / (w + i - h). A hit adds
    one to a run of starts; where runs begin and end is summed along the text, so a hit costs
    two rows whatever the length of the item.
    """
    first, last = f"greatest(pos - n + {k}, 0)", "greatest(least(pos, size - n), 0)"
    turns = f"inline(array(struct({first} AS at, 1L AS turn), struct({last} + 1 AS at, -1L AS turn)))"
    turns = hits.selectExpr("key", "size", "n", turns)
    turns = turns.groupBy("key", "size", "n", "at").agg(F.sum("turn").alias("turn"))
    # One text and one length of items: no more rows than the text has words.
    along = Window.partitionBy("key", "size", "n").orderBy("at")
    runs = turns.select(
        "key", "size", "n", "at", F.sum("turn").over(along).alias("hits"),
        F.lead("at").over(along).alias("until"),
    )
    shingles = f"least(size, n) + n - {2 * (k - 1)}"
    # Rounding must not lose a window that is just as similar as asked.
    enough = f"hits * {1 + similarity} >= {similarity} * ({shingles}) - 1e-6"
    return runs.where(f"hits > 0 AND {enough}").selectExpr(
        "key", "n", "explode(sequence(at, until - 1)) AS start"
    )


def _leaks(texts: DataFrame, items: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    """``(key, item_id, similarity, first_word, n_words)`` per window that is like an item.

    ``texts`` has ``(key, text)``: copies share a key. All items have shingles of k words.
    """
    listed = items.withColumn("hashes", F.expr(hashes_sql("words", k))).selectExpr(
        "item_id",
        "md5(array_join(words, ' ')) AS item",
        "size(words) AS n",
        "hashes",
        f"{shingles_sql('words', k, 'array_join({s}, \' \')')} AS shingles",
        f"{repeated_sql('hashes')} AS item_again",
        f"{simhash_sql('hashes')} AS item_fp",
    )
    listed = write_table(listed, "items")
    known = write_table(listed.selectExpr("n", "explode(hashes) AS hash").distinct(), "item-shingles")
    hits = texts.selectExpr("key", f"{words_sql('text')} AS words").selectExpr(
        "key", "size(words) AS size", f"posexplode({hashes_sql('words', k)}) AS (pos, hash)"
    )
    hits = hits.join(_small(known), "hash").select("key", "size", "n", "pos").distinct()
    # A text has no more windows than words times lengths of items.
    windows = _windows(hits, k, similarity).groupBy("key").agg(
        F.expr("collect_list(struct(n, start)) AS windows")
    )
    windows = write_table(windows, "windows")
    # The text again, one of all its copies. Only the keys, of 16 bytes each, may be broadcast.
    hit = texts.join(_small(windows.select("key")), "key", "left_semi").dropDuplicates(["key"])
    inside = hit.join(windows, "key")
    marked = (
        inside.selectExpr("key", f"{words_sql('text')} AS words", "windows")
        .selectExpr("key", "words", "inline(windows)")
        .selectExpr("key", "n", "start", "slice(words, start + 1, n) AS words")
        .withColumn("hashes", F.expr(hashes_sql("words", k)))
    )
    # Written at each step: what a step makes is used many times by the next one.
    marked = write_table(marked, "window-hashes")
    marked = write_table(marked.withColumn("fp", F.expr(simhash_sql("hashes"))), "window-prints")
    # Windows and items meet by fingerprint alone; words and shingles come to those that are near.
    prints = marked.selectExpr("key", "n", "start", "fp", f"explode({blocks_sql('fp', radius)}) AS block")
    index = listed.selectExpr("item", "n AS item_n", "item_fp").distinct()
    index = index.withColumn("item_block", F.expr(f"explode({probes_sql('item_fp', radius)})"))
    met = prints.join(index, F.expr("n = item_n AND block = item_block"))
    near = met.where(f"bit_count(fp ^ item_fp) <= {radius}")
    near = near.where(first_met_sql("fp ^ item_fp", "block.number", radius))
    near = write_table(near.select("key", "n", "start", "item"), "near-prints")
    wanted = listed.select("item", "item_id", "shingles", F.col("hashes").alias("item_hashes"), "item_again")
    near = near.join(marked.drop("fp"), ["key", "n", "start"]).join(wanted, "item")
    # Shingles that the item does not have bound the similarity from above.
    missing = "size(array_except(hashes, item_hashes))"
    bound = f"(size(hashes) - {missing}) / (size(item_hashes) + {missing}) >= {similarity}"
    found = near.where(bound).select(
        "key", "item_id", "start", "words", "shingles",
        F.expr(shingles_sql("words", k, "array_join({s}, ' ')")).alias("found"),
        # Shingles repeated on both sides; without any, which is the rule, nothing is compared.
        F.expr(f"size(array_intersect({repeated_sql('hashes')}, item_again)) > 0").alias("twice"),
    )
    shared = write_table(found, "near")
    both = f"array_intersect({repeated_sql('found')}, {repeated_sql('shingles')})"
    shared = shared.withColumn("again", F.expr(f"if(twice, {both}, array())"))
    shared = shared.withColumn("shared", F.expr(shared_sql("found", "shingles", "again")))
    return shared.selectExpr(
        "key", "item_id", "shared / (size(found) + size(shingles) - shared) AS similarity",
        "start AS first_word", "size(words) AS n_words",
    ).where(F.col("similarity") >= similarity)


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).withColumn("key", text_hash("text"))


def _best_windows(
    texts: DataFrame, items: DataFrame, shingle: int, similarity: float, radius: int
) -> DataFrame:
    """``(key, item_id, best)`` for every text and item of which it has a window like it."""
    wanted = documents(items, "item_id").selectExpr("doc_id AS item_id", f"{words_sql('text')} AS words")
    wanted = wanted.where("size(words) > 0").withColumn("k", F.least(F.lit(shingle), F.size("words")))
    # At most ``shingle`` different sizes of shingles.
    sizes = [r["k"] for r in wanted.select("k").distinct().collect()]
    parts = [
        _leaks(texts.select("key", "text"), wanted.where(F.col("k") == k), k, similarity, radius)
        for k in sorted(sizes)
    ]
    if not parts:
        item = wanted.schema["item_id"].dataType.simpleString()
        best = "CAST(NULL AS struct<similarity:double,first:int,n_words:int>) AS best"
        return texts.where("false").selectExpr("key", f"CAST(NULL AS {item}) AS item_id", best)
    leaks = reduce(DataFrame.unionByName, parts)
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("first"), "n_words"))
    return write_table(leaks.groupBy("key", "item_id").agg(best.alias("best")), "leaks")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """``(doc_id, item_id, similarity, first_word, n_words)``: the best window per pair.

    A window has as many words as the item, or is the whole document where that is shorter;
    similarity is the multiset Jaccard of shingles; of equally good windows the first counts.
    An item of fewer words than ``shingle`` is one shingle; one without words, or null, is in
    no document. A null text counts as empty; repeated rows are reported as often as they
    occur; rows with a null id are reported with it. Of ``docs`` only ``doc_id`` and ``text``
    are read, of ``items`` only ``item_id`` and ``text``. Without hits there are no rows.
    """
    texts = _keyed(docs)
    best = _best_windows(texts, items, shingle, similarity, radius)
    found = texts.select("doc_id", "key").join(best, "key")
    return found.selectExpr(
        "doc_id", "item_id", "best.similarity", "-best.first AS first_word", "best.n_words"
    )


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``docs`` without any leak, with all their columns.

    The text of a row decides, not its id: clean rows stay whatever rows share their id.
    """
    texts = _keyed(docs)
    leaks = _best_windows(texts, items, shingle, similarity, radius).select("key").distinct()
    inner = [f"c{i}" for i in range(len(docs.columns))]
    text = F.col(inner[docs.columns.index("text")]).cast("string")
    key = text_hash(F.coalesce(text, F.lit("")))
    return docs.toDF(*inner).join(leaks, key == F.col("key"), "left_anti").toDF(*docs.columns)
