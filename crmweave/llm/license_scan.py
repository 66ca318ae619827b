"""License scans: Aho-Corasick over words, and a shunting-yard parser for tag expressions.

A text is turned into lower-case words joined by single spaces, so that a phrase is found
whatever stands between its words. One automaton finds all notice phrases, and the tag that
announces a license expression. Expressions are read from the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import bounded_batches, documents

# The phrases every scan looks for, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notices this scan adds.
MORE_PHRASES = {
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"spdx-license-identifier:([^\r\n]*)", re.IGNORECASE)
# Families of the identifiers in expressions, by how an identifier begins.
FAMILIES = (
    "mit", "apache", "lgpl", "agpl", "gpl", "bsd", "mpl", "epl", "isc", "bsl", "cc0",
    "cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by",
)
# How far a label from a tag, or from a phrase, is to be trusted.
TAG_WEIGHT, PHRASE_WEIGHT = 0.9, 0.6

# Every ASCII byte but letters and digits separates words; capitals are lowered.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Licence:
    """A leaf of an expression."""

    name: str


_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9.+:-]+)")
_BINDING = {"OR": 1, "AND": 2, "WITH": 3}


def to_postfix(expression: str) -> list[str | Licence] | None:
    """Shunting-yard: WITH binds before AND, AND before OR. None if it is not well formed.

    Text behind a complete expression, such as the end of a comment, is left alone.
    """
    out: list[str | Licence] = []
    waiting: list[str] = []
    at, operand_next = 0, True
    text = expression.rstrip()
    while at < len(text):
        found = _TOKEN.match(text, at)
        if found is None:
            break
        token, word = found[1], found[1].upper()
        if token == "(" and operand_next:
            waiting.append(token)
        elif token == ")" and not operand_next and "(" in waiting:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif word in _BINDING and not operand_next:
            while waiting and waiting[-1] != "(" and _BINDING[waiting[-1]] >= _BINDING[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        elif word not in _BINDING and token not in "()" and operand_next:
            out.append(Licence(token))
            operand_next = False
        else:
            break
        at = found.end()
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


@dataclass(frozen=True)
class Offers:
    """The ways to meet an expression: what all of them need, and what any of them names."""

    needed: frozenset[str]
    named: frozenset[str]

    @property
    def single(self) -> bool:
        return self.needed == self.named


def evaluate(postfix: list[str | Licence]) -> Offers:
    """What an expression needs and names, in one walk, however many ANDs and ORs it has.

    AND needs both sides. OR needs what both sides need; a side whose every way already
    contains the only way of the other offers nothing new and is left out. WITH ties its
    exception to the licences before it.
    """
    stack: list[Offers] = []
    for item in postfix:
        if isinstance(item, Licence):
            stack.append(Offers(*[frozenset({item.name.lower()})] * 2))
            continue
        right, left = stack.pop(), stack.pop()
        if item == "AND":
            stack.append(Offers(left.needed | right.needed, left.named | right.named))
        elif item == "OR":
            if left.single and left.needed <= right.needed:
                stack.append(left)
            elif right.single and right.needed <= left.needed:
                stack.append(right)
            else:
                stack.append(Offers(left.needed & right.needed, left.named | right.named))
        else:
            tail = " with " + " ".join(sorted(right.named))
            stack.append(Offers(*[frozenset(n + tail for n in s) for s in (left.needed, left.named)]))
    return stack[0]


def family(identifier: str) -> str:
    """The label of an identifier; an unknown one is its own label."""
    name = identifier.split(" with ")[0].rstrip("+")
    return next((f for f in FAMILIES if name == f or name.startswith(f + "-")), name)


def tag_labels(text: str) -> tuple[list[str], list[str]]:
    """Expressions behind the tags of a text, and the labels of the licences they name."""
    expressions, labels = [], set()
    for found in TAG_LINE.finditer(text):
        postfix = to_postfix(found[1])
        if postfix is None:
            continue
        expressions.append(found[1].strip())
        labels.update(map(family, evaluate(postfix).named))
    return expressions, sorted(labels)


@lru_cache(maxsize=4)
def automaton(phrases: tuple[tuple[str, str], ...]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for phrase, label in (*phrases, (TAG, "")):
        made.add_word(f" {phrase} ", (phrase, label))
    made.make_automaton()
    return made


def places(text: str, phrases: dict[str, str]) -> tuple[int, list[tuple[int, str, str]], bool]:
    """Number of words, ``(first word, phrase, label)`` per place in order, and if a tag occurs."""
    words = [w for w in words_of(text) if w]
    joined = b" ".join([b"", *words, b""]).decode("utf-8", "replace")
    hits = sorted(
        (end + 1 - len(phrase) - 2, phrase, label)
        for end, (phrase, label) in automaton(tuple(phrases.items())).iter(joined)
    )
    found, tagged, counted, word = [], False, 0, 0
    for start, phrase, label in hits:
        word += joined.count(" ", counted, start)
        counted = start
        tagged |= phrase == TAG
        if phrase != TAG:
            found.append((word, phrase, label))
    return len(words), found, tagged


PLACE = "array<struct<word:bigint,phrase:string,label:string>>"


def scan_licenses(
    docs: DataFrame, base: dict[str, str] | None = None, more: dict[str, str] | None = None
) -> DataFrame:
    """``(doc_id, n_words, places, expressions, tag_labels)`` for every row, without a shuffle.

    ``places`` lists every place of a phrase, in order; ``expressions`` the well-formed
    license expressions of the tags. A null text counts as empty and has empty lists; repeated
    rows and null ids stay; texts are read whole; only ``doc_id`` and ``text`` are read.
    """
    phrases = (BASE_PHRASES if base is None else base) | (MORE_PHRASES if more is None else more)
    rows = bounded_batches(documents(docs))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "places", "expressions", "tag_labels"]
    place = pa.list_(
        pa.struct([("word", pa.int64()), ("phrase", pa.string()), ("label", pa.string())])
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            n_words, found, expressions, labels = [], [], [], []
            for text in texts:
                text = text.as_py()
                n, hits, tagged = places(text, phrases)
                tags = tag_labels(text) if tagged else ([], [])
                n_words.append(n)
                found.append([dict(zip(("word", "phrase", "label"), h)) for h in hits])
                expressions.append(tags[0])
                labels.append(tags[1])
            listed = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_words, pa.int64()), pa.array(found, place),
                 pa.array(expressions, listed), pa.array(labels, listed)],
                names,
            )

    schema = (
        f"doc_id {id_type}, n_words bigint, places {PLACE},"
        " expressions array<string>, tag_labels array<string>"
    )
    return rows.mapInArrow(scanned, schema)


def license_digest(scanned: DataFrame, base: dict[str, str] | None = None) -> DataFrame:
    """Per document: words, places of base phrases, their labels, all labels, and a score.

    ``score`` is the chance that some label is right if each is right on its own with the
    weight of its evidence; 0 without labels. A label that another one narrows down
    (``apache`` beside ``apache-2.0``) is no evidence of its own.
    """
    phrases = F.array(*[F.lit(p) for p in (BASE_PHRASES if base is None else base)])
    at = F.filter("places", lambda p: F.array_contains(phrases, p["phrase"]))
    starts = F.transform(at, lambda p: p["word"])
    noticed = F.array_distinct(F.transform("places", lambda p: p["label"]))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    every = F.array_distinct(F.concat(noticed, "tag_labels"))
    narrowed = lambda x: F.exists(every, lambda y: y.startswith(F.concat(x, F.lit("-"))))
    own = F.filter(every, lambda x: ~narrowed(x))
    tagged, plain = F.size(F.array_intersect(own, "tag_labels")), F.size(F.array_except(own, "tag_labels"))
    doubt = F.pow(F.lit(1 - TAG_WEIGHT), tagged) * F.pow(F.lit(1 - PHRASE_WEIGHT), plain)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        text(F.transform(at, lambda p: p["label"])).alias("base_labels"),
        text(F.concat(noticed, "tag_labels")).alias("labels"),
        F.round(1 - doubt, 6).alias("score"),
    )
