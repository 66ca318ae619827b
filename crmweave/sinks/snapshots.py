"""Keyed state between runs: each run writes what it changes, and one file makes it count."""

from __future__ import annotations

import json
import uuid
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmweave.functions.text import id_as_text, named
from crmweave.jvm import (
    delete_path,
    estimated_bytes,
    glob_paths,
    is_file,
    publish_file,
    read_file,
    size_of,
)
from crmweave.operators.dedupe import carried_over
from crmweave.operators.mapping import EXTERNAL_ID

_COMMITS, _COMMIT, _TABLE, _PART = "_commits", "commit=", "table=", "__part"

# State is split by a hash of its key; a run rewrites the parts its keys fall into. Rows
# without a key lie in a part of their own, which is never carried over.
PARTS, KEYLESS = 64, -1

# Parts are split so that they hold so many bytes on average at most.
PART_BYTES = 1 << 30

# A part is written by one task for so many of its bytes, and by so many tasks at most.
WRITERS = 8
FILE_BYTES = PART_BYTES // WRITERS

# So many commits keep their tables; readers of an older one have to start again.
KEPT_COMMITS = 3

# Folders of a state by part, and under COUNT how many parts there are.
Parts = dict[str, str]
COUNT = "parts"


class CommitConflict(RuntimeError):
    """Another run has committed since this one began; nothing of this one counts."""


def part_of(key: Column, parts: int) -> Column:
    """The part of a key by linear hashing.

    With 2^n parts a key lies where its hash says modulo 2^n. Each further part takes its keys
    from one part only: part 2^n + i from part i, whose keys are told apart modulo 2^(n + 1).
    """
    low = 1 << (parts.bit_length() - 1)
    narrow, wide = (F.pmod(F.xxhash64(key), F.lit(n)) for n in (low, 2 * low))
    part = F.when(wide < parts, wide).otherwise(narrow)
    return F.when(key.isNull(), KEYLESS).otherwise(part).cast("int")


def source_of(part: int) -> int:
    """The part that gives this one its keys when it is added."""
    return part - (1 << (part.bit_length() - 1))


class SnapshotStore:
    """Parquet folders under one root on shared storage, and the commits that name them.

    A run writes folders under names of its own, never over what it reads, and then one
    commit, a file that says which folders are the state of which name. Without its commit a
    run has left no trace. Of runs that start from one commit one can commit; the others fail
    and take back what they wrote. The root's file system has to be able to give a finished
    file a name that may not be taken: HDFS and local or mounted disks can.
    """

    def __init__(self, spark: SparkSession, root: str, part_bytes: int = PART_BYTES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.part_bytes = part_bytes
        self.base = max(self._numbers(), default=0)
        self.states = self._read_commit(self.base)
        self._written: list[str] = []

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/{_COMMITS}/{_COMMIT}{number:08d}"

    def _numbers(self) -> list[int]:
        # Earlier versions wrote a folder for each commit, finished by a mark.
        marks = glob_paths(self.spark, f"{self.root}/{_COMMITS}/{_COMMIT}*/_SUCCESS")
        marks = {m.rsplit("/", 1)[0] for m in marks}
        paths = glob_paths(self.spark, f"{self.root}/{_COMMITS}/{_COMMIT}*")
        done = [p for p in paths if p in marks or is_file(self.spark, p)]
        return sorted(int(p.rsplit("/", 1)[1].removeprefix(_COMMIT)) for p in done)

    def _read_commit(self, number: int) -> dict[str, Parts]:
        if not number:
            return {}
        path = self._commit_path(number)
        if is_file(self.spark, path):
            return json.loads(read_file(self.spark, path))
        return json.loads(self.spark.read.text(path).first()[0])

    def _folders_of(self, name: str) -> Parts:
        return {k: v for k, v in self.states.get(name, {}).items() if k != COUNT}

    def _count(self, name: str) -> int:
        return int(self.states.get(name, {}).get(COUNT, PARTS))

    def _read_parts(self, name: str, folders: list[str]) -> DataFrame | None:
        paths = [f"{self.root}/{name}/{f}" for f in folders]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def _touched(self, keys: DataFrame, parts: int, pk: str) -> list[int]:
        """Parts that the rows fall into, at most ``parts`` + 1 numbers."""
        part = part_of(id_as_text(named(pk)), parts).alias(_PART)
        return sorted(r[0] for r in keys.select(part).distinct().collect())

    def read(self, name: str, batch: DataFrame | None = None, pk: str = EXTERNAL_ID) -> DataFrame | None:
        """The state that the commit at the run's start names, or None.

        With ``batch``, only the parts that its keys can lie in: enough for whatever compares
        the state with the batch by key, and little where the batch is small.
        """
        parts = self._folders_of(name)
        if batch is None or not parts:
            return self._read_parts(name, list(parts.values()))
        touched = self._touched(batch, self._count(name), pk)
        folders = [parts[str(k)] for k in touched if str(k) in parts]
        if folders:
            return self._read_parts(name, folders)
        return self._read_parts(name, list(parts.values())).where("false")

    def _next_count(self, name: str, parts: Parts, new: DataFrame) -> int:
        """How many parts the next state has; a state never has fewer than before.

        The size of a first state is an estimate, so it gets no more parts than the session's
        shuffle can write side by side.
        """
        count = self._count(name)
        if not parts:
            wide = int(self.spark.conf.get("spark.sql.shuffle.partitions")) // WRITERS
            return max(count, min(wide, ceil(estimated_bytes(new) / self.part_bytes)))
        return max(count, ceil(self._size(name, parts) / self.part_bytes))

    def _size(self, name: str, parts: Parts) -> int:
        return sum(size_of(self.spark, f"{self.root}/{name}/{f}") for f in parts.values())

    def _writers(self, name: str, parts: Parts, new: DataFrame, count: int) -> int:
        """Tasks that write a part: files take time each, so small parts get one."""
        size = max(self._size(name, parts), estimated_bytes(new))
        return max(1, min(WRITERS, ceil(size / count / FILE_BYTES)))

    def upsert(self, name: str, new: DataFrame, pk: str = EXTERNAL_ID) -> Parts:
        """Write the parts that rows of ``new`` (one per key) belong in, merged with theirs.

        Returns the folders of the next state, for ``commit``. Where the state has outgrown its
        parts, those that are next in line are split as well; all others stay as they are.
        """
        parts = {k: v for k, v in self._folders_of(name).items() if k != str(KEYLESS)}
        before, count = self._count(name), self._next_count(name, parts, new)
        added = range(before, count) if parts else []
        split = {*added, *(_old_part(k, before) for k in added)}
        touched = sorted(split | set(self._touched(new, count, pk)))
        held = {_old_part(k, before) for k in touched if k != KEYLESS}
        old = self._read_parts(name, [parts[str(k)] for k in sorted(held) if str(k) in parts])
        merged = new if old is None else carried_over(old, new, pk).unionByName(new, allowMissingColumns=True)
        table = f"{_TABLE}{self.base + 1:08d}-{uuid.uuid4().hex}"
        self._written.append(f"{self.root}/{name}/{table}")
        key = id_as_text(named(pk))
        writers = self._writers(name, parts, new, count)
        spread = F.pmod(F.xxhash64(F.lit(1), key), F.lit(writers))
        rows = merged.withColumn(_PART, part_of(key, count)).repartition(_PART, spread)
        rows.write.partitionBy(_PART).parquet(f"{self.root}/{name}/{table}")
        made = glob_paths(self.spark, f"{self.root}/{name}/{table}/{_PART}=*")
        made = {p.rsplit("=", 1)[1]: f"{table}/{p.rsplit('/', 1)[1]}" for p in made}
        gone = {str(k) for k in touched} - set(made)
        return {k: v for k, v in parts.items() if k not in gone} | made | {COUNT: str(count)}

    def commit(self, states: dict[str, Parts]) -> None:
        """Make the folders the state of their names, all at once; other names keep theirs."""
        number, states = self.base + 1, {**self.states, **states}
        path, draft = self._commit_path(number), f"{self.root}/{_COMMITS}/_draft-{uuid.uuid4().hex}"
        if number in self._numbers() or not publish_file(self.spark, path, draft, json.dumps(states)):
            for folder in self._written:
                delete_path(self.spark, folder)
            raise CommitConflict(f"another run has made commit {number} of {self.root}")
        self.base, self.states, self._written = number, states, []
        self._retire()

    def _folders(self, number: int) -> set[str]:
        states = self._read_commit(number).items()
        return {f"{n}/{f}" for n, parts in states for k, f in parts.items() if k != COUNT}

    def _retire(self) -> None:
        """Delete commits beyond ``KEPT_COMMITS``, and the folders that only they name."""
        numbers = self._numbers()
        old, kept = numbers[:-KEPT_COMMITS], numbers[-KEPT_COMMITS:]
        needed = set().union(*map(self._folders, kept)) if old else set()
        for number in old:
            for folder in self._folders(number) - needed:
                delete_path(self.spark, f"{self.root}/{folder}")
            delete_path(self.spark, self._commit_path(number))


def _old_part(part: int, before: int) -> int:
    """Where the keys of a part lay when there were ``before`` parts."""
    while part >= before:
        part = source_of(part)
    return part
