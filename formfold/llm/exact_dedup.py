"""Exact deduplication by Grace hashing.

Two rows are equal when their texts are identical after white space is deleted.
Each task of the first pass runs over its own split and keeps one row per content
(so a group of copies, however large, reaches the shuffle as one row per task at
most); the second pass does the same over rows dealt out by content hash. Inside a
task the contents stand in an open-addressing table that compares them completely.
When a table's contents exceed the memory limit, the table and all rows still to
come are divided among spill files by further hash bits, and each file is handled
the same way, recursively.

Edge cases: a null text counts as empty, and all empty texts are equal. A null id
ranks behind all others. Of rows that are equal in every respect exactly one is
kept. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import keep

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of distinct content that one task's table may hold before it spills.
MEMORY = 48 << 20
FAN_OUT = 16


def hash64(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "big", signed=False)


class Table:
    """Open addressing with linear probing; an entry is [hash, content, state]."""

    def __init__(self) -> None:
        self.slots, self.entries, self.size = [-1] * 1024, [], 0

    def find(self, h: int, content: bytes) -> tuple[list, bool]:
        """The entry with this content, and whether it is new."""
        mask, entries = len(self.slots) - 1, self.entries
        at = h & mask
        while (i := self.slots[at]) >= 0:
            if entries[i][0] == h and entries[i][1] == content:
                return entries[i], False
            at = (at + 1) & mask
        self.slots[at] = len(entries)
        entries.append([h, content, None])
        self.size += len(content) + 200
        if 2 * len(entries) > len(self.slots):
            self._grow()
        return entries[-1], True

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for i, e in enumerate(self.entries):
            at = e[0] & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def _records(file) -> Iterator[tuple]:
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def grace(records: Iterator[tuple], merge: Callable, memory: int = MEMORY, level: int = 0) -> Iterator:
    """Group (hash, content, state) records by content.

    ``merge(entry, state, new)`` folds a record's state into the entry and yields what
    is already certain; finished entries are yielded as they are, as lists. Beyond
    ``memory`` bytes of distinct contents, records are divided by four hash bits at
    each level; contents that agree in all 64 bits are no longer divided.
    """
    table = Table()
    for record in records:
        entry, new = table.find(record[0], record[1])
        yield from merge(entry, record[2], new)
        if table.size > memory and level < 16:
            files = [tempfile.TemporaryFile() for _ in range(FAN_OUT)]
            try:
                for h, content, state in table.entries:
                    pickle.dump((h, content, state), files[(h >> (60 - 4 * level)) & 15], 5)
                del table
                for r in records:
                    pickle.dump(r, files[(r[0] >> (60 - 4 * level)) & 15], 5)
                for file in files:
                    yield from grace(_records(file), merge, memory, level + 1)
                    file.close()
            finally:
                for file in files:
                    file.close()
            return
    yield from table.entries


def _order(state: tuple) -> tuple:
    """Longest first, then the smallest id; null ids last."""
    return (-state[0], state[1] is None, state[1] or 0)


LOCAL = "local long, doc_id long, first boolean, h long, content binary, points long, n long"


def _first_pass(memory: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 40

        def records() -> Iterator[tuple]:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1)
                for i in range(len(ids)):
                    text = texts[i].as_py() or ""
                    content = text.encode().translate(None, SPACE)
                    yield hash64(content), content, (len(text), ids[i], None, 1)

        def merge(entry: list, state: tuple, new: bool) -> Iterator[tuple]:
            """State: code points and id of the best row so far, number of the group, rows."""
            nonlocal serial
            old = entry[2]
            if new:
                if state[2] is None:
                    serial += 1
                    state = (*state[:2], serial, 1)
                entry[2] = state
                return
            best, other = (old, state) if _order(old) <= _order(state) else (state, old)
            # A group moved to a spill file comes before the rows that follow it.
            entry[2] = (*best[:2], old[2], old[3] + state[3])
            yield (old[2], other[1], False, None, None, None, None)

        def rows() -> Iterator[tuple]:
            for x in grace(records(), merge, memory):
                if isinstance(x, tuple):
                    yield x
                else:
                    h, content, (points, doc_id, number, n) = x
                    yield (number, doc_id, True, h - (1 << 63), content, points, n)

        yield from _batches(rows(), LOCAL)

    return run


FOUND = "local long, wins boolean, keep_id long, group_size long, text_sha256 string"


def _second_pass(memory: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.to_pylist():
                    yield r["h"] + (1 << 63), r["content"], (r["points"], r["doc_id"], r["local"], r["n"], ())

        def merge(entry: list, state: tuple, new: bool) -> Iterator[tuple]:
            """The state's last part lists the beaten groups: one per task of the first pass at most."""
            if new:
                entry[2] = state
            else:
                best, other = sorted((entry[2], state), key=lambda s: (*_order(s), s[2]))
                entry[2] = (*best[:3], best[3] + other[3], (*best[4], other[2], *other[4]))
            return iter(())

        def rows() -> Iterator[tuple]:
            for _, content, (_, doc_id, number, n, beaten) in grace(records(), merge, memory):
                digest = hashlib.sha256(content).hexdigest()
                yield (number, True, doc_id, n, digest)
                for x in beaten:
                    yield (x, False, doc_id, n, digest)

        yield from _batches(rows(), FOUND)

    return run


_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _batches(rows: Iterator[tuple], schema: str, count: int = 4096, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    fields = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in schema.split(", ")])
    held, filled = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), fields, strict=True)], schema=fields)

    for row in rows:
        held.append(row)
        filled += sum(len(x) for x in row if isinstance(x, bytes))
        if len(held) >= count or filled > size:
            yield made()
            held, filled = [], 0
    if held:
        yield made()


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", memory: int = MEMORY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    local = keep(rows.mapInArrow(_first_pass(memory), LOCAL), "exact", "zstd")
    groups = local.filter("content is not null").drop("first").repartition("h")
    found = groups.mapInArrow(_second_pass(memory), FOUND)
    joined = local.select("local", "doc_id", "first").join(found, "local")
    return joined.select("doc_id", "keep_id", "group_size", (F.col("first") & F.col("wins")).alias("kept"), "text_sha256")
