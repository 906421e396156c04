"""Conflict-constrained best-fit packing of documents into sequences.

A bin holds at most ``capacity`` words and never two documents of one source or of
one cluster of duplicates. Rows are dealt at random to groups of bounded size; each
group is packed on its own, largest first. Its open bins are ordered by what is left
in them and carry bitmaps of their sources and clusters; the search starts at the
tightest bin that is large enough and goes on to the next until one is compatible.

Documents longer than a bin fill whole bins with their first pieces; the rest, which
is shorter than a bin, is packed like any other document.

Edge cases: a null text or one without a word is in no bin (bin columns null). A
null source conflicts with nothing. Repeated rows are duplicates of each other, so no
bin holds two. Ids may be null or repeat. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mixing import size_of
from .store import keep

CAPACITY, GROUP_ROWS, CHUNK = 1024, 8192, 128


class Bins:
    """Open bins ordered by what is left in them."""

    def __init__(self, capacity: int, most: int, sources: int, clusters: int):
        self.capacity, self.n, self.made = capacity, 0, 0
        self.left, self.order = np.zeros(most + 1, np.int64), np.zeros(most + 1, np.int64)
        self.sources = np.zeros((most, (sources + 63) // 64 or 1), np.uint64)
        self.clusters = np.zeros((most, (clusters + 63) // 64 or 1), np.uint64)

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, words in it before) for a document; a negative source or cluster conflicts with none."""
        at = int(np.searchsorted(self.left[: self.n], size))
        while at < self.n:
            bins = self.order[at : min(at + CHUNK, self.n)]
            free = np.ones(len(bins), bool)
            if source >= 0:
                free &= (self.sources[bins, source >> 6] >> np.uint64(source & 63)) & np.uint64(1) == 0
            if cluster >= 0:
                free &= (self.clusters[bins, cluster >> 6] >> np.uint64(cluster & 63)) & np.uint64(1) == 0
            first = int(free.argmax())
            if free[first]:
                at += first
                break
            at += len(bins)
        if at < self.n:
            chosen, rest = int(self.order[at]), int(self.left[at])
            self.left[at : self.n - 1], self.order[at : self.n - 1] = self.left[at + 1 : self.n], self.order[at + 1 : self.n]
            self.n -= 1
        else:
            chosen, rest = self.made, self.capacity
            self.made += 1
        if source >= 0:
            self.sources[chosen, source >> 6] |= np.uint64(1 << (source & 63))
        if cluster >= 0:
            self.clusters[chosen, cluster >> 6] |= np.uint64(1 << (cluster & 63))
        if rest > size:
            # Among equal ones the older bin comes first.
            to = int(np.searchsorted(self.left[: self.n], rest - size, side="right"))
            self.left[to + 1 : self.n + 1], self.order[to + 1 : self.n + 1] = self.left[to : self.n], self.order[to : self.n]
            self.left[to], self.order[to] = rest - size, chosen
            self.n += 1
        return chosen, self.capacity - rest


def pack_group(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, words before) of each document, in the given order; a null source or cluster conflicts with none."""
    seen: dict = {}
    for c in clusters:
        seen[c] = seen.get(c, 0) + 1
    # Only clusters that the group has more than once need a bit.
    repeated = {c: i for i, c in enumerate(c for c, n in seen.items() if n > 1 and c is not None)}
    numbered = {s: i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    bins = Bins(capacity, len(sizes), len(numbered), len(repeated))
    return [bins.place(n, numbered.get(s, -1), repeated.get(c, -1)) for n, s, c in zip(sizes, sources, clusters, strict=True)]


PACKED = "row long, doc_id long, piece long, start long, words long, bin_group long, bin long, bin_offset long"


def _pack(capacity: int) -> callable:
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        got = pack_group(t["words"].to_pylist(), t["source"].to_pylist(), t["cluster"].to_pylist(), capacity)
        bins, offsets = zip(*got, strict=True)
        columns = [t[c].combine_chunks() for c in ("row", "doc_id", "piece", "start", "words", "bin_group")]
        names = [x.split()[0] for x in PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            groups = np.array(batch.column(batch.schema.get_field_index("bin_group")))
            cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                if held and b > a and held[-1]["bin_group"][0].as_py() != int(groups[a]):
                    yield flush(held)
                    held = []
                if b > a:
                    held.append(part)
        if held:
            yield flush(held)

    return run


def same_text(text: str) -> Column:
    """The cluster of exact copies up to white space."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(plain)


def pack(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, doc_id: str = "doc_id", text: str = "text", source: str = "source", cluster: str | Column | None = None) -> DataFrame:
    """Where each piece of each document goes: (row, doc_id, piece, start, words, bin_group, bin, bin_offset).

    ``start`` and ``words``: the piece's place in the document, in words; ``bin_group``
    and ``bin`` name the bin. ``cluster``: which documents count as duplicates of each
    other, equal texts up to white space by default.
    """
    copies = same_text(text) if cluster is None else F.col(cluster) if isinstance(cluster, str) else cluster
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), size_of(text).alias("size"), F.col(source).cast("string").alias("source"), copies.alias("cluster"))
    rows = keep(rows, "pack-rows")
    groups = max(1, -(-rows.count() // group_rows))
    whole = F.floor(F.col("size") / capacity)
    # Whole bins need no search; an empty document gets a piece without a bin.
    full = rows.filter(F.col("size") >= capacity).select("row", "doc_id", F.explode(F.sequence(F.lit(0), whole - 1)).alias("piece"))
    full = full.select("row", "doc_id", "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("long").alias("words"), (-1 - F.col("row")).alias("bin_group"), F.col("piece").alias("bin"), F.lit(0).cast("long").alias("bin_offset"))
    none = F.lit(None).cast("long")
    empty = rows.filter("size = 0").select("row", "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.col("size").alias("words"), none.alias("bin_group"), none.alias("bin"), none.alias("bin_offset"))
    rest = rows.filter(F.col("size") % capacity > 0).select("row", "doc_id", whole.alias("piece"), (whole * capacity).alias("start"), (F.col("size") % capacity).alias("words"), "source", "cluster", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("bin_group"))
    rest = rest.repartition("bin_group").sortWithinPartitions("bin_group", F.desc("words"), "row")
    packed = rest.mapInArrow(_pack(capacity), PACKED)
    return packed.unionByName(full).unionByName(empty)
