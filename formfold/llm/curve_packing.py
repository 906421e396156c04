"""Packing of token ids into sequences along a space-filling curve.

Tasks turn texts into token ids and, from these, into a vector: counts of hashed ids, damped
and scaled to length one, projected to ``DIMS`` dimensions by a seeded random matrix. A
document's key is the place of that point along a Hilbert curve, so documents of like words lie near
each other. Spark sorts ids of rows by ranges of keys; the running number of tokens in a range and
the totals of the ranges before give every document its place in one long stream, which is
cut into sequences of ``capacity`` tokens. What is left at the end of the stream is cut into powers of
two, which need no padding. Ids do not move: they are written once, numbered by the task
that wrote them, and places are joined back by that number.

Copies have equal keys and are ordered by row, so ranges split them wherever they must.

Token ids are those of the tokenizer file, computed from the same vocabulary as ranks, which
is some four times faster (tests compare the two over all kinds of characters). Strings of special tokens in a text
become these tokens. Very long texts are encoded part by part, cut where a single space
stands between two other characters, which the vocabulary's pattern never reads across.

Edge cases: a null or empty text is the end id alone. Ids of documents may be null or repeat, every row
is a document of its own. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .store import keep, keep_numbered

CAPACITY, END_ID = 2048, 1
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
BUCKETS, DIMS, BITS, SEED = 4096, 4, 12, 20
#: Characters encoded at a time, and bytes of ids in a batch that a task returns.
PART_CHARS, BATCH_BYTES = 1 << 20, 8 << 20


@lru_cache(maxsize=4)
def encoding(ranks: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as f:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens=SPECIAL)


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of ``size`` characters or a little more, cut before single spaces."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while 0 <= cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut == len(text) - 1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def token_ids(text: str | None, ranks: str) -> np.ndarray:
    """The ids of a text and the end id, as little-endian 32-bit numbers."""
    tokens = encoding(ranks)
    found = [np.array(tokens.encode(p, allowed_special="all"), "<u4") for p in parts(text or "")]
    return np.concatenate([*found, np.array([END_ID], "<u4")])


@lru_cache(maxsize=1)
def _projection() -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each id by multiplicative hashing, and the matrix."""
    ids = np.arange(1 << 17, dtype=np.uint64)
    buckets = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return buckets.astype(np.int64), np.random.default_rng(SEED).standard_normal((BUCKETS, DIMS))


def point(ids: np.ndarray) -> np.ndarray:
    """The document's point in the cube of ``DIMS`` dimensions, as whole numbers of ``BITS`` bits."""
    buckets, matrix = _projection()
    weights = np.log1p(np.bincount(buckets[ids], minlength=BUCKETS))
    at = weights @ matrix / max(np.sqrt(weights @ weights), 1e-12)
    return np.clip((at + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of points (n, dims): neighbours on it differ by one in one dimension.

    From the highest bit down, a dimension whose bit is set inverts the lower bits of the first dimension, one
    whose bit is not set exchanges them with it; the Gray code of what results is the place.
    """
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            is_set = (x[d] >> b) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            place = (place << 1) | ((x[d] >> b) & 1)
    return place


def _encode(ranks: str) -> callable:
    def flush(ids: list, found: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        keys = hilbert(np.stack([point(f) for f in found]))
        columns = [pa.array(ids, kind), pa.array([f.tobytes() for f in found], pa.binary()), pa.array([len(f) for f in found], pa.int64()), pa.array(keys)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "tokens", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, size = [], [], 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found.append(token_ids(text.as_py(), ranks))
                ids.append(doc_id.as_py())
                size += found[-1].nbytes
                if size >= BATCH_BYTES:
                    yield flush(ids, found, kind)
                    ids, found, size = [], [], 0
        if found:
            yield flush(ids, found, kind)

    return run


def encoded(docs: DataFrame, ranks: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, tokens, key) of every row; ``ids`` as little-endian 32-bit numbers."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"]
    return rows.mapInArrow(_encode(ranks), f"doc_id {kind.dataType.simpleString()}, ids binary, tokens long, key long")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = 0
    for batch in batches:
        ends = before + np.cumsum(batch["tokens"].to_numpy())
        yield batch.append_column("before", pa.array(ends - batch["tokens"].to_numpy()))
        before = int(ends[-1]) if len(ends) else before


def stream_places(rows: DataFrame) -> DataFrame:
    """(part, row, first): where each row of (part, row, tokens, key) begins in the stream ordered by key."""
    narrow = rows.select("part", "row", "tokens", "key").repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    schema = StructType([*narrow.schema.fields, StructField("before", LongType())])
    placed = keep(narrow.mapInArrow(_running, schema).withColumn("task", F.spark_partition_id()).drop("key"), "curve-places")
    sizes = placed.groupBy("task").agg(F.sum("tokens").alias("n"))
    # One row for each task that wrote places: a bound that allows both the window and the broadcast.
    sizes = keep(sizes.select("task", (F.sum("n").over(W.orderBy("task")) - F.col("n")).alias("earlier")), "curve-sizes")
    found = placed.join(F.broadcast(sizes), "task")
    return found.select("part", "row", (F.col("earlier") + F.col("before")).alias("first"))


def cuts(first: Column, end: Column, total: int, capacity: int) -> Column:
    """The sequences that a document from ``first`` to ``end`` touches: array of (id, lo, hi)."""
    whole = total - total % capacity
    cut = lambda i, lo, hi: F.struct(i.cast("long").alias("id"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    c = F.lit(capacity).cast("long")
    numbers = F.sequence(F.floor(first / c), F.floor((F.least(end, F.lit(whole)) - 1) / c))
    full = F.when(first < whole, F.transform(numbers, lambda k: cut(k, k * c, (k + 1) * c)))
    rest, tail, number = total % capacity, [], whole // capacity
    for bit in range(capacity.bit_length(), -1, -1):
        if rest >> bit & 1:
            tail.append(cut(F.lit(number), F.lit(whole), F.lit(whole + (1 << bit))))
            number, whole = number + 1, whole + (1 << bit)
    full = F.coalesce(full, F.array().cast("array<struct<id:bigint,lo:bigint,hi:bigint>>"))
    if not tail:
        return full
    return F.concat(full, F.filter(F.array(*tail), lambda t: (t["lo"] < end) & (t["hi"] > first)))


def pack(docs: DataFrame, capacity: int = CAPACITY, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document: (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    ``start`` is the piece's place in its document, ``offset`` its place in the sequence, both in tokens;
    ``ids`` are its token ids as little-endian 32-bit numbers. Sequences have ``capacity`` tokens, but for the last
    ones, whose lengths are powers of two.
    """
    rows = keep_numbered(encoded(docs, ranks or public_tokenizers.path(RANKS), doc_id, text), "curve_ids")
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    places = stream_places(rows)
    end = F.col("first") + F.col("tokens")

    def piece(cut: Column) -> Column:
        lo, hi = F.greatest(cut["lo"], F.col("first")), F.least(cut["hi"], end)
        start, length = lo - F.col("first"), hi - lo
        ids = F.substring("ids", (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        return F.struct(start.alias("start"), length.alias("length"), cut["id"].alias("sequence_id"), (lo - cut["lo"]).alias("offset"), ids.alias("ids"))

    # Pieces are cut inside the row; the whole document's ids are not repeated for each.
    found = rows.join(places, ["part", "row"]).select(F.col("doc_id").alias("id"), "tokens", F.transform(cuts(F.col("first"), end, total, capacity), piece).alias("pieces"))
    found = found.select("id", "tokens", F.inline("pieces"))
    return found.select(F.col("id").alias(doc_id), "start", "length", F.col("tokens").alias("doc_tokens"), "sequence_id", "offset", "ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) from pieces: a sequence holds ``capacity`` tokens at most, so its row is small."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    text = F.array_join(F.transform(inside, lambda p: F.hex(p["ids"])), "")
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(text).alias("ids"))
