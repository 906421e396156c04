"""Similarity join of documents on word n-grams: MinHash bands, then exact Jaccard.

Texts with equal n-gram sets are one class from the start, so copies cost nothing.
Signatures of the classes are cut into bands, whose number and height follow from
the wanted recall at the threshold; classes that agree in a band share a bucket. A
pair is verified in the first band on which it agrees, on the full n-gram sets made
anew from the texts. Large buckets are divided into blocks by hash, and every two
blocks are compared in a task of their own by one sparse product; what leaves a task
is a count of links per document and one spanning forest, never the pairs.

N-grams are compared by 64-bit hashes. Words are separated by white space and ASCII
letters are lower-cased. Texts of fewer than ``n`` words have one shorter n-gram.

Edge cases: null texts and texts without a word link with nothing and are classes of
their own; a null id takes part like any other, and ranks last when one document of
a group is chosen; of equal rows one is kept. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import keep, keep_numbered, names

N, THRESHOLD, RECALL, HEIGHT = 5, 0.8, 0.998, 5
#: Words of text that a block of a bucket aims at, and members of a bucket beyond which it has blocks.
BLOCK_WORDS, SMALL = 1 << 17, 32
PIECE = 1 << 21

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: White space separates words; ASCII capitals count as small letters. Fixed values.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13, 32]] = 0


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, height: int = HEIGHT) -> int:
    """Bands of ``height`` rows for which a pair at the threshold meets with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**height))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible pattern."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def gram_sets(data: np.ndarray, ends: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of texts laid end to end, sorted in each text, and how many each text has."""
    low = _LOWER[data]
    inside = low > 0
    new, stop = inside.copy(), inside.copy()
    new[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    # A word ends where its text ends.
    cut = ends[(ends > 0) & (ends < len(data))]
    cut = cut[inside[cut] & inside[cut - 1]]
    new[cut], stop[cut - 1] = True, True
    start, end = np.flatnonzero(new), np.flatnonzero(stop) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(data)), out=sums[1:])
    word = mixed((sums[end] - sums[start]) * _powers(_P_INVERSE, len(data) + 1)[start] + (end - start).astype(np.uint64))
    behind = np.searchsorted(start, ends)
    first = np.append(0, behind[:-1])
    words = behind - first
    count = np.where(words > 0, np.maximum(words - n + 1, 1), 0)
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    width = np.repeat(np.minimum(words, n), count)
    code = np.zeros(len(at), np.uint64)
    for j in range(n):
        live = j < width
        code = code * np.uint64(0xD6E8FEB86659FD93) + np.where(live, word[np.minimum(at + j, max(0, len(word) - 1))], 0)
    text = np.repeat(np.arange(len(ends)), count)
    code = mixed(code)
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    return code[fresh], np.bincount(text[fresh], minlength=len(ends))


def signatures(grams: np.ndarray, sizes: np.ndarray, bands: int, height: int = HEIGHT) -> np.ndarray:
    """Band hashes (texts with n-grams, bands)."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    factors = mixed(np.arange(1, bands * height + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros((len(starts), bands), np.uint64)
    for k, f in enumerate(factors):
        least = np.minimum.reduceat(grams * f, starts)
        out[:, k // height] = out[:, k // height] * np.uint64(0x9E3779B97F4A7C15) + mixed(least + np.uint64(k))
    return mixed(out + np.arange(bands, dtype=np.uint64))


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, ends) of runs of texts of about PIECE bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at]
        at = to


SIGNED = "row long, doc_id long, h1 long, h2 long, n long, bands array<long>"


def sign(docs: DataFrame, n: int, bands: int, height: int) -> DataFrame:
    """A row per text: hash of its n-gram set (128 bits, null without n-grams), size, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, ends in _texts(batch.column(2)):
                grams, sizes = gram_sets(data, ends, n)
                full, starts = sizes > 0, (np.cumsum(sizes) - sizes)[sizes > 0]
                found = np.zeros((len(sizes), 2 + bands), np.int64)
                if len(starts):
                    found[full, 0] = np.add.reduceat(mixed(grams + np.uint64(11)), starts).view(np.int64)
                    found[full, 1] = np.add.reduceat(mixed(grams ^ _P), starts).view(np.int64)
                    found[full, 2:] = signatures(grams, sizes, bands, height).view(np.int64)
                flat = pa.array(found[:, 2:].reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(found[:, 0], mask=~full), pa.array(found[:, 1], mask=~full), pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands), flat)],
                    names=["row", "doc_id", "h1", "h2", "n", "bands"],
                )

    return docs.select("row", "doc_id", "text").mapInArrow(run, SIGNED)


class Forest:
    """Union-find over the numbers 0 to n - 1; roots are the smallest members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def linked(grams: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each of ``left``: (i, those of ``right`` behind it whose Jaccard similarity is high enough).

    N-grams that fewer than two of the texts have are left out of the product.
    """
    sizes = np.array([len(g) for g in grams])
    flat, owner = np.concatenate(grams), np.repeat(np.arange(len(grams)), sizes)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    number = np.cumsum(count > 1) - 1
    code, owner = number[code[shared]], owner[shared]
    wide = int((count > 1).sum())
    bounds = np.searchsorted(owner, np.arange(len(grams) + 1))
    # Members of each n-gram, by n-gram: the other side of the product.
    by_gram = np.argsort(code, kind="stable")
    members, at = owner[by_gram], np.searchsorted(code[by_gram], np.arange(wide + 1))
    allowed = np.zeros(len(grams), bool)
    allowed[right] = True
    for i in left:
        mine = code[bounds[i] : bounds[i + 1]]
        if not len(mine):
            continue
        length = at[mine + 1] - at[mine]
        spots = np.repeat(at[mine] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        common = np.bincount(members[spots], minlength=len(grams))
        hit = (common >= threshold * (sizes[i] + sizes - common) - 1e-9) & allowed & (common > 0)
        yield i, np.flatnonzero(hit)


MADE = "row long, links long, root long"


def _verify(n: int, threshold: float) -> callable:
    def unit(rows: list[dict]) -> list[tuple]:
        texts = [(r["text"] or "").encode() for r in rows]
        data = np.frombuffer(b"".join(texts), np.uint8)
        grams, sizes = gram_sets(data, np.cumsum([len(t) for t in texts]), n)
        sets = np.split(grams, np.cumsum(sizes)[:-1])
        bands = np.array([r["bands"] for r in rows])
        side = np.array([r["side"] for r in rows])
        weight, band = np.array([r["members"] for r in rows]), rows[0]["band"]
        number = np.array([r["row"] for r in rows])
        one_block = rows[0]["i"] == rows[0]["j"]
        left, right = (np.arange(len(rows)),) * 2 if one_block else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        links, forest = np.zeros(len(rows), np.int64), Forest(len(rows))
        for i, found in linked(sets, left, right, threshold):
            if one_block:
                found = found[number[found] > number[i]]
            if len(found):
                # Earlier bands in common: another bucket has the pair.
                found = found[(bands[found, :band] != bands[i, :band]).all(1)]
            for j in found:
                links[i] += weight[j]
                links[j] += weight[i]
                forest.join(i, j)
        return [(int(number[k]), int(links[k]), int(number[forest.root(k)])) for k in range(len(rows)) if links[k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and any(row[k] != held[0][k] for k in ("bucket", "i", "j")):
                    out += unit(held)
                    held = []
                held.append(row)
            if len(out) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["row", "links", "root"])
                out = []
        if held:
            out += unit(held)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["row", "links", "root"])

    return run


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, component_id, kept.

    ``class_id``: smallest id with the same n-gram set; ``n_links``: other documents
    that are similar, copies included; ``component_id``: smallest id that links reach;
    ``kept``: one document of each component.
    """
    docs = keep_numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "join-docs")
    return grouped_rows(docs, **options).drop("part", "row")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without those that resemble one that stays through a chain of links."""
    others = F.struct(F.lit(0).alias(names(docs, "none")), *(c for c in docs.columns if c != text))
    whole = keep_numbered(docs.select(others.alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "join-docs")
    stay = grouped_rows(whole.select("part", "row", "doc_id", "text"), **options).filter("kept").select("part", "row")
    columns = (F.col("text").alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns)
    return whole.join(stay, ["part", "row"]).select(*columns)


def grouped_rows(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, height: int = HEIGHT) -> DataFrame:
    """``similar_groups`` of a kept table with part, row, doc_id and text, and these numbers."""
    bands = bands_for(threshold, recall, height)
    signed = keep(sign(docs, n, bands, height), "join-signed")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    classes = keep(signed.filter("h1 is not null").groupBy("h1", "h2").agg(first.alias("best"), F.count("*").alias("members"), F.first("n").alias("n"), F.first("bands").alias("bands")).select("h1", "h2", F.col("best.row").alias("row"), F.col("best.doc_id").alias("doc_id"), "members", "n", "bands"), "join-classes")

    # Buckets of classes that agree in a band; those of one class have nothing to compare.
    met = classes.select("row", "n", F.posexplode("bands").alias("band", "bucket"))
    buckets = met.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("words")).filter("size > 1")
    members = keep(met.join(buckets, "bucket"), "join-members")
    # A small bucket is needed for those pairs that meet in no earlier band.
    x = members.filter(F.col("size") <= SMALL).select("bucket", "band", "row")
    y = x.select("bucket", F.col("row").alias("other"))
    pairs = x.join(y, "bucket").filter("row < other").groupBy("row", "other").agg(F.min(F.struct("band", "bucket")).alias("at"))
    needed = pairs.select("at.bucket", "at.band", F.explode(F.array("row", "other")).alias("row")).distinct()
    small = needed.withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(0)})
    # Large ones are compared block by block; a block's text is about BLOCK_WORDS words.
    blocks = F.ceil(F.greatest(F.col("words") / BLOCK_WORDS, F.col("size") / 1024)).cast("int")
    large = members.filter(F.col("size") > SMALL).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    large = large.select("bucket", "band", "row", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    large = large.select("bucket", "band", "row", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))
    units = small.select("bucket", "band", "row", "i", "j", "side").unionByName(large)
    # A unit's rows come together by its own key, so a large bucket goes to many tasks.
    # Only these rows move: the texts lie by the number of the task that wrote them.
    shipped = units.join(classes.select("row", "members", "bands"), "row").withColumn("part", F.shiftright("row", 33))
    shipped = shipped.join(docs.select("part", "row", "text"), ["part", "row"]).drop("part")
    shipped = shipped.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    made = keep(shipped.mapInArrow(_verify(n, threshold), MADE), "join-links")

    links = made.groupBy("row").agg(F.sum("links").alias("links"))
    groups = components(made.select(F.col("row").alias("a"), F.col("root").alias("b")))
    classes = classes.join(links, "row", "left").join(groups.withColumnRenamed("id", "row"), "row", "left")
    classes = keep(classes.select("h1", "h2", "row", "doc_id", "members", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "row").alias("component")), "join-grouped")
    chosen = classes.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best"))
    named = classes.join(chosen, "component").select("h1", "h2", F.col("doc_id").alias("class_id"), (F.col("links") + F.col("members") - 1).alias("n_links"), F.col("best.doc_id").alias("component_id"), F.col("best.row").alias("best_row"))
    with_set = signed.select("row", "doc_id", "h1", "h2").join(named, ["h1", "h2"], "left")
    alone = F.col("h1").isNull()
    return with_set.select(
        F.shiftright("row", 33).alias("part"),
        "row",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
    )
