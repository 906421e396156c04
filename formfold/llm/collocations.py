"""Phrase collocations from counts of longest windows, summed to shorter phrases by ROLLUP.

A text is lower-cased (A to Z), cut into pieces at marks and line ends, and pieces into words.
Every word is the lead of one window: itself and the words that follow it in its piece, as many as
the longest phrase has, padded behind the end. Only these windows are counted.
How often a shorter phrase occurs is the sum over all windows that begin with it, so one ROLLUP over
the words of the windows gives phrases of every shorter length, words and the number of all words; no other
n-grams are ever made.

Leads are taken where the words lie: a window function would sort and shuffle every word. A task turns
about ``CHUNK`` bytes of text at a time into one row: the chunk's own dictionary and its windows, counted, as
numbers of that dictionary. The dictionaries are summed to the vocabulary of words that
occur ``least`` times; it numbers words, and chunks get their numbers back by a join on
the word, so no task needs the whole vocabulary. Rarer words share one number: a phrase that holds
one is rarer still, and the sums over its windows stay exact.

Windows are shuffled once, as numbers, after a task has merged those of its chunks: a row holds those of one
group, compressed. Groups are dealt by all words but the last, and as many as keep each near ``GROUP`` windows, so the
whole counts of the two longest lengths are known where they meet: the last words of windows below ``least``, and
the last but one where all its windows together are, become the rare word there. ROLLUP gets what is left, some few rows
per frequent phrase. Windows whose first words are all so frequent that they might fill a group are dealt
by a hash of the last word too.

Counts are exact. Scores are quotients of products of counts below 10^14, as decimals.

Edge cases: a null text counts as empty; a null language is one of its own, ``und`` (shared with
a language of that name). Repeated rows count as often as they stand there. Texts of any length are
read whole, long ones in several chunks cut at marks. Empty tables give no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .merkle import numbered
from .ngram_join import mixed
from .store import drop, keep, keep_numbered

#: Where pieces end, and what stands between words.
MARKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
UND = "und"
COUNT, SCALE = "decimal(14,0)", 1_000_000
CHUNK = 5 << 20
#: Windows that a task merges at a time before they are shuffled, and that a group gets on average at most.
MERGED, GROUP = 1 << 19, 1 << 19
#: Occurrences of a word from which windows that begin with such words alone are dealt in several pieces.
SPLIT = 1 << 18
#: Numbers that are no word: behind the end of a piece, and any word too rare for a phrase.
PAD, RARE, FIRST = 0, 1, 2

_LOWER = bytes.maketrans(UPPER, LOWER)
_KIND = bytes(2 if b in MARKS else 1 if b in BLANKS else 0 for b in range(256))
_MARK = re.compile(b"[" + re.escape(MARKS) + b"]")


def slices(data: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """A text in slices of ``size`` bytes or more, cut at marks, where no phrase reaches across."""
    start = 0
    while len(data) - start > size:
        mark = _MARK.search(data, start + size)
        if not mark:
            break
        yield data[start : mark.start()]
        start = mark.end()
    yield data[start:]


def count_rows(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of small non-negative numbers, and how often each occurs."""
    key, used = np.zeros(len(columns[0]), np.int64), 0
    for c in columns:
        width = int(c.max(initial=0)).bit_length()
        if used + width > 62:
            kinds, key = np.unique(key, return_inverse=True)
            used = len(kinds).bit_length()
        key, used = (key << width) | c, used + width
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    if counts is None:
        total = np.diff(starts, append=len(key))
    else:
        total = np.add.reduceat(counts[order].astype(np.int64), starts) if len(key) else np.zeros(0, np.int64)
    first = order[starts]
    return [c[first] for c in columns], total


def chunk_windows(texts: list[bytes], langs: list[str], longest: int) -> tuple[list[str], list[str], np.ndarray, list[np.ndarray], np.ndarray]:
    """(languages, words, occurrences, windows, counts) of texts.

    The first three describe the dictionary, an entry per word of each language; windows are columns of
    its places plus ``FIRST``, ``PAD`` behind the end of a piece.
    """
    data = b"\n".join(texts)
    low, kind = np.frombuffer(data.translate(_LOWER), np.uint8), np.frombuffer(data.translate(_KIND), np.uint8)
    inside = kind == 0
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low[inside]))
    spelled = pc.dictionary_encode(words)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    names, of = np.unique(np.array(langs, object), return_inverse=True)
    lang = of[np.searchsorted(begins, starts, side="right") - 1]
    entries, place, n = np.unique(spelled.indices.to_numpy().astype(np.int64) * len(names) + lang, return_inverse=True, return_counts=True)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    del low, kind, inside, edge, starts, ends, offsets, words, of, lang
    place = place.astype(np.int32)
    columns = [place + FIRST]
    for k in range(1, longest):
        behind = np.full(len(place), PAD, np.int32)
        if len(place) > k:
            behind[:-k] = np.where(piece[k:] == piece[:-k], place[k:] + FIRST, PAD)
        columns.append(behind)
    windows, counts = count_rows(columns)
    return names[entries % len(names)].tolist(), spelled.dictionary.take(pa.array(entries // len(names))).to_pylist(), n, windows, counts


def squeezed(a: np.ndarray) -> bytes:
    """Numbers as compressed bytes: windows are sorted, so their columns shrink to a fraction."""
    return zstandard.compress(a.astype("<i4").tobytes())


def spread_out(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i4")


def _chunks(longest: int) -> callable:
    def row(texts: list[bytes], langs: list[str]) -> pa.RecordBatch:
        names, words, n, windows, counts = chunk_windows(texts, langs, longest)
        entries = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())], ["lang", "word", "n"])
        entries = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), entries)
        kinds = pc.dictionary_encode(pa.array(names, pa.string()))
        blob = lambda a: pa.array([squeezed(a)], pa.binary())
        columns = [entries, pa.array([kinds.dictionary.to_pylist()], pa.list_(pa.string())), blob(kinds.indices.to_numpy()), *[blob(w) for w in windows], blob(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["entries", "langs", "lang_at", *[f"w{k + 1}" for k in range(longest)], "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs, size = [], [], 0
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                for part in slices((text.as_py() or "").encode()):
                    texts.append(part)
                    langs.append(lang.as_py())
                    size += len(part)
                    if size >= CHUNK:
                        yield row(texts, langs)
                        texts, langs, size = [], [], 0
        if size:
            yield row(texts, langs)

    return run


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers as compressed bytes; the first two ascend nearly everywhere, so their differences are kept."""
    a = np.stack(columns).astype("<i8")
    a[:2] = np.diff(a[:2], prepend=0)
    # The bytes of one weight together: most weights are all zeros.
    return zstandard.compress(a.view(np.uint8).reshape(len(a), -1, 8).transpose(0, 2, 1).tobytes())


def unpacked(data: bytes, columns: int) -> np.ndarray:
    a = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(columns, 8, -1)
    a = a.transpose(0, 2, 1).copy().view("<i8")[:, :, 0]
    a[:2] = np.cumsum(a[:2], axis=1)
    return a


def _renumber(longest: int, groups: int) -> callable:
    """Windows of chunks in numbers of the vocabulary, a row per group; behind a rare word nothing counts any more.

    The columns of a group are language, words, piece and count. The piece tells which part of the windows with the
    same first words a window belongs to, from 1; it is 0 where they are not divided.
    """
    names = [f"w{k + 1}" for k in range(longest)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tags, rows = [], {}, 0

        def merged() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            columns, counts = count_rows(columns[:-1], columns[-1])
            key = np.zeros(len(counts), np.uint64)
            for c in [*columns[1:longest], columns[-1]]:
                key = mixed(key + c.astype(np.uint64))
            group = (key % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            kinds, starts = np.unique(group[order], return_index=True)
            blobs = [packed([c[at] for c in [*columns, counts]]) for at in np.split(order, starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array([list(tags)] * len(kinds), pa.list_(pa.string())), pa.array(blobs, pa.binary())], names=["group", "langs", "windows"])

        for batch in batches:
            for i in range(len(batch)):
                tag = np.array([tags.setdefault(x, len(tags)) for x in batch["langs"][i].as_py()], np.int32)
                lang = np.concatenate([np.zeros(FIRST, np.int32), tag[spread_out(batch["lang_at"][i].as_py())]])
                numbers, pieces = np.full(len(lang), RARE, np.int64), np.ones(len(lang), np.int32)
                numbers[PAD] = PAD
                if batch["known"][i].is_valid:
                    numbers[batch["known"][i].values.to_numpy() + FIRST] = batch["ids"][i].values.to_numpy()
                    often = batch["often"][i].values
                    pieces[often.field("pos").to_numpy() + FIRST] = often.field("pieces").to_numpy()
                # Half as wide where they fit: a task holds many.
                numbers = numbers.astype(np.int32) if numbers.max() < 1 << 31 else numbers
                local, counts = [spread_out(batch[n][i].as_py()) for n in names], spread_out(batch["f"][i].as_py())
                columns, gone = [lang[local[0]]], np.zeros(len(counts), bool)
                for c in local:
                    columns.append(np.where(gone, numbers[PAD], numbers[c]))
                    gone |= columns[-1] == RARE
                # Windows occur no more often than the rarest of their words.
                parts = reduce(np.minimum, [pieces[c] for c in local[: max(1, longest - 1)]])
                piece = mixed(columns[-1].astype(np.uint64)) % parts.astype(np.uint64)
                columns.append(np.where(parts > 1, 1 + piece, 0).astype(np.int32))
                held.append([*columns, counts])
                rows += len(counts)
                if rows >= MERGED:
                    yield from merged()
                    rows = 0
        if rows:
            yield from merged()

    return run


def _sum_windows(longest: int, least: int) -> callable:
    """Whole windows of a group, summed.

    The last word of a window that occurs less than ``least`` times becomes the rare word; so does the last but one
    of those that do so together, unless other pieces of them are elsewhere.
    """
    names = [f"w{k + 1}" for k in range(longest)]

    def run(table: pa.Table) -> pa.Table:
        held, tags = [], {}
        for langs, windows in zip(table["langs"], table["windows"], strict=True):
            columns = unpacked(windows.as_py(), longest + 3)
            columns[0] = np.array([tags.setdefault(x, len(tags)) for x in langs.as_py()], np.int64)[columns[0]]
            held.append(columns)
        *columns, f = np.concatenate(held, axis=1)
        (lang, *words, piece), f = count_rows(columns, f)
        words[-1] = np.where(f < least, RARE, words[-1])
        if longest > 2:
            new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in [lang, *words[:-1]]], axis=0)])
            few = (np.add.reduceat(f, np.flatnonzero(new)) < least)[np.cumsum(new) - 1] & (piece == 0)
            words[-2], words[-1] = np.where(few, RARE, words[-2]), np.where(few, PAD, words[-1])
        (lang, *words), f = count_rows([lang, *words], f)
        return pa.table([pa.array(list(tags), pa.string()).take(pa.array(lang)), *map(pa.array, words), pa.array(f)], names=["lang", *names, "f"])

    return run


def phrase_counts(docs: DataFrame, longest: int, least: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, w1, ..., words, f) of each phrase of ``words`` words that occurs ``least`` times; 0 words: all words of the language."""
    names = [f"w{k + 1}" for k in range(longest)]
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UND)).alias("lang"))
    blobs = ", ".join(f"{n} binary" for n in names)
    chunks = keep_numbered(rows.mapInArrow(_chunks(longest), f"entries array<struct<lang:string,word:string,n:long>>, langs array<string>, lang_at binary, {blobs}, f binary"), "phrase_chunks")

    # The dictionaries of all chunks make the vocabulary, and get its numbers back.
    entries = chunks.select("row", F.posexplode("entries").alias("pos", "e")).select("row", "pos", "e.*")
    words = entries.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = numbered(words, "phrase-order", "lang", "word").withColumn("id", F.col("number") + FIRST)
    words = keep(words.select("lang", "word", "id", "n", F.ceil(F.col("n") / SPLIT).alias("pieces")), "phrase-words")
    known = entries.join(words, ["lang", "word"]).select(F.shiftright("row", 33).alias("part"), "row", "pos", "id", "pieces")
    often = F.collect_list(F.when(F.col("pieces") > 1, F.struct("pos", "pieces")))
    # Two lists of numbers in the same order take half the memory of one of pairs.
    known = known.repartition("part").groupBy("part", "row").agg(F.collect_list("pos").alias("known"), F.collect_list("id").alias("ids"), often.alias("often"))
    wide = chunks.join(known, ["part", "row"], "left").select("langs", "lang_at", "known", "ids", "often", *names, "f")

    # Windows with the same first words come together; what is left of their counts is summed to all lengths.
    conf = docs.sparkSession.conf
    total, tasks = words.agg(F.sum("n")).first()[0] or 0, int(conf.get("spark.sql.shuffle.partitions"))
    groups = max(4 * tasks, -(-total // GROUP))
    leads = wide.mapInArrow(_renumber(longest, groups), "group long, langs array<string>, windows binary")
    numbers = ", ".join(f"{n} long" for n in names)
    counted = leads.groupBy("group").applyInArrow(_sum_windows(longest, least), f"lang string, {numbers}, f long")
    found = counted.rollup("lang", *names).agg(F.sum("f").alias("f"), F.grouping_id().alias("level")).filter(F.shiftright("level", longest) == 0)
    missing = reduce(lambda a, b: a + b, [(F.shiftright("level", k).bitwiseAND(1)).cast("int") for k in range(longest)])
    found = found.select("lang", *names, (longest - missing).alias("words"), "f")
    whole = [F.coalesce(F.col(n) >= FIRST, F.lit(True)) for n in names]
    found = found.filter((F.col("words") == 0) | ((F.col("f") >= least) & reduce(lambda a, b: a & b, whole)))
    # Rows of chunks hold megabytes; a task needs few of them at a time.
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(limit)
    conf.set(limit, "8m")
    try:
        found = keep(found, "phrase-numbers")
    finally:
        conf.set(limit, before)
    drop(chunks)
    for n in names:
        found = found.withColumnRenamed(n, "id").join(words.select("id", F.col("word").alias(n)), "id", "left").drop("id")
    return found.select("lang", *names, "words", "f")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, within: int = 50, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words of every language by the score of their weakest cut.

    (lang, rank, phrase, a, l, r, n, score). A phrase occurs ``least`` times or more. It is dropped if
    a longer one that holds it occurs at least ``within`` percent as often.
    """
    names = [f"w{k + 1}" for k in range(longest)]
    counts = keep(phrase_counts(docs, longest, least, text, lang), "phrase-counts")
    spell = lambda cols: F.concat_ws(" ", *cols)
    known = counts.filter("words > 0").select("lang", spell(names).alias("part"), F.col("f").alias("f_part"))
    found = counts.filter("words > 1")
    found = keep(found.select("lang", *names, "words", spell(names).alias("phrase"), F.col("f").alias("a")), "phrase-candidates")

    # Every part of a candidate: what it begins with, what it ends with, and what it holds in between.
    parts = []
    for n in range(2, longest + 1):
        for i in range(n):
            for j in range(i + 1, n + 1):
                if j - i < n:
                    parts.append(F.when(F.col("words") == n, F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), spell(names[i:j]).alias("part"))))
    parts = F.filter(F.array(*parts), lambda p: p.isNotNull())
    asked = found.select("lang", "phrase", "words", "a", F.explode(parts).alias("p")).select("lang", "phrase", "words", "a", "p.*")
    # Frequent words are parts of many candidates: their count is looked up once, then split over the candidates by hash.
    answered = keep(asked.join(known, ["lang", "part"]), "phrase-parts")
    inside = answered.filter("j - i > 1").groupBy("lang", F.col("part").alias("phrase")).agg(F.max("a").alias("longer"))
    cuts = answered.filter("i = 0 OR j = words")
    sides = cuts.select("lang", "phrase", "a", F.when(F.col("i") == 0, F.col("j")).otherwise(F.col("i")).alias("k"), "i", "f_part")
    sides = sides.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("i") == 0, F.col("f_part"))).alias("l"), F.max(F.when(F.col("i") > 0, F.col("f_part"))).alias("r"))
    big = lambda c: F.col(c).cast(COUNT)
    score = F.call_function("div", big("a") * big("a") * F.lit(SCALE).cast("decimal(7,0)"), big("l") * big("r"))
    weakest = sides.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    alone = weakest.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a")))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = alone.select("lang", "phrase", "a", "cut.*").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    size = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
