"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Each word enters as a word vector beside the mean vector of its character n-grams
and its evidence: how much likelier it stands in toxic texts of the sample. In
training a text does not count for its own words' evidence and half of the words show
nothing else, so that a few toxic texts are not learned by heart.
States of both directions give an attention weight and a value per word; every
window of ``WINDOW`` words (all overlapping ones, a step of one word) pools its
values by attention, and the document's score is that of its highest window.
Running sums make all windows cost a few operations per word. Trained in numpy on
a bounded sample of labelled texts, a document as a bag of windows.

Edge cases: null and empty texts, and texts without a word, get the score of a
window without evidence (the base rate); without labels of both kinds the score is
the base rate everywhere (0.0 if there is no label). Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .gru import F4, Adam, Runner, backward, forward, init_cell, lay_out
from .store import names

WINDOW, THRESHOLD = 16, 0.3
HIDDEN, STREAMS, CONTEXT = 8, 1024, 16
WORDS, GRAMS, DIM, LONGEST = 4096, 8192, 16, 24
#: Places of the table of word evidence; far more than words, as a rare word that shares its place with a common one is lost.
EVIDENCE = 1 << 18
#: Texts of both kinds that a word is taken to stand in besides those that it does.
SMOOTH = 2.0
#: Share of the words that enter a training step with their vectors.
SHOWN = 0.5
#: Bytes of text scored at a time.
PIECE = 1 << 20
#: Bounds of the labelled sample: texts of each kind, characters of each, and words of each that enter a training step.
SAMPLE, SAMPLE_CHARS, SAMPLE_WORDS = 1200, 16_000, 200

#: Bytes that belong to words (letters, digits, all of UTF-8 beyond ASCII), lower-cased; 0 elsewhere.
_LOWER = np.zeros(256, np.uint8)
for _b in range(256):
    if _b >= 128 or chr(_b).isalnum():
        _LOWER[_b] = ord(chr(_b).lower()) if _b < 128 else _b
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of texts laid end to end: distinct ones, and each word's number among them.

    Runs of more than ``LONGEST`` bytes are cut into several words.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        low = _LOWER[data]
        inside = low > 0
        new = inside.copy()
        new[1:] &= ~inside[:-1]
        firsts = np.append(0, ends[:-1])
        firsts = firsts[firsts < len(data)]
        new[firsts] = inside[firsts]
        start = np.flatnonzero(new)
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | new[1:]
        length = np.flatnonzero(stop) + 1 - start
        pieces = -(-length // LONGEST)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.start = np.repeat(start, pieces) + k * LONGEST
        self.length = np.minimum(np.repeat(length, pieces) - k * LONGEST, LONGEST)
        power, inverse = _powers(_P, len(data) + 1), _powers(_P_INVERSE, len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(low.astype(np.uint64) * power[:-1], out=sums[1:])
        code = (sums[self.start + self.length] - sums[self.start]) * inverse[self.start] + self.length.astype(np.uint64)
        _, first, self.number = np.unique(code, return_index=True, return_inverse=True)
        self.hash = ((code[first] * _P) >> np.uint64(40)).astype(np.int64)
        self.chars = np.zeros((len(first), LONGEST + 6), np.uint8)
        self.size = self.length[first]
        self.chars[:, 0] = 1
        for j in range(LONGEST):
            live = j < self.size
            self.chars[live, j + 1] = low[self.start[first][live] + j]
        #: How many words stand before the end of each text.
        self.behind = np.searchsorted(self.start, ends)

    def grams(self, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """Hashed character 3- and 5-grams (with the word's start), and which are real."""
        c, size = self.chars[rows].astype(np.uint32), self.size[rows]
        wide = int(size.max(initial=1)) + 1
        codes, live, at = [], [], np.arange(wide)
        for n in (3, 5):
            x = np.full((len(c), wide), n, np.uint32)
            for j in range(n):
                x = (x * np.uint32(0x01000193)) ^ c[:, j : j + wide]
            codes.append((x * np.uint32(0x9E3779B1)) >> np.uint32(19))
            live.append(at[None, :] + n <= np.maximum(size[:, None] + 1, n))
        return np.concatenate(codes, 1).astype(np.int64), np.concatenate(live, 1)


def word_vectors(p: dict, words: Words, rows: slice = slice(None), evidence: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
    codes, live = words.grams(rows)
    weight = (live / live.sum(1, keepdims=True)).astype(F4)
    known = p["evidence"][words.hash[rows] % EVIDENCE] if evidence is None else evidence
    x = np.concatenate([p["words"][words.hash[rows] % WORDS], np.einsum("ug,ugd->ud", weight, p["grams"][codes]), known[:, None]], axis=1)
    return x, (codes, weight)


def evidence(counts: np.ndarray, kinds: np.ndarray, left_out: int | None = None) -> np.ndarray:
    """How much likelier each word stands in toxic texts, as a logarithm, from ``counts`` (2, words) in ``kinds`` (2) texts.

    ``left_out``: the kind of a text that holds the word and does not count itself, so
    that in training a word that no other text holds tells nothing of its text.
    """
    counts, kinds = counts.astype(np.float64), kinds.astype(np.float64)
    if left_out is not None:
        counts[left_out] = np.maximum(counts[left_out] - 1, 0)
        kinds[left_out] = max(kinds[left_out] - 1, 1)
    rate = (counts + SMOOTH * kinds[:, None] / kinds.sum()) / kinds[:, None]
    return np.log(rate[1] / rate[0]).astype(F4)


def window_bounds(behind: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of all windows over texts whose words end at ``behind``; first window of each text that has words."""
    first = np.append(0, behind[:-1])
    count = np.where(behind > first, np.maximum(behind - first - width, 0) + 1, 0)
    start = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return start, np.minimum(start + width, np.repeat(behind, count)), (np.cumsum(count) - count)[count > 0]


def pool(attention: np.ndarray, value: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Attention-weighted mean value of each window, by running sums."""
    e = np.exp(np.clip(attention, -15, 15).astype(np.float64))
    weights, sums = np.append(0, np.cumsum(e)), np.append(0, np.cumsum(e * value))
    return (sums[end] - sums[start]) / (weights[end] - weights[start])


def document_logits(p: dict, texts: list[np.ndarray]) -> np.ndarray:
    """The highest window's logit of each text; NaN where a text has no word."""
    sizes = np.array([len(x) for x in texts], np.int64)
    words = Words(np.concatenate(texts) if texts else np.zeros(0, np.uint8), np.cumsum(sizes))
    out = np.full(len(texts), np.nan)
    if not len(words.number):
        return out
    streams = max(1, min(STREAMS, len(words.number) // 32))
    known = len(words.hash)
    scores = np.zeros((len(words.number), 2), F4)
    first = np.unique(np.append(0, words.behind[:-1]))
    first = first[first < len(words.number)]
    last = np.append(first[1:], len(words.number)) - 1
    x = np.concatenate([word_vectors(p, words, slice(i, i + 4096))[0] for i in range(0, known, 4096)])
    for d in "fb":
        table = np.concatenate([x @ p[f"in_{d}"] + p[f"gate_{d}"], np.zeros((1, 3 * HIDDEN), F4)])
        ids = words.number.astype(np.int64)
        ids[first if d == "f" else last] += known + 1
        # An empty place (the last row, with a start) holds no state.
        steps, own = lay_out(ids if d == "f" else ids[::-1], streams, CONTEXT, 2 * known + 1)
        run = Runner(table, p[f"u_{d}"])
        run.begin(streams)
        w = np.ascontiguousarray(p["out"][:HIDDEN] if d == "f" else p["out"][HIDDEN:])
        got = np.empty((own, streams, 2), F4)
        for t in range(CONTEXT + own):
            h = run.step(steps[t])
            if t >= CONTEXT:
                np.matmul(h, w, out=got[t - CONTEXT])
        flat = got.transpose(1, 0, 2).reshape(-1, 2)[: len(ids)]
        scores += flat if d == "f" else flat[::-1]
    start, end, per_text = window_bounds(words.behind)
    best = np.maximum.reduceat(pool(scores[:, 0], scores[:, 1], start, end), per_text)
    out[np.diff(words.behind, prepend=0) > 0] = best + p["bias"][0]
    return out


def _held(samples: list[tuple[bytes, int]]) -> np.ndarray:
    """In how many texts of each kind (0, 1) each word stands."""
    held = np.zeros((2, EVIDENCE), np.int64)
    for text, kind in samples:
        data = np.frombuffer(text, np.uint8)
        if len(data):
            words = Words(data, np.array([len(data)]))
            held[kind, np.unique(words.hash % EVIDENCE)] += 1
    return held


def _most_telling(text: bytes, known: np.ndarray) -> bytes:
    """The ``SAMPLE_WORDS`` words around the one of most evidence."""
    data = np.frombuffer(text, np.uint8)
    words = Words(data, np.array([len(data)]))
    if len(words.number) <= SAMPLE_WORDS:
        return text
    at = int(known[words.hash % EVIDENCE][words.number].argmax())
    start = min(max(at - SAMPLE_WORDS // 2, 0), len(words.number) - SAMPLE_WORDS)
    stop = start + SAMPLE_WORDS - 1
    return text[words.start[start] : words.start[stop] + words.length[stop]]


def fit(samples: list[tuple[bytes, int]], epochs: int = 4, batch: int = 64, seed: int = 9, share: float | None = None) -> dict:
    """Train on (text bytes, 0 or 1); ``share``: of toxic texts where the sample was drawn."""
    toxic = sum(y for _, y in samples)
    share = toxic / max(1, len(samples)) if share is None else share
    base = {"base": float(share)}
    if toxic in (0, len(samples)):
        return base
    rng, n = np.random.default_rng(seed), HIDDEN
    p = {"words": (rng.standard_normal((WORDS, DIM)) * 0.1).astype(F4), "grams": (rng.standard_normal((GRAMS, DIM)) * 0.1).astype(F4)}
    p |= {"out": (rng.standard_normal((2 * n, 2)) * 0.5).astype(F4), "bias": np.full(1, -1, F4)}
    held, kinds = _held(samples), np.array([len(samples) - toxic, toxic])
    seen = [evidence(held, kinds, kind) for kind in (0, 1)]
    samples = [(_most_telling(text, seen[kind]), kind) for text, kind in samples]
    for d in "fb":
        p |= {f"in_{d}": (rng.standard_normal((2 * DIM + 1, 3 * n)) * 0.3).astype(F4), f"gate_{d}": np.zeros(3 * n, F4), f"u_{d}": init_cell(rng, n)}
    adam = Adam(p, 0.02)
    order = sorted(range(len(samples)), key=lambda i: len(samples[i][0]))
    batches = [order[i : i + batch] for i in range(0, len(order), batch)]
    total = max(epochs * len(batches), 150)
    for step in range(total):
        if step % len(batches) == 0:
            turns = rng.permutation(len(batches))
        chosen = [samples[i] for i in batches[turns[step % len(batches)]]]
        texts = [np.frombuffer(t, np.uint8) for t, _ in chosen]
        words = Words(np.concatenate(texts), np.cumsum([len(t) for t in texts]))
        count = np.minimum(np.diff(words.behind, prepend=0), SAMPLE_WORDS)
        if not len(words.number):
            continue
        first = np.append(0, words.behind[:-1])
        length, known = int(count.max()), len(words.hash)
        # A word is two entries, as clean and as toxic texts see it; each text leaves itself out.
        vectors, (codes, weight) = word_vectors(p, words, evidence=np.zeros(known, F4))
        # A part of the words show their evidence alone, so that texts cannot be learned by heart.
        shown = (rng.random((known, 1)) < SHOWN).astype(F4) / F4(SHOWN)
        x = np.concatenate([np.concatenate([vectors[:, : 2 * DIM] * shown, e[words.hash % EVIDENCE][:, None]], axis=1) for e in seen])
        ids = np.full((length, len(texts)), 2 * known, np.int64)
        for j, (a, c) in enumerate(zip(first, count, strict=True)):
            ids[:c, j] = words.number[a : a + c] + known * chosen[j][1]
        real = ids < 2 * known
        states, saved = {}, {}
        for d in "fb":
            # The table's last row holds what lies beyond a text's end: its update gate is shut.
            shut = np.concatenate([np.full(n, -9, F4), np.zeros(2 * n, F4)])
            table = np.concatenate([x @ p[f"in_{d}"] + p[f"gate_{d}"], shut[None]])
            states[d], saved[d] = forward(table[ids if d == "f" else ids[::-1]], p[f"u_{d}"])
        both = np.concatenate([states["f"], states["b"][::-1]], axis=2)
        score = both @ p["out"]
        d_score = np.zeros_like(score)
        d_bias = 0.0
        for j, (_, y) in enumerate(chosen):
            c = int(count[j])
            if c:
                a, v = score[:c, j, 0], score[:c, j, 1]
                start, end, _ = window_bounds(np.array([c]))
                logits = pool(a, v, start, end)
                at = int(logits.argmax())
                part = slice(start[at], end[at])
                err = (1 / (1 + np.exp(-np.clip(logits[at] + p["bias"][0], -30, 30))) - y) / len(chosen)
                e = np.exp(np.clip(a[part], -15, 15))
                e /= e.sum()
                d_score[part, j, 1] = err * e
                d_score[part, j, 0] = err * e * (v[part] - logits[at])
                d_bias += err
        grads = {"out": both.reshape(-1, 2 * n).T @ d_score.reshape(-1, 2), "bias": np.full(1, d_bias, F4)}
        d_both = (d_score @ p["out"].T).astype(F4)
        dx = np.zeros_like(x)
        for d in "fb":
            d_states = d_both[:, :, :n] if d == "f" else d_both[::-1, :, n:]
            d_gates, grads[f"u_{d}"] = backward(np.ascontiguousarray(d_states), p[f"u_{d}"], saved[d])
            d_gates = (d_gates if d == "f" else d_gates[::-1])[real]
            rows = np.argsort(ids[real], kind="stable")
            numbers = ids[real][rows]
            cut = np.flatnonzero(np.diff(numbers, prepend=-1))
            d_table = np.zeros((2 * known, 3 * n), F4)
            d_table[numbers[cut]] = np.add.reduceat(d_gates[rows], cut)
            grads[f"in_{d}"], grads[f"gate_{d}"] = x.T @ d_table, d_table.sum(0)
            dx += d_table @ p[f"in_{d}"].T
        dx = (dx[:known] + dx[known:])[:, : 2 * DIM] * shown
        grads["words"], grads["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
        np.add.at(grads["words"], words.hash % WORDS, dx[:, :DIM])
        np.add.at(grads["grams"], codes, weight[:, :, None] * dx[:, None, DIM:])
        adam.step(grads, 1 - step / total)
    return p | base | {"evidence": evidence(held, kinds)}


def scores(model: dict, texts: pa.Array) -> np.ndarray:
    """Score (0 to 1) of each text; a text of more than PIECE bytes goes through whole, alone."""
    out = np.full(len(texts), model["base"])
    if "out" not in model:
        return out
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1)
        logits = document_logits(model, [data[offsets[i] : offsets[i + 1]] for i in range(at, to)])
        got = ~np.isnan(logits)
        out[at:to][got] = 1 / (1 + np.exp(-np.clip(logits[got], -30, 30)))
        at = to
    return out


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[bytes, int]], float]:
    """At most ``SAMPLE`` labelled texts of each kind, and the share of toxic ones among all labels.

    Of each kind, at most ``8 * SAMPLE`` ids with the smallest hashes are candidates:
    this list is what is broadcast to find their texts. Equal texts count once. Those of
    at most ``SAMPLE_CHARS`` characters come first and enter whole, then those with the
    smallest hashes; longer ones give as many characters. An id labelled twice counts as
    toxic if one label says so; null labels and null texts are left out.
    """
    y = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    share = y.agg(F.avg(F.col("y").cast("double"))).first()[0]
    got = []
    for kind in (0, 1):
        ids = y.filter(F.col("y") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(8 * SAMPLE).select("doc_id")
        rows = docs.filter("text is not null").join(F.broadcast(ids), "doc_id")
        rows = rows.select(F.substring("text", 1, SAMPLE_CHARS).alias("text"), (F.length("text") > SAMPLE_CHARS).alias("long"), F.xxhash64("text").alias("h"))
        best = rows.groupBy("long", "h").agg(F.min("text").alias("text")).orderBy("long", "h", "text").select("text").limit(SAMPLE)
        got += [(r["text"].encode(), kind) for r in best.collect()]
    return got, share or 0.0


def score_documents(docs: DataFrame, model: dict, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from ``THRESHOLD`` on) to every row; ``columns``: what to carry."""
    score, predicted = names(docs, "score"), names(docs, "predicted")
    carried = [f for f in docs.schema.fields if columns is None or f.name in columns]
    schema = T.StructType([*carried, T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = scores(model, batch.column(text))
            kept = [batch.column(f.name) for f in carried]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))], names=schema.names)

    return docs.select(*dict.fromkeys([f.name for f in carried] + [text])).mapInArrow(run, schema)


def held_out(doc_id: str) -> F.Column:
    """Rows that learning leaves out: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
