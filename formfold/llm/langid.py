"""Language identification by a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on a bounded sample of labelled
texts. Every byte position gets class probabilities from the states of both
directions; a document's probabilities are the mean over all its positions.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a null
language is never learned; without any labelled text all documents are ``und``.
Extra columns pass through; the added names give way to equal ones by underscores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from .gru import F4, Adam, Runner, backward, forward, init_cell, lay_out
from .store import names

HIDDEN, STREAMS, CONTEXT = 8, 2048, 24
#: Bytes run through the network at a time; longer texts are cut into pieces.
PIECE = 1 << 20
UND = "und"


def sample(docs: DataFrame, per_language: int = 400, text: str = "text", lang: str = "lang") -> list[tuple[bytes, str]]:
    """At most ``per_language`` labelled texts of each language, those with the smallest hashes.

    Each is 1,000 characters from a place given by its hash; the bound on rows and
    length is what the driver holds. Languages are far fewer than documents. Each
    task keeps only its own smallest hashes before rows move.
    """
    h = F.xxhash64(text)
    at = F.lit(1) + F.pmod(h, F.greatest(F.length(text) - 1000, F.lit(1)))
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), h.alias("h"), F.substring(F.col(text), at.cast("int"), F.lit(1000)).alias("piece"))
    first = W.partitionBy("lang").orderBy("h", "piece")
    rows = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_language)
    return [(r["piece"].encode(), r["lang"]) for r in rows.orderBy("lang", "h", "piece").collect()]


def fit(samples: list[tuple[bytes, str]], steps: int = 200, seed: int = 5) -> dict | None:
    """Train on (text bytes, language); None without samples."""
    if not samples:
        return None
    rng, classes = np.random.default_rng(seed), sorted({x for _, x in samples})
    # What a language has in common must not hang on how many texts it has.
    by_class = [[np.frombuffer(t, np.uint8) for t, x in samples if x == c] for c in classes]
    length, batch, n = 96, 128, HIDDEN
    p = {"out": (rng.standard_normal((2 * n, len(classes))) * 0.3).astype(F4), "bias": np.zeros(len(classes), F4)}
    for d in "fb":
        p |= {f"in_{d}": (rng.standard_normal((256, 3 * n)) * 0.5).astype(F4), f"u_{d}": init_cell(rng, n)}
    adam = Adam(p, 0.02)
    for step in range(steps):
        y = rng.integers(0, len(classes), batch)
        x = np.full((length, batch), 32, np.int64)
        for j, c in enumerate(y):
            text = by_class[c][rng.integers(len(by_class[c]))]
            at = rng.integers(0, max(1, len(text) - length + 1))
            piece = text[at : at + length]
            x[: len(piece), j] = piece
        runs = {"f": x, "b": x[::-1]}
        states, saved = {}, {}
        for d, ids in runs.items():
            states[d], saved[d] = forward(p[f"in_{d}"][ids], p[f"u_{d}"])
        both = np.concatenate([states["f"], states["b"][::-1]], axis=2)
        logits = both @ p["out"] + p["bias"]
        prob = np.exp(logits - logits.max(2, keepdims=True))
        prob /= prob.sum(2, keepdims=True)
        d_logits = prob
        d_logits[:, np.arange(batch), y] -= 1
        d_logits /= batch * length
        flat = d_logits.reshape(-1, len(classes))
        grads = {"out": both.reshape(-1, 2 * n).T @ flat, "bias": flat.sum(0)}
        d_both = d_logits @ p["out"].T
        one_hot = np.zeros((x.size, 256), F4)
        for d, ids in runs.items():
            d_states = d_both[:, :, :n] if d == "f" else d_both[::-1, :, n:]
            d_gates, grads[f"u_{d}"] = backward(np.ascontiguousarray(d_states), p[f"u_{d}"], saved[d])
            one_hot[:] = 0
            one_hot[np.arange(x.size), ids.reshape(-1)] = 1
            grads[f"in_{d}"] = one_hot.T @ d_gates.reshape(-1, 3 * n)
        adam.step(grads, 1 - step / steps)
    return p | {"classes": classes}


def position_probabilities(model: dict, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class probabilities of each byte of texts laid end to end: (steps, streams, classes).

    Position ``p`` stands at step ``p % steps`` of stream ``p // steps``. ``starts`` are
    the texts' first positions; no state crosses from text to text.
    """
    n, k, size = HIDDEN, len(model["classes"]), len(data)
    streams = max(1, min(STREAMS, size // 64))
    whole = np.full(-(-size // streams) * streams, 32, np.uint16)
    whole[:size] = data
    ids = {"f": whole.copy(), "b": whole}
    ids["f"][starts] += 256
    ids["b"][np.append(starts[1:], size) - 1] += 256
    steps, own = lay_out(ids["f"], streams, CONTEXT, 32 + 256)
    prob = np.empty((own, streams, k), F4)
    run, w = Runner(model["in_f"], model["u_f"]), np.ascontiguousarray(model["out"][:n])
    run.begin(streams)
    for t in range(CONTEXT + own):
        h = run.step(steps[t])
        if t >= CONTEXT:
            np.matmul(h, w, out=prob[t - CONTEXT])
    steps, _ = lay_out(ids["b"], streams, CONTEXT, 32 + 256)
    run, w, ones = Runner(model["in_b"], model["u_b"]), np.ascontiguousarray(model["out"][n:]), np.ones((k, k), F4)
    run.begin(streams)
    bias = np.tile(model["bias"], (streams, 1))
    x, total = np.empty((streams, k), F4), np.empty((streams, k), F4)
    for t in range(own + 2 * CONTEXT - 1, CONTEXT - 1, -1):
        h = run.step(steps[t])
        if t < own + CONTEXT:
            # States lie between -1 and 1, so the logits are bounded by the weights.
            at = prob[t - CONTEXT]
            np.matmul(h, w, out=x)
            at += x
            at += bias
            np.exp(at, out=at)
            np.matmul(at, ones, out=total)
            at /= total
    return prob


def label_positions(model: dict, text: bytes) -> list[str]:
    """The language of every byte position of one text."""
    if not text:
        return []
    best = position_probabilities(model, np.frombuffer(text, np.uint8), np.zeros(1, np.int64)).argmax(2)
    return [model["classes"][i] for i in best.T.reshape(-1)[: len(text)]]


def sums_between(prob: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``prob`` (as above) over the positions of each text [start, end)."""
    own, streams, k = prob.shape
    up_to = np.zeros((own + 1, streams, k), F4)
    for t in range(own):
        np.add(up_to[t], prob[t], out=up_to[t + 1])
    before = np.zeros((streams + 1, k))
    np.cumsum(up_to[own], axis=0, dtype=np.float64, out=before[1:])
    behind = lambda p: before[p // own] + np.where((p % own > 0)[:, None], up_to[p % own, np.minimum(p // own, streams - 1)], 0)
    return behind(ends) - behind(starts)


def pooled(model: dict, texts: pa.Array) -> np.ndarray:
    """Sum over positions of the class probabilities of each text (texts, classes)."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    total = np.zeros((n, len(model["classes"])))
    # Pieces of at most PIECE bytes: (text, from, to); a piece never spans two calls.
    cuts = [(i, a, min(a + PIECE, offsets[i + 1])) for i in range(n) for a in range(offsets[i], offsets[i + 1], PIECE)]
    group: list[tuple[int, int, int]] = []

    def flush() -> None:
        if group:
            whole = np.concatenate([data[a:b] for _, a, b in group])
            starts = np.cumsum([0] + [b - a for _, a, b in group[:-1]])
            sums = sums_between(position_probabilities(model, whole, starts), starts, np.append(starts[1:], len(whole)))
            np.add.at(total, [i for i, _, _ in group], sums)
            group.clear()

    filled = 0
    for cut in cuts:
        if filled + cut[2] - cut[1] > PIECE:
            flush()
            filled = 0
        group.append(cut)
        filled += cut[2] - cut[1]
    flush()
    return total


def identify(docs: DataFrame, model: dict | None, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` (a learned language or ``und``) and ``score`` (0 to 1) to every row.

    ``columns``: what to carry of the input, all by default.
    """
    label, score, letters = (names(docs, x) for x in ("lang_pred", "score", "has_letters"))
    carried = [f for f in docs.schema.fields if columns is None or f.name in columns]
    if model is None:
        return docs.select(*(f.name for f in carried), F.lit(UND).alias(label), F.lit(0.0).alias(score))
    schema = T.StructType([*carried, T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.array(model["classes"])
        for batch in batches:
            has = np.array(batch.column(letters).to_pylist(), bool)
            total = pooled(model, batch.column(text).cast(pa.large_string()).fill_null(""))
            share = total / np.maximum(total.sum(1, keepdims=True), 1e-12)
            pred = np.where(has, classes[share.argmax(1)], UND)
            value = np.where(has, np.clip(share.max(1), 0, 1), 0.0)
            kept = [batch.column(f.name) for f in carried]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred.tolist(), pa.string()), pa.array(value)], names=schema.names)

    seen = docs.withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    wanted = dict.fromkeys([f.name for f in carried] + [text, letters])
    return seen.select(*wanted).mapInArrow(run, schema)


def held_out(doc_id) -> F.Column:
    """Rows that learning leaves out: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
