"""Personal data: exact patterns, and a semi-Markov conditional random field that adds spans.

The patterns find e-mail addresses, IP addresses, card and phone numbers as they are
usually written. The random field learns from them on a bounded sample what such
spans look like (some of the sample's phone and card numbers lose their prefix or get other separators, so
that it learns more than the patterns know) and looks at the rest of the text: every
run of tokens with a digit or an @ that no pattern has taken is a candidate segment.
Features are those of a whole span (shape, digits, check sums, neighbours), and a
dynamic program over segments of bounded length chooses boundaries and types
together. Segments whose posterior probability is high enough are added; a span of a
pattern is never changed or overlapped.

Edge cases: a null text counts as empty and has no spans; without a pattern's match
in the sample nothing is learned and nothing added. Extra columns are ignored. Texts
are searched whole, in time that grows with their length only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Most tokens of a segment, characters kept around a candidate, least posterior of an added span.
LONGEST, AROUND, SURE = 16, 24, 0.95
#: Bound of the sample to learn from, in rows.
SAMPLE = 1500

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts where a run of digits starts, and never gives a digit back: the
# marks below only keep the search linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARKS = re.compile(r"[0-9@](?:[^\n0-9@]{0,48}[0-9@])*+")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\W\d_]+|\s|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(digits: str) -> bool:
    """At most 255; leading zeros go first, as int() refuses texts of many digits."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ has one possible match: the whole run of local characters before it, the domain behind it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All matches of the patterns, by start, then kind."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_octet(x) for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def islands(text: str, taken: list[tuple[str, int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Runs of tokens (start, end) around the digits and @ that ``taken`` doesn't cover.

    Marks on one line with no more than twice ``AROUND`` characters between them are
    one island, which has ``AROUND`` more characters on each side.
    """
    free, at = [], 0
    for _, a, b in sorted(taken, key=lambda s: s[1]):
        free.append((at, a))
        at = max(at, b)
    for a, b in [*free, (at, len(text))]:
        for m in _MARKS.finditer(text, a, max(a, b)):
            yield [t.span() for t in _TOKEN.finditer(text, max(a, m.start() - AROUND), min(b, m.end() + AROUND))]


_SHAPES = str.maketrans({**{c: "9" for c in "0123456789"}, **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "a" for c in range(65, 91)}})


def span_features(text: str, start: int, end: int) -> tuple[str, ...]:
    """What a span as a whole looks like; the same for all spans of equal shape, check sums and borders."""
    s = text[start:end]
    shape = re.sub(r"a+", "a", s.translate(_SHAPES))
    digits = _digits(s)
    runs = re.sub(r"9+", lambda m: str(min(len(m[0]), 9)), shape)
    # Neighbours, one on each side, as classes.
    sort = lambda c: "" if not c else "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c
    before, behind = sort(text[start - 1 : start]), sort(text[end : end + 1])
    marks = "".join(sorted(set(re.sub(r"[a9\s]", "", shape))))
    octets = s.split(".")
    good_ip = len(octets) == 4 and all(x.isdecimal() and len(x) <= 3 and int(x) <= 255 for x in octets)
    return (
        "runs " + runs[:40],
        "shape " + re.sub(r"9+", "9", shape)[:40],
        "marks " + marks,
        f"digits {len(digits)} {'a' in shape}",
        f"luhn {12 <= len(digits) <= 19 and luhn(digits)} {'a' in shape or bool(marks.strip('-'))}",
        f"octets {good_ip}",
        f"address {'@' in s and '.' in s.partition('@')[2]}",
        f"borders {before} {behind}",
        f"inside {before in ('9', 'a')} {behind in ('9', 'a')} {s[0].isspace() or s[-1].isspace()}",
    )


class Field:
    """Weights of (feature, kind) pairs, in a table by hash; ordinary tokens score 0."""

    SIZE = 1 << 14

    def __init__(self) -> None:
        self.w = np.zeros((self.SIZE, len(KINDS)))
        self.bias = np.full(len(KINDS), -4.0)
        self.rows: dict[tuple, np.ndarray] = {}

    def places(self, features: tuple[str, ...]) -> np.ndarray:
        if features not in self.rows:
            if len(self.rows) > 50_000:
                self.rows.clear()
            self.rows[features] = np.array([int.from_bytes(hashlib.blake2b(f.encode(), digest_size=4).digest(), "big") % self.SIZE for f in features])
        return self.rows[features]

    def segments(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, np.ndarray]]:
        """Candidate segments (first token, behind the last, feature places): bounded, with a digit or @, no space at the ends."""
        spaces = [text[a:b].isspace() for a, b in tokens]
        hot = [bool(re.search(r"[0-9@]", text[a:b])) for a, b in tokens]
        out = []
        for i in range(len(tokens)):
            if spaces[i]:
                continue
            seen = False
            for j in range(i, min(len(tokens), i + LONGEST)):
                if text[tokens[j][0] : tokens[j][1]] == "\n":
                    break
                seen |= hot[j]
                if seen and not spaces[j]:
                    out.append((i, j + 1, self.places(span_features(text, tokens[i][0], tokens[j][1]))))
        return out

    def score(self, places: np.ndarray) -> np.ndarray:
        return self.w[places].sum(0) + self.bias

    def lattice(self, n: int, segments: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log sums of all ways to a token and on from it, and scores (segments, kinds)."""
        scores = np.array([self.score(p) for _, _, p in segments]).reshape(-1, len(KINDS))
        total = np.logaddexp.reduce(scores, axis=1) if len(segments) else np.zeros(0)
        to, on = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        to[0] = on[n] = 0
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for k, (i, j, _) in enumerate(segments):
            by_end.setdefault(j, []).append(k)
            by_start.setdefault(i, []).append(k)
        for t in range(1, n + 1):
            to[t] = np.logaddexp.reduce([to[t - 1], *(to[segments[k][0]] + total[k] for k in by_end.get(t, ()))])
        for t in range(n - 1, -1, -1):
            on[t] = np.logaddexp.reduce([on[t + 1], *(on[segments[k][1]] + total[k] for k in by_start.get(t, ()))])
        return to, on, scores

    def learn(self, examples: list[tuple[str, list[tuple[int, int]], list[tuple[str, int, int]]]], epochs: int = 6, rate: float = 0.3, seed: int = 3) -> None:
        """Gradient ascent on the conditional likelihood of the marked spans of (text, tokens, spans)."""
        ready = []
        for text, tokens, spans in examples:
            segments = self.segments(text, tokens)
            truth = {(a, b): KINDS.index(k) for k, a, b in spans}
            gold = np.array([truth.get((tokens[i][0], tokens[j - 1][1]), -1) for i, j, _ in segments])
            ready.append((len(tokens), segments, gold))
        grown = np.full_like(self.w, 1e-3)
        grown_bias = np.full_like(self.bias, 1e-3)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in rng.permutation(len(ready)):
                n, segments, gold = ready[k]
                if not segments:
                    continue
                to, on, scores = self.lattice(n, segments)
                starts, ends = np.array([s[0] for s in segments]), np.array([s[1] for s in segments])
                g = -np.exp(np.minimum(to[starts][:, None] + scores + on[ends][:, None] - on[0], 0))
                g[np.flatnonzero(gold >= 0), gold[gold >= 0]] += 1
                live = np.flatnonzero(np.abs(g).max(1) > 1e-4)
                self.bias += rate * g.sum(0) / np.sqrt(np.add(grown_bias, g.sum(0) ** 2, out=grown_bias))
                for s in live:
                    at = segments[s][2]
                    grown[at] += g[s] ** 2
                    self.w[at] += rate * g[s] / np.sqrt(grown[at]) - 1e-4 * self.w[at]

    def decode(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """The best division into segments; of its spans, those that are sure enough."""
        segments = self.segments(text, tokens)
        if not segments:
            return []
        n = len(tokens)
        to, on, scores = self.lattice(n, segments)
        best, back = np.full(n + 1, -np.inf), [None] * (n + 1)
        best[0] = 0
        by_end: dict[int, list[int]] = {}
        for k, (_, j, _) in enumerate(segments):
            by_end.setdefault(j, []).append(k)
        for t in range(1, n + 1):
            best[t], back[t] = best[t - 1], (t - 1, None)
            for k in by_end.get(t, ()):
                value = best[segments[k][0]] + scores[k].max()
                if value > best[t]:
                    best[t], back[t] = value, (segments[k][0], k)
        out, t = [], n
        while t:
            t, k = back[t]
            if k is not None:
                i, j, _ = segments[k]
                kind = int(scores[k].argmax())
                if to[i] + scores[k, kind] + on[j] - on[0] >= np.log(SURE):
                    out.append((KINDS[kind], tokens[i][0], tokens[j - 1][1]))
        return out[::-1]


def _altered(text: str, kind: str, rng: np.random.Generator) -> str:
    """Another way to write a span, which the patterns may miss."""
    if kind == "phone":
        return re.sub(r"^\+\d+ ?", "", text) if rng.random() < 0.6 else text
    if kind == "card" and text.isdigit() and rng.random() < 0.3:
        return re.sub(r"(\d{4})(?=\d)", r"\1.", text)
    return text


def examples(texts: list[str], seed: int = 4) -> list[tuple[str, list[tuple[int, int]], list[tuple[str, int, int]]]]:
    """Islands of the texts with the patterns' spans as truth, some of them altered."""
    rng, out = np.random.default_rng(seed), []
    for text in texts:
        spans, made, at, moved = base_spans(text), "", 0, []
        for k, a, b in spans:
            if a < at:
                continue
            made += text[at:a]
            s = _altered(text[a:b], k, rng)
            moved.append((k, len(made), len(made) + len(s)))
            made, at = made + s, b
        made += text[at:]
        for tokens in islands(made, []):
            inside = [s for s in moved if tokens[0][0] <= s[1] and s[2] <= tokens[-1][1]]
            out.append((made, tokens, inside))
    return out


def fit(texts: list[str], most: int = 1500) -> Field | None:
    """Learn from at most ``most`` islands; None without a marked span."""
    some = examples(texts)[:most]
    if not any(s for _, _, s in some):
        return None
    field = Field()
    field.learn(some)
    field.rows = {}
    return field


def find(text: str, field: Field | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(spans of the patterns, all spans) of a text, by start, then kind."""
    base = base_spans(text)
    added = [] if field is None else [s for tokens in islands(text, base) for s in field.decode(text, tokens)]
    return base, sorted({*base, *added}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def sample(docs: DataFrame, text: str = "text", most: int = SAMPLE) -> list[str]:
    """At most ``most`` texts with a digit or an @, those with the smallest hashes.

    What is taken of each is at most 4,000 characters around its first mark; this
    bounds what the driver holds.
    """
    first = F.regexp_instr(F.col(text), F.lit(r"[0-9@]"))
    rows = docs.filter(F.col(text).rlike(r"[0-9@]")).select(F.xxhash64(text).alias("h"), F.substring(F.col(text), F.greatest(first - 200, F.lit(1)), F.lit(4000)).alias("piece"))
    return [r["piece"] for r in rows.orderBy("h", "piece").limit(most).collect()]


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: number and digest of the patterns' spans, all spans, how many were added.

    ``n_*`` and the digest are fixed by the text alone; ``spans`` and ``n_added`` depend on what the field learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = []
            digests, alls = [], []
            for t in batch.column(1):
                base, every = find(t.as_py() or "", field)
                counts.append([sum(s[0] == k for s in base) for k in KINDS] + [len(every) - len(set(base))])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                alls.append(joined(every))
            c = np.array(counts, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c[:, i]) for i in range(4)), pa.array(digests), pa.array(alls), pa.array(c[:, 4])], names=[x.split()[0] for x in FOUND.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, FOUND)
