"""Collocations against a plain version and their SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from formfold.llm import collocations as co
from formfold.llm.queries import ORACLE, QUERIES
from tests_support import same_as_sql

SCHEMA = "doc_id long, text string, lang string"


def plain(docs, longest=3, least=10, within=50, top=2000):
    f, n, out = Counter(), Counter(), []
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + m]) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    chosen = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    dropped = set()
    for (lang, *w), a in chosen.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * a >= within * f[(lang, *w[i:j])]:
                    dropped.add((lang, *w[i:j]))
    for lang in {k[0] for k in chosen}:
        found = []
        for key, a in chosen.items():
            if key[0] == lang and key not in dropped:
                w = key[1:]
                sides = [(f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w))]
                score, k = min((10**6 * a * a // (left * right), k) for k, (left, right) in enumerate(sides))
                found.append((-score, -a, " ".join(w).encode(), *sides[k]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in co.collocations(df, **options).collect())


def texts(seed, n=60):
    rnd = random.Random(seed)
    words = ["New", "york", "City", "a", "of", "the", "Été", "x-y", "3", "ab c"]
    return [(i, "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t ", ", ", ".\n", "\r"]) for _ in range(rnd.randrange(80))), rnd.choice(["en", "de", None, "und"])) for i in range(n)]


@pytest.mark.parametrize(("options"), [{}, {"longest": 4, "least": 3}, {"within": 5, "top": 7}, {"longest": 2, "least": 1}])
def test_collocations_equal_plain_version(spark, options):
    docs = [*texts(1), (None, None, None), (90, "", "en"), (91, "word", "xx"), (92, "New york " * 3000, "en"), (93, ".,;:!?\n\r\x0b\x0c \t", "de"), *texts(1)[:20]]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({c: F.lit(1) for c in ("w1", "f", "level", "words", "phrase", "n")})
    assert found(df, **options) == plain(docs, **options)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_collocations_equal_sql(spark):
    same_as_sql(spark, QUERIES["op13_collocations"], ORACLE["op13_collocations"], "/root/testdata/sf0.001")


def test_quotients_of_large_counts_are_exact(spark):
    a, left, right = 99_999_999_999_989, 99_999_999_999_991, 99_999_999_999_997
    big = lambda v: F.lit(v).cast(co.COUNT)
    score = F.call_function("div", big(a) * big(a) * F.lit(co.SCALE).cast("decimal(7,0)"), big(left) * big(right))
    assert spark.range(1).select(score).first()[0] == 10**6 * a * a // (left * right)


def test_only_longest_windows_are_made():
    langs, words, n, columns, counts = co.chunk_windows([b"a b C. d", b"a b c", b""], ["en", "de", "en"], 3)
    spell = lambda i: None if i == co.PAD else words[i - co.FIRST]
    rows = sorted((langs[w[0] - co.FIRST], [spell(i) for i in w], f) for *w, f in zip(*columns, counts, strict=True))
    one = [["a", "b", "c"], ["b", "c", None], ["c", None, None]]
    assert rows == [("de", w, 1) for w in one] + [("en", w, 1) for w in [*one, ["d", None, None]]]
    assert sorted(zip(langs, words, n, strict=True)) == [("de", w, 1) for w in "abc"] + [("en", w, 1) for w in "abcd"]


def test_long_texts_are_cut_at_marks(spark, monkeypatch):
    text = texts(7, 1)[0][1] + " long line without a mark" * 9 + ". " + texts(8, 1)[0][1]
    for size in (1, 10, 100):
        parts = list(co.slices(text.encode(), size))
        assert b"".join(re.sub(rb"[.,;:!?\n-\r]", b"", p) for p in parts) == re.sub(rb"[.,;:!?\n-\r]", b"", text.encode())
    docs = texts(9, 30)
    assert sum(map(len, co.slices(docs[0][1].encode(), 5))) <= len(docs[0][1].encode())


def test_rows_are_counted_whatever_their_width():
    import numpy as np

    rnd = np.random.default_rng(2)
    columns = [rnd.integers(0, 3, 500) * (1 << 40) for _ in range(4)]
    found, total = co.count_rows(columns)
    want = Counter(zip(*[c.tolist() for c in columns], strict=True))
    assert dict(zip(zip(*[c.tolist() for c in found], strict=True), total.tolist(), strict=True)) == want


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_divided_windows_are_counted_whole(spark, monkeypatch, longest):
    """Frequent first words in several pieces, several merges in a task, several groups."""
    for name, value in (("SPLIT", 40), ("MERGED", 100), ("GROUP", 30), ("CHUNK", 500)):
        monkeypatch.setattr(co, name, value, raising=False)
    docs = [*texts(3), *[(200 + i, f"of the w{i % 50} of the v{i}", "en") for i in range(300)], (900, "a b", "xx")]
    assert found(spark.createDataFrame(docs, SCHEMA).repartition(3), longest=longest) == plain(docs, longest=longest)


def test_windows_below_least_are_not_written(spark, monkeypatch):
    """Nearly all windows occur once: no table holds them, and few rows of them reach the sums."""
    rnd = random.Random(5)
    docs = [(i, " ".join(f"w{rnd.randrange(300)}" for _ in range(200)), "en") for i in range(60)]
    kept, keep = [], co.keep

    def counted(df, *rest):
        out = keep(df, *rest)
        kept.append(out.count())
        return out

    monkeypatch.setattr(co, "keep", counted)
    assert found(spark.createDataFrame(docs, SCHEMA).coalesce(1)) == plain(docs)
    assert max(kept) < 60 * 200 / 10


def test_packed_columns_come_back():
    import numpy as np

    columns = [np.array(c) for c in ([0, 0, 1], [7, 1 << 40, 3], [5, 4, 1], [1, 1, 1 << 35])]
    assert co.unpacked(co.packed(columns), 4).tolist() == [c.tolist() for c in columns]


def test_sums_keep_all_counts_of_rare_ends():
    import numpy as np
    import pyarrow as pa

    rows = [(0, 5, 6, 7, 0, 9), (0, 5, 6, 8, 0, 12), (0, 5, 9, 7, 0, 2), (0, 5, 9, 8, 0, 3), (0, 4, 4, 4, 2, 3), (1, co.RARE, co.PAD, co.PAD, 0, 1)]
    blob = co.packed([np.array(c) for c in zip(*rows, strict=True)])
    table = pa.table({"group": [1, 1], "langs": [["en", "de"], ["en", "de"]], "windows": pa.array([blob, blob], pa.binary())})
    got = sorted(zip(*[c.to_pylist() for c in co._sum_windows(3, 20)(table).columns], strict=True))
    r, p = co.RARE, co.PAD
    # A pair in several pieces keeps its words: the others' counts are elsewhere.
    assert got == sorted([("en", 5, 6, r, 18), ("en", 5, 6, 8, 24), ("en", 5, r, p, 10), ("en", 4, 4, r, 6), ("de", r, r, p, 2)])
