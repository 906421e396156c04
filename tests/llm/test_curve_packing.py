"""Packing along the curve against the tokenizer itself, piece by piece."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from formfold.llm import curve_packing as cp
from formfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path(cp.RANKS)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(pieces, docs, tokenizer, capacity):
    """docs: [(id, text)] with unique ids; pieces: rows with ids."""
    of, inside = {}, {}
    for p in pieces:
        of.setdefault(p["doc_id"], []).append(p)
        inside.setdefault(p["sequence_id"], []).append(p)
    assert len(of) == len(docs)
    for i, text in docs:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        got = sorted(of[i], key=lambda p: p["start"])
        assert all(p["doc_tokens"] == len(want) for p in got)
        assert [p["start"] for p in got] == [0, *itertools.accumulate(p["length"] for p in got[:-1])]
        assert all(p["length"] > 0 for p in got)
        ids = b"".join(bytes(p["ids"]) for p in got)
        assert ids == np.array(want, "<u4").tobytes()
    padding = 0
    for parts in inside.values():
        parts.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in parts] == [0, *itertools.accumulate(p["length"] for p in parts[:-1])]
        n = sum(p["length"] for p in parts)
        assert n <= capacity
        padding += 0 if n & (n - 1) == 0 else capacity - n
    assert padding == 0
    return inside


@pytest.mark.parametrize("capacity", [8, 2048])
def test_pieces_of_all_kinds_of_texts(spark, tokenizer, capacity):
    rnd = random.Random(4)
    texts = [None, "", " ", "<|endoftext|>", "a <|endoftext|>b", "\n\n  x", "一二三 四", "x" * 5000, "it's 12 o'clock", "é̂ ﷺ 🙂🙂"]
    texts += [" ".join(rnd.choices(["red", "Blue", "grün", "42", "…", "\t", ""], k=rnd.randrange(300))) for _ in range(60)] + ["the same text"] * 40
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("ids", "key", "row", "part", "tokens", "first")})
    check(cp.pack(df, capacity).collect(), docs, tokenizer, capacity)


def test_empty_table_null_and_repeated_ids(spark):
    assert cp.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = cp.pack(spark.createDataFrame([(None, "a b"), (None, None), (3, "c"), (3, "c")], "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0) == [("3", 2), ("3", 2), ("None", 1), ("None", 3)]


def test_query_on_the_given_documents(spark, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    pieces = cp.pack(spark.read.parquet(f"{SF}/documents.parquet"))
    inside = check(pieces.collect(), docs, tokenizer, 2048)
    built = {r["sequence_id"]: r for r in cp.sequences(pieces).collect()}
    for k, parts in inside.items():
        assert bytes(built[k]["ids"]) == b"".join(bytes(p["ids"]) for p in parts) and built[k]["length"] * 4 == len(built[k]["ids"])
    rows = QUERIES["op12_curve_packing"](spark, SF).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in docs}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))


def test_ids_equal_the_tokenizer_on_every_character(tokenizer):
    for c in itertools.chain(range(0xD800), range(0xE000, 0x20000)):
        text = f"a{chr(c)}b1 {chr(c)}{chr(c)}! {chr(c)}\n"
        assert cp.encoding(RANKS).encode(text, allowed_special="all") == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_where_no_token_reaches_across(tokenizer):
    rnd = random.Random(8)
    words = ["a", "the", "it's", "  ", "\n", "12", "!!", " ", "<|endoftext|>", "é", "x" * 30, "　"]
    for size in (1, 7, 50):
        text = "".join(rnd.choice(words) + rnd.choice([" ", "", "  "]) for _ in range(800))
        found = list(cp.parts(text, size))
        assert "".join(found) == text
        ids = [i for p in found for i in cp.encoding(RANKS).encode(p, allowed_special="all")]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_point_step_by_step(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    places = cp.hilbert(points, bits)
    assert sorted(places) == list(range(len(points)))
    way = points[np.argsort(places)]
    assert (np.abs(np.diff(way, axis=0)).sum(axis=1) == 1).all()


def test_documents_of_like_words_lie_near_each_other():
    rnd = random.Random(1)
    topics = [[f"{w}{t}" for w in ("sun", "mill", "river", "engine", "paper", "green", "walk")] for t in ("ing", "ers", "able")]
    keys, kinds = [], []
    for n in range(90):
        ids = cp.token_ids(" ".join(rnd.choices(topics[n % 3], k=200)), RANKS)
        keys.append(cp.hilbert(cp.point(ids)[None])[0])
        kinds.append(n % 3)
    order = np.array(kinds)[np.argsort(keys)]
    assert (order[1:] != order[:-1]).mean() < 0.3  # 2/3 if the order knew nothing of the words
