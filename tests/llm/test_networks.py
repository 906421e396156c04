"""The recurrent networks: gradients, streams, and the two classifiers built on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from formfold.llm import gru, langid, toxicity
from formfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ONE = ["the cat sat on the mat and then it ran", "when the dog came in the cat was gone", "all that we saw was the old grey house"]
TWO = ["zyx qoqo wupu zazy quqa zozo wyxy", "qaqa zyzy pupu woxo zyx quqo wapu", "wuxu zaza qoqo zyx pupa zyzo quwa"]


def test_gradients_are_those_of_finite_differences(monkeypatch):
    monkeypatch.setattr(gru, "F4", np.float64)
    rng = np.random.default_rng(1)
    gates, u = rng.standard_normal((6, 3, 12)), rng.standard_normal((4, 12)) * 0.5
    states, saved = gru.forward(gates, u)
    d = rng.standard_normal(states.shape)
    d_gates, d_u = gru.backward(d, u, saved)
    for x, g in ((gates, d_gates), (u, d_u)):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in x.shape)
            old, eps = x[at], 1e-6
            x[at] = old + eps
            up = (gru.forward(gates, u)[0] * d).sum()
            x[at] = old - eps
            down = (gru.forward(gates, u)[0] * d).sum()
            x[at] = old
            assert (up - down) / (2 * eps) == pytest.approx(g[at], abs=1e-5)


def test_streams_give_the_states_of_one_run():
    rng = np.random.default_rng(2)
    table, u = rng.standard_normal((5, 12)).astype("f4"), gru.init_cell(rng, 4)
    ids = rng.integers(0, 5, 64)
    whole, _ = gru.forward(table[ids][:, None, :], u)
    run = gru.Runner(table, u)
    run.begin(1)
    got = np.stack([run.step(ids[t : t + 1]).copy() for t in range(len(ids))])
    assert np.allclose(whole, got, atol=1e-5)


def test_no_state_crosses_from_text_to_text():
    model = langid.fit([(t.encode(), "a") for t in ONE] + [(t.encode(), "b") for t in TWO], steps=20)
    alone = langid.pooled(model, pa.array([TWO[0]]))
    beside = langid.pooled(model, pa.array([ONE[0] * 5, TWO[0], "", ONE[1]]))
    assert np.allclose(alone[0], beside[1], atol=0.05 * alone.sum())
    assert beside[2].sum() == 0


def test_positions_sum_to_the_pooled_probabilities(monkeypatch):
    model = langid.fit([(t.encode(), "a") for t in ONE] + [(t.encode(), "b") for t in TWO], steps=20)
    text = "é".join(ONE + TWO)
    data = np.frombuffer(text.encode(), np.uint8)
    prob = langid.position_probabilities(model, data, np.zeros(1, np.int64))
    flat = prob.transpose(1, 0, 2).reshape(-1, 2)[: len(data)]
    assert np.allclose(flat.sum(0), langid.pooled(model, pa.array([text]))[0], rtol=1e-4)
    assert len(langid.label_positions(model, text.encode())) == len(data)
    # A text cut into pieces keeps (nearly) its probabilities.
    whole = langid.pooled(model, pa.array([text * 8]))
    monkeypatch.setattr(langid, "PIECE", 256)
    assert np.allclose(whole, langid.pooled(model, pa.array([text * 8])), rtol=0.1)


def test_languages_and_odd_rows(spark):
    rows = [(i, t, x, 0.5) for i, (t, x) in enumerate([(t, "one") for t in ONE] * 3 + [(t, "two") for t in TWO] * 3)]
    rows += [(100, None, "one", None), (101, "", "two", None), (102, "12 34 !", None, None), (103, "the cat and the dog " * 5000, None, 1.0), (None, TWO[1], None, 1.0), (None, TWO[1], None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = langid.fit(langid.sample(docs))
    assert model["classes"] == ["one", "two"]
    out = langid.identify(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "score", "lang_pred", "score_"]
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score_"]) for r in out.collect()}
    assert out.count() == len(rows)
    assert got[100, None] == got[101, ""] == got[102, "12 34 !"] == ("und", 0.0)
    assert got[103, rows[-3][1]][0] == "one" and got[None, TWO[1]][0] == "two"
    assert all(got[i, t][0] == x for i, t, x, _ in rows[:18])
    empty = docs.limit(0)
    assert langid.fit(langid.sample(empty)) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def test_language_accuracy_on_held_out_documents(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op10_language_id"](spark, SF).join(truth, "doc_id").filter("held_out and lang is not null")
    right, n = got.filter("lang_pred = lang").count(), got.count()
    assert n > 100 and right / n > 0.95


def test_windows_pool_by_attention():
    rng = np.random.default_rng(3)
    behind = np.array([0, 5, 5, 40, 57])
    attention, value = rng.standard_normal(57), rng.standard_normal(57)
    start, end, first = toxicity.window_bounds(behind, 16)
    got = toxicity.pool(attention, value, start, end)
    want = []
    for a, b in zip([0, *behind[:-1]], behind, strict=True):
        for s in range(a, max(a + 1, b - 15)) if b > a else ():
            e = np.exp(attention[s : min(s + 16, b)])
            want.append((e * value[s : min(s + 16, b)]).sum() / e.sum())
    assert np.allclose(got, want) and list(first) == [0, 1, 21]


def test_words_are_found_with_bytes_beyond_ascii():
    texts = ["Élan vital, ab-cd", "", "x" * 60, "Ab ab"]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    w = toxicity.Words(np.concatenate(data), np.cumsum([len(d) for d in data]))
    assert list(np.diff(w.behind, prepend=0)) == [4, 0, 3, 2]
    # "ab" stands in the first and the last text; capitals make no difference.
    assert w.number[2] == w.number[-1] == w.number[-2]


def test_toxicity_of_odd_rows(spark):
    clean, bad = ["a calm and friendly note number", "we like the garden and the tree"], ["you vexel person number", "such a vexel and a gromp"]
    around = "we like the garden and the calm tree in a friendly garden ".split()
    filler = lambda i: " ".join(around[(i * 5 + j) % len(around)] for j in range(i % 19))
    texts = [f"{filler(i)} {clean[i % 2]} {filler(3 * i)} {i}" for i in range(160)] + [f"{filler(i)} {bad[i % 2]} {filler(3 * i)} {i}" for i in range(80)]
    model = toxicity.fit([(t.encode(), int(i >= 160)) for i, t in enumerate(texts)])
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "...", 3), (4, "we like the garden " * 3000, 4), (5, "we like the garden " * 300 + "such a vexel and a gromp 7", 5), (5, "we like the garden " * 300 + "such a vexel and a gromp 7", 5)], "doc_id long, text string, predicted int")
    out = toxicity.score_documents(docs, model)
    assert out.columns == ["doc_id", "text", "predicted", "score", "predicted_"]
    got = {r["doc_id"]: (r["score"], r["predicted_"]) for r in out.collect()}
    assert got[1] == got[2] == got[3] and got[1][0] == pytest.approx(1 / 3)
    assert got[4][1] == 0 and got[5][1] == 1 and out.count() == 6
    assert toxicity.fit([]) == {"base": 0.0}
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.sample(docs, labels) == ([], 0.0)


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op1_toxicity"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    clean = [r["score"] for r in rows if not r["toxic"]]
    toxic = [r["score"] for r in rows if r["toxic"]]
    assert sum(s >= 0.3 for s in clean) <= 0.05 * len(clean)
    assert sum(s >= 0.3 for s in toxic) >= 0.5 * len(toxic)


def test_word_evidence_leaves_the_text_itself_out():
    held, kinds = np.array([[0, 9, 0], [1, 9, 5]]), np.array([90, 10])
    alone, common, strong = toxicity.evidence(held, kinds, 1)
    # A word that only this toxic text holds tells nothing; one that others hold too does.
    assert abs(alone) < 0.1 and strong > 2 and common > 1
    assert toxicity.evidence(held, kinds)[0] > 0.5


def test_the_toxicity_sample_takes_equal_texts_once_and_words_far_behind(spark):
    rows = [(i, "the same bad text") for i in range(40)] + [(40, "calm " * 900 + "vexel" + " calm" * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, share = toxicity.sample(docs, docs.selectExpr("doc_id", "1 as toxic"))
    assert sorted(len(t) for t, _ in got) == [17, 9005] and share == 1.0
    known = np.zeros(toxicity.EVIDENCE, np.float32)
    data = np.frombuffer(b"vexel", np.uint8)
    known[toxicity.Words(data, np.array([5])).hash % toxicity.EVIDENCE] = 3
    piece = toxicity._most_telling(rows[-1][1].encode(), known)
    assert b"vexel" in piece and len(piece.split()) == toxicity.SAMPLE_WORDS
