"""Operators whose results are compared with plain versions or SQL."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from formfold.llm import components, embedding_dedup, exact_dedup, pii, warc
from formfold.llm.queries import ORACLE, QUERIES
from tests_support import same_as_sql

from brute import Sets

SF = "/root/testdata/sf0.001"


def test_exact_groups_agree_with_sql(spark):
    same_as_sql(spark, QUERIES["op5_exact_dedup"], ORACLE["op5_exact_dedup"], SF)


@pytest.mark.parametrize("memory", [1, 2000, 1 << 20])
@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups_spill_and_collide(spark, memory, collide, monkeypatch):
    if collide:
        monkeypatch.setattr(exact_dedup, "hash64", lambda content: len(content) % 2)
    rng = random.Random(1)
    rows = [(i if i % 7 else None, rng.choice(["", " ", None, "a b", "ab", "a\tb ", "x" * 3000, "y" * 3000, "ü\n1"]) if i % 3 else "hot text", "extra") for i in range(300)]
    rows += [(3, "same", "e"), (3, "same", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(5)
    got = exact_dedup.exact_groups(docs, memory=memory).collect()
    groups: dict = {}
    for i, t, _ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    want = sorted((str(m[3]), str(min(g)[3]), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for m in g)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    # Exactly one row of each group stays, and it is the best one.
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def _archives(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    return warc.write_archives(pages, **options)


def test_records_with_long_headers_are_read(spark):
    rng = random.Random(6)
    url = "http://a/" + "".join(rng.choices("abcdefghij0123456789", k=6_000_000))
    files = _archives(spark, [(1, "u", "one", "d"), (2, url, "two", "d"), (3, "u", "three", "d"), (4, url, "one", "d")])
    got = warc.read_archives(files, payload=True).select("page_id", "record_type", "payload_bytes", "refers_to", "payload").collect()
    found = sorted((r[0], r[1], r[2], r[3], None if r[4] is None else bytes(r[4])) for r in got)
    assert found == [(1, "revisit", 3, 4, None), (2, "response", 3, None, b"two"), (3, "response", 5, None, b"three"), (4, "response", 3, None, b"one")]


def test_archives_come_back_whole_at_every_range_size(spark):
    rng = random.Random(2)
    rows = [(i, f"http://a/{i}\r\nX: y", rng.choice(["", None, "same page", "p" * 5000 + str(i), "ü" * i]), "d") for i in range(60)]
    rows += [(None, None, "same page", "d"), (7, "u", "same page", "d"), (7, "u", "same page", "d"), (61, None, "WARC/1.1\r\n\r\n" * 50, "d")]
    files = _archives(spark, rows, file_bytes=3000)
    best: dict = {}
    for i, _, h, _ in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h, _ in rows:
        payload = (h or "").encode()
        again = best[h or ""] != i
        want.append((i, "revisit" if again else "response", best[h or ""] if again else None, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()))
    for size in (37, 500, 1 << 20):
        got = warc.read_archives(files, size, payload=True).collect()
        found = [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got]
        assert sorted(found, key=str) == sorted(want, key=str)
        assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in got)
        assert all(hashlib.sha1(r["payload"]).digest() == base64.b32decode(r["payload_digest"]) for r in got if r["payload"] is not None)
    folder = files.first()["path"].rsplit("/", 1)[0]
    assert warc.read_archives(warc.archives_in(spark, folder), 1000).count() == len(rows)


def test_archives_with_bytes_between_members(spark, tmp_path):
    good = [warc._member(warc.record("response", i, "u", b"x" * i)) for i in range(4)]
    noise = b"\x1f\x8b\x08junk" * 3 + warc._member(b"no archive")
    path = tmp_path / "a.warc.gz"
    path.write_bytes(noise + good[0] + noise + good[1] + good[2][:-3] + good[3])
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")
    for size in (11, 64, 10_000):
        assert sorted(r["page_id"] for r in warc.read_archives(files, size).collect()) == [0, 1, 3]


def test_small_payloads_are_all_responses_and_no_rows_give_none(spark):
    files = _archives(spark, [(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abcd", ""), (4, "u", "abcd", "")], min_bytes=3)
    assert sorted((r["page_id"], r["record_type"]) for r in warc.read_archives(files).collect()) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]
    assert warc.read_archives(_archives(spark, [(1, "u", "a", "")]).limit(0)).count() == 0


def test_pages_query_agrees_with_the_table(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op2_warc"](spark, SF).collect():
        payload = pages.pop(r["page_id"])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
    assert not pages


def test_components_of_random_graphs_and_chains(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(1, 60)]
    want = Sets({x for e in edges for x in e})
    for a, b in edges:
        want.join(a, b)
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: want.root(i) for i in want.up if want.root(i) != i}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_vectors_agree_with_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows, centre = [], rng.standard_normal(16)
    for i in range(400):
        x = rng.standard_normal(16) if i % 4 else centre + rng.standard_normal(16) * (0.02 if i % 8 else 0.4)
        rows.append((i, x.tolist(), int(i % 8 == 1), "n"))
    rows += [(900 + i, rows[5][1], rows[5][2], "copy") for i in range(30)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    odd_rows = [(2000 + i, v, 0, "odd") for i, v in enumerate(odd)] + [(3000, rows[0][1], None, "no label"), (None, rows[0][1], 0, "no id"), (3001, [1.0, 2.0], 0, "short"), (3002, [2.0, 4.0], 0, "short"), (3003, [1e300, 2e300], 0, "short")]
    table = spark.createDataFrame(rows + odd_rows, "vec_id long, embedding array<double>, label int, n_links string")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table, every=7).collect()}
    assert len(got) == len(rows) + len(odd_rows)
    x, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(len(rows), dtype=bool)
    found = sum(got[r[0]]["n_links"] for r in rows)
    assert near.sum() * 0.98 <= found <= near.sum()
    assert all(got[r[0]]["n_links"] <= n for r, n in zip(rows, near.sum(1), strict=True))
    groups = Sets([r[0] for r in rows])
    for i, j in zip(*np.nonzero(near), strict=True):
        groups.join(rows[i][0], rows[j][0])
    assert sum(got[r[0]]["component_id"] != groups.root(r[0]) for r in rows) <= 4
    for i, _, _, _ in odd_rows[:8]:
        assert got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"]
    assert got[3001]["n_links"] == got[3002]["n_links"] == 2 and got[3003]["component_id"] == 3001
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_isolated_pairs_are_found_beside_a_dense_cluster(spark, monkeypatch):
    """One tree of many leaves: the cluster's links alone reach the recall, the pairs need more trees."""
    monkeypatch.setattr(embedding_dedup, "TREES", 1)
    monkeypatch.setattr(embedding_dedup, "LEAF", 2)
    rng = np.random.default_rng(6)
    centre, pairs = rng.standard_normal(32), rng.standard_normal((300, 32))
    cluster = centre + rng.standard_normal((250, 32)) * 0.02
    x = np.concatenate([pairs, pairs + rng.standard_normal((300, 32)) * 0.34, cluster])
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(table, every=1).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    alone = [i for i in range(600) if near[i].any()]
    assert len(alone) > 300 and sum(got[i] == near[i].sum() for i in alone) >= 0.98 * len(alone)


def _near(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    return near


@pytest.mark.parametrize("trees, leaf", [(8, 96), (2, 8)])
def test_clusters_are_counted_whole_and_take_rows_by_their_vectors(spark, monkeypatch, trees, leaf):
    """Two clusters, some of whose vectors link with both, and repeated rows: counts are exact, lists stay short."""
    for name, value in (("TREES", trees), ("LEAF", leaf), ("REGION_BLOCK", 64)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(8)
    one = rng.standard_normal(32)
    two = one + rng.standard_normal(32) * 0.42
    x = np.concatenate([c + rng.standard_normal((size, 32)) * wide for c, size, wide in ((one, 300, 0.03), (two, 250, 0.12), ((one + two) / 2, 30, 0.1))] + [rng.standard_normal((200, 32))])
    x = np.concatenate([x, x[:20], x[295:305]])
    seen, graph_of = [], embedding_dedup.neighbour_graph
    monkeypatch.setattr(embedding_dedup, "neighbour_graph", lambda *a, **b: seen.append(graph_of(*a, **b)) or seen[0])
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table, every=5).collect()}
    near = _near(x)
    # Rounding may put a pair on either side of the threshold; none of these lies there.
    assert [got[i]["n_links"] for i in range(len(x))] == near.sum(1).tolist()
    groups = Sets(list(range(len(x))))
    for i, j in zip(*np.nonzero(near), strict=True):
        groups.join(int(i), int(j))
    assert [got[i]["component_id"] for i in range(len(x))] == [groups.root(i) for i in range(len(x))]
    assert seen[0][0].count() < 10 * len(x) < near.sum()


def test_dense_vectors_connect_what_they_link(spark):
    """A forest keeps the components of the links; a dense vector's list is itself."""
    rng = np.random.default_rng(9)
    linked = rng.random((60, 60)) < 0.03
    linked |= linked.T
    np.fill_diagonal(linked, False)
    want, got = Sets(list(range(60))), Sets(list(range(60)))
    for a, b in zip(*np.nonzero(linked), strict=True):
        want.join(int(a), int(b))
    pairs = list(zip(*embedding_dedup._forest(linked), strict=True))
    for a, b in pairs:
        assert linked[a, b]
        got.join(int(a), int(b))
    assert [got.root(i) for i in range(60)] == [want.root(i) for i in range(60)] and len(pairs) == 60 - len({want.root(i) for i in range(60)})
    size = embedding_dedup.DENSE
    rows = [(0, v, 0.95, 0) for v in range(1, size + 2)] + [(900, v, 0.95, 0) for v in range(1, size + 1)]
    graph, ties = embedding_dedup._parted(embedding_dedup._merged(spark.createDataFrame(rows, "u long, v long, sim double, round int"), 0.93), 0.93)
    assert [tuple(r) for r in graph.filter("u = 0").collect()] == [(0, 0, embedding_dedup.MARK, embedding_dedup.OLD)]
    assert graph.filter("u = 900").count() == size and sorted(r["v"] for r in ties.collect()) == list(range(1, size + 2))


def test_members_that_were_not_joined_stay_new(spark):
    """A list longer than a round joins: every member is joined in some round, new ones before others."""
    size = 3 * embedding_dedup.JOINED + 5
    graph = spark.createDataFrame([(0, v, 0.95, 0) for v in range(1, size + 1)], "u long, v long, sim double, round int")
    nodes = spark.createDataFrame([(i, 0, [1.0, i / 1000]) for i in range(size + 1)], "node long, space long, vector array<double>")
    joined = []
    for now in range(1, 5):
        _, graph = embedding_dedup._refine(graph, nodes, 0.93, now)
        graph = spark.createDataFrame(graph.collect(), graph.schema)
        joined.append(graph.filter(F.col("round") == embedding_dedup.OLD).count())
    assert joined == [64, 128, 192, size]


def test_saturated_lists_keep_room_for_others(spark):
    rows = [(0, v, 0.95 if v <= links else 0.5 - v / 1000, 0, links) for links in (3, 12, 40) for v in range(1, links + 41)]
    for links, others in ((3, 3), (12, 12), (40, 8)):
        graph = spark.createDataFrame([r[:4] for r in rows if r[4] == links], "u long, v long, sim double, round int")
        kept = sorted(r["v"] for r in embedding_dedup._merged(graph, 0.93).collect())
        assert kept == list(range(1, links + others + 1))


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_agree_with_the_patterns():
    rng = random.Random(6)
    for _ in range(8000):
        text = "".join(rng.choice("ab129 0.+@- ()%_\nü") for _ in range(rng.randint(0, 60)))
        assert plain_spans(text) == pii.base_spans(text), text
    cards = "pay 4111 1111 1111 1111 or 4111111111111112, +1 (555) 555-0100 x@y.zz 10.0.0.1 999.1.1.1"
    assert plain_spans(cards) == pii.base_spans(cards) and len(pii.base_spans(cards)) == 4


def test_long_runs_take_linear_time():
    for c in ("1", "a@", "1.", "+1", "a.", "1 "):
        pii.base_spans(c * 50_000)


def test_added_spans_are_new_and_base_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = pii.fit(pii.sample(docs, most=400))
    base, every = pii.find("ring (988) 555-2485 or +1 (988) 555-2486, bob.7@mail.example.com", field)
    assert set(base) <= set(every) and ("phone", 5, 19) in every and len(every) == 3
    rows = [(1, None, 0), (2, "", 0), (3, "nothing to see, version 3 of 12 items", 0), (4, "a@b.cc " * 2000, 0), (None, "10.1.2.3", 0), (None, "10.1.2.3", 0)]
    got = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, spans int"), field).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and by[1]["spans"] == by[2]["spans"] == by[3]["spans"] == ""
    assert by[1]["base_sha256"] == hashlib.sha256(b"").hexdigest() and by[4]["n_email"] == 2000
    assert by[None]["spans"] == "ip:0:8" and by[None]["n_ip"] == 1
    assert pii.fit(["no numbers at all"]) is None and pii.find("10.1.2.3", None)[1] == [("ip", 0, 8)]


def test_personal_data_query_keeps_the_patterns_spans(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_pii"](spark, SF).collect():
        base = plain_spans(texts[r["doc_id"]])
        said = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r["spans"].split(",")) | {""}
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]


def test_counts_are_those_of_the_patterns(spark):
    field = pii.fit(pii.sample(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), most=400))
    text = "ring (988) 555-2485 or +1 (988) 555-2486, bob.7@mail.example.com"
    odd = ["call 10.1.2.\u00b2 now", "call \u00b9.\u00b2.3.4 now", "0" * 5000 + ".1.2.3"]
    rows = [(0, text), *enumerate(odd, 1)]
    by = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()}
    assert by[0]["spans"].count("phone") == 2 and by[0]["n_added"] == 1
    assert [by[0][f"n_{k}"] for k in pii.KINDS] == [1, 0, 0, 1]
    assert by[1]["n_ip"] == by[2]["n_ip"] == 0 and by[3]["n_ip"] == 1
