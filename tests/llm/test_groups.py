"""Line deduplication, the similarity join, mixing, packing and the pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from formfold.llm import line_dedup, mixing, ngram_join, packing
from formfold.llm.queries import QUERIES

from brute import Sets, fuzzy_lines, grams, jaccard_links, words

SF = "/root/testdata/sf0.001"


def plan_nodes(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def edited(rng, text, n=1):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = sentence(rng, 1)
    return " ".join(w)


def test_lines_agree_with_all_pairs(spark):
    rng = random.Random(7)
    pool = [sentence(rng, rng.randint(3, 60)) for _ in range(60)]
    hot = sentence(rng, 40)
    docs = []
    for i in range(160):
        lines = [edited(rng, rng.choice(pool)) if rng.random() < 0.4 else rng.choice([*pool, "", "  ", "ab", "é" * 30]) for _ in range(rng.randint(0, 5))]
        docs.append((i, "\n".join([edited(rng, hot, rng.randint(0, 2)), *lines])))
    docs += [(500, None), (501, ""), (502, "\n \n"), (503, docs[0][1]), (503, docs[0][1]), (None, docs[1][1] + "\r\n" + sentence(rng, 3000))]
    table = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id long, text string, part int, row string").coalesce(1)
    got = line_dedup.dedup_lines(table)
    assert got.columns == ["doc_id", "text", "part", "row", "n_lines", "n_kept"]
    assert "Python" not in plan_nodes(got) and "Arrow" not in plan_nodes(got)
    found = [(r["doc_id"], r["text"], r["n_lines"], r["n_kept"]) for r in got.collect()]
    want = fuzzy_lines(docs)
    # Bands may miss a pair; its lines are nearly all linked through others.
    wrong = sum(n for _, n in (Counter(map(str, found)) - Counter(map(str, want))).items())
    assert len(found) == len(want) and wrong <= 2
    assert line_dedup.dedup_lines(table.limit(0)).count() == 0


def test_lines_that_share_a_passage_are_compared_by_their_rare_shingles(spark, monkeypatch):
    """Lines in one bucket for a passage only: all links, but far fewer comparisons than pairs."""
    rng = random.Random(27)
    hot, family = sentence(rng, 20), sentence(rng, 40)
    lines = [f"{hot} {sentence(rng, 24)}" for _ in range(150)] + [edited(rng, family, rng.randint(1, 12)) for _ in range(150)]
    lines += [edited(rng, line) for line in rng.sample(lines, 60)]
    docs = list(enumerate(lines))
    compared, verified = [], line_dedup._verified

    def counted(pairs, *rest):
        compared.append(pairs.distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    monkeypatch.setattr(line_dedup, "WIDE", 8, raising=False)
    one = F.array(F.lit(1).cast("long"))
    bins = line_dedup.with_bins
    monkeypatch.setattr(line_dedup, "with_bins", lambda df, line="line": bins(df, line).withColumn("bins", one))
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r["doc_id"], r["n_kept"]) for r in got) == [(i, k) for i, _, _, k in fuzzy_lines(docs)]
    assert sum(compared) < len(docs) ** 2 / 10


def test_lines_with_one_changed_character_are_one(spark):
    """Lines of 84 to 114 characters: 0.81 and more on shingles of 8, below 0.8 on those of 12."""
    rng = random.Random(17)
    lines = [sentence(rng, 40)[:n].strip().ljust(n, "q") for n in range(84, 115, 6)]
    docs = [(i, line) for i, line in enumerate(lines)] + [(100 + i, line[: len(line) // 2] + "7" + line[len(line) // 2 + 1 :]) for i, line in enumerate(lines)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r["doc_id"], r["n_kept"]) for r in got) == [(i, int(i < 100)) for i, _ in docs]


def test_runs_of_different_length_give_the_same_bins(spark):
    """Equal shingle sets, though one line repeats a shingle hundreds of times."""
    text = sentence(random.Random(18), 20)[:70]
    pairs = [(c, text + c * n) for c in "-=_.*#~+:x" for n in (12, 120, 400)]
    rows = line_dedup.with_bins(spark.createDataFrame(pairs, "c string, line string")).collect()
    assert len({(r["c"], r["grams"], tuple(r["bins"])) for r in rows}) == 10 == len({r["c"] for r in rows})


def test_line_query_agrees_with_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: (n, k, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, n, k in fuzzy_lines(docs)}
    got = {r["doc_id"]: (r["n_lines"], r["n_kept"], r["text_sha256"]) for r in QUERIES["op7_line_dedup"](spark, SF).collect()}
    assert got == want


def plain_groups(docs):
    sets = {k: grams(t) for k, (_, t) in enumerate(docs)}
    links, groups = Counter(), Sets(sets)
    for a, b in jaccard_links({k: s for k, s in sets.items() if s}):
        links[a] += 1
        links[b] += 1
        groups.join(a, b)
    return links, groups


@pytest.mark.parametrize("small", [2, 32])
def test_join_agrees_with_all_pairs(spark, small, monkeypatch):
    """Also with every bucket divided into blocks."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK_WORDS", 1500 if small == 2 else 1 << 17)
    rng = random.Random(8)
    pool = [sentence(rng, rng.randint(1, 150)) for _ in range(40)]
    docs = [(i, edited(rng, rng.choice(pool), rng.randint(0, 2)) if i % 3 else edited(rng, pool[0] + " " + pool[1] + pool[2], i % 2)) for i in range(240)]
    docs += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "two words"), (906, docs[0][1]), (906, docs[0][1]), (907, sentence(rng, 20_000))]
    table = spark.createDataFrame([(i, t, True) for i, t in docs], "doc_id long, text string, kept boolean").repartition(3)
    got = ngram_join.similar_groups(table, recall=0.99999).collect()
    links, groups = plain_groups(docs)
    want = sorted((docs[k][0], links[k], docs[groups.root(k)][0]) for k in range(len(docs)))
    assert sorted((r["doc_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len({groups.root(k) for k in range(len(docs))})
    with_null = table.withColumn("doc_id", F.when(F.col("doc_id") < 900, F.col("doc_id")))
    assert sum(r["kept"] for r in ngram_join.similar_groups(with_null).collect()) == sum(r["kept"] for r in got)
    assert ngram_join.similar_groups(table.limit(0)).count() == 0


def test_bands_reach_the_recall():
    b = ngram_join.bands_for(0.8, 0.998, 5)
    assert 1 - (1 - 0.8**5) ** b >= 0.998 > 1 - (1 - 0.8**5) ** (b - 1)


def test_join_query_agrees_with_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    links, groups = plain_groups(docs)
    got = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in QUERIES["op9_ngram_jaccard_join"](spark, SF).collect()}
    assert got == {i: (links[k], docs[groups.root(k)][0]) for k, (i, _) in enumerate(docs)}


def plain_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), dict.fromkeys(order, 0.0)
    while open_ and left > 1e-9:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + level * weight[s] >= 2 * sizes[s]}
        if not full:
            for s in open_:
                target[s] += level * weight[s]
            break
        for s in full:
            left -= 2 * sizes[s] - target[s]
            target[s] = 2.0 * sizes[s]
        open_ -= full
    return target


def test_mix_meets_its_targets(spark):
    rng = random.Random(9)
    docs = [(i, rng.choice(["hot"] * 6 + ["a", "b", "ü", None]), sentence(rng, rng.choice([1, 5, 30, 200]))) for i in range(900)]
    docs += [(900, "empty", ""), (901, "empty", None), (None, "a", "x y z"), (None, "a", "x y z"), (5, "b", "w " * 4000), (6, "single", "only one")]
    table = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, source string, text string, size int")
    got = mixing.mix_report(table, blocks=16, shards=4)
    assert "Python" not in plan_nodes(got) and "Arrow" not in plan_nodes(got)
    rows = got.collect()
    sizes = defaultdict(int)
    for _, s, t in docs:
        sizes[s] += len(words(t))
    want, by_size = plain_targets(sizes), {v: k for k, v in sizes.items()}
    assert len(rows) == len(docs)
    taken = Counter()
    for r in rows:
        s = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(want[s]) and r["taken"] <= 2 * r["size"] and len(r["shards"]) <= 2
        taken[s] += r["taken"]
    for s, t in taken.items():
        assert t <= want[s] + 1e-6 and t >= want[s] - max(40, 0.02 * want[s])
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_report(table, blocks=16, shards=4).collect()))
    copies = mixing.mix(table, blocks=16, shards=4)
    assert copies.columns == table.columns and copies.count() == sum(len(r["shards"]) for r in rows)
    assert mixing.mix_report(table.limit(0)).count() == 0 and mixing.mix(table.limit(0)).count() == 0


def test_draws_are_hypergeometric(spark):
    u = mixing._uniform(F.lit(5), "id")
    got = spark.range(4000).select(*(mixing.hypergeometric(F.lit(n), F.lit(k), F.lit(d), u).alias(f"x{n}_{k}_{d}") for n, k, d in [(50, 20, 25), (7, 7, 3), (7, 0, 3), (9, 1, 4), (40000, 2000, 20000)]))
    r = got.agg(*(f(c).alias(f"{name}_{c}") for c in got.columns for name, f in (("mean", F.mean), ("var", F.variance)))).first().asDict()
    assert r["mean_x50_20_25"] == pytest.approx(10, abs=0.15) and r["var_x50_20_25"] == pytest.approx(3.06, abs=0.3)
    assert (r["mean_x7_7_3"], r["mean_x7_0_3"]) == (3, 0) and r["mean_x9_1_4"] == pytest.approx(4 / 9, abs=0.04)
    assert r["mean_x40000_2000_20000"] == pytest.approx(1000, abs=2) and r["var_x40000_2000_20000"] == pytest.approx(475, rel=0.15)


def test_quotas_are_dealt_exactly(spark):
    quotas = [(0, 100), (1, 0), (2, 7), (3, 1), (4, 933)]
    got = mixing.split_tree(spark.createDataFrame(quotas, "number int, quota long"), shards=8, seed=3).collect()
    shards = Counter()
    for number, quota in quotas:
        ranges = sorted((r["start"], r["stop"]) for r in got if r["number"] == number)
        assert ranges[0][0] == 0 and ranges[-1][1] == quota and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    for r in got:
        shards[r["shard"]] += r["stop"] - r["start"]
    assert len(shards) == 8 and max(shards.values()) - min(shards.values()) <= 3


def plain_best_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(b["left"], -b["turn"], i) for i, b in enumerate(bins) if b["left"] >= n and (s is None or s not in b["s"]) and (c is None or c not in b["c"])]
        if fits:
            tightest = min(f[0] for f in fits)
            i = min((b["turn"], i) for i, b in enumerate(bins) if (b["left"], -b["turn"], i) in fits and b["left"] == tightest)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set(), "turn": 0})
        b = bins[i]
        out.append((i, capacity - b["left"]))
        b["left"] -= n
        b["turn"] = len(out)
        b["s"].add(s)
        b["c"].add(c)
    return out


def test_packing_agrees_with_plain_best_fit():
    rng = random.Random(10)
    for most in (3, 200):
        sizes = sorted((rng.randint(1, 100) for _ in range(600)), reverse=True)
        sources, clusters = [rng.choice([None, *range(most)]) for _ in sizes], [rng.choice([None, *range(150)]) for _ in sizes]
        assert packing.pack_group(sizes, sources, clusters, 100) == plain_best_fit(sizes, sources, clusters, 100)


def packed_well(rows, sizes: Counter, capacity):
    """``rows``: (key, source, cluster, piece row); ``sizes``: words of each key over all its copies."""
    words_of, bins = Counter(), defaultdict(list)
    for key, source, cluster, r in rows:
        words_of[key] += r["words"]
        if r["bin"] is None:
            assert r["words"] == 0
        else:
            bins[r["bin_group"], r["bin"]].append((r["bin_offset"], r["words"], source, cluster))
    assert +words_of == +sizes
    for members in bins.values():
        members.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(members, members[1:], strict=False)) and sum(m[1] for m in members) <= capacity
        for k in (2, 3):
            named = [m[k] for m in members if m[k] is not None]
            assert len(named) == len(set(named))
    return len(bins)


def test_documents_are_packed_whole(spark):
    rng = random.Random(11)
    docs = [(i, f"s{rng.randrange(12)}" if i % 5 else None, sentence(rng, rng.randint(1, 60))) for i in range(700)]
    docs += [(1000, "s1", "w " * 523), (1001, "s1", None), (1002, None, ""), (1003, "s2", "w " * 100), (1004, "s2", "w " * 200), *[(1005 + i, f"s{i}", "equal  text") for i in range(12)]]
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, text string, bin int").repartition(3)
    got = packing.pack(table, capacity=100, group_rows=200).collect()
    by = {d: (s, " ".join(words(t))) for d, s, t in docs}
    count = packed_well([(r["doc_id"], *by[r["doc_id"]], r) for r in got], Counter({d: len(words(t)) for d, _, t in docs}), 100)
    assert count <= 1.1 * sum(len(words(t)) for _, _, t in docs) / 100 + 12
    nulls = table.withColumn("doc_id", F.lit(None).cast("long"))
    assert packing.pack(nulls, capacity=100).count() == len(got)
    assert packing.pack(table.limit(0)).count() == 0


def test_packing_query_packs_every_word(spark):
    docs = {r["doc_id"]: (r["source"], " ".join(words(r["text"]))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_best_fit_packing"](spark, SF).collect()
    packed_well([(r["doc_id"], *docs[r["doc_id"]], r) for r in rows], Counter({i: len(t.split()) for i, (_, t) in docs.items()}), packing.CAPACITY)


def test_mixing_query_reaches_the_targets(spark):
    sizes, source = defaultdict(int), {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        sizes[r["source"]] += len(words(r["text"]))
        source[r["doc_id"]] = r["source"]
    want, taken = plain_targets(sizes), Counter()
    for r in QUERIES["op6_mixing"](spark, SF).collect():
        s = source[r["doc_id"]]
        assert (r["source_size"], r["target"]) == (sizes[s], pytest.approx(want[s])) and r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert sum(taken.values()) == pytest.approx(sum(want.values()), rel=0.05)


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.keep(stage(spark, frames[-1], SF), "stage"))
    first, lines, one, mixed, packed = frames[1:]
    assert all(f.columns == columns for f in (first, lines, one, mixed))
    letters = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in first.collect()} == letters
    got = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    want = [(i, t) for i, t, n, k in fuzzy_lines(got(first)) if not n or k]
    assert sorted(got(lines)) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    links, groups = plain_groups(got(lines))
    kept = got(lines)
    assert sorted(i for i, _ in got(one)) == sorted({kept[groups.root(k)][0] for k in range(len(kept))})
    rows = {r["doc_id"]: r for r in one.collect()}
    sizes = defaultdict(int)
    for r in rows.values():
        sizes[r["source"]] += len(words(r["text"]))
    copies = Counter(r["doc_id"] for r in mixed.collect())
    taken = Counter()
    for i, n in copies.items():
        assert n <= 2
        taken[rows[i]["source"]] += n * len(words(rows[i]["text"]))
    assert sum(taken.values()) == pytest.approx(sum(plain_targets(sizes).values()), rel=0.05)
    pieces = [(r["doc_id"], rows[r["doc_id"]]["source"], " ".join(words(rows[r["doc_id"]]["text"])), r) for r in packed.collect()]
    packed_well(pieces, Counter({i: n * len(words(rows[i]["text"])) for i, n in copies.items()}), packing.CAPACITY)
    assert packed.columns == corpus_pipeline.run(spark, SF).columns
