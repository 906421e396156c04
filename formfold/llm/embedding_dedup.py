"""Near-duplicate embeddings by NN-descent.

Vectors of a label are compared by cosine. Equal vectors are one node from the start.
The neighbour graph begins with the leaves of random-projection trees and is refined
by joining neighbours of neighbours: every node sees the members of its list, and
those that list it, as candidates for each other. Links are never dropped from a list. One
of ``CAPACITY`` links is saturated: its capacity doubles until other entries have room
again. A round joins at most ``JOINED`` members of a list; those that wait stay new for
the next. Rounds end when they find no further link and no member waits.

A vector of more than ``DENSE`` links is dense: its links are counted, not listed. It
and all that link with it are a region, with those of the dense vectors it links with, and
all vectors of a region are compared with each other in blocks, of which counts alone
come back. So a cluster takes rows by its vectors, not by their pairs, and no
rounds by its size.

Then recall is audited: the vectors whose id divides by ``AUDIT_EVERY`` are compared with
all others of their label in blocks, and more trees are added until vectors of few and
of many links alike have enough of their links in the graph. Edges from the threshold on make links and components.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components,
and vectors with a null label or id, link with nothing and are their own component.
Vectors of different length are never compared. Repeated rows link with each other;
all rows of the smallest id of a component are kept. Extra columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import components
from .store import drop, keep

THRESHOLD, RECALL, AUDIT_EVERY = 0.93, 0.98, 100
#: Trees at first, vectors in a leaf, first capacity of a list, entries below the
#: threshold that a list keeps at least, members of a list that one round joins.
TREES, LEAF, CAPACITY, OTHERS, JOINED = 8, 96, 12, 3, 64
#: In place of the round that found it: an entry that was joined.
OLD = -1
#: Links of a vector that are listed; a dense vector's list is the entry of itself, of similarity ``MARK``.
DENSE, MARK = 64, 2.0
#: Vectors that are compared with each other in a leaf or an audit, and of a region.
BLOCK, REGION_BLOCK = 256, 2048
_log = logging.getLogger(__name__)


def usable(vector: str) -> Column:
    """Vectors that can be compared."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.cast(pa.large_list(column.type.value_type))
    return np.asarray(lists.flatten(), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither vanish nor overflow.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys, from rows that come sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            x = np.asarray(batch.column(k))
            change[1:] |= x[1:] != x[:-1]
            change[0] |= bool(held) and held[-1].column(k)[-1].as_py() != x[0]
        cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        at = 0
        for cut in cuts:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if cut < batch.num_rows and held:
                yield _one(held)
                held = []
            at = cut
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


EDGE = "u long, v long, sim double"


def _edges(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b, s = (np.concatenate(x) for x in zip(*found, strict=True))
    u, v = np.minimum(a, b), np.maximum(a, b)
    # The same pair may come from many lists of this task, and from both its ends.
    order = np.lexsort([v, u])
    first = order[np.flatnonzero(np.r_[True, (np.diff(u[order]) != 0) | (np.diff(v[order]) != 0)])]
    return pa.RecordBatch.from_arrays([pa.array(u[first]), pa.array(v[first]), pa.array(s[first])], names=["u", "v", "sim"])


def _found(groups: Iterator[pa.RecordBatch], pairs_of: Callable) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for g in groups:
        got = pairs_of(g)
        if len(got[0]):
            held.append(got)
            size += len(got[0])
        if size > 200_000:
            yield _edges(held)
            held, size = [], 0
    if held:
        yield _edges(held)


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a symmetric matrix, as many of its pairs as connect all that it links."""
    up, seen = np.full(len(linked), -1), ~linked.any(1)
    while not seen.all():
        front = np.flatnonzero(~seen)[:1]
        seen[front] = True
        while len(front):
            near = linked[front] & ~seen
            hit = np.flatnonzero(near.any(0))
            up[hit] = front[near[:, hit].argmax(0)]
            seen[hit] = True
            front = hit
    below = np.flatnonzero(up >= 0)
    return up[below], below


def _thin(wanted: np.ndarray, linked: np.ndarray, dense: np.ndarray) -> None:
    """Of the links between dense vectors, ``wanted`` keeps what connects them."""
    both = dense[:, None] & dense[None, :]
    wanted &= ~both
    wanted[_forest(linked & both)] = True


def _leaf_join(threshold: float) -> Callable:
    """Each vector's links of its leaf and the nearest others; vectors that are dense there, marked, with links that connect them."""

    def pairs(g: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, x = np.asarray(g.column("node")), _unit(_matrix(g.column("vector")))
        sim = x @ x.T
        np.fill_diagonal(sim, -2)
        many = min(OTHERS, len(node) - 1)
        if many < 1:
            return (node[:0], node[:0], np.zeros(0))
        linked = sim >= threshold
        wanted = np.triu(linked)
        near = np.argpartition(-sim, many - 1, axis=1)[:, :many]
        np.put_along_axis(wanted, near, True, 1)
        dense = linked.sum(1) > DENSE
        if dense.any():
            _thin(wanted, linked, dense)
            np.fill_diagonal(wanted, dense)
            np.fill_diagonal(sim, MARK)
        i, j = np.nonzero(wanted)
        return node[i], node[j], sim[i, j]

    return lambda batches: _found(_groups(batches, ["tree", "leaf", "part"]), pairs)


def _list_join(threshold: float) -> Callable:
    """All pairs of a list's members with a new one among them, if they are links or better than what one has."""

    def pairs(g: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, new, worst = (np.asarray(g.column(c)) for c in ("node", "new", "worst"))
        x = _unit(_matrix(g.column("vector")))
        sim = x @ x.T
        unseen = (new[:, None] | new[None, :]) & (node[:, None] != node[None, :])
        wanted = (sim >= threshold) | (sim > worst[:, None]) | (sim > worst[None, :])
        wanted &= unseen & (node[:, None] < node[None, :])
        dense = worst >= MARK
        if dense.sum() > 1:
            _thin(wanted, unseen & (sim >= threshold), dense)
        i, j = np.nonzero(wanted)
        return node[i], node[j], sim[i, j]

    return lambda batches: _found(_groups(batches, ["center"]), pairs)


def _leaves(nodes: DataFrame, trees: range) -> DataFrame:
    """(tree, leaf, part, node): where random hyperplanes put each node.

    Depth follows from the number of nodes of the label. A leaf that is still too full,
    as hyperplanes cannot part vectors that are all alike, is divided at random, in
    each tree differently.
    """
    size = nodes.groupBy("space").agg(F.count("*").alias("n"))
    deep = nodes.join(size, "space").select("node", "space", "vector", F.greatest(F.ceil(F.log2(F.col("n") / LEAF)), F.lit(0)).cast("int").alias("depth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple, np.ndarray] = {}
        for batch in batches:
            node, space, depth = (np.asarray(batch.column(c)) for c in ("node", "space", "depth"))
            lengths = np.asarray(pc.list_value_length(batch.column("vector")))
            for wide in np.unique(lengths):
                rows = np.flatnonzero(lengths == wide)
                x = _unit(_matrix(batch.column("vector").take(pa.array(rows))))
                for t in trees:
                    if (t, wide) not in planes:
                        planes[t, wide] = np.random.default_rng([t, int(wide)]).standard_normal((int(wide), 40))
                    bits = (x @ planes[t, wide] > 0) & (np.arange(40)[None, :] < depth[rows][:, None])
                    leaf = bits @ (1 << np.arange(40, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), t)), pa.array(space[rows]), pa.array(leaf), pa.array(node[rows])], names=["tree", "space", "bits", "node"])

    placed = deep.mapInArrow(run, "tree long, space long, bits long, node long").withColumn("leaf", F.xxhash64("space", "bits"))
    placed = keep(placed.select("tree", "leaf", "node"), "nn-leaves")
    full = placed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).filter("n > 1")
    return placed.join(full, ["tree", "leaf"]).select("tree", "leaf", F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("n") / BLOCK)).alias("part"), "node")


def _room(links: Column) -> Column:
    """Entries below the threshold that a list of so many links keeps."""
    capacity = CAPACITY * F.pow(F.lit(2), F.ceil(F.log2((links + OTHERS) / CAPACITY)))
    return F.when(links >= CAPACITY, F.greatest(capacity.cast("long") - links, F.lit(OTHERS))).otherwise(OTHERS)


def _mirrored(edges: DataFrame) -> DataFrame:
    """Found pairs as entries of both lists."""
    return edges.select(F.inline(F.array(F.struct("u", "v", "sim", "round"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "round"))))


def _merged(entries: DataFrame, threshold: float) -> DataFrame:
    """One row per entry v of the list of u, of the first round that found it, or joined; below the threshold only the best.

    ``n`` numbers a list's entries; those of vectors that are ``dense`` are for ``_parted``.
    """
    one = entries.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("round").alias("round"))
    best = W.partitionBy("u").orderBy(F.desc("sim"), "v")
    whole = best.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # Links come first, so their number is known where the others begin.
    link = (F.col("sim") >= threshold).cast("long")
    one = one.withColumn("n", F.row_number().over(best)).withColumn("links", F.sum(link).over(best.rowsBetween(W.unboundedPreceding, 0)))
    one = one.withColumn("dense", (F.first("sim").over(whole) >= MARK) | (F.sum(link).over(whole) > DENSE))
    return keep(one.filter((F.col("sim") >= threshold) | (F.col("n") - F.col("links") <= _room(F.col("links")))).drop("links"), "nn-graph")


def _parted(merged: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(the graph, in which a dense vector lists itself alone; the links such vectors listed)."""
    dense = F.col("dense")
    own = {"v": F.col("u"), "sim": F.lit(MARK), "round": F.lit(OLD)}
    graph = merged.filter(~dense | (F.col("n") == 1)).select("u", *[F.when(dense, x).otherwise(F.col(c)).alias(c) for c, x in own.items()])
    return graph, merged.filter(dense & (F.col("u") != F.col("v")) & (F.col("sim") >= threshold)).select("u", "v")


def _links(graph: DataFrame, threshold: float) -> DataFrame:
    return graph.filter((F.col("sim") >= threshold) & (F.col("u") != F.col("v")))


def _picked(graph: DataFrame, now: int) -> DataFrame:
    """The graph with ``new`` (not joined yet) and ``picked`` (joined in this round): new entries first, in lists that have any."""
    order = W.partitionBy("u").orderBy(F.desc("new"), F.xxhash64("u", "v", F.lit(now)))
    ranked = graph.withColumn("new", F.col("round") > OLD).withColumn("n", F.row_number().over(order)).withColumn("fresh", F.first("new").over(order))
    return ranked.withColumn("picked", F.col("fresh") & (F.col("n") <= JOINED)).drop("n", "fresh")


def _refine(graph: DataFrame, nodes: DataFrame, threshold: float, now: int) -> tuple[DataFrame, DataFrame]:
    """(pairs that neighbours of neighbours suggest, the graph with its joined entries marked)."""
    # What a list would still take: nothing below its worst entry, unless it has room.
    lists = graph.groupBy("u").agg(F.sum((F.col("sim") >= threshold).cast("long")).alias("links"), F.sum((F.col("sim") < threshold).cast("int")).alias("others"), F.min(F.when(F.col("sim") < threshold, F.col("sim"))).alias("least"), F.max(F.col("u") == F.col("v")).alias("marked"))
    worst = F.when(F.col("marked"), MARK).when(F.col("others") >= _room(F.col("links")), F.col("least")).otherwise(F.lit(-1.0))
    picked = _picked(graph, now)
    # The graph holds both directions, so a list is also all those that list the node.
    seen = picked.filter("picked").select(F.col("u").alias("center"), F.col("v").alias("node"), "new")
    member = nodes.join(lists.select(F.col("u").alias("node"), worst.alias("worst")), "node").select("node", "vector", "worst")
    shipped = seen.join(member, "node").repartition("center").sortWithinPartitions("center")
    marked = picked.select("u", "v", "sim", F.when(F.col("picked"), OLD).otherwise(F.col("round")).alias("round"))
    return shipped.select("center", "node", "new", "worst", "vector").mapInArrow(_list_join(threshold), EDGE), marked


def _truth(nodes: DataFrame, threshold: float, every: int) -> DataFrame:
    """All links of the audited vectors, by comparing them with every vector of their label, in blocks."""
    asked = nodes.filter(F.col("audited"))
    blocks = asked.groupBy("space").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    slices = nodes.groupBy("space").agg(F.ceil(F.count("*") / (16 * BLOCK)).cast("int").alias("slices"))
    plan = blocks.join(slices, "space")
    every_block, every_slice = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    queries = asked.join(plan, "space").select("space", "node", "vector", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), every_slice.alias("slice"), F.lit(True).alias("query"))
    others = nodes.join(plan, "space").select("space", "node", "vector", every_block.alias("block"), F.pmod(F.xxhash64("node", F.lit(2)), F.col("slices")).cast("int").alias("slice"), F.lit(False).alias("query"))

    def pairs(g: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, query, x = np.asarray(g.column("node")), np.asarray(g.column("query")), _unit(_matrix(g.column("vector")))
        sim = x[query] @ x[~query].T
        # Pairs that rounding may put on either side of the threshold are not asked for: no tree could promise them.
        i, j = np.nonzero((sim >= threshold + 1e-9) & (node[query][:, None] != node[~query][None, :]))
        return node[query][i], node[~query][j], sim[i, j]

    keys = ["space", "block", "slice"]
    together = queries.unionByName(others).repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(lambda batches: _found(_groups(batches, keys), pairs), EDGE)


def _regions(graph: DataFrame, tied: list[DataFrame], threshold: float) -> DataFrame | None:
    """(node, region) of dense vectors and all that link with them; None without such vectors."""
    if not tied:
        return None
    dense = graph.filter("u = v").select(F.col("u").alias("v"))
    ties = reduce(DataFrame.union, [_links(graph, threshold).join(dense, "v", "left_semi").select("u", "v"), *tied])
    found = keep(components(ties.withColumnsRenamed({"u": "a", "v": "b"})), "nn-regions").select(F.col("id").alias("node"), F.col("component").alias("region"))
    return found.union(found.select("region", "region").distinct())


def _region_join(threshold: float) -> Callable:
    """How many vectors each one links with between two blocks of a region, by the number of their rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["region", "low", "high"]):
            node, block, members = (np.asarray(g.column(c)) for c in ("node", "block", "members"))
            x, low, high = _unit(_matrix(g.column("vector"))), g.column("low")[0].as_py(), g.column("high")[0].as_py()
            rows, others = np.flatnonzero(block == low), np.flatnonzero(block == high)
            of, linked = members.astype(np.float64), np.zeros(len(node))
            for at in range(0, len(rows), BLOCK):
                part = rows[at : at + BLOCK]
                near = (x[part] @ x[others].T >= threshold) & (node[part][:, None] != node[others][None, :])
                near = near.astype(np.float64)
                linked[part] += near @ of[others]
                if low != high:
                    linked[others] += of[part] @ near
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(linked.astype(np.int64))], names=["node", "linked"])

    return counted


def _region_links(regions: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, linked): rows that link with a vector within its region, all of which are compared, block by block."""
    blocks = regions.groupBy("region").agg(F.ceil(F.count("*") / REGION_BLOCK).cast("int").alias("blocks"))
    placed = regions.join(blocks, "region").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("region", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node")
    keys = ["region", "low", "high"]
    shipped = placed.join(nodes.select("node", "vector", "members"), "node").repartition(*keys).sortWithinPartitions(*keys)
    parts = shipped.select(*keys, "block", "node", "members", "vector").mapInArrow(_region_join(threshold), "node long, linked long")
    return parts.groupBy("node").agg(F.sum("linked").alias("linked"))


def _apart(pairs: DataFrame, regions: DataFrame | None) -> DataFrame:
    """``pairs`` with ``together``: both vectors are of one region, which knows all its links."""
    if regions is None:
        return pairs.withColumn("together", F.lit(False))
    ends = [regions.select(F.col("node").alias(c), F.col("region").alias(f"{c}_region")) for c in ("u", "v")]
    same = F.coalesce(F.col("u_region") == F.col("v_region"), F.lit(False))
    return pairs.join(ends[0], "u", "left").join(ends[1], "v", "left").withColumn("together", same).drop("u_region", "v_region")


def audited_recall(truth: DataFrame, graph: DataFrame, threshold: float, regions: DataFrame | None = None) -> float:
    """The smallest recall among audited vectors of like many links.

    A vector counts by the share of its own links that the graph has, and vectors are
    averaged by the power of two below their number of links: neither a dense cluster's
    many links nor its many vectors hide what isolated pairs lack. 1 without links.
    """
    links = _links(graph, threshold).select("u", "v", F.lit(True).alias("listed"))
    asked = _apart(truth.select("u", "v").join(links, ["u", "v"], "left"), regions)
    hit = F.count_if(F.col("together") | F.coalesce("listed", F.lit(False)))
    share = asked.groupBy("u").agg(F.count("*").alias("wanted"), (hit / F.count("*")).alias("share"))
    least = share.groupBy(F.floor(F.log2("wanted")).alias("size")).agg(F.avg("share").alias("recall")).agg(F.min("recall")).first()[0]
    return 1.0 if least is None else least


def neighbour_graph(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, every: int = AUDIT_EVERY) -> tuple[DataFrame, DataFrame | None, float]:
    """(links in both directions, regions of dense vectors, audited recall) of (node, space, vector, audited).

    The links of dense vectors, which are those of their region, are not listed. Trees are added
    until the audit reaches ``recall``, however many that takes. A leaf
    keeps all its links, so every tree finds any given link with some probability.
    """
    truth, graph, tied, trees, now = keep(_truth(nodes, threshold, every), "nn-truth"), None, [], range(TREES), 0
    link, entry = F.col("sim") >= threshold, ~F.col("dense")

    def merge(entries: DataFrame) -> tuple[DataFrame, int, int]:
        """(the graph, links that this round found, entries that wait)."""
        merged = _merged(entries, threshold)
        graph, ties = _parted(merged, threshold)
        waits = entry & (F.col("round") > OLD) & (F.col("round") < now)
        found, waiting, dense = merged.agg(F.count_if(entry & link & (F.col("round") == now)), F.count_if(waits), F.count_if(~entry & (F.col("u") != F.col("v")) & link)).first()
        if dense:
            tied.append(keep(ties, "nn-ties"))
        return graph, found, waiting

    while True:
        leaves = _leaves(nodes, trees).join(nodes.select("node", "vector"), "node").repartition("tree", "leaf", "part").sortWithinPartitions("tree", "leaf", "part")
        found = _mirrored(leaves.select("tree", "leaf", "part", "node", "vector").mapInArrow(_leaf_join(threshold), EDGE).withColumn("round", F.lit(now)))
        graph, _, _ = merge(found if graph is None else graph.unionByName(found))
        while True:
            now += 1
            more, marked = _refine(graph, nodes, threshold, now)
            old, (graph, links, waiting) = graph, merge(marked.unionByName(_mirrored(more.withColumn("round", F.lit(now)))))
            drop(old)
            if not links and not waiting:
                break
        regions = _regions(graph, tied, threshold)
        reached = audited_recall(truth, graph, threshold, regions)
        _log.info("recall %.4f with %d trees after %d rounds", reached, trees.stop, now)
        if reached >= recall:
            return _links(graph, threshold), regions, reached
        trees, now = range(trees.stop, trees.stop + TREES), now + 1


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = AUDIT_EVERY) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows = rows.withColumn("usable", usable("vector") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # Equal vectors come together through their hash; the vectors themselves are compared by the grouping.
    same = rows.filter("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("members"), F.max(F.col("vec_id") % every == 0).alias("audited"))
    nodes = keep(same.withColumn("node", F.monotonically_increasing_id()).withColumn("space", F.xxhash64("label", F.size("vector"))), "nn-nodes")
    links, regions, _ = neighbour_graph(nodes.select("node", "space", "vector", "audited"), threshold, every=every)
    links = _apart(links, regions).filter(~F.col("together"))
    weight = nodes.select(F.col("node").alias("v"), "members")
    degree = links.join(weight, "v").groupBy(F.col("u").alias("node")).agg(F.sum("members").alias("linked"))
    joined = links.select(F.col("u").alias("a"), F.col("v").alias("b"))
    if regions is not None:
        degree = degree.union(_region_links(regions, nodes, threshold)).groupBy("node").agg(F.sum("linked").alias("linked"))
        joined = joined.union(regions)
    groups = components(joined).withColumnRenamed("id", "node")
    named = nodes.join(degree, "node", "left").join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    named = keep(named.select("label", "vector", "first", "group", (F.coalesce("linked", F.lit(0)) + F.col("members") - 1).alias("n_links")), "nn-named")
    smallest = named.groupBy("group").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "group").select(F.col("label").alias("l"), F.col("vector").alias("x"), "n_links", "component_id", F.lit(True).alias("usable"))
    on = (rows["label"] == named["l"]) & (rows["vector"] == named["x"]) & (rows["usable"] == named["usable"])
    out = rows.join(named, on, "left")
    component = F.coalesce("component_id", rows["vec_id"])
    return out.select(rows["vec_id"], F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(rows["vec_id"] == component, F.lit(True)).alias("kept"))
