"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source fall into a fixed number of blocks by a hash of their id. A
source's target is met by whole epochs and a fractional one: permuted blocks up to
the target, then single documents of the block in which it is reached, then the
largest untaken documents that still fit. The drawn blocks are the source's quota.

The quotas are dealt to output shards by a binary tree: at each node the left half
draws its share of blocks without replacement, source by source, from the
hypergeometric distribution conditioned on what is left, so every quota is met
exactly and each shard is a uniform draw of the mix. A shard then takes its next
blocks in the source's permuted order; ``place`` orders the rows inside a shard.

Only DataFrame functions are used. Whatever is gathered in one row or window has at
most one entry per source and block; document rows are only ever summed per block,
and ordered only inside the one block of each source that is taken in part.

Edge cases: a null source is a source of its own, last in order; a null text has
size 0; sources without a word have target 0; rows without an id are placed by their
place in the input; equal rows count each. The caller's columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import keep, keep_numbered

BLOCKS, SHARDS = 1024, 16
WEIGHTS = (3, 1, 2)
#: Words of the mix against words of all documents, and most uses of a document.
SHARE, EPOCHS = 1.5, 2


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size) with the source's number and target; one row per source.

    Sources in the order of size over weight are full from the first on; behind them
    one level of words per weight uses up what is left.
    """
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    numbered = sizes.withColumn("number", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    numbered = numbered.withColumn("weight", F.get(cycle, F.col("number") % len(weights)))
    cap = F.lit(float(epochs)) * F.col("source_size")
    order = W.orderBy(cap / F.col("weight"), "number")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(1))
    rest = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    level = numbered.withColumn("level", rest / F.sum("weight").over(onward)).withColumn("cap", cap)
    # The level holds from the first source on that it does not fill.
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(cap / F.col("weight"), "number", "level"))).over(everything)
    return level.withColumn("level", first["level"]).select("source", "source_size", "number", F.coalesce(F.least(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` out of ``total`` are good, for a uniform ``u``: inversion within 12 deviations of the mode."""
    total, good, draws = (x.cast("double") for x in (total, good, draws))
    lowest, highest = F.greatest(F.lit(0.0), draws - (total - good)), F.least(good, draws)
    mode = F.floor((draws + 1) * (good + 1) / (total + 2)).cast("double")
    spread = F.ceil(F.lit(12.0) * F.sqrt(draws * good / F.greatest(total, F.lit(1.0)) * F.greatest(total - good, F.lit(0.0)) / F.greatest(total, F.lit(1.0)))) + 12
    low, high = F.greatest(lowest, mode - spread).cast("long"), F.least(highest, mode + spread).cast("long")
    steps = F.sequence(low, F.greatest(low, high))

    def ratio(x: Column) -> Column:
        """Weight of x + 1 against that of x."""
        return (good - x) * (draws - x) / F.greatest((x + 1) * (total - good - draws + x + 1), F.lit(1.0))

    first = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    whole = F.aggregate(steps, first, lambda a, x: F.struct((a["w"] * ratio(x)).alias("w"), (a["sum"] + a["w"]).alias("sum")), lambda a: a["sum"])
    start = F.struct(F.lit(1.0).alias("w"), (u * whole).alias("left"), low.alias("x"))
    # Walk up while the probability to use up exceeds the weight of the step.
    walk = lambda a, x: F.struct((a["w"] * ratio(x)).alias("w"), (a["left"] - a["w"]).alias("left"), F.when(a["left"] >= a["w"], F.least(x + 1, F.greatest(low, high))).otherwise(a["x"]).alias("x"))
    return F.aggregate(steps, start, walk, lambda a: a["x"])


def split_tree(quotas: DataFrame, shards: int = SHARDS, seed: int = 1) -> DataFrame:
    """(shard, number, start, stop): each shard's range of the blocks of each source.

    ``quotas``: a row per source, numbered from 0, with its quota of blocks.
    """
    listed = F.transform(F.array_sort(F.collect_list(F.struct("number", "quota"))), lambda x: x["quota"])
    nodes = quotas.agg(listed.alias("q")).select(F.lit(1).alias("node"), "q")
    level = 1
    while level < shards:
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
        start = F.struct(total.alias("all"), F.floor(total / 2).alias("draws"), F.array().cast("array<bigint>").alias("left"))

        def draw(a: Column, x: Column) -> Column:
            n = F.size(a["left"])
            take = hypergeometric(a["all"], x, a["draws"], _uniform(F.lit(seed), F.col("node"), n))
            # One struct of what the step needs, so that the draw is evaluated once.
            return F.element_at(F.transform(F.array(take), lambda t: F.struct((a["all"] - x).alias("all"), (a["draws"] - t).alias("draws"), F.concat(a["left"], F.array(t)).alias("left"))), 1)

        nodes = nodes.withColumn("left", F.aggregate("q", start, draw, lambda a: a["left"]))
        both = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("q")), F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("q", "left", lambda a, b: a - b).alias("q")))
        nodes = keep(nodes.select(F.inline(both)), "mix-nodes")
        level *= 2
    dealt = nodes.select((F.col("node") - level).alias("shard"), F.posexplode("q").alias("number", "blocks"))
    up_to = F.sum("blocks").over(W.partitionBy("number").orderBy("shard"))
    return dealt.select("shard", "number", (up_to - F.col("blocks")).alias("start"), up_to.alias("stop"))


def plan(rows: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS, seed: int = 1, **mix) -> DataFrame:
    """How the mix uses each row of (row, doc_id, source, size).

    Adds source_size, target, and ``uses``: an array of (shard, place), one per copy.
    """
    block = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("doc_id", "row")), F.lit(blocks))
    sources = keep(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), **mix), "mix-sources")
    named = sources.select(F.col("source").alias("named"), "number", "source_size", "target")
    # Rows carry their source's number from here on; the table has a row per source.
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    rows = keep(rows.withColumn("block", block).withColumn("key", F.xxhash64(F.lit(seed + 1), F.coalesce("doc_id", "row"), "row")), "mix-rows")

    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    words = rows.groupBy("number", "block").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    words = words.withColumn("full", full).withColumn("want", F.col("target") - F.col("full") * F.col("source_size"))
    words = words.withColumn("turn", F.xxhash64(F.lit(seed + 2), "number", "block", "full"))
    before = F.coalesce(F.sum("words").over(W.partitionBy("number").orderBy("turn", "block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    state = F.when(before + F.col("words") <= F.col("want"), "in").when(before <= F.col("want"), "edge").otherwise("out")
    drawn = keep(words.withColumn("before", before).withColumn("state", state).withColumn("left", F.col("want") - F.col("before")), "mix-blocks")

    # The block in which the target is reached: its documents in order, as far as they fit.
    edge = drawn.filter("state = 'edge'").select("number", "block", "left")
    inside = rows.select("number", "block", "row", "size", "key").join(edge, ["number", "block"])
    reach = F.sum("size").over(W.partitionBy("number").orderBy("key", "row"))
    inside = inside.withColumn("reach", reach).filter(F.col("reach") <= F.col("left"))
    part = keep(inside.select("number", "row", "size"), "mix-part")
    # Then, twice, the largest untaken document that still fits.
    gaps = edge.select("number", "left")
    for _ in range(2):
        got = part.groupBy("number").agg(F.sum("size").alias("got"))
        gap = gaps.join(got, "number", "left").select("number", (F.col("left") - F.coalesce("got", F.lit(0))).alias("gap"))
        free = rows.select("number", "block", "row", "size", "key").join(drawn.filter("state != 'in'").select("number", "block"), ["number", "block"]).join(part.select("row"), "row", "left_anti")
        best = free.join(gap, "number").filter((F.col("size") > 0) & (F.col("size") <= F.col("gap"))).groupBy("number").agg(F.max(F.struct("size", "key", "row")).alias("best"))
        part = keep(part.unionByName(best.select("number", "best.row", "best.size")), "mix-part")

    # A source's quota: its blocks once per whole epoch, then those of the fractional one.
    drawn_part = drawn.filter("state != 'out'").select("number", "block", F.col("full").alias("epoch"), "turn", "full")
    turns = drawn.filter("full > 0").select("number", "block", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("epoch"), "full")
    turns = turns.withColumn("turn", F.xxhash64(F.lit(seed + 2), "number", "block", "epoch")).select("number", "block", "epoch", "turn", "full")
    units = keep(turns.unionByName(drawn_part).withColumn("unit", F.row_number().over(W.partitionBy("number").orderBy("epoch", "turn", "block")) - 1), "mix-units")
    quotas = sources.select("number").join(units.groupBy("number").agg(F.count("*").alias("quota")), "number", "left").fillna(0, "quota")
    ranges = split_tree(quotas, shards, seed).filter("stop > start")
    shard = ranges.select("number", "shard", F.explode(F.sequence("start", F.col("stop") - 1)).alias("unit"))
    placed = units.join(shard, ["number", "unit"])
    by_block = placed.groupBy("number", "block").agg(F.array_sort(F.collect_list(F.struct("epoch", "shard"))).alias("turns"), F.first("full").alias("full"))
    # Documents drawn one by one go with the block in which the target was reached.
    last = edge.join(placed.filter("epoch = full"), ["number", "block"]).select("number", F.col("shard").alias("edge_shard"))

    used = rows.join(by_block, ["number", "block"], "left").join(drawn.select("number", "block", "state"), ["number", "block"]).join(last, "number", "left")
    used = used.join(part.select("row", F.lit(True).alias("single")), "row", "left")
    whole = F.filter(F.coalesce("turns", F.array().cast("array<struct<epoch:int,shard:int>>")), lambda t: (t["epoch"] < F.col("full")) | (F.col("state") == "in"))
    one = F.when(F.col("single"), F.array(F.struct(F.lit(-1).alias("epoch"), F.col("edge_shard").alias("shard")))).otherwise(F.array().cast("array<struct<epoch:int,shard:int>>"))
    uses = F.transform(F.concat(whole, one), lambda t: F.struct(t["shard"].alias("shard"), F.xxhash64(F.lit(seed + 3), "key", t["epoch"]).alias("place")))
    return used.select("row", "doc_id", "source", "size", "source_size", "target", uses.alias("uses"))


def mix_report(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """A row per document: its size, its source's size and target, the words taken, the shard of each copy."""
    rows = keep(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(text).alias("size")), "mix-sizes")
    taken = (F.size("uses") * F.col("size")).cast("long")
    return plan(rows, **options).select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.col("uses.shard").alias("shards"))


def mix(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: the input's columns, a row per copy, in shard and place order within tasks."""
    base = keep_numbered(docs.select(F.struct(*docs.columns).alias("doc")), "mix-docs")
    rows = base.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.source").cast("string").alias("source"), size_of(f"doc.{text}").alias("size"))
    used = plan(keep(rows, "mix-sizes"), **options).select(F.shiftright("row", 33).alias("part"), "row", F.explode("uses").alias("use"))
    copies = base.join(used, ["part", "row"]).sortWithinPartitions("use.shard", "use.place")
    return copies.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
