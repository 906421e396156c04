"""A Merkle manifest of a dataset: a digest per row, one per group, one for all, and proofs that Spark climbs.

Rows are leaves, ordered by id in their group. Every ``ARITY`` consecutive nodes
become the digest of their run until one node is left, the group's subroot; subroots,
ordered by group, become the root in the same way. Building goes up ``STEP`` levels at a
time: a *node row* holds the members of all runs of that many levels below one node, and
the id of the node row above. All node rows are written to the shared folder.

Proofs come from one recursive query over these rows: it starts with every leaf, meets
the leaf's node row, folds the leaf's digest with its siblings up to the top of that row,
appends these siblings as a row of the result and goes on at the parent, up to the root.
Above a few levels all leaves of a group meet the same node rows, so each is written once for
every ``WINDOW`` consecutive leaves below it, and no key of the join holds more leaves than that.

Ranks in a group come from sorted ranges of rows and the number of rows of each range; no
task sees a whole group.

Edge cases: null fields count as ``-``, so a null source is a group, the first. Null ids
come first in their group; equal ids are ordered by their leaf, and equal rows are leaves
of their own. A single row is its own root and its proof is the digest of nothing. An
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import keep

ARITY, STEP, WINDOW = 3, 3, 3**9
#: Members of the lowest level of one node row.
SPAN = ARITY**STEP
HEX = 64
#: Node ids: number of the first leaf (of the first subroot above them), then the height; heights above subroots start here.
HEIGHTS, ABOVE = 128, 64


def field(c: Column) -> Column:
    """A value as the digests read it: its length in bytes, a colon and itself; ``-`` if null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def numbered(df: DataFrame, label: str, *order: str) -> DataFrame:
    """``df`` with ``number``: 0, 1, 2, ... in the given order, nulls first."""
    at = F.monotonically_increasing_id()
    rows = keep(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at), label)
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row for each task that wrote rows: a bound that allows both the window and the broadcast.
    before = keep(sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before")), label + "-parts")
    found = rows.withColumn("part", part).join(F.broadcast(before), "part")
    return found.withColumn("number", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "part", "before")


def levels(n: Column) -> Column:
    """How often n nodes must be grouped until one is left."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**k).cast("long") for k in range(39)]), lambda x: x < n))


def one_up(members: Column) -> Column:
    """The digests of the runs of members, both as hex text."""
    run = ARITY * HEX
    last = F.floor((F.length(members) - 1) / run).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda r: F.sha2(F.substr(members, r * run + 1, F.lit(run)), 256)), "")


def _node_rows(nodes: DataFrame, height: int, base: int) -> DataFrame:
    """Node rows over nodes (tree, above, place_above, at, hash, lo, hi, todo).

    ``tree`` is the number of the tree's first leaf, ``at`` the node's place in its level,
    ``lo`` and ``hi`` the leaves below it, ``todo`` the levels still to build, ``above`` and
    ``place_above`` where the tree's top hangs.
    """
    block = F.floor(F.col("at") / SPAN)
    keys = ["tree", "above", "place_above", "todo"]
    members = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda x: F.lower(F.hex(x["hash"]))), "")
    rows = nodes.groupBy(*keys, block.alias("at")).agg(members.alias("m0"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    rows = rows.withColumn("up", F.least("todo", F.lit(STEP)))
    for k in range(1, STEP + 1):
        rows = rows.withColumn(f"m{k}", F.when(F.col("up") >= k, one_up(F.col(f"m{k - 1}"))))
    top = F.coalesce(*[F.col(f"m{k}") for k in range(STEP, 0, -1)])
    more = F.col("todo") > F.col("up")
    first = lambda h, at: (F.col("tree") + at * SPAN**h) * HEIGHTS + base + h
    return rows.select(
        *keys[:3], "at", F.unhex(top).alias("hash"), "lo", "hi", (F.col("todo") - F.col("up")).alias("todo"), "up",
        first(height, F.col("at")).alias("id"),
        F.when(more, first(height + 1, F.floor(F.col("at") / SPAN))).otherwise(F.col("above")).alias("parent"),
        F.when(more, F.col("at") % SPAN).otherwise(F.col("place_above")).cast("int").alias("place"),
        *[F.unhex(f"m{k}").alias(f"m{k}") for k in range(STEP)],
    )


def build(nodes: DataFrame, label: str, base: int) -> tuple[list[DataFrame], DataFrame]:
    """All node rows above ``nodes``, as written tables, and the tops (tree, hash, lo, hi) of all trees."""
    carried = ["tree", "above", "place_above", "at", "hash", "lo", "hi", "todo"]
    made, tops, height = [], [nodes.filter("todo = 0").select("tree", "hash", "lo", "hi")], 1
    while True:
        rows = keep(_node_rows(nodes.filter("todo > 0").select(*carried), height, base), f"{label}-{height}")
        most = rows.agg(F.max("todo")).first()[0]
        if most is None:
            break
        made.append(rows)
        tops.append(rows.filter("todo = 0").select("tree", "hash", "lo", "hi"))
        if most == 0:
            break
        nodes, height = rows, height + 1
    top = tops[0]
    for t in tops[1:]:
        top = top.union(t)
    return made, top


def _level(k: int) -> tuple[str, str]:
    """(siblings, folded) at level k of a node row, in SQL; the place counts members of its lowest level."""
    at = f"(q div {ARITY**k})" if k else "q"
    mine, member = f"f{k}", HEX // 2
    left = f"substring(m{k}, {member * ARITY} * ({at} div {ARITY}) + 1, {member} * ({at} % {ARITY}))"
    right = f"substring(m{k}, {member} * {at} + {member + 1}, {member} * ({ARITY - 1} - {at} % {ARITY}))"
    siblings = f"if(up > {k}, concat({left}, {right}), X'')"
    fold = f"if(up > {k}, unhex(sha2(lower(hex(concat({left}, {mine}, {right}))), 256)), {mine})"
    return siblings, fold


def climb_sql() -> str:
    """The recursive query; {leaves} has (number, node, place, folded), {nodes} the node rows by window."""
    inner = f"""SELECT c.number, c.step, c.place AS q, c.folded AS f0, n.parent, n.place, n.up, {", ".join(f"n.m{k}" for k in range(STEP))}
        FROM climb c JOIN {{nodes}} n ON c.node = n.id AND c.number div {WINDOW} = n.window"""
    for k in range(STEP):
        siblings, fold = _level(k)
        inner = f"SELECT *, {siblings} AS s{k}, {fold} AS f{k + 1} FROM ({inner})"
    all_siblings = ", ".join(f"s{k}" for k in range(STEP))
    return f"""
    WITH RECURSIVE climb(number, step, node, place, folded, siblings) AS (
      SELECT number, 0, node, place, folded, X'' FROM {{leaves}}
      UNION ALL
      SELECT number, step + 1, parent, place, f{STEP}, concat({all_siblings}) FROM ({inner})
    )
    SELECT number, step, folded, siblings FROM climb"""


@contextmanager
def unlimited_recursion(spark: SparkSession):
    """A recursive query returns more rows than Spark's guard against endless ones allows."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def climb(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(number, siblings as hex text, folded) of every leaf of (number, node, place, folded)."""
    spark = leaves.sparkSession
    with unlimited_recursion(spark):
        ways = keep(spark.sql(climb_sql(), leaves=leaves, nodes=nodes), "merkle-climb")
    steps = F.array_sort(F.collect_list(F.struct("step", "siblings")))
    text = F.array_join(F.transform(steps, lambda s: F.lower(F.hex(s["siblings"]))), "")
    return ways.groupBy("number").agg(text.alias("siblings"), F.max_by("folded", "step").alias("folded"))


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), tampered: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, siblings, folded_root, verified) of every row, under the name of its id.

    ``siblings`` is the proof: the digests, as hex text, that lead from the leaf to the root.
    ``tampered`` gives what a reader found in place of a field; the proof is folded with it.
    """
    spark = docs.sparkSession
    read = [(tampered or {}).get(f, F.col(f)) for f in fields]
    leaves = docs.select(
        F.col(doc_id).alias("id"), F.col(group).cast("string").alias("tree_of"),
        F.unhex(digest(*[F.col(f) for f in fields])).alias("hash"), F.unhex(digest(*read)).alias("found"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written before they are ordered: their row numbers no longer change when a task runs again.
    leaves = numbered(keep(leaves, "merkle-leaves"), "merkle-numbered", "tree_of", "id", "hash", "row").drop("row")
    trees = leaves.groupBy("tree_of").agg(F.min("number").alias("tree"), F.count("*").alias("n"))
    trees = keep(numbered(trees, "merkle-trees", "tree_of").withColumnRenamed("number", "at_above"), "merkle-trees")
    n_trees = trees.count()
    above = F.floor(F.col("at_above") / SPAN) * SPAN * HEIGHTS + ABOVE + 1
    hang = trees.select(
        F.col("tree_of").alias("of"), "tree", "n", levels(F.col("n")).alias("todo"),
        (above if n_trees > 1 else F.lit(None)).cast("long").alias("above"),
        ((F.col("at_above") % SPAN) if n_trees > 1 else F.lit(None)).cast("int").alias("place_above"),
    )
    leaves = leaves.join(hang, F.col("tree_of").eqNullSafe(F.col("of"))).withColumn("at", F.col("number") - F.col("tree"))
    leaves = keep(leaves.withColumns({"lo": F.col("number"), "hi": F.col("number")}).drop("of", "tree_of"), "merkle-placed")
    made, subroots = build(leaves, "merkle-nodes", 0)
    tops = subroots.join(trees.select("tree", "at_above"), "tree")
    none = F.lit(None)
    tops = keep(tops.select(
        F.lit(0).cast("long").alias("tree"), none.cast("long").alias("above"), none.cast("int").alias("place_above"),
        F.col("at_above").alias("at"), "hash", "lo", "hi", levels(F.lit(n_trees)).alias("todo"), F.col("tree").alias("of"),
    ), "merkle-subroots")
    made_above, root = build(tops, "merkle-top", ABOVE)
    root = root.first()
    nodes = None
    for rows in made + made_above:
        rows = rows.select("id", "up", "parent", "place", *[f"m{k}" for k in range(STEP)], F.explode(F.sequence(F.floor(F.col("lo") / WINDOW), F.floor(F.col("hi") / WINDOW))).alias("window"))
        nodes = rows if nodes is None else nodes.union(rows)
    first = (F.col("tree") + F.floor(F.col("at") / SPAN) * SPAN) * HEIGHTS + 1
    start = leaves.select(
        "number", F.when(F.col("todo") > 0, first).otherwise(F.col("above")).alias("node"),
        F.when(F.col("todo") > 0, F.col("at") % SPAN).otherwise(F.col("place_above")).cast("int").alias("place"), F.col("found").alias("folded"),
    )
    if nodes is None:  # one row, or none
        proofs = start.select("number", F.lit("").alias("siblings"), "folded")
    else:
        proofs = climb(start, keep(nodes, "merkle-windows"))
    text = lambda c: F.lower(F.hex(c))
    subroot = tops.select(F.col("of").alias("tree"), F.col("hash").alias("subroot"))
    out = leaves.select("number", "tree", "id", "hash").join(proofs, "number").join(subroot, "tree")
    whole = F.lit(bytes(root["hash"]).hex() if root else None)
    return out.select(
        F.col("id").alias(doc_id), text("hash").alias("leaf"), text("subroot").alias("subroot"), whole.alias("root"), "siblings",
        text("folded").alias("folded_root"), (text("folded") == whole).alias("verified"),
    )
