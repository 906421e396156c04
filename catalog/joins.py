"""Lookups, hierarchies, semi and anti joins, unions and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.functions import suffix
from formfold.operators import (
    drop_null,
    explode_roles,
    fill,
    hierarchy,
    join_any_key,
    join_app,
    keep_known,
    left_lookup,
    melt,
    melted_keys,
    merge_reports,
    natural,
    new_rows,
    outer,
    pivot,
    split_null,
    spread_join,
    union_all,
    union_branches,
    union_many,
    with_missing,
)

from . import derive
from .checks import LOCATED
from .registry import query, table


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_extendedprice', l_extendedprice FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount', l_discount FROM lineitem"""
)
def unpivot_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return melt(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_partkey"],
        ["l_quantity", "l_extendedprice", "l_discount"],
    )


@query(
    """SELECT o_custkey, min(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS "F",
        min(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS "O",
        min(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS "P"
    FROM orders GROUP BY ALL"""
)
def pivot_status_first(spark: SparkSession, sf: str) -> DataFrame:
    return pivot(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus", ["F", "O", "P"],
        [F.min("o_orderpriority")],
    )


@query(
    f"""WITH {LOCATED}
    SELECT k AS submission_id, r_name AS state_name, n_name AS district_name, c_name AS school_name
    FROM located"""
)
def melt_join_pivot_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Location ids melted to rows, named by one equi-join, and pivoted back."""
    subs = derive.located_orders(spark, sf).selectExpr(
        "o_orderkey AS submission_id", "concat('loc-r', n_regionkey) AS state",
        "concat('code-n', n_nationkey) AS district", "concat('loc-c', o_custkey) AS school",
    )
    ids = melt(subs, ["submission_id"], ["state", "district", "school"], "entity_type", "key")
    named = left_lookup(ids, derive.entity_table(spark, sf), ["entity_type", "key"])
    flagged = named.withColumn("flag", suffix("entity_type", "_name"))
    names = ["state_name", "district_name", "school_name"]
    return pivot(flagged, ["submission_id"], "flag", names, [F.min("entity_name")])


@query(
    """SELECT s_suppkey, s_name, n_name AS district_name, r_name AS state_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE n_nationkey % 4 <> 0"""
)
def hierarchy_inner(spark: SparkSession, sf: str) -> DataFrame:
    """Names per level; a level that must exist drops unmatched rows."""
    nations = table(spark, sf, "nation").filter("n_nationkey % 4 <> 0")
    keys = union_many([
        nations.selectExpr("'district' AS entity_type", "cast(n_nationkey as string) AS key",
                           "cast(n_nationkey as string) AS entity_id", "n_name AS entity_name"),
        table(spark, sf, "region").selectExpr(
            "'state' AS entity_type", "cast(r_regionkey as string) AS key",
            "cast(r_regionkey as string) AS entity_id", "r_name AS entity_name"),
    ])
    rows = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.expr("s_nationkey = n_nationkey")
    ).selectExpr("s_suppkey", "s_name", "cast(n_nationkey as string) AS district_externalId",
                 "cast(n_regionkey as string) AS state_externalId")
    named = hierarchy(rows, keys, ["state", "district"], require=["district"])
    return drop_null(named, ["state_name"]).select("s_suppkey", "s_name", "district_name", "state_name")


@query(
    """SELECT coalesce(a.k, b.k) AS k, n_orders, n_returned FROM
        (SELECT o_custkey % 1000 AS k, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) a
        FULL JOIN (SELECT l_suppkey AS k, count(*) AS n_returned FROM lineitem
            WHERE l_returnflag = 'R' GROUP BY ALL) b ON a.k = b.k
    WHERE n_orders IS NOT NULL OR n_returned IS NOT NULL"""
)
def outer_join_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of two sources side by side; a key may be in either."""
    a = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(
        F.expr("o_custkey % 1000").alias("k")).agg(F.count("*").alias("n_orders"))
    b = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy(
        F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n_returned"))
    return outer(a, b, ["k"])


@query(
    """SELECT o_orderkey, 'known' AS kind FROM orders
        WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    UNION ALL SELECT o_orderkey, 'new' FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')"""
)
def semi_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a known key and rows with a new one."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").selectExpr(
        "l_orderkey AS o_orderkey")
    known = keep_known(orders, returned, "o_orderkey").withColumn("kind", F.lit("known"))
    new = new_rows(orders, returned, "o_orderkey").withColumn("kind", F.lit("new"))
    return union_all(known, new)


@query(
    """SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
        AND (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH')"""
)
def or_join_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Users joined to rows of two apps only."""
    rows = join_app(
        table(spark, sf, "orders"), table(spark, sf, "customer"), "o_custkey", "c_custkey",
        "o_orderpriority", ["1-URGENT", "2-HIGH"],
    )
    return rows.select("o_orderkey", "c_name")


@query(
    """WITH dims AS (SELECT n_nationkey, n_name, concat('K', n_nationkey) AS id,
            CASE WHEN n_nationkey % 2 = 0 THEN concat('K', n_nationkey)
                ELSE concat('C', n_nationkey) END AS code FROM nation),
        facts AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN concat('K', c_nationkey)
            ELSE concat('C', c_nationkey) END AS key FROM customer)
    SELECT c_custkey, n_name FROM facts JOIN dims ON id = key OR code = key"""
)
def any_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """A key that may be the id or the code of the dimension row."""
    dims = table(spark, sf, "nation").selectExpr(
        "n_name", "concat('K', n_nationkey) AS id",
        "if(n_nationkey % 2 = 0, concat('K', n_nationkey), concat('C', n_nationkey)) AS code")
    facts = table(spark, sf, "customer").selectExpr(
        "c_custkey", "if(c_custkey % 2 = 0, concat('K', c_nationkey), concat('C', c_nationkey)) AS key")
    return join_any_key(facts, dims, "key", ["id", "code"]).select("c_custkey", "n_name")


@query(
    """WITH dims AS (SELECT DISTINCT p_partkey % 50 AS n FROM part)
    SELECT DISTINCT concat('id', n) AS id, key FROM (
        SELECT n, concat('id', n) AS key FROM dims
        UNION ALL SELECT n, concat('code', n) FROM dims WHERE n % 3 <> 0)"""
)
def melted_entity_keys(spark: SparkSession, sf: str) -> DataFrame:
    """One row per dimension row and key, without repeats or nulls."""
    dims = table(spark, sf, "part").selectExpr("p_partkey % 50 AS n").distinct().selectExpr(
        "concat('id', n) AS id", "concat('id', n) AS location",
        "CASE n % 3 WHEN 0 THEN null ELSE concat('code', n) END AS code")
    return melted_keys(dims, ["location", "code", "location"], "key").select("id", "key")


@query(
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS user_id, c_mktsegment AS board,
        CASE WHEN c_custkey IS NOT NULL THEN concat('org', c_nationkey) END AS orgname
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"""
)
def user_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """User details joined from a user dimension; unknown users keep their rows."""
    users = table(spark, sf, "customer").filter("c_acctbal > 0").selectExpr(
        "cast(c_custkey as string) AS user_id", "concat('org', c_nationkey) AS orgname",
        "c_mktsegment AS board")
    subs = table(spark, sf, "orders").selectExpr("o_orderkey", "cast(o_custkey as string) AS user_id")
    return left_lookup(subs, users, "user_id")


@query(
    """SELECT c_custkey, coalesce(seg, '') AS segment, c_name, n_orders FROM
        (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer) a
        JOIN (SELECT o_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg2,
            count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) b
        ON c_custkey = o_custkey AND coalesce(seg, '') = coalesce(seg2, '')"""
)
def merge_two_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Two reports joined on all shared columns, blanks matching blanks."""
    users = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "if(c_custkey % 3 = 0, null, c_mktsegment) AS segment")
    progress = table(spark, sf, "orders").join(
        users.select("c_custkey", "segment"), F.expr("o_custkey = c_custkey")
    ).groupBy("c_custkey", "segment").agg(F.count("*").alias("n_orders"))
    return merge_reports(users, progress, ["c_custkey", "segment"])


@query("SELECT n_nationkey, n_name, n_regionkey, s_suppkey FROM nation JOIN supplier ON s_nationkey = n_nationkey")
def natural_join(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").selectExpr("s_nationkey AS n_nationkey", "s_suppkey")
    return natural(table(spark, sf, "nation"), suppliers)


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment FROM customer"""
)
def union_null_branch(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with and without a value handled apart, then put together with typed nulls."""
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "if(c_acctbal > 0, c_mktsegment, null) AS segment")
    without, present = split_null(rows, "segment")
    return union_branches(present, with_missing(without.drop("segment"), {"segment": "string"}))


@query(
    """SELECT r_name AS name, 'state' AS kind, CAST(NULL AS VARCHAR) AS parent FROM region
    UNION ALL SELECT n_name, 'district', r_name FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT c_name, 'school', n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def union_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Several frames with different columns in one."""
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    return union_many([
        region.selectExpr("r_name AS name", "'state' AS kind"),
        nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
            "r_name AS parent", "n_name AS name", "'district' AS kind"),
        table(spark, sf, "customer").join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
            "c_name AS name", "n_name AS parent", "'school' AS kind"),
    ])


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS "userId", concat('role', r) AS "roleId", concat('R', r) AS "roleCode",
        CASE WHEN (c_custkey + r) % 3 = 0 THEN NULL ELSE e END AS "entityId"
    FROM (SELECT c_custkey, r, unnest(CASE WHEN (c_custkey + r) % 3 = 0 THEN ['x']
            WHEN (c_custkey + r) % 3 = 1 THEN ['e1'] ELSE ['e1', 'e2'] END) AS e
        FROM (SELECT c_custkey, unnest(range(1, c_custkey % 3 + 1)) AS r FROM customer))"""
)
def role_entity_explode(spark: SparkSession, sf: str) -> DataFrame:
    """User x role x entity; a role without entities keeps a row."""
    users = table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) AS userId",
        """transform(if(c_custkey % 3 > 0, sequence(1, cast(c_custkey % 3 as int)), array()), r -> named_struct(
            'roleId', concat('role', r), 'code', concat('R', r), 'entities',
            CASE (c_custkey + r) % 3 WHEN 0 THEN if(r = 1, array(), cast(null as array<string>))
                WHEN 1 THEN array('e1') ELSE array('e1', 'e2') END)) AS roles""")
    return explode_roles(users)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, n_lines FROM lineitem
    JOIN (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY ALL) USING (l_partkey)"""
)
def spread_join_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Join back to a per-key table with hot keys split."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    counts = rows.groupBy("l_partkey").agg(F.count("*").alias("n_lines"))
    per_key = counts.withColumnRenamed("n_lines", "n")
    return spread_join(rows, counts, ["l_partkey"], per_key)


@query(
    """SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_brand END, 'none') AS brand,
        coalesce(CASE WHEN p_size % 2 = 0 THEN p_size END, 0) AS size FROM part"""
)
def null_fill(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").selectExpr(
        "p_partkey", "if(p_size > 25, p_brand, null) AS brand", "if(p_size % 2 = 0, p_size, null) AS size")
    return fill(fill(parts, "none", ["brand"]), 0, ["size"])
