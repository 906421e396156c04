"""Counts, maxima, latest rows and metric reports over the flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.functions import ratio
from formfold.operators import (
    count_by,
    distinct,
    distinct_by,
    distinct_report,
    first_by,
    head,
    latest,
    max_by_key,
    n_rows,
    relabel,
    rows_at_max,
    sort,
    top,
    users_by_month,
    values,
    with_name,
)
from formfold.plans import courses, metrics, social, status

from . import derive
from .checks import LOCATED
from .registry import query, table

DAY = "yyyy-MM-dd"


@query(
    """SELECT r_name AS state_name, n_name AS district_name,
        count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS completed_submissions,
        count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS completing_users,
        count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS starting_users,
        count(DISTINCT o_custkey) AS unique_users
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""
)
def metric_cond_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional distinct counts per state and district, names joined from dimensions."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    users = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf, "nation")
    rows = with_name(
        orders.join(users, "o_custkey"), nations, "n_nationkey", "district_name", "n_nationkey", "n_name"
    )
    rows = with_name(
        rows.join(nations.select("n_nationkey", "n_regionkey"), "n_nationkey"),
        table(spark, sf, "region"), "n_regionkey", "state_name", "r_regionkey", "r_name",
    )
    done, started = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    return distinct_report(
        rows,
        ["state_name", "district_name"],
        {
            "completed_submissions": ("o_orderkey", done),
            "completing_users": ("o_custkey", done),
            "starting_users": ("o_custkey", started),
            "unique_users": ("o_custkey", None),
        },
    )


@query(
    f"""WITH {LOCATED}
    SELECT concat('Program ', c % 7) AS program_name, concat('Solution ', k % 6) AS solution_name,
        n_name AS district_name,
        count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN c END) AS "Unique Users who submitted form",
        count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN k END) AS "Total submissions",
        count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN c END) AS "Unique Users who started form",
        count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN c END) AS "Total entities observed"
    FROM located GROUP BY ALL"""
)
def form_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Form usage per program, solution and district."""
    subs = derive.observations(spark, sf).select(
        F.col("_id").alias("submission_id"), "status", "createdBy", "entityId",
        "solutionId", "programId", F.col("userRoleInformation.district").alias("district"),
    )
    subs = with_name(subs, derive.programs(spark, sf), "programId", "program_name")
    subs = with_name(subs, derive.solutions(spark, sf), "solutionId", "solution_name")
    names = table(spark, sf, "nation").selectExpr(
        "concat('code-n', n_nationkey) AS district", "n_name AS district_name"
    )
    return status.form_metrics(subs, names)


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers,
        min(l_shipdate)::VARCHAR AS first_ship, max(l_quantity) AS most
    FROM lineitem GROUP BY ALL"""
)
def group_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, distinct counts, first and largest values per group, in one pass."""
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("first_ship"),
        F.max("l_quantity").alias("most"),
    )


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ALL")
def distinct_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_by(table(spark, sf, "lineitem"), ["l_partkey"], "l_suppkey", "suppliers")


@query("SELECT o_custkey, min(o_orderpriority) AS priority FROM orders GROUP BY ALL")
def first_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return first_by(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "priority")


@query("SELECT o_custkey, max(o_totalprice) AS most FROM orders GROUP BY ALL")
def max_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return max_by_key(table(spark, sf, "orders"), ["o_custkey"], "o_totalprice", "most")


@query(
    """SELECT l_orderkey, l_partkey, l_quantity, l_shipdate::VARCHAR AS shipped, most FROM (
        SELECT *, max(l_quantity) OVER (PARTITION BY l_partkey) AS most FROM lineitem)
    WHERE l_quantity = most"""
)
def max_row_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """All rows that tie at the largest quantity of their part."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"),
    )
    return rows_at_max(rows, ["l_partkey"], "l_quantity", "most")


@query(
    """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM orders) WHERE rn = 1"""
)
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = latest(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return rows.select(
        "o_custkey", "o_orderkey", F.date_format("o_orderdate", DAY).alias("day"), "o_orderpriority"
    )


_COURSE_EVENTS = """scanned AS (
    SELECT concat('Course ', user_id % 5) AS course, concat('Batch ', user_id % 2) AS batch,
        concat('User ', user_id) AS learner, CAST((event_id * 7) % 4 * 25 AS DOUBLE) AS progress,
        event_type AS resource, CAST(event_id % 101 AS DOUBLE) AS resource_progress,
        date_trunc('second', ts) AS tm, CAST(user_id AS VARCHAR) AS user_id,
        concat('login', user_id) AS login_id
    FROM events WHERE event_id % 50 <> 0 AND user_id % 19 <> 0)"""


@query(
    f"""WITH {_COURSE_EVENTS},
    ranked AS (
        SELECT *, rank() OVER (PARTITION BY course, resource, user_id ORDER BY progress DESC) AS r,
            max(tm) OVER (PARTITION BY course, user_id) AS finished FROM scanned)
    SELECT DISTINCT course, batch, learner, resource, resource_progress,
        strftime(tm, '%Y-%m-%d %H:%M:%S') AS resource_completed_at, login_id, user_id,
        progress AS course_progress, strftime(finished, '%Y-%m-%d %H:%M:%S') AS course_completed_at
    FROM ranked WHERE r = 1"""
)
def course_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Rows at each learner's best progress, from unwrapped telemetry responses."""
    rows = courses.course_progress(derive.course_scans(spark, sf))
    text = {
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        for c in ("resource_completed_at", "course_completed_at")
    }
    return rows.withColumns(text)


@query(
    """WITH scanned AS (
        SELECT concat('Course ', user_id % 5) AS course, event_type AS quiz,
            CAST(user_id AS VARCHAR) AS user_id, concat('User ', user_id) AS learner,
            CAST(event_id % 101 AS DOUBLE) AS course_progress,
            CAST((event_id * 13) % 11 AS DOUBLE) AS quiz_progress, date_trunc('second', ts) AS tm
        FROM events),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY course, quiz, user_id
            ORDER BY quiz_progress DESC, tm DESC, learner, course_progress) AS rn FROM scanned)
    SELECT course, quiz, user_id, learner, course_progress, quiz_progress,
        strftime(tm, '%Y-%m-%d %H:%M:%S') AS completed_at FROM placed WHERE rn = 1"""
)
def quiz_progress(spark: SparkSession, sf: str) -> DataFrame:
    rows = courses.quiz_progress(derive.quiz_scans(spark, sf))
    return rows.withColumn("completed_at", F.date_format("completed_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    """SELECT CAST(user_id AS VARCHAR) AS "ActorId", 'ASSESS' AS "EventId",
        concat('Question ', event_id % 7) AS "Question", concat('course', user_id % 5) AS "CourseId",
        concat('item', event_id) AS "ObjectId",
        CASE WHEN event_id % 6 > 0 THEN CAST(event_id % 6 AS VARCHAR) END AS "Answer"
    FROM events WHERE event_type = 'click'"""
)
def quiz_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen option of assessment events, from the first filled field."""
    options = ", ".join(f"'{i}', if(event_id % 6 = {i}, 'x', null)" for i in range(1, 6))
    events = table(spark, sf, "events").selectExpr(
        "if(event_type = 'click', 'ASSESS', 'OTHER') AS eid",
        "named_struct('id', cast(user_id as string)) AS actor",
        f"""named_struct('item', named_struct('title', concat('Question ', event_id % 7)),
            'resvalues', array(named_struct({options}))) AS edata""",
        """named_struct('id', concat('item', event_id),
            'rollup', named_struct('l1', concat('course', user_id % 5))) AS object""",
    )
    return courses.quiz_answers(events).withColumn("Answer", F.col("Answer").cast("string"))


@query(
    """SELECT count(*) AS active_users FROM (
        SELECT user_id FROM events WHERE event_type = 'purchase'
        GROUP BY user_id HAVING count(*) >= 2)"""
)
def having_active_users(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").filter("event_type = 'purchase'")
    return courses.active_users(events, "user_id")


@query(
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) AS unique_users
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY ALL"""
)
def monthly_distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    return users_by_month(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "1996-01-01")


def _event_metric(name: str, filters: list[dict], aggregation: dict | None = None) -> dict:
    return {
        "metric": name,
        "druidQuery": {
            "filters": filters,
            "aggregations": [aggregation or {"name": name, "type": "count"}],
        },
    }


DAILY = {
    "metrics": [
        _event_metric("clicks", [{"type": "equals", "dimension": "event_type", "value": "click"}]),
        _event_metric(
            "entries",
            [{"type": "in", "dimension": "event_type", "values": ["signup", "purchase"]}],
        ),
        _event_metric(
            "buyers",
            [{"type": "equals", "dimension": "event_type", "value": "purchase"}],
            {"name": "buyers", "type": "countDistinct", "fieldName": "user_id"},
        ),
    ],
    "dateRange": {
        "interval": {"startDate": "2024-01-03", "endDate": "2024-01-28"},
        "granularity": "day",
    },
    "labels": {"date": "Date", "clicks": "Total Clicks"},
}

_DAILY_SQL = """
    SELECT date_trunc('day', ts) AS day,
        count(*) FILTER (event_type = 'click') AS clicks,
        count(*) FILTER (event_type IN ('signup', 'purchase')) AS entries,
        count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers
    FROM events WHERE event_type IN ('click', 'signup', 'purchase')
        AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-28'
    GROUP BY ALL"""


@query(
    f"""WITH daily AS ({_DAILY_SQL})
    SELECT strftime(day, '%Y-%m-%d') AS "Date", clicks AS "Total Clicks", entries, buyers FROM daily"""
)
def daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Several filtered counts per day from one pass over the events."""
    rows = metrics.time_metrics(table(spark, sf, "events"), DAILY)
    return rows.withColumn("Date", F.date_format("Date", DAY))


TOP_GROUPS = {
    "metrics": [
        {
            "druidQuery": {
                "filters": [{"type": "in", "dimension": "o_orderstatus", "values": ["F", "O"]}],
                "dimensions": [
                    {"fieldName": "o_custkey", "aliasName": "User"},
                    {
                        "fieldName": "o_orderstatus",
                        "aliasName": "Status",
                        "type": "extraction",
                        "extractionFn": [
                            {"type": "registeredLookup", "fn": "statuses", "retainMissingValue": True}
                        ],
                    },
                ],
                "aggregations": [
                    {"name": "orders", "type": "countDistinct", "fieldName": "o_orderkey"}
                ],
                "limitSpec": {
                    "limit": 500,
                    "columns": [{"dimension": "orders", "direction": "descending"}],
                },
            }
        }
    ],
    "labels": {"orders": "Orders"},
}


@query(
    """SELECT o_custkey AS "User", CASE o_orderstatus WHEN 'F' THEN 'done' ELSE o_orderstatus END AS "Status",
        count(DISTINCT o_orderkey) AS "Orders"
    FROM orders WHERE o_orderstatus IN ('F', 'O')
    GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 500"""
)
def topn_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Largest groups by distinct count; a dimension is shown through a lookup."""
    orders = table(spark, sf, "orders")
    names = orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderstatus").alias("key"), F.lit("done").alias("value")
    )
    return metrics.group_report(
        orders, TOP_GROUPS, "o_orderdate", lookups={"statuses": names.distinct()}
    )


GROUP_ROWS = {
    "metrics": [
        {
            "druidQuery": {
                "dimensions": [
                    {"fieldName": "o_custkey", "aliasName": "User"},
                    {
                        "fieldName": "o_orderpriority",
                        "aliasName": "Rank",
                        "type": "extraction",
                        "extractionFn": [
                            {"type": "registeredLookup", "fn": "ranks", "retainMissingValue": False}
                        ],
                    },
                ],
                "limitSpec": {
                    "limit": 1000,
                    "columns": [
                        {"dimension": "COUNT_DISTINCT(o_orderkey)", "direction": "descending"}
                    ],
                },
            }
        }
    ],
    "dateRange": {"interval": {"startDate": "1996-01-01", "endDate": "2000-01-01"}},
}


@query(
    """SELECT "User", "Rank" FROM (
        SELECT o_custkey AS "User", CASE WHEN o_orderpriority < '3' THEN 'urgent'
            WHEN o_orderpriority < '5' THEN 'normal' END AS "Rank", count(DISTINCT o_orderkey) AS n
        FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
        GROUP BY ALL)
    ORDER BY n DESC, 1, 2 NULLS FIRST LIMIT 1000"""
)
def topn_merged_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups under looked-up names, ordered by a distinct count that is not shown."""
    orders = table(spark, sf, "orders")
    ranks = orders.select("o_orderpriority").distinct().filter("o_orderpriority < '5'").selectExpr(
        "o_orderpriority AS key", "if(o_orderpriority < '3', 'urgent', 'normal') AS value")
    return metrics.group_report(orders, GROUP_ROWS, "o_orderdate", lookups={"ranks": ranks})


@query(
    f"""WITH daily AS ({_DAILY_SQL})
    SELECT strftime(day, '%d-%m-%Y') AS "Date", entries,
        CASE WHEN day < DATE '2024-01-15' THEN 'old' ELSE 'new' END AS run
    FROM daily WHERE day > (SELECT max(day) FROM daily) - INTERVAL 2 WEEK"""
)
def rollup_merge_text_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge on formatted dates, as report files hold them."""
    daily = metrics.time_metrics(table(spark, sf, "events"), {**DAILY, "labels": {}})
    shown = F.date_format("date", "dd-MM-yyyy").alias("Date")
    old = daily.filter("date < '2024-01-18'").select(shown, "entries", F.lit("old").alias("run"))
    new = daily.filter("date >= '2024-01-15'").select(shown, "entries", F.lit("new").alias("run"))
    merge = {"rollup": 1, "rollupAge": "WEEK", "rollupRange": 2, "rollupCol": "Date||%d-%m-%Y"}
    return metrics.rollup_merge(old, new, merge)


@query(
    f"""WITH daily AS ({_DAILY_SQL}),
    previous AS (SELECT day, clicks - 1 AS clicks FROM daily WHERE day < DATE '2024-01-20'),
    new AS (SELECT day, clicks FROM daily WHERE day >= DATE '2024-01-15'),
    merged AS (SELECT * FROM previous p WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.day = p.day)
        UNION ALL SELECT * FROM new)
    SELECT strftime(day, '%Y-%m-%d') AS date, clicks FROM merged
    WHERE day > (SELECT max(day) FROM merged) - INTERVAL 14 DAY"""
)
def rollup_merge(spark: SparkSession, sf: str) -> DataFrame:
    """New days replace old ones; only the newest fourteen stay."""
    daily = metrics.time_metrics(table(spark, sf, "events"), {**DAILY, "labels": {}})
    daily = daily.select("date", "clicks")
    previous = daily.filter("date < '2024-01-20'").withColumn("clicks", F.col("clicks") - 1)
    new = daily.filter("date >= '2024-01-15'")
    merge = {"rollup": 1, "rollupAge": "DAY", "rollupRange": 14, "rollupCol": "date"}
    rows = metrics.rollup_merge(previous, new, merge)
    return rows.withColumn("date", F.date_format("date", DAY))


@query(
    """WITH days AS (
        SELECT user_id AS page_id, date_trunc('day', ts) AS day, count(*) AS total
        FROM events GROUP BY ALL)
    SELECT page_id, strftime(day, '%Y-%m-%d') AS page_date, total AS page_total_followers,
        coalesce(total - lag(total) OVER (PARTITION BY page_id ORDER BY day), 0) AS page_new_followers
    FROM days"""
)
def follower_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Daily change of a page's total."""
    days = table(spark, sf, "events").groupBy(
        F.col("user_id").alias("page_id"), F.to_date("ts").alias("page_date")
    ).agg(F.count("*").alias("page_total_followers"))
    return social.page_growth(days).withColumn("page_date", F.date_format("page_date", DAY))


@query(
    """SELECT user_id, n_click, n_view, CASE WHEN n_click <> 0 AND n_view <> 0
        THEN round(n_click / n_view, 6) END AS ctr FROM (
        SELECT user_id, count(*) FILTER (event_type = 'click') AS n_click,
            count(*) FILTER (event_type = 'view') AS n_view FROM events GROUP BY ALL)"""
)
def ctr_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Click rate per user."""
    counts = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("n_click"),
        F.count_if(F.col("event_type") == "view").alias("n_view"),
    )
    return counts.withColumn("ctr", F.round(ratio("n_click", "n_view"), 6))


_POST_DAYS = """
    named_struct('start', cast(event_id * 60000 as bigint),
        'end', cast(event_id * 60000 + 86400000 as bigint)) AS timeRange"""


@query(
    """SELECT CAST(event_id AS VARCHAR) AS post_id, CAST(user_id % 10 AS VARCHAR) AS page_id,
        concat('group', user_id % 10 % 2) AS cluster_id,
        strftime(make_timestamp(event_id * 60000 * 1000), '%Y-%m-%d') AS post_start_date,
        strftime(make_timestamp((event_id * 60000 + 86400000) * 1000), '%Y-%m-%d') AS post_end_date,
        event_id % 9 AS m1,
        CASE WHEN user_id % 10 % 2 = 0 THEN event_id % 5 ELSE event_id % 4 END AS m2,
        -1::BIGINT AS m3,
        CASE WHEN event_id % 5 <> 0 AND event_id % 4 <> 0
            THEN round((event_id % 5) / (event_id % 4), 6) END AS post_ctr
    FROM events"""
)
def post_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics chosen per page in ordered slots; missing names are skipped."""
    events = table(spark, sf, "events")
    days = events.selectExpr(
        "concat('urn:post:', event_id) AS share",
        "concat('urn:page:', user_id % 10) AS organizationalEntity",
        _POST_DAYS,
        """map('likeCount', event_id % 9, 'clickCount', event_id % 5,
            'impressionCount', event_id % 4) AS totalShareStatistics""",
    )
    groups = events.selectExpr("user_id % 10 AS p").distinct().selectExpr(
        "cast(p as string) AS page_id", "concat('group', p % 2) AS cluster_id",
        """array('likeCount', null, if(p % 2 = 0, 'clickCount', 'impressionCount')) AS names""",
    )
    rows = social.post_metrics(days, groups)
    return rows.select(
        "post_id", "page_id", "cluster_id", "post_start_date", "post_end_date", "m1", "m2",
        F.coalesce("m3", F.lit(-1).cast("bigint")).alias("m3"),
        F.round("post_ctr", 6).alias("post_ctr"),
    )


@query(
    """SELECT CAST(user_id AS VARCHAR) AS page_id, event_id % 7 + event_id % 3 AS new_followers,
        strftime(make_timestamp(event_id * 60000 * 1000), '%Y-%m-%d') AS start_date,
        strftime(make_timestamp((event_id * 60000 + 86400000) * 1000), '%Y-%m-%d') AS end_date,
        user_id + 3 AS followers
    FROM events"""
)
def follower_gains(spark: SparkSession, sf: str) -> DataFrame:
    """Gains per page and period beside the page's total."""
    events = table(spark, sf, "events")
    gains = events.selectExpr(
        "concat('urn:page:', user_id) AS organizationalEntity", _POST_DAYS,
        """named_struct('organicFollowerGain', event_id % 7,
            'paidFollowerGain', event_id % 3) AS followerGains""",
    )
    counts = events.select("user_id").distinct().selectExpr(
        "concat('urn:page:', user_id) AS organizationalEntity",
        """array(named_struct('followerCounts', named_struct(
                'organicFollowerCount', user_id, 'paidFollowerCount', cast(1 as bigint))),
            named_struct('followerCounts', named_struct('organicFollowerCount', cast(2 as bigint),
                'paidFollowerCount', cast(null as bigint)))) AS followerCountsByAssociationType""",
    )
    return social.follower_gains(gains, counts)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS post_id,
        strftime(make_timestamp(o_orderkey * 3723000 * 1000), '%Y-%m-%d') AS date_column,
        strftime(make_timestamp(o_orderkey * 3723000 * 1000), '%H:%M:%S') AS time_column
    FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def new_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts not seen before, with date and time from milliseconds."""
    posts = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) AS post_id", "o_orderkey * 3723000 AS created_ms"
    )
    known = table(spark, sf, "lineitem").selectExpr("cast(l_orderkey as string) AS post_id")
    return social.new_posts(posts, known)


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return distinct(table(spark, sf, "part").select("p_brand", "p_type"))


@query(
    """SELECT 'priority' AS kind, o_orderpriority AS value, (SELECT count(*) FROM orders) AS total
    FROM orders GROUP BY o_orderpriority"""
)
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values of a column beside the number of rows."""
    orders = table(spark, sf, "orders")
    names = relabel(values(orders, "o_orderpriority"), {"o_orderpriority": "value"})
    total = n_rows(orders).scalar()
    return names.withColumns({"kind": F.lit("priority"), "total": total})


@query(
    """SELECT * FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL)
    ORDER BY n DESC, o_custkey LIMIT 25"""
)
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    return top(count_by(table(spark, sf, "orders"), ["o_custkey"], "n"), "n", 25, ["o_custkey"])


@query(
    """SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey LIMIT 10000"""
)
def sorted_head(spark: SparkSession, sf: str) -> DataFrame:
    """Scan limit after a sort in mixed directions."""
    rows = sort(
        table(spark, sf, "orders"),
        ["o_orderdate", "o_orderpriority", "o_orderkey"],
        [False, True, True],
    )
    day = F.date_format("o_orderdate", DAY).alias("day")
    return head(rows, 10000).select("o_orderkey", "o_orderpriority", day)


_ORDER_GROUPS = [{"fieldName": "o_orderpriority", "aliasName": "Priority"}]
TWO_METRICS = {
    "metrics": [
        {
            "druidQuery": {
                "filters": [{"type": "in", "dimension": "o_orderstatus", "values": [status]}],
                "dimensions": _ORDER_GROUPS,
                "aggregations": [{"name": name, "type": "countDistinct", "fieldName": field}],
            }
        }
        for status, name, field in (("F", "done", "o_orderkey"), ("O", "open_users", "o_custkey"))
    ]
}


@query(
    """SELECT o_orderpriority AS "Priority",
        nullif(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END), 0) AS done,
        nullif(count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END), 0) AS open_users
    FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL"""
)
def group_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Several metrics of one dimension list side by side."""
    return metrics.group_report(table(spark, sf, "orders"), TWO_METRICS, "o_orderdate")
