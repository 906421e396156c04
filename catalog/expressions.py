"""Column expressions over the flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold import functions as fn
from formfold.operators import (
    answer_types,
    contains,
    dated_only,
    explode_rows,
    matches,
    metric_slots,
    project,
    relabel,
    where,
)
from formfold.plans.answers import explode_selected, free_answer
from formfold.sources import last_days, scan

from . import derive
from .checks import LOCATED
from .registry import query, table

TS = "yyyy-MM-dd HH:mm:ss"


@query(
    """SELECT o_orderkey,
        CASE WHEN o_orderkey % 3 = 0 THEN 'false' WHEN o_orderkey % 3 = 1 THEN 'true' ELSE 'false' END AS deleted,
        CASE WHEN o_orderkey % 3 = 1 THEN 'true' WHEN o_orderkey % 3 = 2 THEN 'false' ELSE 'true' END AS private,
        CASE WHEN o_orderkey % 4 = 0 THEN 'user created project' ELSE 'project imported from library' END AS made,
        CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 THEN 'observation_with_rubric'
            ELSE 'observation_with_out_rubric' END AS kind,
        CASE WHEN o_orderkey % 5 = 0 THEN concat('Title ', o_custkey) ELSE 'Sol A' END AS title,
        CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS done,
        coalesce(lower(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END), 'survey_app') AS app,
        concat(o_orderstatus, '_name') AS label, 'fixed' AS channel,
        CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN false
            ELSE o_orderkey % 3 = 1 OR o_orderkey % 5 = 1 END AS has_evidence
    FROM orders"""
)
def flags_and_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Report flags from nullable booleans."""
    flag = F.expr("if(o_orderkey % 3 = 0, null, o_orderkey % 3 = 1)")
    task = F.expr("if(o_orderkey % 5 = 0, null, o_orderkey % 5 = 1)")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fn.flag_string(flag).alias("deleted"),
        fn.flag_string(flag, "true").alias("private"),
        fn.project_created_type(F.expr("if(o_orderkey % 4 = 0, null, 'x')")).alias("made"),
        fn.solution_type(flag, F.expr("o_orderkey % 2 = 0")).alias("kind"),
        fn.project_title(
            F.expr("if(o_orderkey % 5 = 0, null, 'Sol\\nA')"), F.expr("concat('Title\\n', o_custkey)")
        ).alias("title"),
        F.date_format(
            fn.completed_date(F.expr("if(o_orderstatus = 'F', 'submitted', o_orderstatus)"), "o_orderdate"), TS
        ).alias("done"),
        fn.app_name(F.expr("if(o_orderkey % 2 = 0, o_orderpriority, null)"), "survey_app").alias("app"),
        fn.suffix("o_orderstatus", "_name").alias("label"),
        fn.const("fixed").alias("channel"),
        fn.evidence_status(flag, task).alias("has_evidence"),
    )


@query(
    """SELECT doc_id, replace(text, chr(10), ' ') AS one_line,
        concat(' ', replace(text, chr(10), ' ')) AS joined,
        regexp_replace(source, '[0-9]+$', '') AS stripped,
        coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END, ''), 'unknown') AS language,
        concat('doc_', lang, '_', doc_id) AS slug,
        CAST(doc_id AS VARCHAR) AS last_part,
        lang || ',' || source AS both
    FROM documents"""
)
def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts on one line, names as slugs, blanks as defaults."""
    return table(spark, sf, "documents").select(
        "doc_id",
        fn.one_line("text").alias("one_line"),
        fn.join_lines("text").alias("joined"),
        fn.strip_pattern("source", "[0-9]+$").alias("stripped"),
        fn.blank_to(F.expr("if(doc_id % 2 = 0, '', lang)"), "unknown").alias("language"),
        fn.slug(F.expr("concat('  Doc ', lang, ' \\t', doc_id, ' ')")).alias("slug"),
        fn.urn_id(F.expr("concat('urn:li:share:', doc_id)")).alias("last_part"),
        fn.distinct_text(F.expr("array(lang, source, lang)")).alias("both"),
    )


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_utc,
        strftime(date_trunc('second', ts) - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS from_kolkata,
        strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS time,
        strftime(ts, '%Y-%m-%d') AS iso_day,
        CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%H:%M:%S') END AS iso_time
    FROM events"""
)
def time_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch milliseconds as text to timestamps, dates and times."""
    ms = "cast(timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as string)"
    rows = table(spark, sf, "events").selectExpr(
        "event_id", f"{ms} AS ms",
        """if(event_id % 2 = 0, date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
            date_format(ts, 'yyyy-MM-dd')) AS iso""",
    )
    return rows.select(
        "event_id",
        F.date_format(fn.ms_to_ts("ms"), TS).alias("at_utc"),
        F.date_format(fn.ms_to_ts("ms", "Asia/Kolkata"), TS).alias("from_kolkata"),
        fn.ms_to_date("ms").alias("day"),
        fn.ms_to_time("ms").alias("time"),
        fn.date_part("iso").alias("iso_day"),
        fn.time_part("iso").alias("iso_time"),
    )


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        concat('{"event_id":', event_id, ',"event_type":"', event_type, '"}') AS record
    FROM events"""
)
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text to columns, and columns to JSON text."""
    return table(spark, sf, "events").select(
        "event_id",
        fn.parse_json_as("props", "k bigint")["k"].alias("k"),
        fn.json_row("event_id", "event_type").alias("record"),
    )


@query(
    """WITH points AS (
        SELECT c_custkey, c_custkey % 80 AS lat, c_custkey % 170 AS long, c_custkey % 7 AS step,
            CAST(c_custkey % 80 AS DOUBLE) + (c_custkey % 7) * 0.0005 AS lat2 FROM customer),
    measured AS (
        SELECT *, 2 * 6371008.8 * asin(sqrt(pow(sin(radians(lat2 - lat) / 2), 2))) AS meters FROM points)
    SELECT c_custkey,
        CASE WHEN c_custkey % 10 = 0 THEN 'gps location not found for school'
            WHEN step = 6 THEN 'gps location not found for question'
            WHEN meters <= 200 THEN 'verified' ELSE 'not verified' END AS label,
        CASE WHEN c_custkey % 10 = 0 OR step = 6 THEN NULL
            ELSE CAST(CAST(floor(meters + 0.01) AS BIGINT) AS VARCHAR) END AS meters
    FROM measured"""
)
def geofence(spark: SparkSession, sf: str) -> DataFrame:
    """Distance of an answer from its school and the 200 m label."""
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 10 = 0, null, concat(c_custkey % 80, ',', c_custkey % 170)) AS school",
        """if(c_custkey % 7 = 6, 'x,y', concat(cast(c_custkey % 80 as double) + (c_custkey % 7) * 0.0005D,
            ', ', c_custkey % 170)) AS answered""",
    )
    place, here = fn.lat_long("school"), fn.lat_long("answered")
    fence = fn.geofence(place, here)
    meters = F.floor(fn.distance_in_meters(place, here) + 0.01).cast("bigint").cast("string")
    return rows.select("c_custkey", fence["label"].alias("label"), meters.alias("meters"))


@query(
    """SELECT o_orderkey, concat('a', o_orderkey % 3) AS first_item,
        CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE concat('b', o_orderkey % 3) END AS last_item,
        CASE o_orderkey % 3 WHEN 0 THEN 1 ELSE 2 END AS n,
        concat('a', o_orderkey % 3, CASE WHEN o_orderkey % 3 > 0 THEN concat(', b', o_orderkey % 3) ELSE '' END) AS joined,
        CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS place,
        CASE o_orderkey % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'High' END AS level,
        o_orderkey % 5 + o_orderkey % 7 AS total,
        concat(CASE WHEN o_orderkey % 2 = 0 THEN 'OB;' ELSE '' END, CASE WHEN o_orderkey % 3 = 0 THEN 'BL;' ELSE '' END) AS na,
        CASE WHEN o_orderkey % 5 = 0 THEN 'f' WHEN o_orderkey % 5 = 1 THEN 'http://b/f' ELSE 'f' END AS url
    FROM orders"""
)
def array_expressions(spark: SparkSession, sf: str) -> DataFrame:
    """Positions, sizes, joins and lookups inside arrays and maps."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderkey % 3 AS r", "o_orderkey % 4 AS q",
        """if(o_orderkey % 3 = 0, array('a0'), array(concat('a', o_orderkey % 3),
            concat('b', o_orderkey % 3))) AS arr""",
        "map('OB', map('S1', array('e1', 'e2', 'e3'))) AS seq",
        """map('x', named_struct('level', '0', 'label', 'Low'),
            'y', named_struct('level', '1', 'label', 'High')) AS levels""",
        """array(named_struct('a', o_orderkey % 5, 'b', cast(null as bigint)),
            named_struct('a', cast(0 as bigint), 'b', o_orderkey % 7)) AS gains""",
        """array(named_struct('name', 'OB', 'notApplicable', o_orderkey % 2 = 0),
            named_struct('name', 'BL', 'notApplicable', o_orderkey % 3 = 0)) AS methods""",
        "CASE o_orderkey % 5 WHEN 0 THEN 'link' WHEN 1 THEN 'image' END AS kind",
    )
    return rows.select(
        "o_orderkey",
        fn.item("arr").alias("first_item"),
        F.nullif(fn.last("arr"), F.lit("a0")).alias("last_item"),
        fn.n_items("arr").alias("n"),
        fn.join_array("arr", ", ").alias("joined"),
        fn.sequence_number(F.col("seq"), F.lit("OB"), F.lit("S1"), F.concat(F.lit("e"), "q"))
        .cast("string").alias("place"),
        fn.level_label(F.col("levels"), F.col("r").cast("string")).alias("level"),
        fn.sum_fields("gains", "a", "b").alias("total"),
        fn.ecm_marked_na("methods").alias("na"),
        fn.evidence_url(F.lit("f"), F.col("kind"), "http://b/").alias("url"),
    )


@query(
    """SELECT o_orderkey AS submission, concat('prefix/', o_orderkey, '/', i) AS url, n FROM (
        SELECT o_orderkey, unnest(range(1, o_orderkey % 3 + 1)) AS i, o_orderkey % 3 AS n FROM orders)"""
)
def evidence_file_urls(spark: SparkSession, sf: str) -> DataFrame:
    """File addresses of an answer joined to one text, and back to rows."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS submission",
        """transform(if(o_orderkey % 3 > 0, sequence(1, cast(o_orderkey % 3 as int)), array()),
            i -> named_struct('sourcePath', concat(o_orderkey, '/', i))) AS files""")
    urls = fn.evidence_urls("files", "prefix/", " ; ")
    n = fn.n_items("files").cast("bigint").alias("n")
    return rows.select("submission", n, F.explode(F.split(urls, " ; ")).alias("url"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_utc, event_type FROM events
    WHERE event_type IN ('click', 'purchase') AND value > 1 AND ts >= TIMESTAMP '2024-01-10'
        AND ts < TIMESTAMP '2024-01-20'"""
)
def interval_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A pruned scan of an interval; filters reach the file scan."""
    rows = scan(
        table(spark, sf, "events"), ["event_id", "ts", "event_type"],
        [F.col("event_type").isin("click", "purchase"), F.col("value") > 1],
        "ts", "2024-01-10", "2024-01-20",
    )
    return rows.select("event_id", F.date_format("ts", TS).alias("at_utc"), "event_type")


@query(
    """SELECT event_type, count(*) AS n FROM events
    WHERE ts >= TIMESTAMP '2024-01-25' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-25' GROUP BY ALL"""
)
def last_days_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = last_days(table(spark, sf, "events"), "ts", 7, "2024-01-25")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    """SELECT url, page_id AS "Page" FROM pages
    WHERE url LIKE '%example%' AND regexp_matches(url, '/[0-9]+') AND html IS NOT NULL"""
)
def text_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Substring, pattern and not-null filters, with a report label."""
    rows = dated_only(table(spark, sf, "pages"), "html")
    rows = matches(contains(where(rows, F.col("page_id") >= 0), "url", "example"), "url", "/[0-9]+")
    return relabel(rows.select("url", "page_id"), {"page_id": "Page"})


@query(
    f"""WITH {LOCATED}
    SELECT CAST(k AS VARCHAR) AS submission_id, c_name AS school, n_name AS district,
        'Program ' || c % 7 AS program FROM located"""
)
def nested_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Nested paths under report names."""
    docs = derive.projects(spark, sf).withColumn(
        "place", F.expr("named_struct('school', userProfile.userName)"))
    docs = docs.withColumn("program", fn.one_line("programInformation.name"))
    nations = table(spark, sf, "nation").selectExpr(
        "concat('code-n', n_nationkey) AS code", "n_name AS district")
    joined = docs.join(nations, F.expr("userRoleInformation.district = code"))
    return project(
        joined,
        {"submission_id": "_id", "school": "place.school", "district": "district", "program": "program"},
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, kind FROM (
        SELECT *, CASE l_linenumber % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'radio' WHEN 2 THEN 'matrix'
            ELSE 'date' END AS kind FROM lineitem) WHERE kind <> 'matrix'"""
)
def answer_type_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose response type carries one answer."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        """CASE l_linenumber % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'radio' WHEN 2 THEN 'matrix'
            ELSE 'date' END AS kind""")
    return answer_types(rows, "kind")


@query(
    """SELECT event_id, user_id % 3 AS grp,
        CASE user_id % 3 WHEN 0 THEN event_id % 5 WHEN 1 THEN event_id % 7 ELSE event_id % 5 END AS m1,
        CASE user_id % 3 WHEN 0 THEN event_id % 7 WHEN 1 THEN CAST(NULL AS BIGINT) ELSE event_id % 9 END AS m2
    FROM events"""
)
def metric_slot_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Metric values in slots by the names that are not null."""
    rows = table(spark, sf, "events").selectExpr(
        "event_id", "user_id % 3 AS grp",
        "map('a', event_id % 5, 'b', event_id % 7, 'c', event_id % 9) AS stats",
        """CASE user_id % 3 WHEN 0 THEN array('a', 'b') WHEN 1 THEN array(null, 'b', null)
            ELSE array('a', null, 'c') END AS names""")
    return metric_slots(rows, "stats", "names", slots=2).drop("stats", "names")


@query(
    """SELECT o_orderkey, answer, label FROM (
        SELECT o_orderkey, o_orderstatus AS answer, concat('Label ', o_orderstatus) AS label, 1 AS t FROM orders
            WHERE o_orderstatus IN ('F', 'O')
        UNION ALL SELECT o_orderkey, 'X', 'Label X', 2 FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL SELECT o_orderkey, o_orderpriority, CAST(o_custkey AS VARCHAR), 3 FROM orders
            WHERE o_orderkey % 3 > 0)"""
)
def option_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Selected values with their option's label, and free answers with a recorded label."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "to_variant_object(if(o_orderkey % 2 = 0, array(o_orderstatus, 'X', 'Y'), array(o_orderstatus))) AS picked",
        """transform(array('F', 'O', 'X'), v -> named_struct('value', cast(v as variant),
            'label', concat('Label ', v))) AS options""",
        "cast(o_orderpriority as variant) AS free",
        """to_variant_object(if(o_orderkey % 3 = 0, cast(array() as array<string>),
            array(cast(o_custkey as string)))) AS labels""",
    )
    picked = rows.select(
        "o_orderkey", F.inline(explode_selected(F.col("picked"), F.col("options"))))
    free = rows.select("o_orderkey", F.inline(free_answer(F.col("free"), F.col("labels"))))
    return picked.unionByName(free).select(
        "o_orderkey", F.col("questionAnswer").alias("answer"), "label")


@query(
    """SELECT l_orderkey, l_linenumber, concat(l_returnflag, CASE WHEN l_linestatus <> l_returnflag THEN concat(',', l_linestatus)
        ELSE '' END, ',', 'n', l_linenumber) AS seen FROM lineitem"""
)
def ordered_distinct_list(spark: SparkSession, sf: str) -> DataFrame:
    """A list without its repeats, in the order of first occurrence."""
    number = F.concat(F.lit("n"), "l_linenumber")
    values = F.array("l_returnflag", "l_linestatus", "l_returnflag", number, "l_linestatus", number)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws(",", fn.distinct_list(values)).alias("seen"))


@query(
    """SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part FROM orders WHERE o_orderkey % 3 > 0
    UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 3 = 0"""
)
def explode_keeping_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A row per element; rows whose list is empty or missing stay."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE o_orderkey % 3 WHEN 0 THEN if(o_orderkey % 2 = 0, null, array()) ELSE split(o_orderpriority, '-') END AS parts")
    return explode_rows(orders, "parts", "part").select("o_orderkey", "part")
