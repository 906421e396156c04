"""Outputs written and read back, and streaming twins of the reports.

All folders lie below the shared checkpoint root (see ``shared_folder``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold import schemas
from formfold.operators import (
    bitmap_counts,
    bitmap_table,
    extend_dictionary,
    keep_known,
    merge_bitmaps,
    missing_columns,
    new_rows,
    union_all,
    with_missing,
)
from formfold.plans import answers, evidence, metrics
from formfold.plans.bad_answers import split_answers
from formfold.sinks import append_rows, publish, read_rollup, split_write, write_csv, write_json, write_rollup
from formfold.sources import params, read_csv, read_docs, read_json, read_stream, records, unwrap
from formfold.streaming import batch_sink, drain, record_sink, run_stream, split_bad
from formfold.workspace import materialize, shared_folder

from . import derive
from .documents import (
    BASE,
    EVIDENCE_SQL,
    OBSERVATION_SQL,
    evidence_view,
    observation_view,
)
from .metrics import DAILY, DAY
from .registry import CHECKS, query, table, table_stream


@query(
    """SELECT CASE WHEN p_partkey % 9 = 0 THEN 'programname_notdefined' ELSE lower(p_brand) END AS program_slug,
        concat('sol_', lower(p_type)) AS solution_slug, count(*) AS n, sum(p_size)::BIGINT AS total_size
    FROM part GROUP BY ALL"""
)
def split_write_readback(spark: SparkSession, sf: str) -> DataFrame:
    """One folder per program and solution, read back by folder."""
    rows = table(spark, sf, "part").selectExpr(
        "if(p_partkey % 9 = 0, null, p_brand) AS program_name",
        "concat(' Sol  ', p_type) AS solution_name", "p_partkey", "p_size")
    path = split_write(rows, ["program_name", "solution_name"], shared_folder(spark, "split"))
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("program_slug", "solution_slug").agg(
        F.count("*").alias("n"), F.sum(F.col("p_size").cast("bigint")).alias("total_size"))


@query("SELECT c_custkey, c_name, coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '') AS segment FROM customer")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with header written and read, missing text as blanks."""
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "if(c_acctbal > 0, c_mktsegment, null) AS segment")
    back = read_csv(spark, write_csv(rows, shared_folder(spark, "csv")))
    return back.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS _id, CAST(o_orderkey % 4 AS BIGINT) AS n_tasks FROM orders
        JOIN customer ON o_custkey = c_custkey
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderkey % 4 FROM orders
        JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'"""
)
def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Nested documents as compressed JSON lines, appended to, read with their schema."""
    docs = derive.projects(spark, sf)
    folder = shared_folder(spark, "json")
    write_json(docs, folder, "projects", compression="gzip")
    path = write_json(docs.filter("status = 'submitted'"), folder, "projects", mode="append", compression="gzip")
    back = read_docs(spark, path, schemas.PROJECT)
    return back.select("_id", F.array_size("tasks").cast("bigint").alias("n_tasks"))


@query("SELECT CAST(event_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS actor_id FROM events WHERE event_id % 5 > 0")
def unwrap_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Scan responses written as compressed JSON, read and unwrapped."""
    wrapped = table(spark, sf, "events").selectExpr(
        """if(event_id % 5 = 0, array(), array(named_struct('actor_id', cast(user_id as string),
            'mid', cast(event_id as string)))) AS events""")
    path = shared_folder(spark, "scan")
    wrapped.write.option("compression", "gzip").json(path)
    return unwrap(read_json(spark, path, schemas.ACTIVE_USER_SCAN)).na.drop()


@query(
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"""
)
def parameter_list(spark: SparkSession, sf: str) -> DataFrame:
    """Ids listed in a CSV file select the rows, in one pass."""
    listed = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").selectExpr(
        "cast(c_custkey as string) AS o_custkey")
    path = write_csv(listed, shared_folder(spark, "params"))
    wanted = params(spark, path, "o_custkey").select(F.col("o_custkey").cast("bigint"))
    return keep_known(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), wanted, "o_custkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def append_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Appends that add only rows the table lacks; a repeated append adds nothing."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    path = append_rows(orders.filter("o_orderstatus = 'F'"), shared_folder(spark, "table"))
    for _ in range(2):
        append_rows(new_rows(orders, spark.read.parquet(path), "o_orderkey"), path)
    return spark.read.parquet(path)


@query(
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events
    GROUP BY ALL"""
)
def publish_days(spark: SparkSession, sf: str) -> DataFrame:
    """Dimensions published by day; publishing some days again replaces only those."""
    events = table(spark, sf, "events")
    path = publish(events, ["event_id", "event_type"], "ts", shared_folder(spark, "publish"))
    publish(events.filter("ts >= '2024-01-20'"), ["event_id", "event_type"], "ts", path)
    back = spark.read.parquet(path)
    return back.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count("*").alias("n"))


def _observation_records(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of observations as JSON bytes, the shape of a topic.

    The one input file gives each micro-batch one partition, as a topic with one
    partition would; it is spread before the wide work.
    """
    orders = table_stream(spark, sf, "orders").repartition(spark.sparkContext.defaultParallelism)
    return derive.records(derive.observations(spark, sf, orders))


@query(OBSERVATION_SQL)
def stream_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Question-level rows from a stream of records, by the batch function."""
    stream = _observation_records(spark, sf)

    def report(source: DataFrame) -> DataFrame:
        good, _ = split_bad(records(source, schemas.OBSERVATION))
        return answers.observation_answers(
            good, derive.questions(spark, sf), derive.solutions(spark, sf),
            derive.programs(spark, sf), derive.criteria(spark, sf), derive.entities(spark, sf), BASE,
        )

    return observation_view(drain(spark, stream, report, shared_folder(spark, "answers")))


@query(EVIDENCE_SQL)
def stream_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence rows from the same records, a second query with its own checkpoint."""
    stream = _observation_records(spark, sf)

    def report(source: DataFrame) -> DataFrame:
        good, _ = split_bad(records(source, schemas.OBSERVATION))
        return evidence.observation_evidence(good)

    rows = drain(spark, stream, report, shared_folder(spark, "evidence"))
    return evidence_view(rows, "observationSubmissionId", "entity", "entityName", "observationId")


@query(
    """SELECT kind, count(*) AS n FROM (
        SELECT CASE WHEN event_id % 10 < 2 THEN 'bad' ELSE 'good' END AS kind FROM events) GROUP BY ALL"""
)
def stream_bad_records(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable records go to their own output and stop nothing."""
    folder = shared_folder(spark, "bad")
    table(spark, sf, "events").selectExpr(
        """cast(CASE event_id % 10 WHEN 0 THEN concat('{"_id": "', event_id) WHEN 1 THEN '{"x": 1}'
            ELSE concat('{"_id": "', event_id, '"}') END as binary) AS value"""
    ).write.parquet(f"{folder}/topic")
    stream = read_stream(spark, "parquet", f"{folder}/topic", "value binary")
    parts = []
    for i, kind in enumerate(["good", "bad"]):
        rows = drain(
            spark, stream, lambda s, i=i: split_bad(records(s, "_id string"))[i], f"{folder}/{kind}")
        parts.append(rows.select(F.lit(kind).alias("kind")))
    return parts[0].unionByName(parts[1]).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT event_id, event_type FROM events")
def stream_idempotent_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Each micro-batch owns a folder, so a replayed batch replaces itself."""
    folder = shared_folder(spark, "batches")
    stream = table_stream(spark, sf, "events")
    report = lambda s: s.select("event_id", "event_type")
    for attempt in ("first", "replayed"):
        # a fresh checkpoint makes the second run write batch 0 again
        query_ = run_stream(
            stream, report, batch_sink(f"{folder}/rows", once=True), f"{folder}/{attempt}")
        query_.awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch")


@query("SELECT event_id, event_type, user_id FROM events")
def stream_rows_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Batches with other boundaries bring the same rows: each is stored once."""
    folder = shared_folder(spark, "keyed")
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    events.withColumn("half", F.col("event_id") % 2).write.partitionBy("half").parquet(f"{folder}/topic")
    for attempt, files in (("one", 1), ("all", 1000)):
        stream = (
            spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
            .parquet(f"{folder}/topic/half=*")
        )
        sink = batch_sink(f"{folder}/rows", once=True, keys=["event_id"])
        run_stream(stream, lambda s: s, sink, f"{folder}/{attempt}").awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch")


# Of ten kinds of answers, five are wrong in some way; one is a matrix with good and bad ones inside.
_ANSWER = """concat('{"qid":"q', l_linenumber, '","responseType":"number","value":1,"maxScore":', l_quantity, '}')"""
_ANSWERS = f"""parse_json(CASE (l_orderkey + l_linenumber) % 10
    WHEN 0 THEN replace({_ANSWER}, concat('"maxScore":', l_quantity), '"maxScore":"much"')
    WHEN 1 THEN '{{"responseType":"text","value":"x"}}'
    WHEN 2 THEN concat('{{"qid":"q', l_linenumber, '","responseType":"matrix","value":[[',
        '{{"qid":"a","responseType":"text","payload":7}},{{"qid":"b","responseType":"text","value":"y"}}],',
        '{{"k":{{"responseType":"text"}}}}]}}')
    WHEN 3 THEN concat('{{"qid":"q', l_linenumber, '","responseType":"matrix","value":"none"}}')
    WHEN 4 THEN '5'
    ELSE {_ANSWER} END)"""


def answer_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as records of JSON bytes, their lines as answers; an order has a few lines at most."""
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey", f"{_ANSWERS} AS answer")
    named = F.transform(F.collect_list("answer"), lambda a, i: F.struct(F.concat(F.lit("a"), i), a))
    found = lines.groupBy(F.concat(F.lit("o"), "l_orderkey").alias("_id")).agg(F.map_from_entries(named).alias("answers"))
    return derive.records(found)


def _split_rows(records_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    readable, _ = split_bad(records(records_of, schemas.open_answers(f"_id string, answers map<string,{schemas.ANSWER}>")))
    good, bad = split_answers(readable)
    good = answers.explode_answers(good).select(
        F.col("_id").alias("record_id"), F.col("a_qid").alias("question_id"), "instance_id",
        F.lit(None).cast("string").alias("reason"), F.col("a_maxScore").alias("max_score"))
    bad = bad.select("record_id", "question_id", "instance_id", "reason", F.lit(None).cast("double").alias("max_score"))
    return good, bad


BAD_ANSWERS_SQL = """WITH l AS (SELECT concat('o', l_orderkey) AS record_id, concat('q', l_linenumber) AS q, l_quantity::DOUBLE AS n,
        (l_orderkey + l_linenumber) % 10 AS kind FROM lineitem)
    SELECT record_id, CASE WHEN kind NOT IN (1, 4) THEN q END AS question_id, NULL::INT AS instance_id,
        CASE kind WHEN 0 THEN 'wrong type: maxScore' WHEN 1 THEN 'no question id' WHEN 3 THEN 'wrong type: value'
            WHEN 4 THEN 'no object' END AS reason,
        CASE WHEN kind > 4 THEN n END AS max_score FROM l WHERE kind <> 2
    UNION ALL
    SELECT record_id, i.question_id, i.instance_id, i.reason, NULL FROM l, (VALUES ('a', 1, 'wrong type: payload'),
        ('b', 1, NULL), (NULL, 2, 'no question id')) i(question_id, instance_id, reason) WHERE kind = 2"""


@query(BAD_ANSWERS_SQL)
def bad_answers_apart(spark: SparkSession, sf: str) -> DataFrame:
    """Good answers as rows, bad ones with their record, question and reason; the others of a record stay."""
    good, bad = _split_rows(answer_records(spark, sf))
    return good.unionByName(bad)


@query(BAD_ANSWERS_SQL)
def stream_bad_answers(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a stream: rows of good answers, and a side output of bad ones."""
    folder = shared_folder(spark, "bad-answers")
    answer_records(spark, sf).write.parquet(f"{folder}/topic")
    stream = read_stream(spark, "parquet", f"{folder}/topic", "value binary")
    parts = [drain(spark, stream, lambda s, i=i: _split_rows(s)[i], f"{folder}/{i}") for i in range(2)]
    return parts[0].unionByName(parts[1])


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_record_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Rows sent as JSON texts, one per record, and read back."""
    folder = shared_folder(spark, "sent")
    sink = record_sink("text", f"{folder}/records", once=True)
    report = lambda s: s.select("event_id", "user_id", "event_type", "value")
    stream = table_stream(spark, sf, "events")
    run_stream(stream, report, sink, f"{folder}/checkpoint").awaitTermination()
    return read_json(spark, f"{folder}/records", report(stream).schema.simpleString()[7:-1].replace(",", ", ").replace(":", " "))


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, 'known' AS side FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, NULL, 'new' FROM orders"""
)
def align_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A frame that lacks columns of another gets them as typed nulls, then both are one."""
    whole = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.lit("known").alias("side"))
    part = whole.drop("o_orderstatus").withColumn("side", F.lit("new"))
    kinds = dict(whole.dtypes)
    part = with_missing(part, {c: kinds[c] for c in missing_columns(whole, part)})
    return union_all(whole, part.select(*whole.columns))


@query(CHECKS["rollup_merge"])
def rollup_by_folders(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup merge by date folders: two periods written one after the other."""
    daily = metrics.time_metrics(table(spark, sf, "events"), {**DAILY, "labels": {}}).select("date", "clicks")
    path = shared_folder(spark, "rollup")
    merge = {"rollup": 1, "rollupAge": "DAY", "rollupRange": 14, "rollupCol": "date"}
    write_rollup(daily.filter("date < '2024-01-20'").withColumn("clicks", F.col("clicks") - 1), path, merge)
    write_rollup(daily.filter("date >= '2024-01-15'"), path, merge)
    return read_rollup(spark, path, daily.schema).withColumn("date", F.date_format("date", DAY))


@query(
    """SELECT 'day' AS grain, strftime(ts, '%Y-%m-%d') AS period, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL
    UNION ALL SELECT 'month', strftime(ts, '%Y-%m'), event_type, count(DISTINCT user_id) FROM events GROUP BY ALL
    UNION ALL SELECT 'month of all', strftime(ts, '%Y-%m'), NULL, count(DISTINCT user_id) FROM events GROUP BY ALL
    UNION ALL SELECT 'all', NULL, event_type, count(DISTINCT user_id) FROM events GROUP BY ALL"""
)
def distinct_counts_from_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Daily, monthly and overall distinct users from one bitmap table, filled by two periods."""
    events = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    dims, periods, ids = ["day", "event_type"], [], None
    for condition in ("ts < '2024-01-16'", "ts >= '2024-01-16'"):
        period = events.filter(condition)
        ids = extend_dictionary(period, "user_id", ids)
        periods.append(materialize(bitmap_table(period, dims, "user_id", ids), "bitmaps"))
    days = union_all(*periods)
    month, none = F.substring("day", 1, 7), F.lit(None).cast("string")
    months = materialize(merge_bitmaps(days, [month.alias("month"), "event_type"]), "bitmaps")
    columns = lambda grain, period, kind: [F.lit(grain).alias("grain"), period.alias("period"), kind.alias("event_type"), F.col("n").alias("users")]
    kind = F.col("event_type")
    parts = [
        bitmap_counts(days, dims).select(*columns("day", F.col("day"), kind)),
        bitmap_counts(months, ["month", "event_type"]).select(*columns("month", F.col("month"), kind)),
        bitmap_counts(months, ["month"]).select(*columns("month of all", F.col("month"), none)),
        bitmap_counts(months, ["event_type"]).select(*columns("all", none, kind)),
    ]
    return union_all(union_all(parts[0], parts[1]), union_all(parts[2], parts[3]))
