"""Single-row behaviour of column builders."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from formfold import functions as fn


@pytest.mark.parametrize(
    "column, expected",
    [
        (lambda: fn.last(F.array().cast("array<int>")), None),
        (lambda: fn.item(F.array(F.lit(1)), 5), None),
        (lambda: fn.n_items(F.lit(None).cast("array<int>")), 0),
        (lambda: fn.join_lines(F.lit("l1\nl2")), " l1 l2"),
        (lambda: fn.join_lines(F.lit(None).cast("string")), None),
        (lambda: fn.flag_string(F.lit(None).cast("boolean"), "true"), "true"),
        (lambda: fn.solution_type(F.lit(True), F.lit(None).cast("boolean")), "observation_with_out_rubric"),
        (lambda: fn.slug(F.lit("  My\t Big  Program ")), "my_big_program"),
        (lambda: fn.blank_to(F.lit(""), "none"), "none"),
        (lambda: fn.evidence_url(F.lit("x"), F.lit(None).cast("string"), "b/"), "x"),
        (lambda: fn.evidence_url(F.lit("x"), F.lit("link"), "b/"), "x"),
        (lambda: fn.evidence_url(F.lit("x"), F.lit("image"), "b/"), "b/x"),
        (lambda: fn.time_part(F.lit("2024-01-01")), None),
        (lambda: fn.ms_to_date(F.lit("1640975400000")), "2021-12-31"),
        (lambda: fn.ratio(F.lit(0), F.lit(5)), None),
        (lambda: fn.ratio(F.lit(2), F.lit(0)), None),
        (lambda: fn.ratio(F.lit(1), F.lit(4)), 0.25),
        (lambda: fn.from_micros(F.lit(2500000)), 2.5),
        (lambda: fn.lat_long(F.lit("1.5")), None),
        (lambda: fn.evidence_status(F.lit(None).cast("boolean"), F.lit(True)), False),
        (lambda: fn.urn_id(F.lit("urn:li:share:77")), "77"),
        (lambda: fn.evidence_urls(F.array().cast("array<struct<sourcePath:string>>"), "b/"), None),
        (lambda: fn.typed_null("bigint"), None),
    ],
)
def test_value(spark, column, expected):
    assert spark.range(1).select(column()).first()[0] == expected


def test_theme_trees_of_any_depth_are_walked(spark):
    from formfold.operators import theme_criteria

    def tree(depth):
        node = '{"name":"leaf","criteria":[{"criteriaId":"c"}]}'
        for i in range(depth):
            node = f'{{"name":"n{i}","children":[{node}]}}'
        return spark.range(1).select(F.parse_json(F.lit(f"[{node}]")).alias("t"))

    for depth in (1, 20, 40):
        found = tree(depth).select(theme_criteria("t")).first()[0]
        assert [(f["criteria_id"], f["parent"], f["domain_name"]) for f in found] == [
            ("c", "leaf", f"n{depth - 1}")
        ]


def test_more_metrics_than_slots_are_refused(spark):
    from formfold.operators import metric_slots

    names = [f"n{i}" for i in range(11)]
    rows = spark.createDataFrame([({n: i for i, n in enumerate(names)}, names)], "s map<string,int>, n array<string>")
    wide = metric_slots(rows, "s", "n", slots=11).first()
    assert [wide[f"m{i}"] for i in range(1, 12)] == list(range(11))
    with pytest.raises(Exception, match="more than 9 metrics"):
        metric_slots(rows, "s", "n").collect()


def test_matching_a_stream_to_known_batches(spark, tmp_path):
    """A record sink writes one JSON text per row."""
    from formfold.streaming import record_sink, run_stream

    spark.range(5).selectExpr("id", "concat('n', id) AS name").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("id bigint, name string").parquet(str(tmp_path / "in"))
    sink = record_sink("text", str(tmp_path / "out"), once=True)
    run_stream(source, lambda s: s.filter("id > 2"), sink, str(tmp_path / "cp")).awaitTermination()
    found = sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert found == ['{"id":3,"name":"n3"}', '{"id":4,"name":"n4"}']


def test_column_sets_and_time_stamp(spark):
    from formfold.operators import missing_columns, with_missing, with_time_stamp

    a, b = spark.range(1).selectExpr("id", "1 AS x", "2 AS y"), spark.range(1)
    assert missing_columns(a, b) == ["x", "y"]
    assert dict(with_missing(b, {"x": "int", "id": "int"}).dtypes) == {"id": "bigint", "x": "int"}
    assert dict(with_time_stamp(b).dtypes)["time_stamp"] == "timestamp"


def test_shared_folder_follows_the_session():
    from types import SimpleNamespace

    from formfold.workspace import shared_folder

    def session(root, master="spark://cluster"):
        conf = SimpleNamespace(get=lambda key, default: root if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    first, second = (shared_folder(session("hdfs://shared/root/"), "x") for _ in range(2))
    assert first.startswith("hdfs://shared/root/x-") and first != second
    assert shared_folder(session(None, "local[2]"), "x")
    with pytest.raises(ValueError, match="shared by all executors"):
        shared_folder(session(None), "x")


def test_under_split_scans_are_spread(spark):
    from formfold.sources import spread

    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(10).coalesce(1), spark.range(10).repartition(cores + 1)
    assert spread(few).rdd.getNumPartitions() == cores
    assert spread(many) is many


def test_scans_are_spread_by_their_rows(spark):
    from formfold.sources import spread

    rows = spark.range(0, 2_000_000, 1, spark.sparkContext.defaultParallelism)
    assert spread(rows).rdd.getNumPartitions() == 20


def test_wide_theme_trees_are_walked_as_often_as_they_are_deep(spark):
    import json

    from formfold.operators import theme_criteria
    from formfold.operators.themes import array_depth

    leaf = lambda i: {"name": f"t]{i}", "children": [], "criteria": [{"criteriaId": f"c{i}"}]}
    wide = json.dumps([{"name": "d[[\"[", "externalId": "D\\", "children": [leaf(i) for i in range(500)]}])
    rows = spark.createDataFrame([(wide,), ("[]",), (None,), ("{}",)], "t string")
    assert [r[0] for r in rows.select(array_depth(F.col("t"))).collect()] == [3, 1, 0, 0]
    found = rows.select(theme_criteria(F.parse_json("t"))).collect()
    assert [len(r[0]) for r in found] == [500, 0, 0, 0]
    assert found[0][0][499].asDict() == {"domain_name": 'd[["[', "domain_externalId": "D\\", "parent": "t]499", "criteria_id": "c499"}


def test_equal_theme_documents_are_walked_once(spark):
    from formfold.operators.themes import theme_table

    a = '[{"name":"A","externalId":"a","criteria":[{"criteriaId":"x"},{"criteriaId":"y"}]}]'
    rows = [(f"s{i}", a) for i in range(50)] + [("t", a.replace("A", "B")), ("u", None), ("v", "[]")]
    solutions = spark.createDataFrame(rows, "_id string, t string").withColumn("themes", F.parse_json("t"))
    found = theme_table(solutions)
    assert found.columns == ["solution_id", "domain_name", "domain_externalId", "parent", "criteria_id"]
    got = sorted((r[0], r[1], r[4]) for r in found.collect())
    assert got == sorted((i, "B" if i == "t" else "A", c) for i in [f"s{n}" for n in range(50)] + ["t"] for c in "xy")
    walk = found._jdf.queryExecution().optimizedPlan().toString()
    assert walk.index("Generate inline") < walk.index("Aggregate [")
