"""Bad answers set apart, and the sink that stores a key once."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from formfold import schemas
from formfold.plans.answers import explode_answers
from formfold.plans.bad_answers import split_answers
from formfold.sources import records
from formfold.streaming import batch_sink, run_stream, split_bad
from formfold.streaming.streams import bucket_of, known_keys, ledger

SCHEMA = schemas.open_answers(f"_id string, answers map<string,{schemas.ANSWER}>")


def opened(spark, *items):
    raw = spark.createDataFrame([(json.dumps(i).encode(),) for i in items], "value binary")
    return split_bad(records(raw, SCHEMA))[0]


def answer(qid, **fields):
    return {"qid": qid, "responseType": "text", "value": "v", **fields}


def test_one_wrong_answer_of_ten_costs_one_row(spark):
    ten = {f"k{i}": answer(f"q{i}", maxScore="much" if i == 4 else i) for i in range(10)}
    good, bad = split_answers(opened(spark, {"_id": "r", "answers": ten}))
    rows = explode_answers(good).select("a_qid", "a_maxScore").collect()
    assert sorted(tuple(r) for r in rows) == [(f"q{i}", float(i)) for i in range(10) if i != 4]
    assert [tuple(r) for r in bad.collect()] == [("r", "k4", None, "q4", "wrong type: maxScore", json.dumps(ten["k4"], sort_keys=True, separators=(",", ":")))]


@pytest.mark.parametrize(
    ("wrong", "reason"),
    [
        (7, "no object"), ("text", "no object"), (None, "no object"), ([1], "no object"), ({}, "no question id"),
        ({"qid": None, "responseType": "text"}, "no question id"), (answer("q", fileName="f"), "wrong type: fileName"),
        (answer("q", payload=[1]), "wrong type: payload"), (answer("q", responseType="matrix", value=3), "wrong type: value"),
        (answer("q", fileName=None, maxScore=None, value=None), None), (answer("q", maxScore="3.5"), None),
        (answer("q", responseType="matrix", value=[]), None), (answer(5), None),
    ],
)
def test_faults_of_an_answer(spark, wrong, reason):
    good, bad = split_answers(opened(spark, {"_id": "r", "answers": {"x": wrong, "y": answer("fine")}}))
    assert [r["reason"] for r in bad.collect()] == ([reason] if reason else [])
    assert good.select(F.size("answers")).first()[0] == (1 if reason else 2)


def test_bad_answers_inside_a_matrix(spark):
    grid = answer("m", responseType="matrix", value=[[answer("a"), answer("b", scoreAchieved={})], 4, {"k": {"value": 1}, "l": answer("c")}])
    good, bad = split_answers(opened(spark, {"_id": "r", "answers": {"g": grid}}))
    assert sorted(r["a_qid"] for r in explode_answers(good).collect()) == ["a", "c"]
    found = [(r["instance_id"], r["question_id"], r["reason"]) for r in bad.collect()]
    assert sorted(found) == [(1, "b", "wrong type: scoreAchieved"), (3, None, "no question id")]


def test_records_without_answers(spark):
    good, bad = split_answers(opened(spark, {"_id": "a"}, {"_id": "b", "answers": {}}))
    assert good.count() == 2 and bad.count() == 0


def feed(spark, folder, sink, name, frame):
    """Run one stream over the rows of a frame, by a checkpoint of its own."""
    frame.write.parquet(f"{folder}/{name}/topic")
    stream = spark.readStream.schema(frame.schema).parquet(f"{folder}/{name}/topic")
    run_stream(stream, lambda s: s, sink, f"{folder}/checkpoint").awaitTermination()


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    path, keys = str(tmp_path / "rows"), ["id"]
    rows = spark.range(500).withColumn("v", F.col("id") * 2)
    sink = batch_sink(path, once=True, keys=keys, buckets=16)
    feed(spark, tmp_path, sink, "first", rows)
    one = rows.filter(bucket_of(keys, 16) == 3)
    known = known_keys(rows, path, keys, [3], 16)
    assert known.count() == one.count() > 0
    assert all(re.search(r"/bucket=3/", f) for f in known.inputFiles())
    assert known_keys(rows, path, keys, [], 16) is None
    # the ledger alone is read: rows of earlier batches may be out of reach
    assert spark.read.parquet(ledger(path, 16)).select("id", "bucket", "batch").distinct().count() == 500


def test_keys_are_stored_once_over_many_batches(spark, tmp_path):
    path = str(tmp_path / "rows")
    for i, (low, high) in enumerate([(0, 50), (20, 70), (0, 0), (60, 90)]):
        part = spark.range(low, high).select("id", F.when(F.col("id") % 5 > 0, F.col("id")).alias("other"))
        frame = part.union(part).coalesce(1)
        frame.write.mode("append").parquet(str(tmp_path / "topic"))
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "topic"))
        sink = batch_sink(path, once=True, keys=["id", "other"], buckets=4)
        run_stream(stream, lambda s: s, sink, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(90))


def test_a_batch_tried_again_leaves_nothing_of_its_first_attempt(spark, tmp_path):
    path = str(tmp_path / "rows")
    sink = batch_sink(path, once=True, keys=["id"], buckets=4)
    feed(spark, tmp_path / "a", sink, "t", spark.range(0, 30))
    # a new checkpoint writes batch 0 again, with other rows: the keys of the first attempt are free again
    feed(spark, tmp_path / "b", sink, "t", spark.range(20, 40))
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(20, 40))
    assert sorted(r["id"] for r in spark.read.parquet(ledger(path, 4)).collect()) == list(range(20, 40))


def test_rows_stored_before_there_was_a_ledger(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(10).write.parquet(f"{path}/batch=7")
    feed(spark, tmp_path, batch_sink(path, once=True, keys=["id"], buckets=4), "t", spark.range(5, 15))
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(15))
    with pytest.raises(Exception, match="another number of buckets"):
        feed(spark, tmp_path / "x", batch_sink(path, once=True, keys=["id"], buckets=8), "t", spark.range(1))
