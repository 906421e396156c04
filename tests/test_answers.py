"""Edge cases of question-level flattening and evidence."""

from __future__ import annotations

import pytest

from formfold import schemas
from formfold.plans.answers import explode_answers, observation_answers, survey_answers
from formfold.plans.evidence import observation_evidence

QUESTIONS = [
    {"_id": "free", "externalId": "F", "options": []},
    {"_id": "pick", "externalId": "P", "options": [
        {"value": "R1", "label": "One"}, {"value": "R2", "label": "Two"}, {"value": 3, "label": "Three"}]},
    {"_id": "grid", "externalId": "G", "options": []},
]


def answer(qid, value, labels=None, kind="radio", **more):
    payload = {"question": [f"{qid}?"]}
    if labels is not None:
        payload["labels"] = labels
    return {"qid": qid, "responseType": kind, "value": value, "payload": payload, **more}


@pytest.fixture
def flat(docs):
    """(questionId, answer, label, instance) of a survey with the given answers."""

    def run(answers: dict, **fields):
        sub = {"_id": "s", "status": "completed", "isAPrivateProgram": False, "answers": answers, **fields}
        rows = survey_answers(
            docs(schemas.SURVEY, sub), docs(schemas.QUESTION, *QUESTIONS), docs(schemas.SOLUTION, {"_id": "x"}),
            docs(schemas.PROGRAM, {"_id": "x"}), docs(schemas.CRITERIA, {"_id": "x"}), "b/")
        found = rows.select("questionId", "questionAnswer", "questionResponseLabel", "instanceId").collect()
        return sorted((tuple(r) for r in found), key=str)

    return run


def test_free_answer_needs_a_label(flat):
    assert flat({"a": answer("free", "hi", ["hi"], "text")}) == [("free", "hi", "hi", None)]
    assert flat({"a": answer("free", "hi", [], "text")}) == []
    assert flat({"a": answer("free", "hi", None, "text")}) == []


def test_answers_take_only_their_own_criterion(docs):
    answers = {"a": answer("free", "hi", ["hi"], "text", criteriaId="c2"), "b": answer("free", "x", ["x"], "text", criteriaId="c9")}
    subs = docs(schemas.SURVEY, {"_id": "s", "answers": answers}).selectExpr(
        "_id", "answers", "array(named_struct('id', 'c1', 'v', 1), named_struct('id', 'c2', 'v', 2)) AS own")
    rows = explode_answers(subs, own="own")
    assert "own" not in rows.columns
    assert sorted(map(tuple, rows.select("a_criteriaId", "_criterion.v").collect())) == [("c2", 2), ("c9", None)]


def test_free_answer_with_a_single_label(flat):
    assert flat({"a": answer("free", 5, "five", "number")}) == [("free", "5", "five", None)]


def test_single_answer_must_be_an_option(flat):
    assert flat({"a": answer("pick", "R2", ["chosen"])}) == [("pick", "R2", "chosen", None)]
    assert flat({"a": answer("pick", "R9", ["chosen"])}) == []


def test_text_and_number_options_differ(flat):
    assert flat({"a": answer("pick", 3, ["x"])}) == [("pick", "3", "x", None)]
    assert flat({"a": answer("pick", "3", ["x"])}) == []


def test_fractions_never_match_options(flat):
    assert flat({"a": answer("pick", 2.5, ["x"], "slider")}) == []


def test_multiselect_partly_matching(flat):
    found = flat({"a": answer("pick", ["R2", "no", 3], ["x"], "multiselect")})
    assert found == [("pick", "3", "Three", None), ("pick", "R2", "Two", None)]


def test_matrix_instances_as_list_and_as_object(flat):
    value = [
        [answer("free", "a", ["a"], "text"), answer("pick", "R1", ["one"])],
        {"k": answer("free", "b", ["b"], "text")},
    ]
    assert flat({"m": answer("grid", value, None, "matrix")}) == [
        ("free", "a", "a", 1), ("free", "b", "b", 2), ("pick", "R1", "one", 1)]


def test_empty_matrix_and_other_types_are_left_out(flat):
    assert flat({"m": answer("grid", [], None, "matrix"),
                 "p": answer("free", "x", ["x"], "pageQuestions")}) == []


def test_unknown_question_is_left_out(flat):
    assert flat({"a": answer("nobody", "x", ["x"], "text")}) == []


def test_submission_must_be_completed_and_say_if_private(flat):
    answers = {"a": answer("free", "hi", ["hi"], "text")}
    assert flat(answers, status="started") == []
    assert flat(answers, isAPrivateProgram=None) == []


def test_field_of_another_type_inside_a_matrix_is_null_not_lost(flat):
    inner = answer("free", "a", ["a"], "text", maxScore="high")
    assert flat({"m": answer("grid", [[inner]], None, "matrix")}) == [("free", "a", "a", 1)]


@pytest.mark.parametrize(
    "school, answered, label",
    [
        (None, "1,2", "gps location not found for school"),
        ("10.0,20.0", None, "gps location not found for question"),
        ("10.0,20.0", "here", "gps location not found for question"),
        ("10.0,20.0", "10.00179,20.0", "verified"),  # 199 m
        ("10.0,20.0", "10.00181,20.0", "not verified"),  # 201 m
    ],
)
def test_geofence_of_an_observation(docs, school, answered, label):
    sub = {"_id": "s", "status": "completed", "isAPrivateProgram": True, "entityId": "e",
           "completedDate": "2024-01-01T00:00:00Z",
           "answers": {"a": answer("free", "hi", ["hi"], "text", gpsLocation=answered)}}
    rows = observation_answers(
        docs(schemas.OBSERVATION, sub), docs(schemas.QUESTION, *QUESTIONS),
        docs(schemas.SOLUTION, {"_id": "x"}), docs(schemas.PROGRAM, {"_id": "x"}),
        docs(schemas.CRITERIA, {"_id": "x"}),
        docs(schemas.ENTITY, {"_id": "e", "metaInformation": {"gpsLocation": school}}))
    assert [r[0] for r in rows.select("location_validated_with_geotag").collect()] == [label]


def file(name):
    return {"name": name, "sourcePath": f"p/{name}"}


def test_evidence_of_plain_and_matrix_answers(docs):
    sub = {"_id": "s", "status": "completed", "isAPrivateProgram": True,
           "completedDate": "2024-01-01T00:00:00Z", "answers": {
               "a": answer("free", "x", fileName=[file("1"), file("2")]),
               "b": answer("free", "x", fileName=[], instanceFileName=[[file("9")]]),
               "c": answer("grid", [], instanceFileName=[[file("3")], [file("4"), file("5")]]),
               "d": answer("free", "x"),
               "e": answer(None, "x", fileName=[file("6")])}}
    rows = observation_evidence(docs(schemas.OBSERVATION, sub))
    found = rows.select("questionId", "evidence_count", "fileName", "fileSourcePath", "total_evidences")
    assert sorted(tuple(r) for r in found.collect()) == [
        ("free", 2, "1,2", "p/1,p/2", 6), ("grid", 3, "3,4,5", "p/3,p/4,p/5", 6)]


def test_bad_records_are_set_apart(spark):
    from formfold.sources import records
    from formfold.streaming import split_bad

    raw = spark.createDataFrame([(b'{"_id": "1"}',), (b'{"_id": ',), (b"text",), (b"{}",)], "value binary")
    good, bad = split_bad(records(raw, "_id string"))
    assert [r[0] for r in good.collect()] == ["1"]
    assert sorted(r[0] for r in bad.collect()) == ["text", '{"_id": ', "{}"]


def test_observation_fans_out_given_roles(docs):
    from pyspark.sql import functions as F

    sub = {"_id": "s", "status": "completed", "isAPrivateProgram": True, "entityId": "e",
           "completedDate": "2024-01-01T00:00:00Z", "entityType": "school",
           "answers": {"a": answer("free", "hi", ["hi"], "text")}}
    subs = docs(schemas.OBSERVATION, sub).withColumn("roles", F.expr(
        """array(named_struct('role_title', 'head', 'user_stateName', 'A'),
            named_struct('role_title', 'head', 'user_stateName', 'A'),
            named_struct('role_title', 'coach', 'user_stateName', 'A'))"""))
    rows = observation_answers(
        subs, docs(schemas.QUESTION, *QUESTIONS), docs(schemas.SOLUTION, {"_id": "x"}),
        docs(schemas.PROGRAM, {"_id": "x"}), docs(schemas.CRITERIA, {"_id": "x"}),
        docs(schemas.ENTITY, {"_id": "e"}), roles="roles")
    found = rows.select("role_title", "user_stateName", "questionAnswer", "school").collect()
    assert sorted(tuple(r) for r in found) == [("coach", "A", "hi", "e"), ("head", "A", "hi", "e")]


def test_submission_columns_pass_the_answers_as_one(docs):
    """A row's steps carry them in one struct; a column that rows have themselves is the row's."""
    import re

    from pyspark.sql import functions as F

    from support import plan_text

    sub = {"_id": "s", "status": "completed", "isAPrivateProgram": True, "entityId": "e", "createdBy": "u", "title": "T",
           "completedDate": "2024-01-01T00:00:00Z", "entityType": "school", "solutionId": "x",
           "answers": {"a": answer("free", "hi", ["hi"], "text", remarks="seen"), "b": answer("free", "ho", ["ho"], "text")}}
    subs = docs(schemas.OBSERVATION, sub).withColumn("remarks", F.lit("of the submission"))
    rows = observation_answers(
        subs, docs(schemas.QUESTION, *QUESTIONS), docs(schemas.SOLUTION, {"_id": "x", "name": "X", "scoringSystem": "pointsBasedScoring"}),
        docs(schemas.PROGRAM, {"_id": "x"}), docs(schemas.CRITERIA, {"_id": "x"}), docs(schemas.ENTITY, {"_id": "e"}))
    found = rows.select("questionAnswer", "remarks", "createdBy", "submissionTitle", "solutionName", "scoringSystem", "school").collect()
    same = ("u", "T", "X", "pointsBasedScoring", "e")
    assert sorted(tuple(r) for r in found) == [("hi", "seen", *same), ("ho", None, *same)]
    [carried] = re.findall(r"Arguments: explode\(_matches#\d+\), \[(.*?)\]", plan_text(rows))
    assert "_whole#" in carried and "createdBy#" not in carried


def test_a_theme_may_list_a_criterion_by_its_parent(spark):
    from pyspark.sql import functions as F

    from catalog import derive
    from support import SF
    from formfold.plans import answers

    solutions = derive.solutions(spark, SF)
    listed = F.parse_json(F.replace(F.to_json("themes"), F.lit('"crit2"'), F.lit('"parent2"')))
    rest = (derive.programs(spark, SF), derive.criteria(spark, SF), derive.entities(spark, SF), "")

    def domains(s):
        rows = answers.observation_answers(derive.observations(spark, SF), derive.questions(spark, SF), s, *rest)
        rows = rows.filter("criteriaId = 'crit2'").groupBy("domainName", "domainLevel", "level", "label").count()
        return sorted(map(str, rows.collect()))

    found = domains(solutions)
    assert found and all("domainName='Domain B'" in r for r in found)
    assert domains(solutions.withColumn("themes", listed)) == found
