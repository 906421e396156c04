"""Edge cases of flattening project tasks."""

from __future__ import annotations

from formfold import schemas
from formfold.operators import flatten_tasks
from formfold.plans.projects import project_report


def image(name):
    return {"type": "image", "name": name, "sourcePath": f"path/{name}"}


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_no_tasks_keeps_one_row(docs):
    df = flatten_tasks(docs(schemas.PROJECT, {"_id": "p", "tasks": []}, {"_id": "q"}))
    assert rows(df, "_id", "task_id", "task_deleted_flag") == [
        ("p", None, "false"), ("q", None, "false")]


def test_more_attachments_than_sub_tasks(docs):
    task = {"_id": "t", "name": "a\nb", "remarks": "r", "attachments": [image("x"), image("y")],
            "children": [{"_id": "c", "name": "child"}]}
    df = flatten_tasks(docs(schemas.PROJECT, {"_id": "p", "tasks": [task]}), "http://b/")
    assert rows(df, "tasks", "task_evidence", "sub_task_id", "sub_task_start_date", "task_remarks") == [
        ("a b", "http://b/path/x", "c", "", "r"),
        ("a b", "http://b/path/y", None, None, None),
    ]


def test_more_sub_tasks_than_attachments(docs):
    task = {"_id": "t", "attachments": [image("x")],
            "children": [{"_id": "c1"}, {"_id": "c2", "isDeleted": True, "startDate": "d"}]}
    df = flatten_tasks(docs(schemas.PROJECT, {"_id": "p", "tasks": [task]}))
    assert rows(df, "task_evidence", "sub_task_id", "sub_task_start_date", "sub_task_deleted_flag") == [
        ("path/x", "c1", "", "false"), (None, "c2", "d", "true")]


def test_project_attachments_beyond_the_rows_are_kept(docs):
    doc = {"_id": "p", "remarks": "note", "tasks": [{"_id": "t"}],
           "attachments": [image("x"), {"type": "link", "name": "L", "sourcePath": "s"}, image("z")]}
    df = flatten_tasks(docs(schemas.PROJECT, doc), "http://b/")
    assert rows(df, "task_id", "project_evidence", "project_remarks", "project_has_evidence") == [
        ("t", "http://b/path/x", "note", True),
        (None, "L", None, True),
        (None, "http://b/path/z", None, True),
    ]


def test_remarks_with_empty_project_attachments(docs):
    doc = {"_id": "p", "remarks": "note", "attachments": [], "tasks": [{"_id": "t"}]}
    df = flatten_tasks(docs(schemas.PROJECT, doc))
    assert rows(df, "task_id", "project_remarks", "project_has_evidence") == [("t", "note", False)]


def test_attachment_without_a_type_is_no_evidence(docs):
    task = {"_id": "t", "attachments": [{"name": "n", "sourcePath": "s"}]}
    df = flatten_tasks(docs(schemas.PROJECT, {"_id": "p", "tasks": [task]}))
    assert rows(df, "task_evidence", "task_evidence_status") == [(None, True)]


def test_equal_rows_of_a_project_are_merged(docs):
    task = {"_id": "t", "attachments": [image("x"), image("x"), image("y")]}
    df = flatten_tasks(docs(schemas.PROJECT, {"_id": "p", "tasks": [task, task]}))
    assert sorted(rows(df, "task_evidence")) == [("path/x",), ("path/y",)]


def test_report_fans_out_other_organisations_only(docs):
    orgs = [{"organisationId": "1", "orgName": "A", "isSchool": False},
            {"organisationId": "2", "orgName": "B", "isSchool": True},
            {"organisationId": "3", "orgName": "C"}]
    found = docs(
        schemas.PROJECT,
        {"_id": "p", "tasks": [{"_id": "t"}], "userProfile": {"organisations": orgs}},
        {"_id": "q", "tasks": [{"_id": "t"}], "userProfile": {"organisations": []}},
        {"_id": "r", "tasks": [{"_id": "t"}]},
    )
    got = rows(project_report(found), "project_id", "organisation_id", "state_name", "private_program")
    assert sorted(got, key=str) == [
        ("p", "1", None, "true"), ("p", "3", None, "true"), ("q", None, None, "true"),
        ("r", None, None, "true")]


def test_report_equals_a_distinct_over_all_columns(docs):
    task = {"_id": "t", "name": "a\nb", "attachments": [image("x"), image("x")]}
    same = {"_id": "t", "name": "a b", "attachments": [image("x")]}
    report = project_report(docs(schemas.PROJECT, {"_id": "p", "tasks": [task, same]}))
    assert report.count() == report.dropDuplicates().count() == 1
