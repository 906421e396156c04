"""Course, quiz and active-user reports over telemetry scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formfold.functions import first_option, item, ms_to_ts
from formfold.operators import HOT_ROWS, having, latest, n_rows, spread_join
from formfold.sources import unwrap

ANSWER_OPTIONS = ["1", "2", "3", "4", "5"]


def course_progress(scans: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows at a learner's best course progress per resource, with the completion time.

    Progress is compared as a number. Copies are merged first (combined before
    the shuffle); the best progress and the last time of each learner and
    resource are combined the same way, and the two per-learner figures come
    from that small table. The rows are then matched to it with hot learners
    split.
    """
    events = unwrap(scans).select(
        F.col("Course_name").alias("course"),
        F.col("batch_name").alias("batch"),
        F.col("User_FirstName").alias("learner"),
        F.col("course_progress").cast("double").alias("progress"),
        F.col("section_name").alias("resource"),
        F.col("section_progress").cast("double").alias("resource_progress"),
        ms_to_ts("__time").alias("time"),
        F.col("User_id").alias("user_id"),
        F.col("user_login_id").alias("login_id"),
    )
    events = events.na.drop(subset=["course", "user_id"])
    keys = ["course", "resource", "user_id"]
    per_resource = events.groupBy(*keys).agg(
        F.max("progress").alias("course_progress"),
        F.max("time").alias("_last"),
        F.count("*").alias("n"),
    )
    finished = per_resource.groupBy("course", "user_id").agg(
        F.max("_last").alias("course_completed_at")
    )
    best = per_resource.drop("_last", "n").join(finished, ["course", "user_id"])
    matched = spread_join(events, best, keys, per_resource.select(*keys, "n"), hot_rows)
    # Copies change no maximum, so only the rows that reach one are compared.
    matched = matched.filter(F.col("progress") == F.col("course_progress")).dropDuplicates()
    return matched.select(
        "course",
        "batch",
        "learner",
        "resource",
        "resource_progress",
        F.col("time").alias("resource_completed_at"),
        "login_id",
        "user_id",
        "course_progress",
        "course_completed_at",
    )


def quiz_progress(scans: DataFrame, zone: str | None = None) -> DataFrame:
    """Newest row at the best quiz result per course, quiz and learner."""
    events = unwrap(scans).select(
        F.col("course_name").alias("course"),
        F.col("content_name").alias("quiz"),
        F.col("User_id").alias("user_id"),
        F.col("User_Name").alias("learner"),
        F.col("progress").cast("double").alias("course_progress"),
        F.col("Event_duration").cast("double").alias("quiz_progress"),
        ms_to_ts("__time", zone).alias("completed_at"),
    )
    keys = ["course", "quiz", "user_id"]
    events = events.na.drop(subset=[*keys, "quiz_progress"])
    return latest(
        events, keys, ["quiz_progress", "completed_at"], ["learner", "course_progress"]
    )


def active_users(events: DataFrame, user: str, at_least: int = 2) -> DataFrame:
    """Number of users with at least so many events."""
    busy = having(events.na.drop(subset=[user]), [user], F.count("*") >= at_least)
    return n_rows(busy, "active_users")


def quiz_answers(assess: DataFrame) -> DataFrame:
    """Chosen option number of each assessment event."""
    return assess.filter(F.col("eid") == "ASSESS").select(
        F.col("actor.id").alias("ActorId"),
        F.col("eid").alias("EventId"),
        F.col("edata.item.title").alias("Question"),
        F.col("object.rollup.l1").alias("CourseId"),
        F.col("object.id").alias("ObjectId"),
        first_option(item("edata.resvalues", 0), ANSWER_OPTIONS).alias("Answer"),
    )
