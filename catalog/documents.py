"""Reports over nested documents: projects, observations, surveys, evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.operators import (
    entity_columns,
    fan_out_orgs,
    fan_out_roles,
    flatten_tasks,
    locations_to_columns,
    theme_table,
)
from formfold.plans import answers, dump, evidence, hand, projects, status
from formfold.plans.answers import explode_answers, match_answers

from formfold.workspace import materialize

from . import derive
from .checks import ANSWERS, LOCATED, ORGS, STATUS, URLS
from .registry import query

BASE = "http://b/"
TS = "yyyy-MM-dd HH:mm:ss"

# rows of the tasks of a project, then of the project with its own attachments
_TASK_ROWS = f"""
WITH {LOCATED},
tasks AS (SELECT k, c, o_orderdate, unnest(range(1, k % 4 + 1)) AS t FROM located),
sized AS (SELECT *, (k + t) % 5 AS na, (c + t) % 3 AS ns FROM tasks),
task_rows AS (SELECT *, unnest(range(1, greatest(na, ns, 1) + 1)) AS i FROM sized),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, i) AS p FROM task_rows),
counts AS (SELECT k, count(*) AS n FROM placed GROUP BY k),
slots AS (
    SELECT located.k, c, unnest(range(1, greatest(coalesce(n, 0), k % 6,
        CASE WHEN k % 6 < 3 THEN 1 ELSE 0 END, 1) + 1)) AS p
    FROM located LEFT JOIN counts USING (k)),
flat AS (
    SELECT slots.k, slots.p,
        CASE WHEN t IS NOT NULL THEN concat('t', t) END AS task_id,
        CASE WHEN t IS NOT NULL THEN concat('Task ', t) END AS tasks,
        coalesce(CAST(t = 2 AS VARCHAR), 'false') AS task_deleted_flag,
        na > 0 AS task_evidence_status,
        CASE WHEN t = 3 THEN '' WHEN t IS NOT NULL THEN 'a' END AS task_assigned_to,
        CASE WHEN t = 1 THEN 'done' WHEN t IS NOT NULL THEN '' END AS tasks_status,
        CASE WHEN i > na THEN NULL WHEN i % 3 = 0 THEN concat('t', t, '-name', i)
            WHEN i IS NOT NULL THEN concat('http://b/t', t, '-path', i) END AS task_evidence,
        CASE WHEN i = 1 AND (placed.k + t) % 2 = 0 THEN concat('note ', t) END AS task_remarks,
        CASE WHEN i <= ns THEN concat('s', t, '.', i) END AS sub_task_id,
        CASE WHEN i <= ns THEN concat('Sub ', i) END AS sub_task,
        CASE WHEN i <= ns THEN (CASE WHEN i = 1 THEN '2024-02-01' ELSE '' END) END AS sub_task_start_date,
        CASE WHEN i <= ns AND i = 2 THEN 'true' ELSE 'false' END AS sub_task_deleted_flag,
        CASE WHEN slots.p > slots.k % 6 THEN NULL WHEN slots.p % 3 = 0 THEN concat('p-name', slots.p)
            ELSE concat('http://b/p-path', slots.p) END AS project_evidence,
        CASE WHEN slots.p = 1 AND slots.k % 6 < 3 THEN concat('remark ', slots.k) END AS project_remarks
    FROM slots LEFT JOIN placed ON slots.k = placed.k AND slots.p = placed.p)
"""

_TASK_NAMES = [
    "task_id",
    "tasks",
    "task_deleted_flag",
    "task_evidence_status",
    "task_assigned_to",
    "tasks_status",
    "task_evidence",
    "task_remarks",
    "sub_task_id",
    "sub_task",
    "sub_task_start_date",
    "sub_task_deleted_flag",
    "project_evidence",
    "project_remarks",
]


@query(
    f"""{_TASK_ROWS}
    SELECT CAST(k AS VARCHAR) AS project_id, {", ".join(_TASK_NAMES)} FROM flat"""
)
def flatten_project_tasks(spark: SparkSession, sf: str) -> DataFrame:
    rows = flatten_tasks(derive.projects(spark, sf), BASE)
    return rows.select(F.col("_id").alias("project_id"), *_TASK_NAMES)


_PROJECT_SQL = f"""{_TASK_ROWS}, {ORGS},
report AS (
    SELECT CAST(located.k AS VARCHAR) AS project_id,
        CASE WHEN located.k % 3 = 0 THEN 'user created project'
            ELSE 'project imported from library' END AS project_created_type,
        CASE WHEN located.k % 2 = 0 THEN concat('Solution ', located.k % 6)
            ELSE concat('Project ', located.k % 10) END AS project_title,
        concat('prg', c % 7) AS program_id, concat('PRG-', c % 7) AS program_externalId,
        concat('Program ', c % 7) AS program_name,
        CASE WHEN located.k % 7 = 0 THEN 'true' ELSE 'false' END AS project_deleted_flag,
        CASE located.k % 3 WHEN 0 THEN '' WHEN 1 THEN 'Cat1' ELSE 'Cat1, Cat2' END AS area_of_improvement,
        CASE WHEN o_orderstatus = 'F' THEN 'submitted' ELSE 'started' END AS status_of_project,
        CAST(c AS VARCHAR) AS "createdBy",
        concat('Goal ', o_orderpriority) AS project_goal,
        CASE WHEN located.k % 5 = 0 THEN 'false' ELSE 'true' END AS private_program,
        CASE WHEN located.k % 4 = 0 THEN 'true' ELSE 'false' END AS project_terms_and_condition,
        CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END
            AS project_completed_date,
        concat('sol', located.k % 6) AS solution_id, c_mktsegment AS designation,
        concat('root', n_regionkey) AS channel,
        concat('B1,B', c % 3) AS board_name,
        CASE WHEN c % 2 = 0 THEN 'teacher' ELSE 'teacher,head' END AS user_type,
        concat('cert', located.k) AS certificate_id,
        CASE WHEN located.k % 9 = 0 THEN 'active' ELSE 'open' END AS certificate_status,
        task_evidence_status IS NOT NULL AND (located.k % 6 > 0 OR task_evidence_status)
            AS evidence_status,
        organisation_id, organisation_name,
        CASE WHEN c % 13 > 0 THEN r_name END AS state_name,
        CASE WHEN c % 13 > 0 THEN concat('r', n_regionkey) END AS "state_externalId",
        CASE WHEN c % 13 > 0 THEN n_name END AS district_name,
        CASE WHEN c % 13 > 0 THEN concat('n', n_nationkey) END AS "district_externalId",
        CASE WHEN c % 13 > 0 THEN concat('code-c', c) END AS school_code,
        {", ".join(_TASK_NAMES)}
    FROM located JOIN flat ON located.k = flat.k JOIN orgs ON located.k = org_k)
"""

_PROJECT_NAMES = [
    "project_id",
    "project_created_type",
    "project_title",
    "program_id",
    "program_externalId",
    "program_name",
    "project_deleted_flag",
    "area_of_improvement",
    "status_of_project",
    "createdBy",
    "project_goal",
    "private_program",
    "project_terms_and_condition",
    "solution_id",
    "designation",
    "channel",
    "board_name",
    "user_type",
    "certificate_id",
    "certificate_status",
    "evidence_status",
    "organisation_id",
    "organisation_name",
    "state_name",
    "state_externalId",
    "district_name",
    "district_externalId",
    "school_code",
]


def _report(spark: SparkSession, sf: str, **options) -> DataFrame:
    return projects.project_report(derive.projects(spark, sf), BASE, **options)


@query(f"{_PROJECT_SQL} SELECT * FROM report")
def project_report(spark: SparkSession, sf: str) -> DataFrame:
    done = F.date_format("project_completed_date", TS).alias("project_completed_date")
    return _report(spark, sf).select(*_PROJECT_NAMES, done, *_TASK_NAMES)


_COUNTS = """
    count(DISTINCT CASE WHEN certificate_status = 'active' THEN project_id END) AS no_of_certificate_issued,
    count(DISTINCT project_id) AS unique_projects,
    count(DISTINCT "createdBy") AS unique_users,
    count(DISTINCT CASE WHEN evidence_status AND status_of_project = 'submitted'
        THEN project_id END) AS no_of_imp_with_evidence
"""


@query(
    f"""{_PROJECT_SQL}
    SELECT program_name, program_id, project_title, solution_id, status_of_project, state_name,
        "state_externalId", district_name, "district_externalId", organisation_name, organisation_id,
        private_program, project_created_type, CAST(NULL AS VARCHAR) AS parent_channel, {_COUNTS}
    FROM report GROUP BY ALL"""
)
def project_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return projects.project_counts(_report(spark, sf, per_task=False))


@query(
    f"""{_PROJECT_SQL}
    SELECT program_name, program_id, status_of_project, state_name, "state_externalId",
        private_program, project_created_type, CAST(NULL AS VARCHAR) AS parent_channel, {_COUNTS}
    FROM report GROUP BY ALL"""
)
def project_distinct_counts_by_program(spark: SparkSession, sf: str) -> DataFrame:
    return projects.project_counts(_report(spark, sf, per_task=False), projects.PROGRAM_DIMENSIONS)


@query(
    f"""WITH {LOCATED}
    SELECT CAST(k AS VARCHAR) AS project_id, concat('prg', c % 7) AS program_id,
        r_name AS state_name, n_name AS district_name, c_name AS school_name,
        concat('ent-r', n_regionkey) AS state_id, CAST(NULL AS VARCHAR) AS block_name
    FROM located"""
)
def project_locations_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    """Location names looked up by id or code, level by level."""
    report = projects.project_report(derive.projects(spark, sf), BASE, entities=derive.entity_table(spark, sf))
    return report.select(
        "project_id", "program_id", "state_name", "district_name", "school_name", "state_id", "block_name"
    ).distinct()


def _observation_answers(df: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    return answers.observation_answers(
        df,
        derive.questions(spark, sf),
        derive.solutions(spark, sf),
        derive.programs(spark, sf),
        derive.criteria(spark, sf),
        derive.entities(spark, sf),
        BASE,
    )


OBSERVATION_NAMES = [
    "observationSubmissionId",
    "appName",
    "solution_type",
    "location_validated_with_geotag",
    "entity",
    "entityName",
    "createdBy",
    "isAPrivateProgram",
    "programName",
    "programDescription",
    "solutionName",
    "scoringSystem",
    "observationName",
    "criteriaDescription",
    "section",
    "questionId",
    "questionAnswer",
    "questionResponseType",
    "questionResponseLabel_number",
    "questionResponseLabel",
    "questionExternalId",
    "questionName",
    "questionECM",
    "criteriaId",
    "criteriaExternalId",
    "remarks",
    "evidences",
    "instanceParentId",
    "instanceParentQuestion",
    "instanceParentCriteriaExternalId",
    "instanceParentExternalId",
    "instanceParentSection",
    "channel",
    "domainName",
    "domainExternalId",
    "domainLevel",
    "childName",
    "ancestorName",
    "childType",
    "childExternalid",
    "level",
    "label",
    "imp_project_id",
    "imp_project_externalId",
    "school",
    "blockName",
    "role_title",
    "organisation_name",
    "user_stateName",
    "user_districtName",
    "user_schoolUDISE_code",
]
# numbers that may be missing are compared as text
OBSERVATION_NUMBERS = [
    "distance_in_meters",
    "questionSequenceByEcm",
    "totalScore",
    "scoreAchieved",
    "maxScore",
    "minScore",
    "evidence_count",
    "total_evidences",
    "instanceId",
    "instanceParentEcmSequence",
    "domainScore",
    "criteriaScore",
]

OBSERVATION_SQL = f"""
WITH {LOCATED}, {ANSWERS},
rows AS (
    SELECT m.*, a.*, CAST(substr(crit, 5) AS BIGINT) AS ci,
        CASE qid WHEN 'q5' THEN 'S2' WHEN 'q6' THEN 'S2' ELSE 'S1' END AS section
    FROM matched m JOIN answered a USING (k) WHERE k % 11 > 0)
SELECT CAST(k AS VARCHAR) AS "observationSubmissionId",
    CASE WHEN k % 2 = 0 THEN 'portal' ELSE 'survey_app' END AS "appName",
    CASE WHEN k % 3 = 1 AND k % 2 = 0 THEN 'observation_with_rubric'
        ELSE 'observation_with_out_rubric' END AS solution_type,
    CASE WHEN c % 10 = 0 THEN 'gps location not found for school'
        WHEN instance IS NOT NULL OR k % 4 IN (0, 3) THEN 'gps location not found for question'
        WHEN k % 4 = 1 THEN 'verified' ELSE 'not verified' END AS location_validated_with_geotag,
    CASE WHEN c % 10 = 0 OR instance IS NOT NULL THEN NULL WHEN k % 4 = 1 THEN '111'
        WHEN k % 4 = 2 THEN '1111' END AS distance_in_meters,
    concat('ent-c', c) AS entity, c_name AS "entityName", CAST(c AS VARCHAR) AS "createdBy",
    k % 5 = 1 AS "isAPrivateProgram",
    concat('Program ', c % 7) AS "programName", concat('Describes ', c % 7) AS "programDescription",
    concat('Solution ', k % 6) AS "solutionName",
    CASE WHEN k % 2 = 0 THEN 'pointsBasedScoring' END AS "scoringSystem",
    concat('Observation ', k % 9) AS "observationName",
    concat('Criterion text ', ci) AS "criteriaDescription",
    section, qid AS "questionId", answer AS "questionAnswer", kind AS "questionResponseType",
    CASE WHEN kind = 'number' THEN label END AS "questionResponseLabel_number",
    label AS "questionResponseLabel", concat('Q-', qid) AS "questionExternalId",
    concat('Question ', qid, '?') AS "questionName", 'OB' AS "questionECM", crit AS "criteriaId",
    concat('CRIT-', ci) AS "criteriaExternalId",
    CASE WHEN k % 2 = 0 AND instance IS NULL THEN 'seen' END AS remarks,
    {URLS} AS evidences,
    CASE WHEN instance IS NOT NULL THEN 'q4' END AS "instanceParentId",
    CASE WHEN instance IS NOT NULL THEN 'Question q4?' END AS "instanceParentQuestion",
    CASE WHEN instance IS NOT NULL THEN 'CRIT-1' END AS "instanceParentCriteriaExternalId",
    CASE WHEN instance IS NOT NULL THEN 'Q-q4' END AS "instanceParentExternalId",
    CASE WHEN instance IS NOT NULL THEN 'S1' END AS "instanceParentSection",
    concat('root', n_regionkey) AS channel,
    CASE WHEN ci < 2 THEN 'Domain A' WHEN ci = 2 THEN 'Domain B' END AS "domainName",
    CASE WHEN ci < 2 THEN 'DA' WHEN ci = 2 THEN 'DB' END AS "domainExternalId",
    CASE WHEN ci < 2 THEN concat('L', k % 3) WHEN ci = 2 THEN concat('L', k % 2) END AS "domainLevel",
    CASE WHEN ci < 3 THEN concat('Criterion ', ci) END AS "childName",
    CASE ci WHEN 0 THEN 'Theme A1' WHEN 1 THEN 'Theme A3' WHEN 2 THEN 'Domain B' END AS "ancestorName",
    CASE WHEN ci < 3 THEN 'criteria' END AS "childType",
    CASE WHEN ci < 3 THEN crit END AS "childExternalid",
    CASE WHEN ci < 3 THEN concat('L', (k + ci) % 4) END AS level,
    CASE WHEN ci = 3 THEN NULL ELSE
        CASE (k + ci) % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Middle' WHEN 2 THEN 'High' END END AS label,
    CASE WHEN ci < 3 AND (k + ci) % 3 > 0 THEN concat('imp', (k + ci) % 3) END AS imp_project_id,
    CASE WHEN ci < 3 AND (k + ci) % 3 > 0 THEN concat('IMP', (k + ci) % 3) END AS "imp_project_externalId",
    CASE WHEN k % 8 > 0 THEN concat('ent-c', c) END AS school,
    CASE WHEN k % 8 = 0 THEN c_name END AS "blockName",
    c_mktsegment AS role_title,
    CASE k % 3 WHEN 1 THEN concat('Org ', c % 5) WHEN 2 THEN 'Last' END AS organisation_name,
    CASE WHEN c % 13 > 0 THEN r_name END AS "user_stateName",
    CASE WHEN c % 13 > 0 THEN n_name END AS "user_districtName",
    CASE WHEN c % 13 > 0 THEN concat('code-c', c) END AS "user_schoolUDISE_code",
    CASE WHEN section = 'S1' THEN CASE qid WHEN 'q3' THEN '1' WHEN 'q2' THEN '2' WHEN 'q1' THEN '3' END END
        AS "questionSequenceByEcm",
    CASE WHEN k % 2 = 0 THEN '100.0' END AS "totalScore",
    CASE WHEN k % 2 = 0 THEN concat(k % 100, '.0') END AS "scoreAchieved",
    CASE WHEN k % 2 = 0 AND instance IS NULL THEN '10.0' END AS "maxScore",
    CASE WHEN k % 2 = 0 AND instance IS NULL THEN concat(k % 10, '.0') END AS "minScore",
    CASE WHEN files > 0 THEN CAST(files AS VARCHAR) END AS evidence_count,
    CAST(total_evidences AS VARCHAR) AS total_evidences,
    CAST(instance AS VARCHAR) AS "instanceId",
    CASE WHEN instance IS NOT NULL THEN '4' END AS "instanceParentEcmSequence",
    CASE WHEN ci < 2 THEN concat(k % 50, '.0') WHEN ci = 2 THEN concat(k % 60, '.0') END AS "domainScore",
    CASE WHEN ci < 3 THEN concat((k + ci) % 7, '.0') END AS "criteriaScore"
FROM rows
"""


def observation_view(rows: DataFrame) -> DataFrame:
    numbers = [F.col(n).cast("string").alias(n) for n in OBSERVATION_NUMBERS]
    return rows.select(*OBSERVATION_NAMES, *numbers)


@query(OBSERVATION_SQL)
def observation_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Every question-level row of completed observations."""
    return observation_view(_observation_answers(derive.observations(spark, sf), spark, sf))


@query(
    f"""WITH {LOCATED}, {ANSWERS}, {ORGS}
    SELECT CAST(k AS VARCHAR) AS "surveySubmissionId", qid AS "questionId",
        answer AS "questionAnswer", label AS "questionResponseLabel",
        CASE WHEN kind = 'number' THEN label END AS "questionResponseLabel_number",
        CAST(instance AS VARCHAR) AS "instanceId", concat('Survey ', k % 9) AS "surveyName",
        concat('Solution ', k % 6) AS "solutionName", concat('Program ', c % 7) AS "programName",
        'S1' AS section, concat('CRIT-', substr(crit, 5)) AS "criteriaExternalId",
        concat('Criterion ', substr(crit, 5)) AS "criteriaName",
        CASE WHEN instance IS NOT NULL THEN 'Criterion 1' END AS "instanceParentCriteriaName",
        CASE qid WHEN 'q3' THEN '1' WHEN 'q2' THEN '2' WHEN 'q1' THEN '3' END AS "questionSequenceByEcm",
        organisation_id, organisation_name, c_mktsegment AS user_subtype,
        CASE WHEN c % 2 = 0 THEN 'teacher' ELSE 'teacher,head' END AS user_type,
        concat('B1,B', c % 3) AS board_name,
        CASE WHEN c % 13 > 0 THEN r_name END AS state_name,
        CASE WHEN c % 13 > 0 THEN concat('n', n_nationkey) END AS "district_externalId",
        {URLS} AS evidences, total_evidences
    FROM matched JOIN answered USING (k) JOIN orgs ON k = org_k"""
)
def survey_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Every question-level row of completed surveys, per organisation."""
    rows = answers.survey_answers(
        derive.surveys(spark, sf),
        derive.questions(spark, sf),
        derive.solutions(spark, sf),
        derive.programs(spark, sf),
        derive.criteria(spark, sf),
        BASE,
    )
    return rows.select(
        "surveySubmissionId", "questionId", "questionAnswer", "questionResponseLabel",
        "questionResponseLabel_number", F.col("instanceId").cast("string").alias("instanceId"),
        "surveyName", "solutionName", "programName", "section", "criteriaExternalId",
        "criteriaName", "instanceParentCriteriaName",
        F.col("questionSequenceByEcm").cast("string").alias("questionSequenceByEcm"),
        "organisation_id", "organisation_name", "user_subtype", "user_type", "board_name",
        "state_name", "district_externalId", "evidences",
        F.col("total_evidences").cast("bigint").alias("total_evidences"),
    )


@query(
    f"""WITH {LOCATED}, {ANSWERS}
    SELECT CAST(k AS VARCHAR) AS submission_id, qid, kind, answer, label FROM matched
    WHERE instance IS NULL"""
)
def match_options(spark: SparkSession, sf: str) -> DataFrame:
    """Plain answers against the options of their question."""
    subs = derive.surveys(spark, sf).filter(
        (F.col("status") == "completed") & F.col("isAPrivateProgram").isNotNull()
    )
    rows = explode_answers(subs.select("_id", "answers")).filter(F.col("instance_id").isNull())
    return match_answers(rows, derive.questions(spark, sf)).select(
        F.col("_id").alias("submission_id"),
        F.col("a_qid").alias("qid"),
        F.col("a_responseType").alias("kind"),
        F.col("questionAnswer").alias("answer"),
        F.col("_label").alias("label"),
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS submission_id, CAST(i AS BIGINT) AS instance_id, qid,
        CASE qid WHEN 'q5' THEN concat('note ', i) ELSE o_orderpriority END AS answer
    FROM (SELECT o_orderkey, o_orderpriority, unnest(range(1, o_orderkey % 4 + 1)) AS i
          FROM orders WHERE o_orderkey % 17 <> 0), (VALUES ('q5'), ('q2')) v(qid)"""
)
def matrix_instances(spark: SparkSession, sf: str) -> DataFrame:
    """Answers inside matrix questions, whether an instance is a list or an object."""
    rows = explode_answers(derive.surveys(spark, sf).select("_id", "answers"))
    return rows.filter(F.col("instance_id").isNotNull()).select(
        F.col("_id").alias("submission_id"),
        F.col("instance_id").cast("bigint").alias("instance_id"),
        F.col("a_qid").alias("qid"),
        F.expr("a_value::string").alias("answer"),
    )


_FILE_ROWS = """
    files AS (
        SELECT k, 'q1' AS qid, 'number' AS kind, k % 3 AS n,
            CASE k % 3 WHEN 1 THEN 'q1-1.jpg' ELSE 'q1-1.jpg,q1-2.jpg' END AS names,
            CASE k % 3 WHEN 1 THEN 'q1/1' ELSE 'q1/1,q1/2' END AS paths FROM answered
        UNION ALL SELECT k, 'q2', 'radio', (k + 1) % 3,
            CASE (k + 1) % 3 WHEN 1 THEN 'q2-1.jpg' ELSE 'q2-1.jpg,q2-2.jpg' END,
            CASE (k + 1) % 3 WHEN 1 THEN 'q2/1' ELSE 'q2/1,q2/2' END FROM answered
        UNION ALL SELECT k, 'q4', 'matrix', k % 2 + k % 3,
            concat_ws(',', CASE WHEN k % 2 = 1 THEN 'm1-1.jpg' END,
                CASE WHEN k % 3 > 0 THEN 'm2-1.jpg' END, CASE WHEN k % 3 > 1 THEN 'm2-2.jpg' END),
            concat_ws(',', CASE WHEN k % 2 = 1 THEN 'm1/1' END,
                CASE WHEN k % 3 > 0 THEN 'm2/1' END, CASE WHEN k % 3 > 1 THEN 'm2/2' END) FROM answered)
"""


def _evidence_sql(key: str, extra: str) -> str:
    return f"""WITH {LOCATED}, {ANSWERS}, {_FILE_ROWS}
    SELECT CAST(k AS VARCHAR) AS "{key}", {extra}
        CAST(c AS VARCHAR) AS "createdBy", concat('sol', k % 6) AS "solutionId",
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "completedDate",
        CASE WHEN k % 2 = 0 THEN 'portal' ELSE 'survey_app' END AS "appName",
        total_evidences, CASE WHEN k % 2 = 0 THEN 'seen' END AS remarks,
        qid AS "questionId", qid AS "questionExternalId", concat('Question ', qid, '?') AS "questionName",
        kind AS "questionResponseType", n AS evidence_count, names AS "fileName", paths AS "fileSourcePath"
    FROM files JOIN answered USING (k) WHERE n > 0 AND k % 11 > 0"""


def evidence_view(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(
        *names, "createdBy", "solutionId", F.date_format("completedDate", TS).alias("completedDate"),
        "appName", F.col("total_evidences").cast("bigint").alias("total_evidences"), "remarks",
        "questionId", "questionExternalId", "questionName", "questionResponseType",
        F.col("evidence_count").cast("bigint").alias("evidence_count"), "fileName", "fileSourcePath",
    )


EVIDENCE_SQL = _evidence_sql(
    "observationSubmissionId",
    "concat('ent-c', c) AS entity, c_name AS \"entityName\", concat('obs', k % 9) AS \"observationId\",",
)


@query(EVIDENCE_SQL)
def evidence_extract(spark: SparkSession, sf: str) -> DataFrame:
    rows = evidence.observation_evidence(derive.observations(spark, sf))
    return evidence_view(rows, "observationSubmissionId", "entity", "entityName", "observationId")


@query(_evidence_sql("surveySubmissionId", "concat('sur', k % 9) AS \"surveyId\","))
def survey_evidence_extract(spark: SparkSession, sf: str) -> DataFrame:
    rows = evidence.survey_evidence(derive.surveys(spark, sf))
    return evidence_view(rows, "surveySubmissionId", "surveyId")


_STATUS_SQL = f"""
WITH {LOCATED},
report AS (
    SELECT CAST(k AS VARCHAR) AS submission_id, {STATUS} AS status,
        concat('code-c', c) AS "entity_externalId", concat('ent-c', c) AS entity_id,
        CASE WHEN k % 8 = 0 THEN 'block' ELSE 'school' END AS entity_type,
        CAST(c AS VARCHAR) AS user_id, concat('sol', k % 6) AS solution_id,
        concat('Solution ', k % 6) AS solution_name, concat('prg', c % 7) AS program_id,
        concat('Program ', c % 7) AS program_name,
        CASE WHEN k % 2 = 0 THEN 'portal' ELSE 'survey_app' END AS app_name,
        CASE WHEN k % 5 < 2 THEN 'true' ELSE 'false' END AS private_program,
        CASE WHEN k % 3 = 1 AND k % 2 = 0 THEN 'observation_with_rubric'
            ELSE 'observation_with_out_rubric' END AS solution_type,
        concat(CASE WHEN k % 2 = 0 THEN 'OB;' ELSE '' END, CASE WHEN k % 3 = 0 THEN 'BL;' ELSE '' END)
            AS ecm_marked_na,
        c_mktsegment AS role_title, concat('root', n_regionkey) AS channel,
        concat('B1,B', c % 3) AS board_name,
        CASE WHEN c % 2 = 0 THEN 'teacher' ELSE 'teacher,head' END AS user_type,
        CASE k % 3 WHEN 1 THEN concat('Org ', c % 5) WHEN 2 THEN 'Last' END AS organisation_name,
        CASE k % 3 WHEN 1 THEN concat('org', c % 5) WHEN 2 THEN 'last' END AS organisation_id,
        CASE WHEN c % 13 > 0 THEN r_name END AS state_name,
        CASE WHEN c % 13 > 0 THEN concat('r', n_regionkey) END AS "state_externalId",
        CASE WHEN c % 13 > 0 THEN n_name END AS district_name,
        CASE WHEN c % 13 > 0 THEN concat('n', n_nationkey) END AS "district_externalId",
        CASE WHEN c % 13 > 0 THEN c_name END AS school_name, k, c
    FROM located)
"""
# the same rows once per organisation that is not a school
_STATUS_ORGS_SQL = f"""{_STATUS_SQL}, {ORGS},
fanned AS (
    SELECT report.* EXCLUDE (organisation_name, organisation_id), orgs.organisation_name,
        orgs.organisation_id
    FROM report JOIN orgs ON org_k = k)
"""
_STATUS_NAMES = [
    "submission_id", "status", "entity_externalId", "entity_id", "entity_type", "user_id",
    "solution_id", "solution_name", "program_id", "program_name", "app_name", "private_program",
    "solution_type", "ecm_marked_na", "role_title", "channel", "board_name", "user_type",
    "organisation_name", "organisation_id", "state_name", "state_externalId", "district_name",
    "district_externalId", "school_name",
]


def _status(spark: SparkSession, sf: str, **options) -> DataFrame:
    return status.status_report(
        derive.observations(spark, sf),
        derive.solutions(spark, sf),
        derive.programs(spark, sf),
        **options,
    )


@query(f"{_STATUS_SQL} SELECT * EXCLUDE (k, c) FROM report")
def status_report(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf).select(*_STATUS_NAMES)


@query(
    f"""{_STATUS_SQL},
    places AS (SELECT DISTINCT n_nationkey, n_name FROM located WHERE c % 13 > 0)
    SELECT submission_id, p.n_name AS district_name, concat('n', p.n_nationkey) AS district_id
    FROM report JOIN located ON located.k = report.k JOIN places p USING (n_nationkey)"""
)
def status_report_required_level(spark: SparkSession, sf: str) -> DataFrame:
    """Names from all users' locations; submissions without a known district drop out."""
    keys = materialize(
        status.location_keys(derive.observations(spark, sf)), "places", ["entity_type"])
    report = _status(spark, sf, keys=keys, require=["district"])
    return report.select("submission_id", "district_name", "district_id")


_STATUS_COUNTS = """count(DISTINCT submission_id) AS unique_submissions,
    count(DISTINCT entity_id) AS unique_entities, count(DISTINCT user_id) AS unique_users"""
_STATUS_DIMS = """program_name, program_id, solution_name, solution_id, state_name, "state_externalId",
    district_name, "district_externalId", organisation_name, organisation_id,
    CAST(NULL AS VARCHAR) AS parent_channel, solution_type, private_program"""


@query(f"{_STATUS_ORGS_SQL} SELECT * EXCLUDE (k, c) FROM fanned")
def status_report_organisations(spark: SparkSession, sf: str) -> DataFrame:
    """A row per submission and organisation."""
    return _status(spark, sf, every_organisation=True).select(*_STATUS_NAMES)


@query(f"{_STATUS_ORGS_SQL} SELECT {_STATUS_DIMS}, status, {_STATUS_COUNTS} FROM fanned GROUP BY ALL")
def status_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return status.status_counts(_status(spark, sf, every_organisation=True))


_DOMAIN_SQL = f"""{_STATUS_ORGS_SQL},
themed AS (
    SELECT *, 'Domain A' AS domain_name, 'DA' AS "domain_externalId", concat('L', k % 3) AS domain_level,
        unnest([0, 1]) AS ci FROM fanned
    UNION ALL SELECT *, 'Domain B', 'DB', concat('L', k % 2), 2 FROM fanned),
scored AS (
    SELECT *, concat('Criterion ', ci) AS criteria_name, concat('L', (k + ci) % 4) AS criteria_score,
        concat('crit', ci) AS criteria_id
    FROM themed WHERE status = 'completed' AND solution_type = 'observation_with_rubric')
"""
_DOMAIN_DIMS = f'{_STATUS_DIMS}, domain_name, "domain_externalId", domain_level'


@query(f"{_DOMAIN_SQL} SELECT {_DOMAIN_DIMS}, {_STATUS_COUNTS} FROM scored GROUP BY ALL")
def domain_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return status.domain_counts(_status(spark, sf, every_organisation=True))


@query(
    f"""{_DOMAIN_SQL} SELECT {_DOMAIN_DIMS}, criteria_name, criteria_score, criteria_id, {_STATUS_COUNTS}
    FROM scored GROUP BY ALL"""
)
def domain_criteria_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return status.domain_counts(_status(spark, sf, every_organisation=True), by_criteria=True)


@query(
    f"""WITH {LOCATED}, wanted AS (SELECT DISTINCT concat('prg', p_partkey % 3) AS program_id FROM part),
    entries(kind, qid, kind_name) AS (VALUES (1, 'q1', 'number'), (1, 'q2', 'radio'),
        (1, 'q3', 'multiselect'), (1, 'q4', 'matrix'), (1, 'q6', 'text'), (1, 'q2', 'slider'),
        (1, 'q8', 'pageQuestions'), (0, NULL, NULL))
    SELECT CAST(k AS VARCHAR) AS submission_id, concat('prg', c % 7) AS program_id,
        concat('Program ', c % 7) AS program_name, concat('Solution ', k % 6) AS solution_name,
        c_name AS "userName", n_name AS district_name, qid, kind_name AS "responseType",
        CASE WHEN qid IS NOT NULL THEN concat('Question ', qid, '?') END AS question,
        CASE WHEN kind = 0 OR k % 4 = 0 THEN 'gps location not found for school'
            WHEN k % 4 = 1 THEN concat(c % 80, '.001,', c % 170)
            WHEN k % 4 = 2 THEN concat(c % 80, '.01,', c % 170) ELSE 'unknown' END AS "gpsLocation",
        CASE qid WHEN 'q1' THEN k % 3 = 0
            WHEN 'q2' THEN kind_name = 'slider' OR (k + 1) % 3 = 0 ELSE true END AS without_files
    FROM located JOIN entries ON kind = CASE WHEN k % 17 = 0 THEN 0 ELSE 1 END
    WHERE concat('prg', c % 7) IN (SELECT program_id FROM wanted)"""
)
def question_dump(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of the programs named by a parameter table, one pass for all."""
    wanted = spark.read.parquet(f"{sf}/part.parquet").selectExpr(
        "concat('prg', p_partkey % 3) AS program_id"
    )
    rows = dump.question_dump(
        derive.observations(spark, sf),
        derive.solutions(spark, sf),
        derive.programs(spark, sf),
        wanted.distinct(),
        derive.entity_table(spark, sf),
    )
    return rows.select(
        "submission_id", "program_id", "program_name", "solution_name", "userName",
        "district_name", "qid", "responseType", "question", "gpsLocation", "without_files",
    )


@query(
    f"""WITH {LOCATED}
    SELECT CAST(k AS VARCHAR) AS submission_id, kind, CAST(n AS BIGINT) AS n FROM (
        SELECT k, unnest(['number', 'radio', 'multiselect', 'matrix', 'text', 'slider', 'pageQuestions'])
            AS kind, 1 AS n FROM located WHERE k % 17 <> 0
        UNION ALL SELECT k, NULL, 0 FROM located WHERE k % 17 = 0)"""
)
def explode_map_answers(spark: SparkSession, sf: str) -> DataFrame:
    """The answers map to rows, keeping submissions without answers."""
    from formfold.operators import explode_map

    rows = explode_map(derive.surveys(spark, sf).select("_id", "answers"), "answers", "key", "a")
    return rows.select(
        F.col("_id").alias("submission_id"),
        F.col("a.responseType").alias("kind"),
        F.when(F.col("key").isNull(), 0).otherwise(1).cast("bigint").alias("n"),
    )


@query(
    f"""WITH {LOCATED}, {ORGS}
    SELECT CAST(org_k AS VARCHAR) AS submission_id, organisation_id, organisation_name FROM orgs"""
)
def fan_out_organisations(spark: SparkSession, sf: str) -> DataFrame:
    subs = derive.surveys(spark, sf).select(F.col("_id").alias("submission_id"), "userProfile")
    return fan_out_orgs(subs, "userProfile.organisations").drop("userProfile")


@query(
    f"""WITH {LOCATED}
    SELECT DISTINCT CAST(k AS VARCHAR) AS submission_id, title, place FROM (
        SELECT k, concat('role', c % 2) AS title, n_name AS place FROM located WHERE k % 4 > 0
        UNION ALL SELECT k, concat('role', c % 3), n_name FROM located WHERE k % 4 > 0
        UNION ALL SELECT k, NULL, NULL FROM located WHERE k % 4 = 0)"""
)
def fan_out_user_roles(spark: SparkSession, sf: str) -> DataFrame:
    """One row per distinct role of the user; users without roles keep a row."""
    roles = """if(o_orderkey % 4 > 0, array(
        named_struct('title', concat('role', o_custkey % 2), 'place', n_name),
        named_struct('title', concat('role', o_custkey % 3), 'place', n_name)), null) AS roles"""
    subs = derive.located_orders(spark, sf).selectExpr(
        "cast(o_orderkey as string) AS submission_id", roles
    )
    return fan_out_roles(subs, "roles")


@query(
    f"""WITH {LOCATED}
    SELECT CAST(k AS VARCHAR) AS submission_id,
        CASE WHEN c % 13 > 0 THEN r_name END AS state_name,
        CASE WHEN c % 13 > 0 THEN concat('r', n_regionkey) END AS "state_externalId",
        CASE WHEN c % 13 > 0 THEN concat('code-r', n_regionkey) END AS state_code,
        CASE WHEN c % 13 > 0 THEN n_name END AS district_name,
        CASE WHEN c % 13 > 0 THEN c_name END AS school_name,
        CAST(NULL AS VARCHAR) AS block_name
    FROM located"""
)
def location_columns(spark: SparkSession, sf: str) -> DataFrame:
    subs = derive.surveys(spark, sf).select(F.col("_id").alias("submission_id"), "userProfile")
    return locations_to_columns(subs, "userProfile.userLocations").select(
        "submission_id", "state_name", "state_externalId", "state_code", "district_name",
        "school_name", "block_name",
    )


@query(
    """SELECT DISTINCT concat('sol', o_orderkey % 6) AS solution_id, domain_name, domain_externalId,
        parent, criteria_id
    FROM orders, (VALUES ('Domain A', 'DA', 'Theme A1', 'crit0'), ('Domain A', 'DA', 'Theme A3', 'crit1'),
        ('Domain B', 'DB', 'Domain B', 'crit2')) v(domain_name, domain_externalId, parent, criteria_id)"""
)
def theme_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Criteria of every solution's theme tree with their domain."""
    # Read twice, for keys and for documents, so written once.
    return theme_table(materialize(derive.solutions(spark, sf), "solutions"))


@query(
    f"""WITH {LOCATED}
    SELECT CAST(k AS VARCHAR) AS submission_id,
        CASE WHEN k % 8 > 0 THEN concat('ent-c', c) END AS school,
        CASE WHEN k % 8 > 0 THEN c_name END AS "schoolName",
        CASE WHEN k % 8 = 0 THEN concat('code-c', c) END AS "blockExternalId"
    FROM located"""
)
def entity_type_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Entity id, name and external id under the names of the row's entity type."""
    subs = derive.observations(spark, sf).select(
        F.col("_id").alias("submission_id"), "entityType", "entityId", "entityExternalId",
        F.col("entityInformation.name").alias("entityName"),
    )
    rows = entity_columns(
        subs, ["block", "school"], "entityType", "entityId", "entityName", "entityExternalId"
    )
    return rows.select("submission_id", "school", "schoolName", "blockExternalId")


_RUBRIC_SQL = f"FROM ({OBSERVATION_SQL}) AS o WHERE solution_type = 'observation_with_rubric'"
_HAND_WHO = """"createdBy" AS "UUID", role_title AS "User Sub Type", organisation_name AS "Org Name",
    "programName" AS "Program Name", "solutionName" AS "Observation Name",
    "observationSubmissionId" AS observation_submission_id, "domainName" AS "Domain Name",
    "user_stateName" AS "Declared State", "user_districtName" AS "District",
    "user_schoolUDISE_code" AS "School ID\""""


@query(
    f"""SELECT DISTINCT {_HAND_WHO}, "domainLevel" AS "Domain Level", "childName" AS "Criteria Name",
        level AS "Criteria Level" {_RUBRIC_SQL}"""
)
def domain_hand_report(spark: SparkSession, sf: str) -> DataFrame:
    """Domains and criteria of rubric observations under their labels."""
    return hand.domain_report(observation_answers(spark, sf))


@query(
    f"""SELECT DISTINCT {_HAND_WHO}, "questionExternalId" AS "Question_external_id",
        "questionName" AS "Question", "questionResponseLabel" AS "Question_response_label",
        evidences AS "Evidences", remarks AS "Remarks" {_RUBRIC_SQL}"""
)
def question_hand_report(spark: SparkSession, sf: str) -> DataFrame:
    """Questions and answers of rubric observations under their labels."""
    rows = hand.question_report(observation_answers(spark, sf))
    return rows.drop("Question score")


@query(
    f"""{_STATUS_SQL} SELECT DISTINCT user_id AS "UUID", role_title AS "User sub type",
        state_name AS "Declared State", program_name AS "Program Name", status AS "Status"
    FROM report WHERE app_name = 'portal' AND solution_type = 'observation_with_rubric'
        AND private_program = 'false' AND user_id IN (
            SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)"""
)
def status_hand_report(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows of the users a table names, for one app and kind of observation."""
    users = spark.read.parquet(f"{sf}/customer.parquet").filter("c_acctbal > 0")
    users = users.select(F.col("c_custkey").cast("string").alias("id"))
    labels = {
        "user_id": "UUID",
        "role_title": "User sub type",
        "state_name": "Declared State",
        "program_name": "Program Name",
        "status": "Status",
    }
    kind = {"solution_type": hand.RUBRIC, "private_program": "false"}
    return hand.handed_status(_status(spark, sf), users, ["portal"], labels, **kind)
