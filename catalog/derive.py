"""Nested documents derived row by row from the given tables.

An order stands for a project or a submission, its customer for the user and
the school, the nation for the district and the region for the state. Arrays
and maps are built inside the order's row with simple arithmetic on its keys,
so deriving them needs no grouping, and the flat result can be computed again
in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.operators import entity_keys
from formfold.sources import spread
from formfold.workspace import materialize

from .registry import table

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'started' ELSE 'inProgress' END"

ROLE_INFO = """named_struct(
    'state', concat('loc-r', n_regionkey), 'block', cast(null as string),
    'district', concat('code-n', n_nationkey), 'cluster', cast(null as string),
    'school', concat('loc-c', o_custkey), 'role', c_mktsegment)"""

LOCATIONS = """if(o_custkey % 13 = 0, null, array(
    named_struct('name', r_name, 'type', 'state',
                 'id', concat('r', n_regionkey), 'code', concat('code-r', n_regionkey)),
    named_struct('name', n_name, 'type', 'district',
                 'id', concat('n', n_nationkey), 'code', concat('code-n', n_nationkey)),
    named_struct('name', c_name, 'type', 'school',
                 'id', concat('c', o_custkey), 'code', concat('code-c', o_custkey))))"""

# 0: no list; 1: one organisation; 2: a school, and another organisation twice
ORGANISATIONS = """CASE o_orderkey % 3
    WHEN 1 THEN array(named_struct('organisationId', concat('org', o_custkey % 5),
        'orgName', concat('Org ', o_custkey % 5), 'isSchool', false))
    WHEN 2 THEN array(
        named_struct('organisationId', concat('org', o_custkey % 5),
            'orgName', concat('Org ', o_custkey % 5), 'isSchool', false),
        named_struct('organisationId', concat('org', o_custkey % 5),
            'orgName', concat('Org ', o_custkey % 5), 'isSchool', false),
        named_struct('organisationId', 'school', 'orgName', c_name, 'isSchool', true),
        named_struct('organisationId', 'last', 'orgName', 'Last', 'isSchool', cast(null as boolean)))
    END"""

PROFILE = f"""named_struct(
    'rootOrgId', concat('root', n_regionkey), 'userName', c_name,
    'userId', cast(o_custkey as string),
    'framework', named_struct('board', array('B1', concat('B', o_custkey % 3))),
    'organisations', {ORGANISATIONS},
    'profileUserTypes', array(named_struct('type', 'teacher'),
        named_struct('type', if(o_custkey % 2 = 0, 'teacher', 'head'))),
    'userLocations', {LOCATIONS})"""


def located_orders(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """Orders (the table, or a stream of it) with their customer, nation and region."""
    orders = spread(table(spark, sf, "orders")) if orders is None else orders
    return (
        orders.join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    )


def _attachments(n: str, tag: str) -> str:
    """n attachments; every third one is a link."""
    return f"""transform(if({n} > 0, sequence(1, cast({n} as int)), array()), i -> named_struct(
        'type', if(i % 3 = 0, 'link', 'image'), 'name', concat({tag}, '-name', i),
        'sourcePath', concat({tag}, '-path', i)))"""


def projects(spark: SparkSession, sf: str) -> DataFrame:
    """Projects with k % 4 tasks; attachments and sub-tasks vary per task."""
    tasks = f"""transform(
        if(o_orderkey % 4 > 0, sequence(1, cast(o_orderkey % 4 as int)), array()), t -> named_struct(
        '_id', concat('t', t), 'name', concat('Task\\n', t), 'isDeleted', t = 2,
        'assignee', if(t = 3, null, 'a'), 'startDate', cast(null as string),
        'endDate', '2024-01-01', 'syncedAt', cast(o_orderdate as timestamp),
        'status', if(t = 1, 'done', null),
        'remarks', if((o_orderkey + t) % 2 = 0, concat('note ', t), null),
        'attachments', {_attachments("((o_orderkey + t) % 5)", "concat('t', t)")},
        'children', transform(
            if((o_custkey + t) % 3 > 0, sequence(1, cast((o_custkey + t) % 3 as int)), array()),
            s -> named_struct('_id', concat('s', t, '.', s), 'name', concat('Sub ', s),
                'status', 'open', 'syncedAt', cast(o_orderdate as timestamp),
                'startDate', if(s = 1, '2024-02-01', null), 'endDate', cast(null as string),
                'isDeleted', if(s = 2, true, null)))))"""
    return located_orders(spark, sf).selectExpr(
        "cast(o_orderkey as string) AS _id",
        "if(o_orderkey % 3 = 0, null, 'template') AS projectTemplateId",
        "concat('Project\\n', o_orderkey % 10) AS title",
        "o_orderpriority AS description",
        "if(o_orderstatus = 'F', 'submitted', 'started') AS status",
        "cast(o_custkey as string) AS userId",
        "concat('prg', o_custkey % 7) AS programId",
        "concat('PRG-', o_custkey % 7) AS programExternalId",
        "named_struct('name', concat('Program\\n', o_custkey % 7)) AS programInformation",
        """named_struct('name', if(o_orderkey % 2 = 0, concat('Solution ', o_orderkey % 6), null),
            '_id', concat('sol', o_orderkey % 6)) AS solutionInformation""",
        "named_struct('duration', '1 week', 'goal', concat('Goal\\n', o_orderpriority)) AS metaInformation",
        "cast(o_orderdate as timestamp) AS createdAt",
        "cast(o_orderdate as timestamp) AS updatedAt",
        "cast(o_orderdate as timestamp) AS syncedAt",
        "if(o_orderkey % 7 = 0, true, null) AS isDeleted",
        "if(o_orderkey % 5 = 0, false, null) AS isAPrivateProgram",
        "if(o_orderkey % 4 = 0, true, null) AS hasAcceptedTAndC",
        """transform(if(o_orderkey % 3 > 0, sequence(1, cast(o_orderkey % 3 as int)), array()),
            i -> named_struct('name', concat('Cat', i))) AS categories""",
        "if(o_orderkey % 6 < 3, concat('remark\\n', o_orderkey), null) AS remarks",
        f"{_attachments('(o_orderkey % 6)', repr('p'))} AS attachments",
        f"{tasks} AS tasks",
        """named_struct('osid', concat('cert', o_orderkey),
            'status', if(o_orderkey % 9 = 0, 'active', 'open'),
            'issuedOn', '2024-03-01') AS certificate""",
        f"{ROLE_INFO} AS userRoleInformation",
        f"{PROFILE} AS userProfile",
    )


def _files(n: str, tag: str) -> str:
    return f"""transform(if({n} > 0, sequence(1, cast({n} as int)), array()), i -> named_struct(
        'name', concat('{tag}-', i, '.jpg'), 'sourcePath', concat('{tag}/', i)))"""


NO_FILES = "cast(null as array<struct<name:string,sourcePath:string>>)"
NO_INSTANCES = "cast(null as array<array<struct<name:string,sourcePath:string>>>)"


def _answer(
    qid: str,
    kind: str,
    value: str,
    labels: str,
    files: str = NO_FILES,
    instance_files: str = NO_INSTANCES,
    criteria: str = "concat('crit', o_orderkey % 4)",
) -> str:
    """One answer struct; ``value`` and ``labels`` are variant expressions."""
    return f"""named_struct(
        'qid', '{qid}', 'responseType', '{kind}', 'value', {value},
        'remarks', if(o_orderkey % 2 = 0, 'seen', null),
        'gpsLocation', {GPS_ANSWER},
        'criteriaId', {criteria}, 'evidenceMethod', 'OB',
        'fileName', {files}, 'instanceFileName', {instance_files},
        'maxScore', cast(10 as double), 'scoreAchieved', cast(o_orderkey % 10 as double),
        'percentageScore', cast(10 * (o_orderkey % 10) as double),
        'pointsBasedScoreInParent', cast(null as double),
        'payload', named_struct('question', array('Question {qid}?'), 'labels', {labels}))"""


# none; 0.001 degree off (inside the fence); 0.01 degree off (outside); unreadable
GPS_ANSWER = """CASE o_orderkey % 4 WHEN 1 THEN concat(o_custkey % 80, '.001,', o_custkey % 170)
    WHEN 2 THEN concat(o_custkey % 80, '.01,', o_custkey % 170) WHEN 3 THEN 'unknown' END"""

SELECTED = "array(o_orderstatus, substr(o_orderpriority, 1, 1), 'none')"

# an instance is an object of answers for odd places, a list for even ones
_NOTE = """named_struct('qid', 'q5', 'responseType', 'text', 'value', concat('note ', i),
    'criteriaId', 'crit0', 'evidenceMethod', 'OB', 'remarks', cast(null as string), 'payload',
    named_struct('question', array('Question q5?'), 'labels', array(concat('note ', i))))"""
_PICK = """named_struct('qid', 'q2', 'responseType', 'radio', 'value', o_orderpriority,
    'criteriaId', 'crit0', 'evidenceMethod', 'OB', 'remarks', cast(null as string), 'payload',
    named_struct('question', array('Question q2?'), 'labels', array('chosen')))"""
MATRIX = f"""to_variant_object(transform(
    if(o_orderkey % 4 > 0, sequence(1, cast(o_orderkey % 4 as int)), array()),
    i -> if(i % 2 = 1, to_variant_object(map('first', {_NOTE}, 'second', {_PICK})),
        to_variant_object(array({_NOTE}, {_PICK})))))"""


def _answers() -> str:
    entries = {
        "a1": _answer(
            "q1", "number", "cast(cast(o_totalprice as bigint) as variant)",
            "to_variant_object(if(o_orderkey % 5 = 0, array(), array(cast(o_custkey as string))))",
            _files("(o_orderkey % 3)", "q1"),
        ),
        "a2": _answer(
            "q2", "radio", "cast(o_orderpriority as variant)",
            "to_variant_object(array(concat('picked ', o_orderpriority)))",
            _files("((o_orderkey + 1) % 3)", "q2"),
        ),
        "a3": _answer(
            "q3", "multiselect", f"to_variant_object({SELECTED})",
            f"to_variant_object({SELECTED})",
        ),
        "a4": _answer(
            "q4", "matrix", MATRIX, "cast(null as variant)",
            instance_files=f"array({_files('(o_orderkey % 2)', 'm1')}, {_files('(o_orderkey % 3)', 'm2')})",
            criteria="'crit1'",
        ),
        "a6": _answer(
            "q6", "text", "cast(o_orderpriority as variant)", "cast('free text' as variant)"
        ),
        "a7": _answer(
            "q2", "slider", "cast(cast(2.5 as double) as variant)",
            "to_variant_object(array('2.5'))",
        ),
        "a8": _answer("q8", "pageQuestions", "cast('x' as variant)", "cast(null as variant)"),
    }
    pairs = ", ".join(f"'{key}', {answer}" for key, answer in entries.items())
    return f"if(o_orderkey % 17 = 0, null, map({pairs}))"


THEMES = """array(
    named_struct('name', 'Domain A', 'externalId', 'DA',
        'pointsBasedLevel', concat('L', o_orderkey % 3), 'scoreAchieved', cast(o_orderkey % 50 as double),
        'criteria', array(named_struct('criteriaId', 'crit0'), named_struct('criteriaId', 'crit1'))),
    named_struct('name', 'Domain B', 'externalId', 'DB',
        'pointsBasedLevel', concat('L', o_orderkey % 2), 'scoreAchieved', cast(o_orderkey % 60 as double),
        'criteria', array(named_struct('criteriaId', 'parent2'))))"""

CRITERIA = """transform(array(0, 1, 2, 3), i -> named_struct(
    '_id', concat('crit', i), 'parentCriteriaId', if(i >= 2, concat('parent', i), null),
    'name', concat('Criterion ', i), 'description', 'd',
    'score', concat('L', (o_orderkey + i) % 4), 'scoreAchieved', cast((o_orderkey + i) % 7 as double),
    'rubric', named_struct('levels', map(
        'L0', named_struct('level', 'L0', 'label', 'Low'),
        'L1', named_struct('level', 'L1', 'label', 'Middle'),
        'L2', named_struct('level', 'L2', 'label', 'High'))),
    'improvementProjects', transform(
        if((o_orderkey + i) % 3 > 0, sequence(1, cast((o_orderkey + i) % 3 as int)), array()),
        j -> named_struct('_id', concat('imp', j), 'title', concat('Improve ', j),
            'goal', 'better', 'externalId', concat('IMP', j)))))"""


def _submission_columns() -> list[str]:
    return [
        "cast(o_orderkey as string) AS _id",
        f"{STATUS} AS status",
        "cast(o_custkey as string) AS createdBy",
        "concat('sol', o_orderkey % 6) AS solutionId",
        "concat('SOL-', o_orderkey % 6) AS solutionExternalId",
        "concat('prg', o_custkey % 7) AS programId",
        "concat('PRG-', o_custkey % 7) AS programExternalId",
        "concat('Submission ', o_orderkey) AS title",
        "cast(o_orderkey % 4 as int) AS submissionNumber",
        "cast(o_orderdate as timestamp) AS createdAt",
        "cast(o_orderdate as timestamp) AS updatedAt",
        "if(o_orderstatus = 'F' AND o_orderkey % 11 > 0, cast(o_orderdate as timestamp), null) AS completedDate",
        "CASE o_orderkey % 5 WHEN 0 THEN null WHEN 1 THEN true ELSE false END AS isAPrivateProgram",
        "named_struct('appName', if(o_orderkey % 2 = 0, 'Portal', null)) AS appInformation",
        "cast(100 as double) AS pointsBasedMaxScore",
        "cast(o_orderkey % 100 as double) AS pointsBasedScoreAchieved",
        "cast(o_orderkey % 100 as double) AS pointsBasedPercentageScore",
        f"{_answers()} AS answers",
        f"{ROLE_INFO} AS userRoleInformation",
        f"{PROFILE} AS userProfile",
    ]


def observations(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    return located_orders(spark, sf, orders).selectExpr(
        *_submission_columns(),
        "concat('ent-c', o_custkey) AS entityId",
        "concat('code-c', o_custkey) AS entityExternalId",
        "if(o_orderkey % 8 = 0, 'block', 'school') AS entityType",
        "'type1' AS entityTypeId",
        "concat('obs', o_orderkey % 9) AS observationId",
        "named_struct('name', concat('Observation ', o_orderkey % 9)) AS observationInformation",
        "if(o_orderkey % 3 = 0, null, o_orderkey % 3 = 1) AS isRubricDriven",
        "o_orderkey % 2 = 0 AS criteriaLevelReport",
        """named_struct('name', c_name, 'externalId', concat('code-c', o_custkey),
            'schoolTypes', cast(null as string), 'administrationTypes', cast(null as string)) AS entityInformation""",
        """array(named_struct('name', 'OB', 'notApplicable', o_orderkey % 2 = 0),
            named_struct('name', 'IN', 'notApplicable', false),
            named_struct('name', 'BL', 'notApplicable', o_orderkey % 3 = 0)) AS evidencesStatus""",
        f"{THEMES} AS themes",
        f"{CRITERIA} AS criteria",
    )


def surveys(spark: SparkSession, sf: str) -> DataFrame:
    return located_orders(spark, sf).selectExpr(
        *_submission_columns(),
        "concat('sur', o_orderkey % 9) AS surveyId",
        "named_struct('name', concat('Survey ', o_orderkey % 9)) AS surveyInformation",
    )


def entities(spark: SparkSession, sf: str) -> DataFrame:
    """Regions, nations and customers as state, district and school entities."""

    def typed(df: DataFrame, kind: str, key: str, name: str, tag: str, gps: str) -> DataFrame:
        return df.selectExpr(
            f"concat('ent-{tag}', {key}) AS _id",
            f"'{kind}' AS entityType",
            f"named_struct('name', {name}, 'gpsLocation', {gps}) AS metaInformation",
            f"named_struct('locationId', concat('loc-{tag}', {key}), "
            f"'code', concat('code-{tag}', {key})) AS registryDetails",
        )

    none = "cast(null as string)"
    gps = "if(c_custkey % 10 = 0, null, concat(c_custkey % 80, ',', c_custkey % 170))"
    return (
        typed(table(spark, sf, "region"), "state", "r_regionkey", "r_name", "r", none)
        .unionByName(typed(table(spark, sf, "nation"), "district", "n_nationkey", "n_name", "n", none))
        .unionByName(typed(table(spark, sf, "customer"), "school", "c_custkey", "c_name", "c", gps))
    )


def entity_table(spark: SparkSession, sf: str) -> DataFrame:
    """Entities by location id and by code, written once for the joins of all levels."""
    return materialize(entity_keys(entities(spark, sf)), "entities", ["entity_type"])


def solutions(spark: SparkSession, sf: str) -> DataFrame:
    """The solutions orders refer to, with a theme tree; six at most, so broadcast."""
    return F.broadcast(
        table(spark, sf, "orders")
        .selectExpr("o_orderkey % 6 AS n")
        .distinct()
        .selectExpr(
            "concat('sol', n) AS _id",
            "concat('Solution ', n) AS name",
            "concat('About ', n) AS description",
            "if(n % 2 = 0, 'pointsBasedScoring', null) AS scoringSystem",
            "map('S1', 'Section 1') AS sections",
            "map('OB', map('S1', array('Q-q3', 'Q-q2', 'Q-q1', 'Q-q4'))) AS questionSequenceByEcm",
            """parse_json('[{"name":"Domain A","externalId":"DA","type":"theme","children":[
                {"name":"Theme A1","externalId":"A1","type":"theme","criteria":[{"criteriaId":"crit0"}]},
                {"name":"Theme A2","externalId":"A2","type":"theme","children":[
                    {"name":"Theme A3","externalId":"A3","type":"theme","criteria":[{"criteriaId":"crit1"}]}]}]},
                {"name":"Domain B","externalId":"DB","type":"theme","criteria":[{"criteriaId":"crit2"}]}]')
                AS themes""",
        )
    )


def programs(spark: SparkSession, sf: str) -> DataFrame:
    """The programs of all users; seven at most, so broadcast."""
    return F.broadcast(
        table(spark, sf, "orders")
        .selectExpr("o_custkey % 7 AS n")
        .distinct()
        .selectExpr(
            "concat('prg', n) AS _id",
            "concat('PRG-', n) AS externalId",
            "concat('Program ', n) AS name",
            "concat('Describes ', n) AS description",
        )
    )


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """q2 offers every priority but the lowest; q3 offers statuses and ranks; the rest none.

    Seven rows whatever the data, so broadcast.
    """
    orders = table(spark, sf, "orders")
    none = "cast(array() as array<struct<value:variant,label:string>>)"
    priorities = orders.select("o_orderpriority").distinct().filter("o_orderpriority <> '5-LOW'")
    marks = (
        orders.selectExpr("explode(array(o_orderstatus, substr(o_orderpriority, 1, 1))) AS v")
        .distinct()
    )

    def options(df: DataFrame, qid: str, value: str) -> DataFrame:
        option = F.expr(f"named_struct('v', {value}, 'label', concat('Label ', {value}))")
        return df.groupBy(F.lit(qid).alias("qid")).agg(F.collect_set(option).alias("o")).selectExpr(
            "qid",
            "transform(o, x -> named_struct('value', cast(x.v as variant), 'label', x.label)) AS options",
        )

    plain = orders.sparkSession.createDataFrame([(q,) for q in ("q1", "q4", "q5", "q6", "q8")], "qid string")
    return F.broadcast(
        plain.selectExpr("qid", f"{none} AS options")
        .unionByName(options(priorities, "q2", "o_orderpriority"))
        .unionByName(options(marks, "q3", "v"))
        .selectExpr(
            "qid AS _id", "concat('Q-', qid) AS externalId", "'Header' AS sectionHeader",
            "array(concat('Question ', qid, '?')) AS question", "options",
        )
    )


def criteria(spark: SparkSession, sf: str) -> DataFrame:
    """Criteria documents; section S1 lists the first questions, S2 the others.

    Four at most, so broadcast.
    """
    return F.broadcast(
        table(spark, sf, "orders")
        .selectExpr("o_orderkey % 4 AS n")
        .distinct()
        .selectExpr(
            "concat('crit', n) AS _id",
            "concat('CRIT-', n) AS externalId",
            "concat('Criterion ', n) AS name",
            "concat('Criterion text ', n) AS description",
            """array(named_struct('sections', array(
                named_struct('code', 'S1', 'questions', array(named_struct('_id', 'q1'),
                    named_struct('_id', 'q2'), named_struct('_id', 'q3'), named_struct('_id', 'q4'))),
                named_struct('code', 'S2', 'questions', array(named_struct('_id', 'q5'),
                    named_struct('_id', 'q6')))))) AS evidences""",
        )
    )


def course_scans(spark: SparkSession, sf: str) -> DataFrame:
    """Telemetry responses: each event as a response with one or two entries, some empty.

    Progress is text ("9", "85", "100", ...), time is epoch milliseconds as text.
    """
    return table(spark, sf, "events").selectExpr(
        """if(event_id % 50 = 0, array(), transform(array(0, 1), i -> named_struct(
            'Course_name', concat('Course ', user_id % 5),
            'batch_name', concat('Batch ', user_id % 2),
            'User_FirstName', concat('User ', user_id),
            'course_progress', cast((event_id * 7) % 4 * 25 + i * 0 as string),
            'section_name', event_type,
            'section_progress', cast(event_id % 101 as string),
            '__time', cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) * 1000 as string),
            'User_id', if(user_id % 19 = 0, null, cast(user_id as string)),
            'user_login_id', concat('login', user_id)))) AS events"""
    )


def quiz_scans(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        """array(named_struct(
            'course_name', concat('Course ', user_id % 5),
            'User_Name', concat('User ', user_id),
            'progress', cast(event_id % 101 as string),
            'content_name', event_type,
            'Event_duration', cast((event_id * 13) % 11 as string),
            '__time', cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) * 1000 as string),
            'User_id', cast(user_id as string))) AS events"""
    )


def records(df: DataFrame) -> DataFrame:
    """Documents as JSON bytes, the way a topic holds them."""
    return df.select(F.to_json(F.struct(*df.columns)).cast("binary").alias("value"))
