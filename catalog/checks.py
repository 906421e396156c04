"""SQL fragments shared by the checks: the derived documents, flat."""

LOCATED = """located AS (
    SELECT *, o_orderkey AS k, o_custkey AS c FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'started' ELSE 'inProgress' END"

# non-school organisations of a user, without repeats; one null row if none
ORGS = """orgs AS (
    SELECT k AS org_k, concat('org', c % 5) AS organisation_id, concat('Org ', c % 5) AS organisation_name
    FROM located WHERE k % 3 > 0
    UNION ALL SELECT k, 'last', 'Last' FROM located WHERE k % 3 = 2
    UNION ALL SELECT k, NULL, NULL FROM located WHERE k % 3 = 0)"""

# answers of completed submissions that match their question, one row each
ANSWERS = """answered AS (
    SELECT *, k % 3 + (k + 1) % 3 + k % 2 + k % 3 AS total_evidences FROM located
    WHERE o_orderstatus = 'F' AND k % 5 <> 0 AND k % 17 <> 0),
matched AS (
    SELECT k, 'q1' AS qid, 'number' AS kind, CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) AS answer,
        CAST(c AS VARCHAR) AS label, k % 3 AS files, CAST(NULL AS BIGINT) AS instance,
        concat('crit', k % 4) AS crit FROM answered
    UNION ALL SELECT k, 'q2', 'radio', o_orderpriority, concat('picked ', o_orderpriority),
        (k + 1) % 3, NULL, concat('crit', k % 4) FROM answered WHERE o_orderpriority <> '5-LOW'
    UNION ALL SELECT k, 'q3', 'multiselect', v, concat('Label ', v), 0, NULL, concat('crit', k % 4)
        FROM (SELECT k, unnest([o_orderstatus, substr(o_orderpriority, 1, 1)]) AS v FROM answered)
    UNION ALL SELECT k, 'q5', 'text', concat('note ', i), concat('note ', i), 0, i, 'crit0'
        FROM (SELECT k, unnest(range(1, k % 4 + 1)) AS i FROM answered)
    UNION ALL SELECT k, 'q2', 'radio', o_orderpriority, 'chosen', 0, i, 'crit0'
        FROM (SELECT k, o_orderpriority, unnest(range(1, k % 4 + 1)) AS i FROM answered)
        WHERE o_orderpriority <> '5-LOW'
    UNION ALL SELECT k, 'q6', 'text', o_orderpriority, 'free text', 0, NULL, concat('crit', k % 4)
        FROM answered)"""

URLS = """CASE files WHEN 1 THEN concat('http://b/', qid, '/1')
    WHEN 2 THEN concat('http://b/', qid, '/1 , http://b/', qid, '/2') END"""
