"""Queries that merge events into tables, and status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.functions.maps import map_upsert
from jobloom.importers.employees import apply_control_events
from jobloom.operators import route as r, status as st
from jobloom.operators.compare import differences
from jobloom.operators.latest import winning_rows
from jobloom.operators.merge import UPDATE, merge
from jobloom.operators.publish import staged
from jobloom.operators.sharedtable import SharedTable
from jobloom.session import shared_dir
from jobloom.workload.events import MESSAGES, routed
from jobloom.workload.shapes import event_id, table

KEYS = ["c_custkey"]
INSERT = "insert"


def _target(spark: SparkSession, sf: str) -> DataFrame:
    """The customers; those of one market segment have keys that no event names."""
    other = F.when(F.col("c_mktsegment") == "BUILDING", -F.col("c_custkey") - 1)
    return table(spark, sf, "customer").withColumn(
        "c_custkey", F.coalesce(other, F.col("c_custkey")))


def _source(spark: SparkSession, sf: str) -> DataFrame:
    """New values for customers: one row per importable event, the user being the customer."""
    events = routed(spark, sf).filter(F.col("route") == r.IMPORTABLE)
    return events.select(
        F.col("key").cast("string").cast("bigint").alias("c_custkey"),
        F.concat(F.lit("event_"), F.col("offset") * 3 + F.col("partition")).alias("c_name"),
        F.col("partition").alias("c_nationkey"),
        F.col("offset").cast("double").alias("c_acctbal"),
        F.when(F.col("partition") > 0, F.col("state")).alias("c_mktsegment"),
        "timestamp", "partition", "offset",
    )


def _winners(spark: SparkSession, sf: str, keep: str) -> DataFrame:
    columns = table(spark, sf, "customer").columns
    return winning_rows(_source(spark, sf), KEYS, keep).select(*columns)


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return _winners(spark, sf, "last")


def first_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return _winners(spark, sf, "first")


def _staged(spark: SparkSession, sf: str, keep: str) -> DataFrame:
    """The winners written down, as a merge asks for its source more than once."""
    return staged(_winners(spark, sf, keep), shared_dir(spark, "winners"))


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return merge(_target(spark, sf), _staged(spark, sf, "last"), KEYS, UPDATE)


def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return merge(_target(spark, sf), _staged(spark, sf, "first"), KEYS, INSERT)


def merge_shared(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge into one table of several namespaces, of which the second batch rewrites only
    the pieces that it touches; a batch that runs again changes nothing."""
    folder = shared_dir(spark, "shared")
    columns = table(spark, sf, "customer").schema

    def placed(df: DataFrame) -> DataFrame:
        number = F.pmod("c_custkey", F.lit(5)).cast("string")
        return df.withColumn("namespace", F.concat(F.lit("n"), F.coalesce(number, F.lit("one"))))

    shared = SharedTable(spark, f"{folder}/table", columns, KEYS, "namespace")
    batches = [("0", _target(spark, sf), UPDATE), ("1", _staged(spark, sf, "last"), UPDATE)]
    for writer, rows, mode in [*batches, batches[0]]:
        shared.merge([(placed(rows), mode)], writer, f"{folder}/{writer}")
    return shared.read()


def merge_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    source = _staged(spark, sf, "last")
    once = merge(_target(spark, sf), source, KEYS, UPDATE)
    return merge(once, source, KEYS, UPDATE)


def table_differences(spark: SparkSession, sf: str) -> DataFrame:
    """What a merge changed, as rows of either side."""
    return differences(merge_upsert(spark, sf), _target(spark, sf))


def employees_import(spark: SparkSession, sf: str) -> DataFrame:
    """The control events applied to a table of customers' names."""
    target = _target(spark, sf).select(
        F.col("c_custkey").cast("int").alias("employee_id"),
        F.col("c_name").alias("employee_name"),
    )
    return apply_control_events(target, routed(spark, sf).filter(F.col("route") == r.CONTROL))


def status_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A start on every customer's map: set one key, remove two, keep the others."""
    c = table(spark, sf, "customer")
    old = F.create_map(
        F.lit("note"), F.col("c_name"), F.lit(st.ERROR), F.lit("t1"),
        F.lit(st.COMPLETE), F.lit("t0"), F.lit(st.NO_OPERATION), F.col("c_mktsegment"),
    )
    new = F.create_map(F.lit(st.START), F.concat(F.lit("t"), F.col("c_nationkey")))
    return c.select(
        F.col("c_custkey").cast("string").alias("job_id"),
        F.explode(map_upsert(old, new, st.UNSETS[st.START])),
    )


STATUS_KEYS = {"click": st.START, "purchase": st.COMPLETE, "error": st.ERROR,
               "view": st.NO_OPERATION, "signup": "note"}


def job_status(spark: SparkSession, sf: str) -> DataFrame:
    """Events as status changes of their user, folded to the current status."""
    key = F.lit(None)
    for kind, name in STATUS_KEYS.items():
        key = F.when(F.col("event_type") == kind, name).otherwise(key)
    changes = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("job_id"), key.alias("key"),
        st.iso_utc(F.col("ts").cast("timestamp")).alias("value"), "ts", "event_id",
    )
    status = st.status_maps(st.current_status(changes, ["ts", "event_id"]))
    return status.select("job_id", F.explode("meta"))


QUERIES = {f.__name__: f for f in (
    latest_per_key, first_per_key, merge_upsert, merge_insert_only, merge_shared, merge_idempotent,
    table_differences, employees_import, status_upsert, job_status,
)}

_SOURCE = MESSAGES + """, s AS (
  SELECT user_id AS c_custkey, 'event_' || event_id AS c_name, part AS c_nationkey,
         CAST(off AS DOUBLE) AS c_acctbal,
         CASE WHEN part > 0 THEN 'complete' END AS c_mktsegment, ts, part, off
  FROM r WHERE route = 'importable'
), last AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM s
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY ts DESC, part DESC, off DESC) = 1
), first AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM s
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY ts, part, off) = 1
), t AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN -c_custkey - 1 ELSE c_custkey END AS c_custkey,
         c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer
), up AS (
  SELECT * FROM last UNION ALL
  SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
)
"""

ORACLE = {
    "latest_per_key": _SOURCE + "SELECT * FROM last",
    "first_per_key": _SOURCE + "SELECT * FROM first",
    "merge_upsert": _SOURCE + "SELECT * FROM up",
    "merge_insert_only": _SOURCE + """
SELECT * FROM t UNION ALL
SELECT * FROM first WHERE c_custkey NOT IN (SELECT c_custkey FROM t)""",
    "merge_shared": _SOURCE + """
SELECT *, 'n' || coalesce(CAST((c_custkey % 5 + 5) % 5 AS VARCHAR), 'one') AS namespace FROM up""",
    "merge_idempotent": _SOURCE + "SELECT * FROM up",
    "table_differences": _SOURCE + """
SELECT *, 'actual' AS side FROM (SELECT * FROM up EXCEPT ALL SELECT * FROM t) UNION ALL
SELECT *, 'expected' AS side FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM up)""",
    "employees_import": MESSAGES + """, rows_ AS (
  SELECT CAST(user_id AS INTEGER) AS employee_id, 'user_' || user_id AS employee_name, k, ts
  FROM r WHERE k = 3
  UNION ALL
  SELECT CAST(user_id AS INTEGER), 'user ' || user_id || ' of ' || id, k, ts FROM r WHERE k = 14
  UNION ALL
  SELECT CAST(event_id AS INTEGER), 'event ' || id, k, ts FROM r WHERE k = 14
), t AS (
  SELECT CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN -c_custkey - 1 ELSE c_custkey END AS INTEGER)
           AS employee_id, c_name AS employee_name
  FROM customer
), u AS (
  SELECT employee_id, employee_name FROM rows_ WHERE k = 3
  QUALIFY rank() OVER (PARTITION BY employee_id ORDER BY ts DESC) = 1
), i AS (
  SELECT employee_id, employee_name FROM rows_ WHERE k = 14
  QUALIFY rank() OVER (PARTITION BY employee_id ORDER BY ts) = 1
), up AS (
  SELECT * FROM u UNION ALL
  SELECT * FROM t WHERE employee_id NOT IN (SELECT employee_id FROM u)
)
SELECT * FROM up UNION ALL
SELECT * FROM i WHERE employee_id NOT IN (SELECT employee_id FROM up)""",
    "status_upsert": """
SELECT CAST(c_custkey AS VARCHAR) AS job_id, 'note' AS key, c_name AS value FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'cse_event_processing_no_operation', c_mktsegment
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'cse_event_processing_start', 't' || c_nationkey
FROM customer""",
    "job_status": """
WITH ch AS (
  SELECT user_id, CASE event_type WHEN 'click' THEN 'cse_event_processing_start'
                    WHEN 'purchase' THEN 'cse_event_processing_complete'
                    WHEN 'error' THEN 'cse_event_processing_error'
                    WHEN 'view' THEN 'cse_event_processing_no_operation'
                    ELSE 'note' END AS key, ts
  FROM events
), last AS (SELECT user_id, key, max(ts) AS at FROM ch GROUP BY user_id, key)
SELECT CAST(a.user_id AS VARCHAR) AS job_id, a.key,
       strftime(a.at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS value
FROM last a LEFT JOIN last b ON a.user_id = b.user_id AND b.key = 'cse_event_processing_start'
WHERE NOT (a.key IN ('cse_event_processing_complete', 'cse_event_processing_error')
           AND b.at IS NOT NULL AND b.at > a.at)""",
}
