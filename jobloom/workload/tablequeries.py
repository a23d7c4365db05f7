"""Queries that write, catalog and scan tables and files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.operators.compare import differences
from jobloom.operators.merge import UPDATE
from jobloom.operators.publish import (
    BASE, complete_versions, merge_and_publish, publish_version, read_version, staged,
)
from jobloom.plans.selfcheck import self_check
from jobloom.schemas import DOUBLE, EMPLOYEES, INT, LONG, STRING, shape
from jobloom.session import shared_dir
from jobloom.sources import tables
from jobloom.sources.files import cast_to_schema, scan_delimited
from jobloom.workload.shapes import table


def _namespace(spark: SparkSession) -> str:
    """A new namespace whose tables are in the shared folder."""
    name = "ns_" + uuid.uuid4().hex
    tables.create_namespace(spark, name, shared_dir(spark, "namespace"), if_not_exists=False)
    return name


def _employees(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("employee_id"),
        F.col("s_name").alias("employee_name"),
    )


def literal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Literal names for kinds of event, joined to the events."""
    rows = [(1, "click"), (2, "view"), (3, "purchase")]
    kinds = F.broadcast(tables.literal_rows(spark, rows, EMPLOYEES))  # three rows
    events = table(spark, sf, "events")
    return (
        events.join(kinds, events["event_type"] == kinds["employee_name"], "left")
        .groupBy("employee_id").agg(F.count("*").alias("n"))
    )


def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{_namespace(spark)}.customer"
    tables.overwrite_table(table(spark, sf, "customer"), name)
    return tables.scan_table(spark, name)


def overwrite_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write a table twice; its rows, and any row in which it differs from the source."""
    rows = _employees(spark, sf)
    name = f"{_namespace(spark)}.employees"
    tables.overwrite_table(rows.withColumn("employee_id", -F.col("employee_id")), name)
    tables.overwrite_table(rows, name)
    actual = tables.scan_table(spark, name)
    return (
        actual.withColumn("side", F.lit("both")).unionByName(differences(actual, rows))
        .orderBy("employee_id")
    )


def namespace_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """Create a namespace and table, fill the table, drop all; what was read is kept."""
    ns = _namespace(spark)
    name = f"{ns}.employees"
    tables.create_namespace(spark, ns)
    for _ in range(2):
        tables.create_table(spark, name, EMPLOYEES)
    _employees(spark, sf).write.insertInto(name)
    kept = shared_dir(spark, "kept")
    tables.scan_table(spark, name).write.parquet(kept)
    tables.drop_namespace(spark, ns)
    gone = not spark.catalog.databaseExists(ns)
    return spark.read.parquet(kept).withColumn("dropped", F.lit(gone))


def preview(spark: SparkSession, sf: str) -> DataFrame:
    return tables.preview(table(spark, sf, "customer"), ["c_custkey"])


PART = shape(p_partkey=LONG, p_name=STRING, p_brand=STRING, p_type=STRING, p_size=INT,
             p_retailprice=DOUBLE)


def scan_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """Write parts as several delimited files and read them in one scan."""
    path = shared_dir(spark, "tsv")
    (table(spark, sf, "part").write.partitionBy("p_type")
     .option("header", True).option("sep", "\t").csv(path))
    kinds = table(spark, sf, "part").select("p_type").distinct().orderBy("p_type")
    paths = [f"{path}/p_type={r.p_type}" for r in kinds.toLocalIterator()]
    columns = [c for c in PART.names if c != "p_type"]
    rows = scan_delimited(spark, paths, columns)
    kind = F.regexp_extract("_file", "p_type=([^/]*)/", 1)
    return cast_to_schema(rows.withColumn("p_type", kind), PART, strict=True)


def table_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Publish two versions of a table and read the view and the first version."""
    ns, place = _namespace(spark), shared_dir(spark, "versions")
    rows = _employees(spark, sf)
    publish_version(rows, f"{ns}.employees", place, 1)
    shout = rows.withColumn("employee_name", F.upper("employee_name"))
    publish_version(shout, f"{ns}.employees", place, 2)
    first, newest = complete_versions(spark, place)
    old = read_version(spark, place, first, EMPLOYEES).withColumn("version", F.lit(first))
    return tables.scan_table(spark, f"{ns}.employees").withColumn(
        "version", F.lit(newest)).unionByName(old)


def checked_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the start-up check wrote and read back without a difference."""
    rows = _employees(spark, sf)
    self_check(spark, rows)
    return rows


def publish_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Customers merged event by event kind, half of the kinds by a second run whose batch ids
    start at 0 again, and one batch replayed at the end."""
    ns, place = _namespace(spark), shared_dir(spark, "restart")
    name, schema = f"{ns}.customer", table(spark, sf, "customer").select("c_custkey", "c_name").schema
    publish_version(table(spark, sf, "customer").select("c_custkey", "c_name"), name, place, BASE)
    events = table(spark, sf, "events")
    batches = [("first/0", "click"), ("first/1", "view"), ("second/0", "purchase"),
               ("second/1", "signup"), ("second/1", "signup"), ("first/1", "view")]
    for writer, kind in batches:
        last = events.filter(F.col("event_type") == kind).groupBy("user_id").agg(
            F.max("event_id").alias("event_id"))
        source = last.select(F.col("user_id").alias("c_custkey"),
                             F.concat_ws("_", F.lit(kind), "event_id").alias("c_name"))
        merge_and_publish(spark, name, place, schema, ["c_custkey"],
                          [(staged(source, shared_dir(spark, "batch")), UPDATE)], writer, keep=9)
    return tables.scan_table(spark, name)


QUERIES = {f.__name__: f for f in (
    checked_roundtrip, publish_restart, literal_rows, scan_table, overwrite_roundtrip, namespace_lifecycle, preview, scan_tsv,
    table_versions,
)}

_EMPLOYEES = "SELECT CAST(s_suppkey AS INTEGER) AS employee_id, s_name AS employee_name"

ORACLE = {
    "checked_roundtrip": f"{_EMPLOYEES} FROM supplier",
    "publish_restart": """
WITH last AS (
  SELECT user_id, event_type, max(event_id) AS event_id FROM events
  WHERE event_type IN ('click', 'view', 'purchase', 'signup') GROUP BY ALL
), won AS (
  SELECT user_id AS c_custkey, event_type || '_' || event_id AS c_name FROM last
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY list_position(
    ['click', 'view', 'purchase', 'signup'], event_type) DESC) = 1
)
SELECT * FROM won UNION ALL
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM won)""",
    "literal_rows": """
SELECT CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 END
         AS employee_id, count(*) AS n
FROM events GROUP BY ALL""",
    "scan_table": "SELECT * FROM customer",
    "overwrite_roundtrip": f"{_EMPLOYEES}, 'both' AS side FROM supplier",
    "namespace_lifecycle": f"{_EMPLOYEES}, true AS dropped FROM supplier",
    "preview": "SELECT * FROM customer ORDER BY c_custkey LIMIT 20",
    "scan_tsv": "SELECT * FROM part",
    "table_versions": f"{_EMPLOYEES}, 1 AS version FROM supplier UNION ALL "
                      "SELECT CAST(s_suppkey AS INTEGER), upper(s_name), 2 FROM supplier",
}
