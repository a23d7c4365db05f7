"""Queries over job documents: building, reading and joining them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.functions import text
from jobloom.operators import jobs as j, route as r
from jobloom.operators.publish import staged
from jobloom.session import shared_dir
from jobloom.sources import registry as reg
from jobloom.workload import shapes
from jobloom.workload.events import MESSAGES, routed
from jobloom.workload.shapes import event_id, table

# Small enough that some of the test jobs have more than one part.
PART_SIZE = 4


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return j.build_jobs(shapes.job_headers(spark, sf), shapes.job_files(spark, sf), PART_SIZE)


def build_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, summed up again over their parts."""
    # Of a part, only what is summed up is sorted by job.
    parts = _documents(spark, sf).select(
        "id", "user", "output_file_count", F.size("outputs").alias("n"),
        F.array_min("outputs")["file"].alias("first"), F.array_max("outputs")["file"].alias("last"),
        F.size("transition_times").alias("steps"),
    )
    return parts.groupBy("id", "user", "output_file_count").agg(
        F.sum("n").alias("n_outputs"),
        F.min("first").alias("first_file"),
        F.max("last").alias("last_file"),
        F.max("steps").alias("n_transitions"),
    )


def explode_outputs(spark: SparkSession, sf: str) -> DataFrame:
    return j.explode_outputs(_documents(spark, sf))


def completion_time(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.job_headers(spark, sf).select(
        "id", j.completion_time(F.col("transition_times")).alias("completion_time")
    )


def import_record(spark: SparkSession, sf: str) -> DataFrame:
    return _naive(j.import_record(shapes.headers_with_counts(spark, sf)))


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumn("completion_time", F.col("completion_time").cast("timestamp_ntz"))


def image_ref(spark: SparkSession, sf: str) -> DataFrame:
    image = F.col("image")
    composed = text.compose_image(image["name"], image["digest"])
    ref = text.compose_image(F.concat_ws(":", image["name"], image["tag"]), image["digest"])
    return shapes.job_headers(spark, sf).select(
        "id", composed.alias("composed"), text.image_name(ref).alias("name"),
        text.image_tag(ref).alias("tag"), text.image_digest(ref).alias("digest"),
        text.image_tag(composed).alias("no_tag"),
    )


def labels(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    prefix = F.when(F.col("c_mktsegment") == "BUILDING", "").when(
        F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return c.select(
        "c_custkey", text.job_label(F.col("c_custkey")).alias("job"),
        text.run_prefix(prefix).alias("prefix"),
        F.length(text.run_label(prefix)).alias("n_label"),
        text.identifier(F.concat_ws("-", "c_mktsegment", "c_custkey")).alias("identifier"),
        text.namespace_prefix(F.col("c_name")).alias("namespace"),
    )


def _importable(spark: SparkSession, sf: str) -> DataFrame:
    return routed(spark, sf).filter(F.col("route") == r.IMPORTABLE).select(
        "job_id", "partition", "offset"
    )


def enrich_jobs(spark: SparkSession, sf: str) -> DataFrame:
    full = j.enrich(_importable(spark, sf), shapes.headers_with_counts(spark, sf))
    return _naive(full).select(
        event_id(), "job_id", "job_found", "namespace_prefix", "image", "image_digest",
        "input_file_count", "output_file_count", "completion_time",
    )


def lookup_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """As enrich_jobs, through a job table laid out by id: only its parts that hold an asked job are
    read, if the jobs asked for are few."""
    folder = shared_dir(spark, "lookup")
    j.write_jobs(shapes.headers_with_counts(spark, sf), f"{folder}/jobs")
    events = staged(_importable(spark, sf), f"{folder}/events")
    ids = staged(events.filter("job_id is not null").select("job_id").distinct(), f"{folder}/ids")
    headers = j.asked_for(spark.read.parquet(f"{folder}/jobs"), ids)
    return _naive(j.enrich(events, headers)).select(
        event_id(), "job_id", "job_found", "namespace_prefix", "image", "image_digest",
        "input_file_count", "output_file_count", "completion_time",
    )


def missing_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return j.missing_jobs(_importable(spark, sf), shapes.job_headers(spark, sf)).select(
        event_id(), "job_id"
    )


def dispatch(spark: SparkSession, sf: str) -> DataFrame:
    full = j.enrich(_importable(spark, sf), shapes.headers_with_counts(spark, sf))
    # Written down, a registry is known to be small.
    registry = staged(shapes.image_registry(spark, sf), shared_dir(spark, "registry"))
    return j.dispatch(full, registry).select(
        event_id(), "module", F.to_json("meta").alias("meta"), r.job_route().alias("route")
    )


def _part_registry(spark: SparkSession, sf: str) -> DataFrame:
    """A registry with one row per part: images repeat, and economy parts name no module."""
    p = table(spark, sf, "part")
    module = F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).otherwise(F.lit(""))
    meta = F.when(F.col("p_size") < 25, F.to_json(F.struct(F.col("p_size").alias("size"))))
    return reg.registry(p, F.col("p_name"), module,
                        F.concat(F.col("p_partkey"), F.lit(".yaml")), meta)


def registry_load(spark: SparkSession, sf: str) -> DataFrame:
    return _part_registry(spark, sf).withColumn("meta", F.to_json("meta"))


def registry_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return reg.conflicts(_part_registry(spark, sf))


def registry_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return reg.invalid_rows(_part_registry(spark, sf)).select(
        "source_file", F.array_join("violations", ",").alias("violations")
    )


QUERIES = {f.__name__: f for f in (
    build_jobs, explode_outputs, completion_time, import_record, image_ref, labels,
    enrich_jobs, lookup_jobs, missing_jobs, dispatch, registry_load, registry_conflicts, registry_invalid,
)}

FILE = "'bucket/' || l_orderkey || '/' || l_linenumber || '-' || l_partkey || '.tsv'"
# Jobs as the shapes make them, flat.
JOBS = """
j AS (
  SELECT CASE WHEN o_orderkey % 40 = 7 THEN 'x' || o_orderkey
              ELSE CAST(o_orderkey AS VARCHAR) END AS id, 'cust_' || o_custkey AS owner,
         'u_cust_' || o_custkey || '__' AS namespace_prefix,
         'img/' || o_orderpriority AS image, 'sha256:' || o_orderkey AS image_digest,
         CASE WHEN o_totalprice < 10000 THEN NULL
              WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 2 DAY
              ELSE o_orderdate + INTERVAL 1 DAY END AS completion_time,
         CASE WHEN o_totalprice < 10000 THEN 1 WHEN o_orderstatus = 'O' THEN 3 ELSE 2 END
           AS n_transitions,
         o_orderpriority AS priority
  FROM orders
), f AS (
  SELECT CASE WHEN l_orderkey % 40 = 7 THEN 'x' || l_orderkey
              ELSE CAST(l_orderkey AS VARCHAR) END AS id, """ + FILE + """ AS file,
         right('aaaaaaaaaaaa' || l_orderkey || l_linenumber, 12) AS crc64nvme
  FROM lineitem
), c AS (
  SELECT id, count(*) AS n FROM f GROUP BY id
)
"""
_TIME = "strftime(completion_time, '%Y-%m-%dT00:00:00+00:00')"

ORACLE = {
    "build_jobs": "WITH" + JOBS + """
SELECT j.id, owner AS "user", count(f.id) AS output_file_count,
       CAST(count(f.id) AS BIGINT) AS n_outputs, min(file) AS first_file,
       max(file) AS last_file, max(n_transitions) AS n_transitions
FROM j LEFT JOIN f ON j.id = f.id GROUP BY j.id, owner""",
    "explode_outputs": "WITH" + JOBS
    + "SELECT f.id, file, crc64nvme FROM f JOIN j ON j.id = f.id",
    "completion_time": "WITH" + JOBS + f"SELECT id, {_TIME} AS completion_time FROM j",
    "import_record": "WITH" + JOBS + """
SELECT j.id, namespace_prefix, image, image_digest, 1 AS input_file_count,
       coalesce(n, 0) AS output_file_count, completion_time
FROM j LEFT JOIN c ON j.id = c.id""",
    "image_ref": "WITH" + JOBS + """
SELECT id, image || '@' || image_digest AS composed, image AS name, 'v1' AS tag,
       image_digest AS digest, CAST(NULL AS VARCHAR) AS no_tag FROM j""",
    "labels": """
SELECT c_custkey, 'job_id_' || c_custkey AS job, prefix,
       CAST(length(prefix) + 37 AS INTEGER) AS n_label,
       c_mktsegment || '_' || c_custkey AS identifier, 'u_' || c_name || '__' AS namespace
FROM (SELECT *, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'integration_test'
                     ELSE c_mktsegment END AS prefix FROM customer)""",
    "enrich_jobs": MESSAGES + "," + JOBS + """
SELECT event_id, job_id, j.id IS NOT NULL AS job_found, namespace_prefix, image,
       image_digest, CASE WHEN j.id IS NOT NULL THEN 1 END AS input_file_count,
       CASE WHEN j.id IS NOT NULL THEN coalesce(n, 0) END AS output_file_count,
       completion_time
FROM r LEFT JOIN j ON job_id = j.id LEFT JOIN c ON j.id = c.id WHERE route = 'importable'""",
    "missing_jobs": MESSAGES + "," + JOBS + """
SELECT event_id, job_id FROM r LEFT JOIN j ON job_id = j.id
WHERE route = 'importable' AND j.id IS NULL""",
    "dispatch": MESSAGES + "," + JOBS + """
SELECT event_id,
       CASE WHEN priority <> '5-LOW' THEN 'import_' || left(priority, 1) END AS module,
       CASE WHEN priority = '1-URGENT' THEN '{"fast":true}'
            WHEN priority <> '5-LOW' THEN '{}' END AS meta,
       CASE WHEN j.id IS NULL THEN 'dlq_no_job' WHEN completion_time IS NULL THEN 'dlq_bad_job'
            WHEN priority = '5-LOW' THEN 'no_operation' ELSE 'import' END AS route
FROM r LEFT JOIN j ON job_id = j.id WHERE r.route = 'importable'""",
    "registry_load": """
SELECT p_name AS image, CASE WHEN p_type <> 'ECONOMY' THEN p_type ELSE '' END AS module,
       p_partkey || '.yaml' AS source_file,
       CASE WHEN p_size < 25 THEN '{"size":' || p_size || '}' ELSE '{}' END AS meta
FROM part""",
    "registry_conflicts": """
SELECT p_name AS image, count(*) AS n, min(p_partkey || '.yaml') AS first_file,
       max(p_partkey || '.yaml') AS last_file
FROM part GROUP BY p_name HAVING count(*) > 1""",
    "registry_invalid": """
SELECT p_partkey || '.yaml' AS source_file, 'module' AS violations
FROM part WHERE p_type = 'ECONOMY'""",
}
ORACLE["lookup_jobs"] = ORACLE["enrich_jobs"]
