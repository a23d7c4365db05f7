"""Queries that import output files of jobs, as a plan and through the whole stream."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.importers.quality import JOB_COLUMN, QUALITY_IMPORTER
from jobloom.operators import dlq
from jobloom.operators.merge import merge
from jobloom.operators.publish import staged
from jobloom.plans import importing as imp
from jobloom.schemas import QUALITY
from jobloom.session import shared_dir
from jobloom.sources import events as ev
from jobloom.sources.registry import registry
from jobloom.streaming.flow import Ingest
from jobloom.workload.shapes import TOPIC, records, table

# The files of the tests carry Spark's names.
IMPORTER = replace(QUALITY_IMPORTER, accepts=lambda file: file.endswith(".csv"))
LOST = "event_type=signup/day=2024-01-20/lost.csv"


def _reports(spark: SparkSession, sf: str) -> DataFrame:
    """Quality rows: one per user, event type and day.

    Errors are not summed up, so a user with two errors on a day repeats a key. On one day
    the numbers of purchases are no numbers.
    """
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    single = F.when(F.col("event_type") == "error", F.col("event_id"))
    rows = e.groupBy("day", "event_type", "user_id", single.alias("single")).agg(
        F.count("*").cast("int").alias("n"), F.max("value").alias("top"),
        F.min("event_id").alias("first_id"),
    )
    n, top = F.col("n"), F.col("top")
    broken = (F.col("event_type") == "purchase") & (F.dayofmonth("day") == 9)
    return rows.select(
        "day", "event_type",
        F.concat(F.lit("GCA_"), "user_id").alias("Name"),
        top.alias("Completeness"), (top / 2).alias("Contamination"),
        F.lit("model").alias("Completeness_Model_Used"), n.alias("Translation_Table_Used"),
        (top / 4).alias("Coding_Density"), n.alias("Contig_N50"),
        (top / 8).alias("Average_Gene_Length"),
        F.when(broken, "?").otherwise(n.cast("string")).alias("Genome_Size"),
        top.alias("GC_Content"), n.alias("Total_Coding_Sequences"),
        n.alias("Total_Contigs"), n.alias("Max_Contig_Length"),
        F.when(n > 1, F.concat(F.lit("first "), "first_id")).alias("Additional_Notes"),
    )


def _write_reports(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Write the reports below a root; returns it and the files as rows (id, file), named
    relative to the root. The files of view days belong to jobs that nobody asks for; one signup
    day has a lost file."""
    root = shared_dir(spark, "reports") + "/"
    (_reports(spark, sf).hint("rebalance", "event_type", "day")
     .write.partitionBy("event_type", "day").option("header", True).option("sep", "\t")
     .csv(root))
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select(F.regexp_extract("path", "(event_type=.*)$", 1).alias("file"))
    )
    lost = spark.createDataFrame([(LOST,)], "file string")
    files = found.unionByName(lost).select(
        F.concat_ws(":", F.regexp_extract("file", "event_type=([^/]*)/", 1),
                    F.regexp_extract("file", "day=([^/]*)/", 1)).alias("id"), "file",
    )
    other = F.when(F.col("id").startswith("view:"), F.concat(F.lit("not_"), "id"))
    return root, files.withColumn("id", F.coalesce(other, F.col("id")))


def _jobs(spark: SparkSession, sf: str) -> DataFrame:
    """One job per event type and day that has events; its user is the event type."""
    days = (
        table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day")).distinct()
    )
    return days.select(
        F.concat_ws(":", "event_type", "day").alias("job_id"), "event_type", "day",
        F.col("day").cast("timestamp").alias("timestamp"), F.lit(0).alias("partition"),
        F.datediff("day", F.lit("2024-01-01")).cast("bigint").alias("offset"),
    )


def _plan(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Rows to merge and failed jobs of importing all reports as one batch."""
    root, files = _write_reports(spark, sf)
    stage = shared_dir(spark, "plan")
    prefix = F.concat(F.lit("u_"), "event_type", F.lit("__"))
    jobs = staged(_jobs(spark, sf).withColumn(imp.PREFIX, prefix), f"{stage}/jobs")
    files = staged(files, f"{stage}/files")
    typed, missing = imp.stage_typed(spark, IMPORTER, jobs, files, root, f"{stage}/typed")
    failed = staged(
        imp.failed_jobs(IMPORTER, jobs, files, typed, missing), f"{stage}/failed")
    return imp.rows_to_merge(IMPORTER, jobs, typed, failed), failed


def _comparable(df: DataFrame) -> DataFrame:
    """Floats as rounded doubles."""
    return df.select(*[
        F.round(F.col(f.name).cast("double"), 2).alias(f.name)
        if f.dataType.typeName() == "float" else F.col(f.name) for f in df.schema
    ])


def quality_import(spark: SparkSession, sf: str) -> DataFrame:
    """The reports of all jobs merged into a table that holds old rows of click days."""
    is_known = F.col("c_mktsegment") == "BUILDING"
    old = table(spark, sf, "customer").select(
        F.lit("u_click__").alias(imp.PREFIX),
        F.concat(F.when(is_known, "GCA_").otherwise("OLD_"), "c_custkey").alias("Name"),
        F.lit("old_job").alias(JOB_COLUMN),
        *[F.lit("1").cast(f.dataType).alias(f.name) for f in QUALITY[2:-1]],
        F.col("c_name").alias("Additional_Notes"),
    )
    rows, _ = _plan(spark, sf)
    source = staged(rows, shared_dir(spark, "winners"))
    return _comparable(merge(old, source, [imp.PREFIX, "Name"], IMPORTER.mode))


def import_failures(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf)[1].select("id", "error")


def _job_events(spark: SparkSession, sf: str) -> DataFrame:
    body = F.struct("job_id", F.lit("complete").alias("state"))
    return _jobs(spark, sf).select(
        F.lit(None).cast("binary").alias("key"), ev.to_record(body),
        F.lit("reports").alias("topic"), "partition", "offset", "timestamp",
        F.lit(0).alias("timestampType"),
    )


def run_stream(spark: SparkSession, sf: str, **options) -> Ingest:
    """Run the ingest over job events and all messages of `events` until it has caught up. The
    users of each run have names of their own.

    Purchase days from the 20th on belong to an image without importer.
    """
    root, files = _write_reports(spark, sf)
    jobs = _jobs(spark, sf)
    work = shared_dir(spark, "work")
    late = (F.col("event_type") == "purchase") & (F.dayofmonth("day") >= 20)
    done = F.struct(F.lit("complete").alias("state"),
                    F.date_format("day", "yyyy-MM-dd'T'00:00:00'Z'").alias("time"))
    headers = jobs.select(
        F.col("job_id").alias("id"), F.concat("event_type", F.lit(f"_{work[-32:]}")).alias("user"),
        F.struct(F.when(late, "img/none").otherwise("img/quality").alias("name"),
                 F.lit("sha256:0").alias("digest")).alias("image"),
        F.lit(1).alias("input_file_count"),
        F.lit(1).cast("bigint").alias("output_file_count"),
        F.array(done).alias("transition_times"),
    )
    images = spark.createDataFrame([("img/quality",)], "image string")
    known = registry(images, F.col("image"), F.lit(IMPORTER.name), F.lit("quality.yaml"),
                     F.lit(None).cast("string"))
    topic = ev.Topic("file", shared_dir(spark, "topic"), TOPIC)
    ev.publish(_job_events(spark, sf).unionByName(records(spark, sf)), topic)
    ingest = Ingest(
        headers=lambda: headers, outputs=lambda: files, registry=lambda: known,
        importers=[IMPORTER], work=work, tables=shared_dir(spark, "tables"), files_root=root,
        control_namespace=f"control_{work[-32:]}", **options,
    )
    ingest.start(spark, topic, f"{work}/checkpoint", every=None).awaitTermination()
    return ingest


def import_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The tables that the stream leaves, by namespace: views on one table of all of them."""
    ingest = run_stream(spark, sf, shared_namespace=f"all_{uuid.uuid4().hex}")
    kinds = [r.event_type for r in
             table(spark, sf, "events").select("event_type").distinct().collect()]
    names = {k: IMPORTER.table_name(f"u_{k}_{ingest.work[-32:]}__") for k in kinds}
    views = [
        spark.table(name).withColumn(imp.PREFIX, F.lit(f"u_{k}__"))
        for k, name in names.items() if spark.catalog.tableExists(name)
    ]
    return _comparable(reduce(DataFrame.unionByName, views))


def stream_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What became of the events: current status of the jobs and kinds of dead letters."""
    ingest = run_stream(spark, sf)
    status = ingest.job_status(spark).select(F.col("job_id").alias("subject"), "key")
    letters = dlq.read_dead_letters(spark, ingest.dlq).select(
        F.concat_ws("/", "src_topic", "src_partition", "src_offset").alias("subject"),
        F.col("route").alias("key"),
    )
    return status.unionByName(letters)


QUERIES = {f.__name__: f for f in (
    quality_import, import_failures, import_batch, stream_outcomes,
)}

_REPORTS = """
WITH g AS (
  SELECT CAST(ts AS DATE) AS day, event_type, user_id, count(*) AS n, max(value) AS top,
         min(event_id) AS first_id
  FROM events
  GROUP BY CAST(ts AS DATE), event_type, user_id,
           CASE WHEN event_type = 'error' THEN event_id END
), jobs AS (
  SELECT event_type, day, event_type || ':' || day AS id,
         CASE WHEN event_type = 'signup' AND day = DATE '2024-01-20'
                THEN 'No such file: """ + LOST + """'
              WHEN event_type = 'view' THEN 'No checkm2 quality report files found'
              WHEN event_type = 'purchase' AND day(day) = 9
                THEN 'A value does not fit column Genome_Size'
              WHEN event_type = 'error' AND count(*) > count(DISTINCT user_id)
                THEN 'A key repeats within the job: Name' END AS error
  FROM g GROUP BY event_type, day
), rows_ AS (
  SELECT 'u_' || event_type || '__' AS namespace_prefix, 'GCA_' || user_id AS Name,
         id AS cts_job_id, round(CAST(CAST(top AS FLOAT) AS DOUBLE), 2) AS Completeness,
         round(CAST(CAST(top / 2 AS FLOAT) AS DOUBLE), 2) AS Contamination,
         'model' AS Completeness_Model_Used, CAST(n AS INTEGER) AS Translation_Table_Used,
         round(CAST(CAST(top / 4 AS FLOAT) AS DOUBLE), 2) AS Coding_Density,
         CAST(n AS INTEGER) AS Contig_N50,
         round(CAST(CAST(top / 8 AS FLOAT) AS DOUBLE), 2) AS Average_Gene_Length,
         CAST(n AS INTEGER) AS Genome_Size,
         round(CAST(CAST(top AS FLOAT) AS DOUBLE), 2) AS GC_Content,
         CAST(n AS INTEGER) AS Total_Coding_Sequences, CAST(n AS INTEGER) AS Total_Contigs,
         CAST(n AS INTEGER) AS Max_Contig_Length,
         CASE WHEN n > 1 THEN 'first ' || first_id END AS Additional_Notes,
         day, user_id
  FROM g JOIN jobs USING (event_type, day) WHERE error IS NULL
), won AS (
  SELECT * FROM rows_ QUALIFY rank() OVER (
    PARTITION BY namespace_prefix, Name ORDER BY day DESC) = 1
)
"""
_LATE = "event_type = 'purchase' AND day(day) >= 20"

ORACLE = {
    "quality_import": _REPORTS + """
SELECT * EXCLUDE (day, user_id) FROM won UNION ALL
SELECT 'u_click__', n, 'old_job', 1, 1, '1', 1, 1, 1, 1, 1, 1, 1, 1, 1, c_name
FROM (SELECT c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'GCA_' ELSE 'OLD_' END || c_custkey AS n
      FROM customer)
WHERE n NOT IN (SELECT Name FROM won WHERE namespace_prefix = 'u_click__')""",
    "import_failures": _REPORTS + "SELECT id, error FROM jobs WHERE error IS NOT NULL",
    "import_batch": _REPORTS.replace("WHERE error IS NULL",
                                     f"WHERE error IS NULL AND NOT ({_LATE})")
    + "SELECT * EXCLUDE (day, user_id) FROM won",
    "stream_outcomes": _REPORTS + f""", e AS (
  SELECT event_id, event_type, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
)
SELECT id AS subject, 'cse_event_processing_start' AS key FROM jobs UNION ALL
SELECT id, CASE WHEN {_LATE} THEN 'cse_event_processing_no_operation'
                WHEN error IS NULL THEN 'cse_event_processing_complete'
                ELSE 'cse_event_processing_error' END FROM jobs UNION ALL
SELECT 'reports/0/' || (day - DATE '2024-01-01'), 'dlq_import_error' FROM jobs
WHERE error IS NOT NULL AND NOT ({_LATE}) UNION ALL
SELECT 'jobs/' || event_id % 3 || '/' || event_id // 3,
       CASE WHEN k IN (0, 4, 5, 6, 11, 13, 15, 17) THEN 'dlq_malformed'
            WHEN k IN (1, 2) THEN 'dlq_missing_keys' ELSE 'dlq_no_job' END
FROM e WHERE k NOT IN (3, 14, 9, 12) AND (k IN (0, 1, 2, 4, 5, 6, 10, 11, 13, 15, 17)
                                          OR event_type = 'purchase')""",
}
