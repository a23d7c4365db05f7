"""Job documents: building, reading and joining them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.text import namespace_prefix
from jobloom.operators.merge import fits_broadcast
from jobloom.operators.route import COMPLETE
from jobloom.sources.files import FILE_COLUMN, bare_path


# A job of more files than fill this many parts is spread over tasks, each part by itself.
SPREAD_PARTS = 8
# Up to this many spread jobs are broadcast (an id and two numbers each).
BROADCAST_JOBS = 200_000
SALTS = 256
# A job table is laid out by this hash of the id; the number belongs to the layout.
ID_PART, ID_PARTS = "id_part", 256
# Fixed value: text for a job that has not completed.
NOT_COMPLETE_TEXT = "No complete event found for job "


def _with_parts(files: DataFrame, large: DataFrame, salts: int) -> DataFrame:
    """Add the number of parts to the files of spread jobs. Never exchanges on the bare id, as
    one job may own a large share of the files. Broadcast unless there are salts."""
    if not salts:
        return files.join(F.broadcast(large), "id", "left")
    salt = F.pmod(F.xxhash64("file"), F.lit(salts)).cast("int")
    salted = large.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Repeated rows are small in an exchange, so that Spark would take them to fit a broadcast.
    return files.withColumn("_salt", salt).join(
        salted.hint("merge"), ["id", "_salt"], "left").drop("_salt")


def build_jobs(headers: DataFrame, files: DataFrame, part_size: int = 10_000) -> DataFrame:
    """Job documents from header rows (one per `id`) and file rows (id, file, crc64nvme).

    The files of a job are nested in parts of about `part_size`, so that a job that owns a
    large share of all files is never one group. Part 0 always exists. Files are exchanged once,
    by job, and cut into parts where they meet; a job beyond SPREAD_PARTS parts is exchanged by
    part. Counts these jobs when called.
    """
    # A file without a job meets no header; all of them would be one group.
    files = files.select("id", "file", "crc64nvme").filter("id is not null")
    body = [F.col(f"`{c}`") for c in headers.columns if c != "id"]
    parts = F.ceil(F.col("output_file_count") / part_size).cast("int")
    large = output_counts(files).filter(
        F.col("output_file_count") > part_size * SPREAD_PARTS
    ).select("id", F.col("output_file_count").alias("_total"), parts.alias("_parts"))
    keys, total, first = ["id"], F.lit(None).cast("bigint"), F.lit(0)
    if n_large := large.count():
        # So few salts that the salted jobs are fewer than the files.
        salts = min(SALTS, part_size) if n_large > BROADCAST_JOBS else 0
        part = F.coalesce(F.pmod(F.xxhash64("file", "crc64nvme"), "_parts").cast("int"), F.lit(0))
        files = _with_parts(files, large, salts).withColumn("_part", part)
        spread = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
        headers = headers.join(large if salts else F.broadcast(large), "id", "left").withColumn(
            "_part", spread)
        keys, total, first = ["id", "_part"], F.col("_total"), F.col("_part")
    nested = (
        files
        # Collecting does not shrink the rows, so it is not worth doing before the exchange.
        .repartition(*keys)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("file", "crc64nvme"))).alias("_files"))
    )
    own = F.coalesce("_files", F.array().cast("array<struct<file:string,crc64nvme:string>>"))

    def of_part(p: Column) -> Column:
        return F.filter(own, lambda f: F.pmod(F.xxhash64(f["file"], f["crc64nvme"]), parts) == p)

    # A spread job comes in its parts already.
    cut = F.when(total.isNull() & (F.col("output_file_count") > part_size),
                 F.transform(F.sequence(F.lit(0), parts - 1), of_part)).otherwise(F.array(own))
    return (
        headers.join(nested, keys, "left")
        .withColumn("output_file_count", F.coalesce(total, F.size(own).cast("bigint")))
        .select("id", *body, "output_file_count", first.alias("_first"),
                F.posexplode(cut).alias("_at", "outputs"))
        .select("id", (F.col("_first") + F.col("_at")).alias("outputs_part"), *body,
                "output_file_count", "outputs")
    )


def output_counts(files: DataFrame) -> DataFrame:
    """Number of output files per job."""
    return files.groupBy("id").agg(F.count("*").alias("output_file_count"))


def job_headers(jobs: DataFrame) -> DataFrame:
    """One row per job, without outputs."""
    return jobs.filter("outputs_part = 0").drop("outputs", "outputs_part")


def explode_outputs(jobs: DataFrame) -> DataFrame:
    """One row per job and output file."""
    own = ["id", *[c for c in [ID_PART] if c in jobs.columns]]
    return jobs.select(*own, F.explode("outputs").alias("o")).select(
        *own, F.col("o.file").alias("file"), F.col("o.crc64nvme").alias("crc64nvme")
    )


def completion_time(transitions: Column) -> Column:
    """Time text of the last transition to complete, NULL if there is none."""
    done = F.filter(transitions, lambda t: t["state"] == COMPLETE)
    return F.try_element_at(done, F.lit(-1))["time"]


def import_record(headers: DataFrame) -> DataFrame:
    """What an importer is told about a job, outputs excepted."""
    return headers.select(*import_columns())


def import_columns() -> list[Column]:
    return [
        F.col("id"),
        namespace_prefix(F.col("user")).alias("namespace_prefix"),
        F.col("image.name").alias("image"),
        F.col("image.digest").alias("image_digest"),
        F.col("input_file_count"),
        F.col("output_file_count"),
        F.try_to_timestamp(completion_time(F.col("transition_times"))).alias("completion_time"),
    ]


def id_part(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(ID_PARTS)).cast("int")


def write_jobs(jobs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lay job documents (or headers, or files with their job's `id`) out by a hash of the id, in
    files sorted by it, so that a batch's lookup reads the folders of its jobs only. Written again with
    only some parts, the other parts stay."""
    (jobs.withColumn(ID_PART, id_part(F.col("id"))).hint("rebalance", ID_PART)
     .sortWithinPartitions(ID_PART, "id").write.mode(mode).partitionBy(ID_PART)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def asked_for(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (headers or files of jobs) that a small set of ids (column job_id) asks for, else all
    of them.

    A batch asks for few of all jobs: with the ids broadcast, the job table is scanned but not
    exchanged, and of a table that is laid out by id only the parts that hold one are read. Many ids
    are left to the join that follows.
    """
    if not fits_broadcast(ids):
        return rows
    asked = ids.select(F.col("job_id").alias("id"))
    if ID_PART not in rows.columns:
        return rows.join(asked, "id", "left_semi")
    # The comparison holds for all; it tells Spark that the ids are worth pruning by.
    asked = asked.withColumn(ID_PART, id_part(F.col("id"))).filter(F.col(ID_PART) >= 0)
    return rows.join(asked, [ID_PART, "id"], "left_semi").drop(ID_PART)


def job_fault() -> Column:
    """Why a job cannot be imported by its document, NULL if it can."""
    done = completion_time(F.col("transition_times"))
    unreadable = F.try_to_timestamp(done).isNull()
    job = F.concat(F.lit(" job "), F.col("id"))
    return (
        F.when(done.isNull(), F.concat(F.lit(NOT_COMPLETE_TEXT), F.col("id")))
        .when(unreadable, F.concat(F.lit("Unreadable completion time of"), job, F.lit(": "), done))
        .when(namespace_prefix(F.col("user")).isNull(), F.concat(F.lit("No user in the document of"), job))
        .when(F.col("image.name").isNull(), F.concat(F.lit("No image in the document of"), job))
    )


def one_per_job(headers: DataFrame) -> DataFrame:
    """The import record of each job with `job_fault`; of a job with several headers one row,
    which has a fault."""
    rows = headers.select(*import_columns(), job_fault().alias("job_fault"))
    several = F.concat(F.lit("More than one document of job "), F.col("id"))
    own = [c for c in rows.columns if c != "id"]
    return (
        rows.groupBy("id").agg(F.min(F.struct(*own)).alias("r"), F.count("*").alias("n"))
        .select("id", *[F.col(f"r.{c}").alias(c) for c in own if c != "job_fault"],
                F.when(F.col("n") > 1, several).otherwise(F.col("r.job_fault")).alias("job_fault"))
    )


def enrich(events: DataFrame, headers: DataFrame) -> DataFrame:
    """Join events to the import record of their job; `job_found` tells hits from misses and
    `job_fault` why a job that is there cannot be imported. An event stays one row.

    A left join with the events on the left, so AQE can split a hot or NULL job id.
    """
    record = one_per_job(headers).withColumnRenamed("id", "_id")
    return (
        events.join(record, events["job_id"] == F.col("_id"), "left")
        .withColumn("job_found", F.col("_id").isNotNull())
        .drop("_id")
    )


def missing_jobs(events: DataFrame, headers: DataFrame) -> DataFrame:
    """Events whose job is unknown."""
    return events.join(headers.select(F.col("id").alias("job_id")), "job_id", "left_anti")


def dispatch(enriched: DataFrame, registry: DataFrame) -> DataFrame:
    """Join the importer of the job's image. There are few images, and one may own most jobs:
    give the registry as files or a written table, whose size Spark knows and broadcasts."""
    importers = registry.select(F.col("image").alias("_image"), "module", "meta")
    return enriched.join(importers, F.col("image") == F.col("_image"), "left").drop("_image")


def rows_with_owner(rows: DataFrame, owners: DataFrame, root: str = "") -> DataFrame:
    """File rows joined to the jobs that list their file below `root`; owners has id and file.

    Rows are on the left, so AQE can split a hot file.
    """
    files = owners.select("id", bare_path(F.concat(F.lit(root), "file")).alias(FILE_COLUMN))
    return rows.join(files, FILE_COLUMN).drop(FILE_COLUMN)
