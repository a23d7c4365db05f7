"""The import of one batch: file rows of all its jobs to merged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from jobloom.importers.base import Importer
from jobloom.operators.jobs import ID_PART, asked_for, rows_with_owner
from jobloom.operators.latest import ARRIVAL, repeated_keys, winning_rows
from jobloom.operators.merge import UPDATE, fits_broadcast
from jobloom.operators.publish import staged
from jobloom.schemas import STRING, shape
from jobloom.sources.files import missing_paths, path_slices, scan_delimited
from jobloom.sources.joboutputs import locate, opens, read_rows
from jobloom.sources.tables import empty_table

PREFIX = "namespace_prefix"
SALTS = 64

LOST = shape(file=STRING, fault=STRING)

# Reasons in the order in which a job reports them.
_BAD_NAMESPACE, _MISSING_FILE, _NO_FILES, _BAD_CELL, _REPEATED = range(5)


def winning_jobs(events: DataFrame, mode: str) -> DataFrame:
    """One event per job: a job's outputs are the same for all of its events, so only the
    last one (first, if matched rows stay) can decide a row. Events have a job id here."""
    keep = "last" if mode == UPDATE else "first"
    return winning_rows(events, ["job_id"], keep, ties=False)


def owned_files(importer: Importer, jobs: DataFrame, outputs: DataFrame) -> DataFrame:
    """The files an importer reads for these jobs, as rows (id, file).

    One job may own most files. Where the jobs are too many to broadcast, both sides are salted,
    so that no job's files are exchanged to one task.
    """
    files = outputs.filter(importer.accepts(F.col("file")))
    files = files.select("id", "file", *[c for c in [ID_PART] if c in files.columns])
    ids = jobs.select(F.col("job_id").alias("id"))
    if fits_broadcast(ids):
        return asked_for(files, jobs).select("id", "file")
    files = files.select("id", "file")
    salt = F.pmod(F.xxhash64("file"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    return files.withColumn("_salt", salt).join(
        ids.select("id", salts), ["id", "_salt"], "left_semi").drop("_salt")


def _failure(df: DataFrame, reason: int, error) -> DataFrame:
    return df.select("id", F.lit(reason).alias("reason"), error.alias("error"))


def jobs_without_files(importer: Importer, jobs: DataFrame, files: DataFrame) -> DataFrame:
    ids = jobs.select(F.col("job_id").alias("id"))
    return _failure(ids.join(files.select("id").distinct(), "id", "left_anti"), _NO_FILES,
                    F.lit(importer.no_files_error))


def jobs_with_missing_files(files: DataFrame, missing: DataFrame) -> DataFrame:
    """Jobs that list a file that does not exist or cannot be read; `missing` has the columns file
    and fault."""
    faults = missing.select("file", "fault").distinct()
    hit = files.join(faults, "file")
    return _failure(hit.groupBy("id").agg(F.min_by("fault", "file").alias("fault")),
                    _MISSING_FILE, F.col("fault"))


def jobs_with_bad_namespace(importer: Importer, jobs: DataFrame) -> DataFrame:
    """Jobs whose user does not give a name that the catalog takes."""
    name = F.concat(F.col(PREFIX), F.lit(importer.namespace))
    bad = jobs.filter(~name.rlike(r"^\w+\z")).withColumnRenamed("job_id", "id")
    return _failure(bad, _BAD_NAMESPACE, F.concat(F.lit("Not a valid namespace: "), name))


def _checked_cells(rows: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the schema; `_bad` names the first column whose cell does not fit."""
    cells, bad = [], []
    for f in schema:
        cast = F.col(f"`{f.name}`").try_cast(f.dataType)
        cells.append(cast.alias(f.name))
        if rows.schema[f.name].dataType != f.dataType:
            bad.append(F.when(F.col(f"`{f.name}`").isNotNull() & cast.isNull(), F.lit(f.name)))
    first = F.coalesce(*bad, F.lit(None).cast("string"))
    return rows.select("id", *cells, first.alias("_bad"))


def typed_rows(importer: Importer, jobs: DataFrame, owned: DataFrame) -> DataFrame:
    """File rows with the `id` of their job as the importer's rows, with `id` and `_bad`."""
    return _checked_cells(
        importer.transform(owned, jobs.withColumnRenamed("job_id", "id")), importer.schema
    )


def failed_jobs(importer: Importer, jobs: DataFrame, files: DataFrame, typed: DataFrame,
                missing: DataFrame) -> DataFrame:
    """Jobs that fail, as rows (id, reason, error).

    A job without a valid namespace, without files, with a missing one, an unreadable cell or,
    when updating, a repeated key fails as a whole.
    """
    failed = _failure(
        typed.filter("_bad is not null").groupBy("id").agg(F.min("_bad").alias("_bad")),
        _BAD_CELL, F.concat(F.lit("A value does not fit column "), F.col("_bad")),
    )
    if importer.mode == UPDATE:
        repeated = repeated_keys(typed, ["id"], importer.keys).select("id").distinct()
        text = f"A key repeats within the job: {', '.join(importer.keys)}"
        failed = failed.unionByName(_failure(repeated, _REPEATED, F.lit(text)))
    failed = failed.unionByName(jobs_without_files(importer, jobs, files))
    failed = failed.unionByName(jobs_with_bad_namespace(importer, jobs))
    return first_reason(failed.unionByName(jobs_with_missing_files(files, missing)))


def rows_to_merge(importer: Importer, jobs: DataFrame, typed: DataFrame,
                  failed: DataFrame) -> DataFrame:
    """The winning rows of the jobs that do not fail, with their namespace prefix.

    Give `jobs` and `failed` as written tables: if they are small, Spark then knows it and
    broadcasts them, where otherwise it would exchange all rows by their job.
    """
    place = jobs.select(F.col("job_id").alias("id"), PREFIX, *ARRIVAL)
    good = (
        typed.drop("_bad").join(failed.select("id"), "id", "left_anti").join(place, "id")
    )
    keep = "last" if importer.mode == UPDATE else "first"
    rows = winning_rows(good, [PREFIX, *importer.keys], keep)
    return rows.select(PREFIX, *importer.schema.names)


def first_reason(failures: DataFrame) -> DataFrame:
    """One error per job."""
    return (
        failures.groupBy("id").agg(F.min(F.struct("reason", "error")).alias("f"))
        .select("id", "f.reason", "f.error")
    )


def stage_typed(spark: SparkSession, importer: Importer, jobs: DataFrame, files: DataFrame,
                root: str, stage: str) -> tuple[DataFrame, DataFrame]:
    """Read the files and write down their typed rows; returns these and the files at fault
    (file, fault).

    Tasks read the files themselves, in as many Spark jobs for any number of files. Below a root
    that they cannot open, Spark's file scan does it, slice by slice of the paths.
    """
    if not opens(spark, root):
        return _scan_in_slices(spark, importer, jobs, files, root, stage)
    located = staged(locate(files, root, importer.file_columns, importer.sep), f"{stage}/located")
    owned = read_rows(located, root, importer.file_columns, importer.sep)
    typed = staged(typed_rows(importer, jobs, owned), f"{stage}/rows")
    return typed, located.filter("fault is not null").select("file", "fault")


def _scan_in_slices(spark: SparkSession, importer: Importer, jobs: DataFrame, files: DataFrame,
                    root: str, stage: str, slice_size: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """The driver holds one slice of paths at a time, as every Spark file scan needs."""
    rows_path, lost_path = f"{stage}/rows", f"{stage}/missing"
    columns = [StructField("id", STRING), *importer.schema, StructField("_bad", STRING)]
    schema = StructType(columns)
    rows_mode = lost_mode = "overwrite"
    for paths in path_slices(files.select("file"), slice_size):
        gone = set(missing_paths(spark, [root + p for p in paths]))
        there = [root + p for p in paths if root + p not in gone]
        if there:
            raw = scan_delimited(spark, there, importer.file_columns, importer.sep)
            owned = rows_with_owner(raw, files, root)
            typed_rows(importer, jobs, owned).write.mode(rows_mode).parquet(rows_path)
            rows_mode = "append"
        if gone:
            lost = [(p, f"No such file: {p}") for p in paths if root + p in gone]
            spark.createDataFrame(lost, LOST).write.mode(lost_mode).parquet(lost_path)
            lost_mode = "append"

    def written(path: str, mode: str, schema: StructType) -> DataFrame:
        if mode == "overwrite":  # nothing was
            return empty_table(spark, schema)
        return spark.read.schema(schema).parquet(path)

    return written(rows_path, rows_mode, schema), written(lost_path, lost_mode, LOST)
