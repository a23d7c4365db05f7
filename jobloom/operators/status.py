"""Import status of jobs: changes are appended, the current status is a fold over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Keys of a job's status.
START = "cse_event_processing_start"
COMPLETE = "cse_event_processing_complete"
NO_OPERATION = "cse_event_processing_no_operation"
ERROR = "cse_event_processing_error"

# What setting a key removes.
UNSETS = {START: [COMPLETE, ERROR]}


def iso_utc(at: Column) -> Column:
    """ISO 8601 text in UTC with microseconds."""
    utc = F.to_utc_timestamp(at, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def current_status(changes: DataFrame, order: list[str]) -> DataFrame:
    """The present value of each key of each job, as rows (job_id, key, value) and the order
    of its last change, so that a fold can go on from them.

    The last change of a key wins; a start removes earlier complete and error marks. The
    changes are combined before the first exchange; only one row per job and key is left for
    the window.
    """
    at = F.struct(*order)
    last = changes.groupBy("job_id", "key").agg(
        F.max(F.struct(at.alias("at"), F.col("value"))).alias("_last")
    )
    started = F.max(F.when(F.col("key") == START, F.col("_last.at"))).over(
        Window.partitionBy("job_id")
    )
    gone = F.col("key").isin(UNSETS[START]) & F.coalesce(
        F.col("_started") > F.col("_last.at"), F.lit(False)
    )
    return (
        last.withColumn("_started", started).filter(~gone)
        .select("job_id", "key", F.col("_last.value").alias("value"),
                *[F.col(f"_last.at.{o}").alias(o) for o in order])
    )


def status_maps(status: DataFrame) -> DataFrame:
    """One map per job from status rows. A job has few keys."""
    return status.groupBy("job_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("meta")
    )
