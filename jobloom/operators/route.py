"""Routing: exactly one outcome per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MALFORMED = "dlq_malformed"
CONTROL = "control"
MISSING_KEYS = "dlq_missing_keys"
DISCARD = "discard"
IMPORTABLE = "importable"
NO_JOB = "dlq_no_job"
BAD_JOB = "dlq_bad_job"
NO_OPERATION = "no_operation"
IMPORT = "import"
IMPORT_ERROR = "dlq_import_error"

CONTROL_TYPE = "integration_test"
COMPLETE = "complete"


def first_route() -> Column:
    """Route by the content of a decoded event; the first match wins."""
    return (
        F.when(F.col("event").isNull(), MALFORMED)
        .when(F.coalesce(F.col("special_event_type") == CONTROL_TYPE, F.lit(False)), CONTROL)
        .when(F.size("missing_keys") > 0, MISSING_KEYS)
        .when(F.coalesce(F.col("state"), F.lit("")) != COMPLETE, DISCARD)
        .otherwise(IMPORTABLE)
    )


def route(decoded: DataFrame) -> DataFrame:
    """Add `route`. Lazy, so it also runs on a stream."""
    return decoded.withColumn("route", first_route())


def job_route() -> Column:
    """Route of an importable event after the joins with jobs and registry."""
    return (
        F.when(~F.col("job_found"), NO_JOB)
        .when(F.col("job_fault").isNotNull(), BAD_JOB)
        .when(F.col("module").isNull(), NO_OPERATION)
        .otherwise(IMPORT)
    )


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(F.count("*").alias("n"))
