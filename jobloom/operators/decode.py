"""Strict decoding of event records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.functions import jsonobj

REQUIRED_KEYS = ["job_id", "state"]


def decode(records: DataFrame) -> DataFrame:
    """Add `event`, the JSON object of a record, and the fields that routing needs.

    `event` is NULL for anything but one UTF-8 JSON object. Lazy and free of shuffles, so it
    also runs on a stream. The fields come out of a one-row generator: filters on them stay
    above it, where otherwise they would be pushed down with the whole parse inlined.
    """
    event = F.col("_event")
    fields = F.struct(
        event.alias("event"),
        jsonobj.field(event, "job_id").alias("job_id"),
        jsonobj.field(event, "state").alias("state"),
        jsonobj.field(event, "special_event_type").alias("special_event_type"),
        jsonobj.missing_keys(event, REQUIRED_KEYS).alias("missing_keys"),
    )
    parsed = jsonobj.with_object(records, F.col("value"), "_event")
    return parsed.select(*records.columns, F.inline(F.array(fields)))
