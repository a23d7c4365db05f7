"""Importer of the rows that control events carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.functions import jsonobj
from jobloom.operators.latest import ARRIVAL, repeated_keys, winning_rows
from jobloom.operators.merge import UPDATE, merge
from jobloom.operators.publish import staged
from jobloom.schemas import EMPLOYEES
from jobloom.session import shared_dir

KEYS = ["employee_id"]
EVENT = ["topic", "partition", "offset"]
COLUMNS = EMPLOYEES.names


def _events(control: DataFrame) -> DataFrame:
    event = F.col("event")
    return control.select(
        *EVENT, "timestamp",
        # Absent means update; an explicit null is not "update".
        F.when(F.array_contains(jsonobj.keys(event), "mode"), jsonobj.field(event, "mode"))
        .otherwise(F.lit(UPDATE)).alias("mode"),
        jsonobj.field(event, "input_data", "array<variant>").alias("data"),
    )


def parsed_rows(control: DataFrame) -> DataFrame:
    """One row per entry of an event's input, with `reason` where the schema refuses it. An
    event without a list gives one row with its reason."""
    row = F.col("row")
    size = F.size(row.try_cast("array<variant>"))
    number = F.try_variant_get(row, "$[0]", "int")
    name = F.try_variant_get(row, "$[1]", "string")
    integral = F.schema_of_variant(F.try_variant_get(row, "$[0]", "variant")) == "BIGINT"
    fits = (size == 2) & integral & number.isNotNull() & name.isNotNull()
    reason = F.when(F.col("data").isNull(), "input_data is missing or not a list").when(
        F.col("row").isNotNull() & ~F.coalesce(fits, F.lit(False)),
        "input_data has a row that does not fit the schema",
    )
    return (
        _events(control)
        .select("*", F.explode_outer("data").alias("row"))
        .select(*EVENT, "timestamp", "mode", number.alias("employee_id"),
                name.alias("employee_name"), F.col("row").isNotNull().alias("has_row"),
                reason.alias("reason"))
    )


def failures(rows: DataFrame) -> DataFrame:
    """Events that cannot be imported, with the reason, from parsed rows."""
    refused = rows.filter("reason is not null").select(*EVENT, F.col("reason").alias("error"))
    updating = rows.filter((F.col("mode") == UPDATE) & F.col("has_row"))
    repeated = repeated_keys(updating, EVENT, KEYS).select(
        *EVENT, F.lit("input_data repeats a key").alias("error")
    )
    return refused.unionByName(repeated).groupBy(*EVENT).agg(F.min("error").alias("error"))


def merge_steps(rows: DataFrame, failed: DataFrame) -> list[tuple[DataFrame, str]]:
    """Two merges that equal taking the control events of a batch one by one.

    Per key the last updating event wins; without one, the first inserting event counts if
    the key is new.
    """
    good = rows.filter("has_row").join(failed.select(*EVENT), EVENT, "left_anti")
    updating = F.coalesce(F.col("mode") == UPDATE, F.lit(False))
    updates = winning_rows(good.filter(updating), KEYS, "last", ARRIVAL)
    inserts = winning_rows(good.filter(~updating), KEYS, "first", ARRIVAL)
    return [(updates.select(*COLUMNS), UPDATE), (inserts.select(*COLUMNS), "insert")]


def apply_control_events(target: DataFrame, control: DataFrame) -> DataFrame:
    """The employees after all control events of a batch. Merging asks for the sources more
    than once, so they are written down first."""
    spark = control.sparkSession
    rows = staged(parsed_rows(control), shared_dir(spark, "control"))
    for source, mode in merge_steps(rows, failures(rows)):
        target = merge(target, staged(source, shared_dir(spark, "source")), KEYS, mode)
    return target
