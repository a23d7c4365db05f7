"""Which event wins a key within a batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Arrival order of events, within a partition that of the topic.
ARRIVAL = ["timestamp", "partition", "offset"]


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def winning_rows(rows: DataFrame, keys: list[str], keep: str = "last",
                 order: list[str] | None = None, ties: bool = True) -> DataFrame:
    """All rows of the last (or first) event of each key; rows with a NULL key all pass.
    Without `ties`, one row per key (and for NULL keys, per event and map task).

    The filter on the rank makes Spark keep only the best rows of each map task before the
    exchange, so a hot key moves little. NULL keys never match each other: their rows are
    grouped by event and map task, where all have rank 1.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last: {keep}")
    order = order or ARRIVAL
    groups = list(keys)
    if any(rows.schema[k].nullable for k in keys):
        rows = rows.withColumn("_task", F.spark_partition_id()).withColumn(
            "_null_group", F.when(any_null(keys), F.struct(*order, "_task"))
        )
        groups.append("_null_group")
    by = [F.col(o).desc() if keep == "last" else F.col(o).asc() for o in order]
    number = F.rank() if ties else F.row_number()
    rank = number.over(Window.partitionBy(*groups).orderBy(*by))
    return (
        rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_null_group", "_task")
    )


def repeated_keys(rows: DataFrame, unit: list[str], keys: list[str]) -> DataFrame:
    """Keys that one unit (a job, an event) holds more than once. NULL keys never match."""
    return (
        rows.filter(~any_null(keys)).groupBy(*unit, *keys)
        .agg(F.count("*").alias("n")).filter("n > 1")
    )
