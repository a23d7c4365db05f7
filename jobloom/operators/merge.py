"""Keyed merge as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

UPDATE = "update"


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast the frame."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimate <= limit


def new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks; a NULL key is always lacking.

    The target gives only its keys, each once. If the source is small they are first cut to
    those it asks for, so a large target is scanned but not shuffled.
    """
    known = target.select(*keys)
    if fits_broadcast(source):
        known = known.join(source.select(*keys), keys, "left_semi")
    return source.join(known.distinct(), keys, "left_anti")


def merge(target: DataFrame, source: DataFrame, keys: list[str], mode: str = UPDATE) -> DataFrame:
    """The target after a merge: in mode "update" matched rows take all source values, in
    any other mode they stay; rows without a match are inserted. Columns match by name.

    Keys compare with `=`. In update mode a key must not repeat in the source. Two joins
    rather than a full outer one: this way Spark can broadcast a small source, and split a
    hot key of a large target. The source is asked for up to three times, so stage it if it
    is costly.
    """
    columns = target.columns
    if set(source.columns) != set(columns):
        raise ValueError(f"source columns {source.columns} differ from target's {columns}")
    inserted = new_rows(target, source, keys).select(*columns)
    if mode != UPDATE:
        return target.unionByName(inserted)
    values = [c for c in columns if c not in keys]
    updates = source.select(
        *keys, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in values]
    )
    kept = target.join(updates, keys, "left").select(
        *[F.col(c) if c in keys
          else F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
          for c in columns]
    )
    return kept.unionByName(inserted)
