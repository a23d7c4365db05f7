"""Connected components by alternating stars, as joins and aggregates of edges.

Each round ties every node's larger neighbours to the smallest one it knows, then its smaller
ones; the edges end as stars around the smallest node of each component. Rounds grow with the
logarithm of the longest chain. Each is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from jobloom.llm.written import written
from jobloom.session import shared_dir


def _written(df: DataFrame, folder: str) -> DataFrame:
    return written(df, f"{folder}/{uuid.uuid4().hex}")


def _smallest(sides: DataFrame, folder: str) -> DataFrame:
    """Each node's smallest neighbour, written so that Spark can split a node in the next join."""
    return _written(sides.groupBy("u").agg(F.min("v").alias("v")), folder).withColumnRenamed("v", "m")


def _large_star(edges: DataFrame, folder: str) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both, folder).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, folder: str) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down, folder)
    return (down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all nodes of (u, v) edges but those that are their own label."""
    folder = shared_dir(edges.sparkSession, "components")
    edges = _written(edges.filter("u <> v").distinct(), folder)
    state = _state(edges)
    while state[0]:
        large = _written(_large_star(edges, folder), folder)
        edges = _written(_small_star(large, folder).distinct(), folder)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
