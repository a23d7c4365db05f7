"""One table for all namespaces, of which a batch rewrites only what it touches.

Rows lie in pieces: a piece is the rows of one namespace whose keys fall into one of a fixed number of
buckets. A batch reads the pieces that its rows fall into, merges all namespaces in one join by
namespace and key, and writes these pieces anew below `data/v=<number>`. Which piece is current is a
table of its own (`v=<number>`: namespace, bucket, version), a few bytes for each piece, written with
every version. A version counts once its state says that it is done, so readers see all of a batch or
nothing of it, a batch that runs again finds its version, and pieces that the kept versions no longer
name go. Neither jobs nor catalog calls grow with the namespaces, but for those that are new.

A view joins the data to the pieces of the newest version; each namespace is a view on it. Its filter
reaches the scan as a partition filter.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from jobloom.operators.latest import any_null
from jobloom.operators.merge import merge
from jobloom.operators.publish import (
    expire_versions, provider, read_version, remove, staged, versions, write_version,
)
from jobloom.schemas import INT, LONG, STRING, shape
from jobloom.sources.tables import create_namespace, empty_table, quoted

BUCKET, VERSION = "_bucket", "_v"
BUCKETS = 16
THREADS = 16


def bucket_of(schema: StructType, keys: list[str], buckets: int) -> Column:
    """The bucket of a row by its key. Rows with a NULL key match none: they go by all their cells,
    so that they do not meet in one bucket."""
    cells = [f.name for f in schema if not isinstance(f.dataType, (MapType, VariantType))]
    by_key = F.xxhash64(*(F.col(f"`{k}`") for k in keys))
    by_row = F.xxhash64(*(F.col(f"`{c}`") for c in cells))
    return F.pmod(F.when(any_null(keys), by_row).otherwise(by_key), F.lit(buckets)).cast("int")


class SharedTable:
    """The rows of `schema` of all namespaces, below `location`. `by` names the namespace.

    The number of buckets belongs to the table: opening one with another number is an error.
    """

    def __init__(self, spark: SparkSession, location: str, schema: StructType, keys: list[str], by: str,
                 buckets: int = BUCKETS):
        self.spark, self.location, self.schema = spark, location.rstrip("/"), schema
        self.keys, self.by, self.buckets = keys, by, buckets
        self.rows = shape(**{f.name: f.dataType for f in schema}, **{by: STRING, BUCKET: INT})
        self.pieces = shape(**{by: STRING, BUCKET: INT, VERSION: LONG})

    @property
    def data(self) -> str:
        return f"{self.location}/data"

    def newest(self, but: str | None = None) -> int | None:
        """The newest whole version, without those of the batch `but`."""
        done = [n for n, s in versions(self.spark, self.location).items()
                if s["done"] and s["writer"]["batch"] != but]
        return done[-1] if done else None

    def current_pieces(self, version: int | None) -> DataFrame:
        if version is None:
            return empty_table(self.spark, self.pieces)
        return read_version(self.spark, self.location, version, self.pieces)

    def of_pieces(self, pieces: DataFrame) -> DataFrame:
        """The rows of some pieces. If these are few, only their folders are read."""
        schema = StructType([*self.rows.fields, self.pieces[VERSION]])
        all_ = self.spark.read.schema(schema).parquet(self.data)
        # The comparison holds for all; it tells Spark that the pieces are worth pruning by.
        named = pieces.filter(F.col(VERSION) >= 0)
        return all_.join(named, [VERSION, self.by, BUCKET], "left_semi").drop(VERSION)

    def read(self) -> DataFrame:
        """All current rows, with the namespace."""
        version = self.newest()
        if version is None:
            return empty_table(self.spark, StructType(self.rows.fields[:-1]))
        return self.of_pieces(self.current_pieces(version)).drop(BUCKET)

    def merge(self, steps: list[tuple[DataFrame, str]], writer: str, scratch: str, keep: int = 3) -> int:
        """Merge sources (rows with their namespace), each with its mode, as one version; returns it.

        `writer` names the batch: what it has merged before is not merged again. `scratch` is a folder
        of the batch.
        """
        states = versions(self.spark, self.location)
        done = [n for n, s in states.items() if s["done"]]
        for n in done:
            if states[n]["writer"]["batch"] == writer:
                return done[-1]
        for s in (states[n] for n in done):
            if s["writer"]["buckets"] != self.buckets:
                raise ValueError(f"{self.location} has {s['writer']['buckets']} buckets")
        base, number = (done[-1] if done else None), max(states, default=-1) + 1
        bucket = bucket_of(self.schema, self.keys, self.buckets)
        cells = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema]
        steps = [(staged(rows.select(*cells, self.by).withColumn(BUCKET, bucket), f"{scratch}/source-{i}"),
                  mode) for i, (rows, mode) in enumerate(steps)]
        named = [rows.select(self.by, BUCKET) for rows, _ in steps]
        touched = staged(reduce(DataFrame.unionByName, named).distinct(), f"{scratch}/touched")
        before = self.current_pieces(base)
        old = staged(before.join(touched, [self.by, BUCKET], "left_semi"), f"{scratch}/pieces")
        table = empty_table(self.spark, self.rows)
        if not old.isEmpty():
            table = self.of_pieces(old).select(*self.rows.names)
        for rows, mode in steps:
            table = merge(table, rows, [self.by, BUCKET, *self.keys], mode)
        # A small piece is one file, a large one several.
        (table.hint("rebalance", self.by, BUCKET).write.mode("overwrite").partitionBy(self.by, BUCKET)
         .option("partitionOverwriteMode", "static").parquet(f"{self.data}/{VERSION}={number}"))
        kept = before.join(touched, [self.by, BUCKET], "left_anti")
        now = kept.unionByName(touched.withColumn(VERSION, F.lit(number).cast("bigint")))
        write_version(now, self.location, number, base, {"batch": writer, "buckets": self.buckets})
        self.expire(keep)
        return number

    def expire(self, keep: int) -> None:
        """Keep the last versions, and of the data the pieces that they name."""
        states = versions(self.spark, self.location)
        done = [n for n, s in states.items() if s["done"]]
        for n in set(states) - set(done):
            if n < done[-1]:  # begun, and never finished
                remove(self.spark, f"{self.data}/{VERSION}={n}")
        old, kept = done[:-max(keep, 1)], done[-max(keep, 1):]
        if not old:
            return
        named = [reduce(DataFrame.unionByName, map(self.current_pieces, some)) for some in (old, kept)]
        # As many as later batches replaced.
        gone = named[0].distinct().join(named[1], [self.by, BUCKET, VERSION], "left_anti")
        parts = gone.select(VERSION, self.by, BUCKET).toLocalIterator()
        paths = (f"{self.data}/{VERSION}={v}/{self._folder(by)}/{BUCKET}={b}" for v, by, b in parts)
        with ThreadPoolExecutor(THREADS) as pool:
            for _ in pool.map(lambda p: remove(self.spark, p), paths):
                pass
        expire_versions(self.spark, self.location, keep)

    def _folder(self, by: str) -> str:
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return escaped.getPartitionPathString(self.by, by)

    def point_view(self, name: str, version: int) -> None:
        """Let the view `name` show the rows of a version, with the namespace."""
        columns = ", ".join(f"d.{quoted(c)}" for c in [*self.schema.names, self.by])
        on = " AND ".join(f"d.{quoted(c)} = p.{quoted(c)}" for c in (VERSION, self.by, BUCKET))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{self.data}` d "
            f"LEFT SEMI JOIN parquet.`{self.location}/v={version}` p ON {on} AND p.{quoted(VERSION)} >= 0")


def for_each(spark: SparkSession, prefixes: DataFrame, work: Callable[[str], None],
             is_outage: Callable[[Exception], bool], threads: int = THREADS) -> list[tuple[str, str, str]]:
    """Do catalog work for some (new) namespaces, several at a time; returns (namespace, error, trace)
    of those where it fails."""
    def one(prefix: str) -> tuple[str, str, str] | None:
        try:
            work(prefix)
        except Exception as e:
            if is_outage(e):
                raise
            return prefix, str(e), traceback.format_exc()
        return None

    with ThreadPoolExecutor(threads) as pool:
        done = pool.map(inheritable_thread_target(spark)(one), (r[0] for r in prefixes.toLocalIterator()))
        return [x for x in done if x]


def claim(spark: SparkSession, namespace: str, location: str, table: str) -> None:
    """Create a namespace, unless its table is something else than a view."""
    create_namespace(spark, namespace, location)
    if (format_ := provider(spark, table)) is not None:
        raise ValueError(f"{table} is a plain {format_} table; move it away first")


def point_namespace(spark: SparkSession, name: str, shared: str, by: str, value: str,
                    columns: list[str]) -> None:
    """The view of one namespace on the shared one."""
    listed = ", ".join(quoted(c) for c in columns)
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS SELECT {listed} FROM {shared} "
              f"WHERE {quoted(by)} = '{text}'")
