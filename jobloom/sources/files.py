"""Output files of jobs: delimited text with a header line."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

FILE_COLUMN = "_file"


def bare_path(path: Column) -> Column:
    """A path without its scheme: bucket and key, the form job documents use."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+|^/+", "")


def _read_from() -> Column:
    """Bare path of the file a row came from; the metadata column is URL-encoded."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return bare_path(F.url_decode(encoded))


def scan_delimited(spark: SparkSession, paths: list[str] | str, columns: list[str] | None = None,
                   sep: str = "\t") -> DataFrame:
    """All files as strings in one scan, plus the bare path each row came from.

    With `columns`, no file is opened to learn the header.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if columns:
        schema = StructType()
        for name in columns:
            schema = schema.add(name, StringType())
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(paths)
    return df.select("*", _read_from().alias(FILE_COLUMN))


def cast_to_schema(df: DataFrame, schema: StructType, strict: bool = False,
                   keep: list[str] | None = None) -> DataFrame:
    """Columns by name, cast to the declared types.

    A cell that does not fit fails the query if strict, else becomes NULL.
    """
    def cell(f) -> Column:
        c = F.col(f"`{f.name}`")
        return (c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name)

    return df.select(*[F.col(k) for k in keep or []], *[cell(f) for f in schema])


def rejected_cells(df: DataFrame, schema: StructType, by: list[str] | None = None) -> DataFrame:
    """How many cells of each column do not fit the declared type."""
    bad = [
        F.count_if(F.col(f"`{f.name}`").isNotNull()
                   & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema
    ]
    counts = df.groupBy(*(by or [])).agg(*bad)
    return counts.unpivot(by or [], schema.names, "column", "rejected")


def path_slices(paths: DataFrame, size: int = 20_000) -> Iterator[list[str]]:
    """The distinct paths of a one-column frame, in slices.

    Spark's file scans take path lists from the driver. This way it holds one slice, and one
    partition of paths, at a time.
    """
    found = (r.path for r in paths.toDF("path").distinct().toLocalIterator())
    while part := list(islice(found, size)):
        yield part


def missing_paths(spark: SparkSession, paths: list[str], threads: int = 16) -> list[str]:
    """The paths that do not exist. One missing path would fail a whole scan."""
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()

    def exists(path: str) -> bool:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).exists(p)

    with ThreadPoolExecutor(threads) as pool:
        return [p for p, found in zip(paths, pool.map(exists, paths)) if not found]
