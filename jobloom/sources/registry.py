"""The importer registry: which importer takes the output of which image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.functions.checks import check


def read_registry(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Registry rows from JSON files that have one object {image, py_module,
    importer_meta} each. A file that is no JSON fails the read."""
    raw = (
        spark.read.option("multiLine", True).option("mode", "FAILFAST")
        .schema("image string, py_module string, importer_meta string")
        .json(paths)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )
    return registry(
        raw, F.col("image"), F.col("py_module"), F.col("source_file"), F.col("importer_meta")
    )


def registry(df: DataFrame, image: Column, module: Column, source_file: Column,
             meta: Column) -> DataFrame:
    """A registry from columns; `meta` is JSON text, missing means the empty object. Text that is
    no JSON gives NULL, which `invalid_rows` reports."""
    return df.select(
        image.alias("image"), module.alias("module"), source_file.alias("source_file"),
        F.try_parse_json(F.coalesce(meta, F.lit("{}"))).alias("meta"),
    )


def invalid_rows(reg: DataFrame) -> DataFrame:
    """Rows that lack their image, module or readable metadata, with what they lack."""
    rules = {
        "image": F.coalesce(F.col("image") == "", F.lit(True)),
        "module": F.coalesce(F.col("module") == "", F.lit(True)),
        "meta": F.col("meta").isNull(),
    }
    return check(reg, rules).filter(F.size("violations") > 0)


def conflicts(reg: DataFrame) -> DataFrame:
    """Images registered more than once, with their number of rows and two of the files.

    Only bounded aggregates, so a hot image is combined before the exchange.
    """
    return (
        reg.groupBy("image")
        .agg(F.count("*").alias("n"), F.min("source_file").alias("first_file"),
             F.max("source_file").alias("last_file"))
        .filter("n > 1")
    )


def require_sound(reg: DataFrame) -> None:
    """Raise if rows are incomplete or an image is registered twice, naming files."""
    bad = [f"{r.source_file}: no {', '.join(r.violations)}" for r in invalid_rows(reg).head(5)]
    bad += [f"{r.image} is registered {r.n} times, in {r.first_file} and {r.last_file}"
            for r in conflicts(reg).head(5)]
    if bad:
        raise ValueError("the importer registry is not sound: " + "; ".join(bad))
