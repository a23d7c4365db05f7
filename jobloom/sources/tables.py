"""Literal rows, catalog tables and namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """Rows given in code. NULLs and overflow that the schema forbids are refused."""
    return spark.createDataFrame(rows, schema)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, which the optimizer knows: unions and joins with it fall away."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).filter(F.lit(False)).select(*none)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def quoted(name: str) -> str:
    """One part of a catalog name for use in SQL."""
    return "`" + name.replace("`", "``") + "`"


def create_namespace(spark: SparkSession, name: str, location: str | None = None,
                     if_not_exists: bool = True) -> None:
    clause = "IF NOT EXISTS " if if_not_exists else ""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {clause}{quoted(name)}{at}")


def create_table(spark: SparkSession, name: str, schema: StructType,
                 provider: str = "parquet") -> None:
    """Create a table if there is none. Its columns take NULL whatever the schema says."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}")


def overwrite_table(df: DataFrame, name: str, provider: str = "parquet") -> None:
    df.write.mode("overwrite").option("compression", "snappy").format(provider).saveAsTable(name)


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Drop a namespace with everything in it."""
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(name)} CASCADE")


def preview(df: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*keys).limit(n)
