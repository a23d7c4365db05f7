"""Queries that check, mask and describe values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.functions import checks, text
from jobloom.schemas import DOUBLE, INT, LONG, STRING, shape
from jobloom.sources.files import cast_to_schema, rejected_cells
from jobloom.workload.shapes import table


def check_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rules on customers, with some values blanked and stretched by segment."""
    segment = F.col("c_mktsegment")
    c = table(spark, sf, "customer").withColumns({
        "name": F.when(segment == "BUILDING", F.lit(" \t 　\x1c"))
        .when(segment == "MACHINERY", F.concat(F.lit("\n "), "c_name", F.lit("\x85")))
        .otherwise(F.col("c_name")),
        "topic": F.when(segment == "FURNITURE", F.concat(segment, F.lit("-"), "c_custkey"))
        .when(segment == "HOUSEHOLD", F.rpad(segment, 250, "x"))
        .otherwise(F.concat(segment, F.lit("_"), "c_custkey")),
        "crc": F.concat(F.lit("aaaaaaaaaa"), F.col("c_nationkey")),
    })
    rules = {
        "nation": checks.falsy(F.col("c_nationkey"), "number"),
        "name": checks.blank(F.col("name")),
        "balance": checks.below(F.col("c_acctbal"), 0),
        "topic": checks.bad_topic_name(F.col("topic")),
        "checksum": checks.bad_checksum(F.col("crc")),
    }
    return checks.check(c, rules).select(
        "c_custkey", F.array_join("violations", ",").alias("violations"),
        F.length(checks.stripped(F.col("name"))).alias("n_name"),
    )


def control_chars(spark: SparkSession, sf: str) -> DataFrame:
    """Position of the first control character in whole documents, pages and turns."""
    def positions(name: str, key, body: str) -> DataFrame:
        return table(spark, sf, name).select(
            F.lit(name).alias("origin"), key.cast("string").alias("key"),
            checks.control_position(F.col(body)).alias("any_control"),
            checks.control_position(F.col(body), "\n\t").alias("other_control"),
        )

    return (
        positions("documents", F.col("doc_id"), "text")
        .unionByName(positions("pages", F.col("page_id"), "html"))
        .unionByName(positions(
            "conversations", F.concat_ws("-", "conv_id", "turn"), "text"))
    )


def aware_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Order times as texts with and without a zone."""
    status = F.col("o_orderstatus")
    naive = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    stamp = (
        F.when(status == "P", naive)
        .when((status == "O") & (F.col("o_totalprice") < 100000), F.substring(naive, 1, 10))
        .when(status == "O", F.concat(naive, F.lit("+0000")))
        .otherwise(F.concat(naive, F.lit("Z")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", (~checks.zoneless(stamp)).alias("aware")
    )


def redact(spark: SparkSession, sf: str) -> DataFrame:
    return text.redact(table(spark, sf, "customer"), ["c_custkey", "c_mktsegment"])


def audit_json(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    fields = {
        "level": F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"),
        "name": F.lit("ingest"), "message": F.col("event_type"),
        "exc_info": F.when(F.col("event_type") == "error", F.concat(F.lit("k="), "user_id")),
    }
    return e.select(
        "event_id", text.audit_json(fields, F.col("ts").cast("timestamp")).alias("record")
    )


CELLS = shape(p_partkey=LONG, p_name=STRING, p_brand=INT, p_size=INT, p_retailprice=DOUBLE)


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as strings; the sizes of small ones are not numbers, nor are brands."""
    p = table(spark, sf, "part")
    size = F.when(F.col("p_type") == "SMALL", F.concat("p_size", F.lit("x"))).otherwise(
        F.col("p_size").cast("string"))
    return p.select(
        F.col("p_partkey").cast("string").alias("p_partkey"), "p_name",
        F.when(F.col("p_size") < 10, F.regexp_extract("p_brand", "[0-9]+", 0))
        .otherwise(F.col("p_brand")).alias("p_brand"),
        size.alias("p_size"), F.col("p_retailprice").cast("string").alias("p_retailprice"),
        "p_type",
    )


def cast_cells(spark: SparkSession, sf: str) -> DataFrame:
    return cast_to_schema(_cells(spark, sf), CELLS)


def rejected(spark: SparkSession, sf: str) -> DataFrame:
    return rejected_cells(_cells(spark, sf), CELLS, ["p_type"])


QUERIES = {f.__name__: f for f in (check_rules, control_chars, aware_ts, redact, audit_json)} | {
    "cast_to_schema": cast_cells, "rejected_cells": rejected,
}


def _positions(name: str, key: str, body: str) -> str:
    return f"""
SELECT '{name}' AS origin, {key} AS key,
       CAST(CASE WHEN regexp_matches({body}, '\\p{{C}}')
            THEN length(regexp_extract({body}, '^(\\P{{C}}*)', 1)) ELSE -1 END AS INTEGER)
         AS any_control,
       CAST(CASE WHEN regexp_matches(translate({body}, chr(10) || chr(9), '  '), '\\p{{C}}')
            THEN length(regexp_extract(translate({body}, chr(10) || chr(9), '  '),
                                       '^(\\P{{C}}*)', 1))
            ELSE -1 END AS INTEGER) AS other_control
FROM {name}"""


_CELL_SQL = """
SELECT p_partkey, p_name, p_type,
       TRY_CAST(CASE WHEN p_size < 10 THEN regexp_extract(p_brand, '[0-9]+') ELSE p_brand END
                AS INTEGER) AS p_brand,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_size END AS p_size, p_retailprice
FROM part"""

ORACLE = {
    "check_rules": """
SELECT c_custkey, concat_ws(',', CASE WHEN c_nationkey = 0 THEN 'nation' END,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'name' END,
         CASE WHEN c_acctbal < 0 THEN 'balance' END,
         CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'topic' END,
         CASE WHEN c_nationkey < 10 THEN 'checksum' END) AS violations,
       CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE length(c_name) END AS INTEGER)
         AS n_name
FROM customer""",
    "control_chars": " UNION ALL ".join((
        _positions("documents", "CAST(doc_id AS VARCHAR)", "text"),
        _positions("pages", "CAST(page_id AS VARCHAR)", "html"),
        _positions("conversations", "conv_id || '-' || turn", "text"))),
    "aware_ts": """
SELECT o_orderkey, o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_totalprice >= 100000)
  AS aware
FROM orders""",
    "redact": """
SELECT c_custkey, 'REDACTED' AS c_name, 'REDACTED' AS c_nationkey, 'REDACTED' AS c_acctbal,
       c_mktsegment FROM customer""",
    "audit_json": """
SELECT event_id, '{"level":"' || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END
  || '","name":"ingest","message":"' || event_type
  || CASE WHEN event_type = 'error' THEN '","exc_info":"k=' || user_id ELSE '' END
  || '","asctime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00"}' AS record
FROM events""",
    "cast_to_schema": f"SELECT p_partkey, p_name, p_brand, p_size, p_retailprice "
                      f"FROM ({_CELL_SQL})",
    "rejected_cells": f"""
WITH c AS ({_CELL_SQL}), b AS (
  SELECT p_type, count(*) FILTER (p_brand IS NULL) AS brand,
         count(*) FILTER (p_size IS NULL) AS size FROM c GROUP BY p_type)
SELECT p_type, 'p_partkey' AS "column", CAST(0 AS BIGINT) AS rejected FROM b UNION ALL
SELECT p_type, 'p_name', 0 FROM b UNION ALL
SELECT p_type, 'p_brand', brand FROM b UNION ALL
SELECT p_type, 'p_size', size FROM b UNION ALL
SELECT p_type, 'p_retailprice', 0 FROM b""",
}
