"""Dead letters: what is kept of an event that could not be imported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions import jsonobj
from jobloom.operators import route as r
from jobloom.schemas import DLQ

# Fields added to a dead letter, and error texts.
ERROR = "error_dlq"
TRACE = "error_dlq_trace"
MISSING_KEYS_TEXT = "Message has missing required keys:\n"
NO_JOB_TEXT = "No such job"
BAD_JOB_TEXT = "No complete event found for job "


def error_text() -> Column:
    """Why a routed event is rejected."""
    return (
        F.when(F.col("route") == r.MISSING_KEYS,
               F.concat(F.lit(MISSING_KEYS_TEXT), F.to_json(F.col("event"))))
        .when(F.col("route") == r.NO_JOB, NO_JOB_TEXT)
        .when(F.col("route") == r.BAD_JOB,
              F.concat(F.lit(BAD_JOB_TEXT), F.col("job_id")))
    )


def payload(event: Column, raw: Column, error: Column, trace: Column) -> Column:
    """Bytes of a dead letter: the object with its error, or the raw bytes unchanged."""
    enriched = jsonobj.with_strings(event, {ERROR: error, TRACE: trace})
    return F.when(event.isNull(), raw).otherwise(enriched.cast("binary"))


def dead_letters(rejected: DataFrame, batch_id: int | None) -> DataFrame:
    """Dead letters from routed events. Columns `error` and `trace` are used if present."""
    none = F.lit(None).cast("string")
    error = F.coalesce(F.col("error"), error_text()) if "error" in rejected.columns \
        else error_text()
    trace = F.col("trace") if "trace" in rejected.columns else none
    return (
        rejected.withColumns({ERROR: error, TRACE: trace})
        .select(
            payload(F.col("event"), F.col("value"), F.col(ERROR), F.col(TRACE)).alias("value"),
            "job_id", "route", ERROR, TRACE,
            F.col("topic").alias("src_topic"), F.col("partition").alias("src_partition"),
            F.col("offset").alias("src_offset"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch; a replay of the batch replaces what it wrote before, even by nothing."""
    few_files = df.drop("batch_id").hint("rebalance")
    few_files.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def publish_dead_letters(letters: DataFrame, servers: str, topic: str) -> None:
    (letters.select("value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
     .option("kafka.enable.idempotence", "true").option("topic", topic).save())


def read_dead_letters(spark, path: str) -> DataFrame:
    return spark.read.schema(DLQ).parquet(path)


def as_events(letters: DataFrame) -> DataFrame:
    """Dead letters as event records again, without the error fields."""
    clean = F.to_json(jsonobj.without_keys(F.col("_obj"), [ERROR, TRACE])).cast("binary")
    return jsonobj.with_object(letters, F.col("value"), "_obj").select(
        F.lit(None).cast("binary").alias("key"),
        F.when(F.col("_obj").isNull(), F.col("value")).otherwise(clean).alias("value"),
        F.col("src_topic").alias("topic"), F.col("src_partition").alias("partition"),
        F.col("src_offset").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
