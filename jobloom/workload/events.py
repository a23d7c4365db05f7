"""Queries over events: decoding, routing, dead letters, topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.functions import jsonobj
from jobloom.operators import dlq, route as r
from jobloom.operators.decode import decode
from jobloom.session import shared_dir
from jobloom.sources import events as ev
from jobloom.workload.shapes import TOPIC, event_id, records, table

BATCH = 7


def routed(spark: SparkSession, sf: str) -> DataFrame:
    return r.route(decode(records(spark, sf)))


def _topic(spark: SparkSession, df: DataFrame, name: str = TOPIC) -> ev.Topic:
    """A file topic that holds these records."""
    topic = ev.Topic("file", shared_dir(spark, "topic"), name)
    ev.publish(df, topic)
    return topic


def src_events(spark: SparkSession, sf: str) -> DataFrame:
    """Copy a topic through a stream and read the copy."""
    topic = _topic(spark, records(spark, sf))
    copy, checkpoint = shared_dir(spark, "copy"), shared_dir(spark, "checkpoint")
    query = (
        ev.stream_events(spark, topic).writeStream.format("parquet")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(copy)
    )
    query.awaitTermination()
    return ev.read_events(spark, ev.Topic("file", copy, TOPIC)).select(
        event_id(), "partition", "offset", F.col("key").cast("string").alias("key"),
        F.unix_micros("timestamp").alias("ts_micros"), F.octet_length("value").alias("n_bytes"),
    )


def publish_event(spark: SparkSession, sf: str) -> DataFrame:
    """Publish events as JSON and read their fields back."""
    body = F.struct(F.col("event_id").cast("string").alias("job_id"),
                    F.col("event_type").alias("state"), "value")
    out = records(spark, sf, ev.to_record(body))
    topic = _topic(spark, out)
    return decode(ev.read_events(spark, topic)).select(
        F.col("job_id").cast("bigint").alias("event_id"), "state",
        jsonobj.field(F.col("event"), "value", "double").alias("value"),
    )


def decode_strict(spark: SparkSession, sf: str) -> DataFrame:
    return decode(records(spark, sf)).select(
        event_id(), F.col("event").isNotNull().alias("valid"), "job_id", "state"
    )


def required_keys(spark: SparkSession, sf: str) -> DataFrame:
    return decode(records(spark, sf)).filter("event is not null").select(
        event_id(), F.array_join("missing_keys", ",").alias("missing")
    )


def route_events(spark: SparkSession, sf: str) -> DataFrame:
    return routed(spark, sf).select(event_id(), "route")


def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    return r.route_counts(routed(spark, sf))


def _letters(spark: SparkSession, sf: str, batch_id: int = BATCH) -> DataFrame:
    rejects = routed(spark, sf).filter(F.col("route").isin(r.MALFORMED, r.MISSING_KEYS))
    return dlq.dead_letters(rejects, batch_id)


def _source_id():
    return (F.col("src_offset") * 3 + F.col("src_partition")).alias("event_id")


def dlq_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters, their payload read back."""
    parsed = jsonobj.with_object(_letters(spark, sf), F.col("value"), "obj")
    obj = F.col("obj")
    return parsed.select(
        _source_id(), "route",
        jsonobj.field(obj, "job_id").alias("job_id"),
        jsonobj.field(obj, "status").alias("status"),
        jsonobj.field(obj, dlq.ERROR).alias("error"),
        F.when(obj.isNull(), F.hex("value")).alias("raw"),
    )


def dlq_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Write a batch of dead letters twice, as a replay does, and read them."""
    path = shared_dir(spark, "dlq")
    for _ in range(2):
        dlq.write_batch(_letters(spark, sf), path, BATCH)
    return dlq.read_dead_letters(spark, path).select(
        _source_id(), "route", "job_id", "src_topic", "src_partition", "src_offset", "batch_id"
    )


def dlq_dump(spark: SparkSession, sf: str) -> DataFrame:
    """Everything a dead-letter topic holds, with sizes."""
    letters = _letters(spark, sf)
    out = letters.select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit("jobs-dlq").alias("topic"),
        F.col("src_partition").alias("partition"), F.col("src_offset").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    topic = _topic(spark, out, "jobs-dlq")
    return ev.dump(ev.read_events(spark, topic)).select(
        event_id(), "topic", "partition", "offset", "serialized_key_size",
        "serialized_value_size",
    )


def dlq_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Run dead letters through decoding and routing again."""
    path = shared_dir(spark, "dlq")
    dlq.write_batch(_letters(spark, sf), path, BATCH)
    again = r.route(decode(dlq.as_events(dlq.read_dead_letters(spark, path))))
    return again.select(
        event_id(), "route", "job_id",
        F.array_join(F.array_sort(jsonobj.keys(F.col("event"))), ",").alias("fields"),
    )


QUERIES = {f.__name__: f for f in (
    src_events, publish_event, decode_strict, required_keys, route_events, route_counts,
    dlq_payload, dlq_sink, dlq_dump, dlq_replay,
)}

# What the shapes of workload/shapes.py mean, stated on the typed columns.
MESSAGES = """
WITH m AS (
  SELECT event_id, user_id, ts, event_type, value,
         CAST(event_id % 3 AS INTEGER) AS part, event_id // 3 AS off,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         CASE WHEN event_type = 'purchase' THEN 'complete' ELSE event_type END AS st,
         CAST(event_id AS VARCHAR) AS id
  FROM events
), r AS (
  SELECT *, CASE
           WHEN k IN (0, 4, 5, 6, 11, 13, 15, 17) THEN 'dlq_malformed'
           WHEN k IN (3, 14) THEN 'control'
           WHEN k IN (1, 2) THEN 'dlq_missing_keys'
           WHEN k = 10 THEN 'importable'
           WHEN k IN (9, 12) THEN 'discard'
           WHEN st = 'complete' THEN 'importable'
           ELSE 'discard' END AS route,
         CASE WHEN k IN (0, 3, 4, 5, 6, 10, 11, 13, 14, 15, 17) THEN NULL ELSE id END AS job_id,
         CASE k
           WHEN 0 THEN '{"job_id":"' || id || '","sta'
           WHEN 1 THEN '{"job_id":"' || id || '"}'
           WHEN 2 THEN '{"job_id":"' || id || '","status":"' || st || '"}'
           WHEN 3 THEN '{"special_event_type":"integration_test","input_data":[[' || user_id
                       || ',"user_' || user_id || '"]]}'
           WHEN 4 THEN '[1]'
           WHEN 5 THEN '{"job_id":"' || id || '","state":"' || st || '"} x'
           WHEN 6 THEN '{"job_id":"' || id || '","state":"' || st || '"}]'
           WHEN 7 THEN '{"job_id":"other","job_id":"' || id || '","state":"' || st || '"}'
           WHEN 8 THEN ' ' || chr(10) || '{"job_id":"' || id || '","state":"' || st || '"}'
                       || chr(10) || ' '
           WHEN 9 THEN '{"job_id":"' || id || '","state":null}'
           WHEN 10 THEN '{"job_id":null,"state":"complete"}'
           WHEN 12 THEN '{"job_id":"' || id || '","state":["complete"]}'
           WHEN 13 THEN '{''job_id'':''' || id || ''',''state'':''' || st || '''}'
           WHEN 14 THEN '{"special_event_type":"integration_test","mode":"insert",'
                        || '"input_data":[[' || user_id || ',"user ' || user_id || ' of ' || id
                        || '"],[' || id || ',"event ' || id || '"]]}'
           WHEN 15 THEN NULL
           WHEN 16 THEN '{"job_id":"' || id || '","state":"' || st
                        || '","extra":{"n":1.5,"u":null}}'
           WHEN 17 THEN '{"job_id":"' || id || '","state":"' || st || '"},{"job_id":"' || id
                        || '","state":"' || st || '"}'
           ELSE '{"job_id":"' || id || '","state":"' || st || '"}' END AS body
  FROM m
)
"""

_BYTES = "CASE WHEN k = 11 THEN 2 ELSE CAST(strlen(body) AS INTEGER) END"
_REJECTS = "FROM r WHERE route IN ('dlq_malformed', 'dlq_missing_keys')"
# Length of the added error text as JSON: each quote of the message takes a backslash.
_LETTER_BYTES = """
CASE WHEN k = 11 THEN 2 WHEN k = 15 THEN -1
     WHEN route = 'dlq_malformed' THEN strlen(body)
     ELSE strlen(body) - 1 + strlen(',"error_dlq":"Message has missing required keys:\\n')
          + strlen(replace(body, '"', '\\"')) + strlen('"}') END
"""

ORACLE = {
    "src_events": MESSAGES + f"""
SELECT event_id, part AS partition, off AS "offset", CAST(user_id AS VARCHAR) AS key,
       epoch_us(ts) AS ts_micros, {_BYTES} AS n_bytes FROM r""",
    "publish_event": "SELECT event_id, event_type AS state, value FROM events",
    "decode_strict": MESSAGES + """
SELECT event_id, route <> 'dlq_malformed' AS valid, job_id,
       CASE WHEN route IN ('dlq_malformed', 'dlq_missing_keys', 'control') OR k = 9 THEN NULL
            WHEN k = 12 THEN '["complete"]' WHEN k = 10 THEN 'complete' ELSE st END AS state
FROM r""",
    "required_keys": MESSAGES + """
SELECT event_id, CASE WHEN route = 'control' THEN 'job_id,state'
                      WHEN route = 'dlq_missing_keys' THEN 'state' ELSE '' END AS missing
FROM r WHERE route <> 'dlq_malformed'""",
    "route_events": MESSAGES + "SELECT event_id, route FROM r",
    "route_counts": MESSAGES + "SELECT route, count(*) AS n FROM r GROUP BY route",
    "dlq_payload": MESSAGES + f"""
SELECT event_id, route, CASE WHEN route = 'dlq_missing_keys' THEN id END AS job_id,
       CASE WHEN k = 2 THEN st END AS status,
       CASE WHEN route = 'dlq_missing_keys'
            THEN 'Message has missing required keys:' || chr(10) || body END AS error,
       CASE WHEN route = 'dlq_missing_keys' THEN NULL WHEN k = 11 THEN 'FF7B'
            ELSE hex(body) END AS raw
{_REJECTS}""",
    "dlq_sink": MESSAGES + f"""
SELECT event_id, route, job_id, 'jobs' AS src_topic, part AS src_partition,
       off AS src_offset, CAST({BATCH} AS BIGINT) AS batch_id
{_REJECTS}""",
    "dlq_dump": MESSAGES + f"""
SELECT event_id, 'jobs-dlq' AS topic, part AS partition, off AS "offset",
       -1 AS serialized_key_size, CAST({_LETTER_BYTES} AS INTEGER) AS serialized_value_size
{_REJECTS}""",
    "dlq_replay": MESSAGES + f"""
SELECT event_id, route, job_id,
       CASE k WHEN 1 THEN 'job_id' WHEN 2 THEN 'job_id,status' END AS fields
{_REJECTS}""",
}
