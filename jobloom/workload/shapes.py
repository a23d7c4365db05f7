"""Events, job documents and registries derived from the test tables.

Every row of `events` becomes one message; the number in its `props` picks the shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.operators.jobs import output_counts
from jobloom.sources.registry import registry

TOPIC = "jobs"

# Shape of a message by the number in `props`; any other number gives the plain shape.
# {id} and {state} stand for the event's id and state, {user} for its user.
SHAPES = {
    0: '{"job_id":"{id}","sta',
    1: '{"job_id":"{id}"}',
    2: '{"job_id":"{id}","status":"{state}"}',
    3: '{"special_event_type":"integration_test","input_data":[[{user},"user_{user}"]]}',
    4: '[1]',
    5: '{"job_id":"{id}","state":"{state}"} x',
    6: '{"job_id":"{id}","state":"{state}"}]',
    7: '{"job_id":"other","job_id":"{id}","state":"{state}"}',
    8: ' \n{"job_id":"{id}","state":"{state}"}\n ',
    9: '{"job_id":"{id}","state":null}',
    10: '{"job_id":null,"state":"complete"}',
    12: '{"job_id":"{id}","state":["complete"]}',
    13: "{'job_id':'{id}','state':'{state}'}",
    14: '{"special_event_type":"integration_test","mode":"insert",'
        '"input_data":[[{user},"user {user} of {id}"],[{id},"event {id}"]]}',
    16: '{"job_id":"{id}","state":"{state}","extra":{"n":1.5,"u":null}}',
    17: '{"job_id":"{id}","state":"{state}"},{"job_id":"{id}","state":"{state}"}',
}
INVALID_UTF8, NULL_VALUE = 11, 15
PLAIN = '{"job_id":"{id}","state":"{state}"}'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, body: Column | None = None) -> DataFrame:
    """One event record per row of `events`, with another value if `body` is given. A purchase is
    a completed job."""
    ev = table(spark, sf_dir, "events")
    ev = ev.withColumn("shape", F.get_json_object("props", "$.k").cast("int"))
    shape = F.col("shape")
    shapes = F.create_map(*[F.lit(x) for item in SHAPES.items() for x in item])
    state = F.when(F.col("event_type") == "purchase", "complete").otherwise(F.col("event_type"))
    text = F.coalesce(F.try_element_at(shapes, shape), F.lit(PLAIN))
    for name, value in {"{id}": F.col("event_id").cast("string"), "{state}": state,
                        "{user}": F.col("user_id").cast("string")}.items():
        text = F.replace(text, F.lit(name), value)
    value = (
        F.when(shape == INVALID_UTF8, F.unhex(F.lit("ff7b")))
        .when(shape == NULL_VALUE, F.lit(None).cast("binary"))
        .otherwise(text.cast("binary"))
    )
    return ev.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        (value if body is None else body).alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_id() -> Column:
    """The event a record was made from."""
    return (F.col("offset") * 3 + F.col("partition")).alias("event_id")


def job_id(order: str) -> Column:
    """The job of an order. Some have ids that no event asks for, so that events miss."""
    key = F.col(order).cast("string")
    return F.when(F.col(order) % 40 == 7, F.concat(F.lit("x"), key)).otherwise(key)


def job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output file per line item. The checksum is made up, of the right length."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        job_id("l_orderkey").alias("id"),
        F.concat(F.lit("bucket/"), F.col("l_orderkey"), F.lit("/"), F.col("l_linenumber"),
                 F.lit("-"), F.col("l_partkey"), F.lit(".tsv")).alias("file"),
        F.lpad(F.concat("l_orderkey", "l_linenumber"), 12, "a").alias("crc64nvme"),
    )


def job_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per order, without its outputs.

    An open job (O) completed twice; a cheap one never completed.
    """
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")

    def step(state: str, days: int, n: int):
        time = F.concat(F.date_format(F.date_add(day, days), "yyyy-MM-dd"),
                        F.lit("T00:00:00+00:00"))
        return F.struct(F.lit(state).alias("state"), time.alias("time"),
                        F.concat(F.lit("t"), F.col("o_orderkey"), F.lit(f"-{n}"))
                        .alias("trans_id"), F.lit(True).alias("notif_sent"))

    created, done, again = step("created", 0, 0), step("complete", 1, 1), step("complete", 2, 2)
    transitions = (
        F.when(F.col("o_totalprice") < 10000, F.array(created))
        .when(F.col("o_orderstatus") == "O", F.array(created, done, again))
        .otherwise(F.array(created, done))
    )
    name = F.concat(F.lit("img/"), F.col("o_orderpriority"))
    digest = F.concat(F.lit("sha256:"), F.col("o_orderkey"))
    user = F.concat(F.lit("cust_"), F.col("o_custkey"))
    return o.select(
        job_id("o_orderkey").alias("id"),
        user.alias("user"),
        F.lit("complete").alias("state"),
        F.struct(user.alias("registered_by"),
                 F.col("o_orderdate").cast("timestamp").alias("registered_on"),
                 name.alias("name"), digest.alias("digest"),
                 F.array(F.lit("run")).alias("entrypoint"), F.lit("v1").alias("tag")
                 ).alias("image"),
        F.struct(F.lit("cluster").alias("cluster"),
                 F.concat_ws("@", name, digest).alias("image"),
                 F.struct(F.array(F.lit("a"), F.lit("b")).alias("args")).alias("params"),
                 F.concat(F.lit("bucket/"), F.col("o_orderkey")).alias("output_dir"),
                 F.array(F.struct(F.lit("bucket/input").alias("file"),
                                  F.lit("aaaaaaaaaaaa").alias("crc64nvme"))
                         ).alias("input_files")).alias("job_input"),
        F.lit(1).alias("input_file_count"),
        transitions.alias("transition_times"),
    )


def image_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All images but that of low priority have an importer."""
    images = (
        table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'")
        .select("o_orderpriority").distinct()
    )
    p = F.col("o_orderpriority")
    meta = F.when(p == "1-URGENT", F.lit('{"fast":true}'))
    return registry(
        images, F.concat(F.lit("img/"), p), F.concat(F.lit("import_"), F.substring(p, 1, 1)),
        F.concat(p, F.lit(".yaml")), meta,
    )


def headers_with_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job headers with the number of their output files."""
    return job_headers(spark, sf_dir).join(
        output_counts(job_files(spark, sf_dir)), "id", "left"
    ).fillna({"output_file_count": 0})
