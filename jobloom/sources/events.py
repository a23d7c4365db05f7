"""Event topics: Kafka, or a folder of records with the same shape."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.schemas import RECORD


@dataclass(frozen=True)
class Topic:
    """Where the records of a topic are.

    kind "kafka": `location` is the list of bootstrap servers, separated by commas.
    kind "file": `location` is a folder of parquet files in the record schema.
    `min_partitions` reads a topic of few partitions with more tasks than it has.
    """

    kind: str
    location: str
    name: str
    max_records_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    min_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in ("kafka", "file"):
            raise ValueError(f"unknown topic kind: {self.kind}")


def _kafka_options(topic: Topic) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": topic.location,
        "subscribe": topic.name,
        "startingOffsets": "earliest",
    }
    if topic.min_partitions:
        options["minPartitions"] = str(topic.min_partitions)
    return options | topic.options


def stream_events(spark: SparkSession, topic: Topic) -> DataFrame:
    """All records of a topic as a stream, from the earliest on the first run.

    Progress is kept in the checkpoint of the query that reads this.
    """
    if topic.kind == "kafka":
        reader = spark.readStream.format("kafka").options(**_kafka_options(topic))
        if topic.max_records_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", topic.max_records_per_trigger)
        df = reader.load()
    else:
        reader = spark.readStream.schema(RECORD).format("parquet").options(**topic.options)
        if topic.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", topic.max_files_per_trigger)
        df = reader.load(topic.location)
    return df.select(*RECORD.names)


def read_events(spark: SparkSession, topic: Topic) -> DataFrame:
    """All records a topic holds now."""
    if topic.kind == "kafka":
        options = _kafka_options(topic) | {"endingOffsets": "latest"}
        df = spark.read.format("kafka").options(**options).load()
    else:
        df = spark.read.schema(RECORD).parquet(topic.location)
    return df.select(*RECORD.names)


def dump(records: DataFrame) -> DataFrame:
    """Records with the sizes of key and value, -1 where there is none."""
    def size(name: str) -> Column:
        return F.coalesce(F.octet_length(name), F.lit(-1)).alias(f"serialized_{name}_size")

    return records.select("*", size("key"), size("value"))


def to_record(event: Column) -> Column:
    """An event struct as the UTF-8 JSON bytes of a record."""
    return F.to_json(event).cast("binary").alias("value")


def publish(df: DataFrame, topic: Topic) -> None:
    """Append records to a topic."""
    if topic.kind == "kafka":
        (df.select("value").write.format("kafka")
           .option("kafka.bootstrap.servers", topic.location)
           .option("kafka.enable.idempotence", "true").option("kafka.acks", "all")
           .option("topic", topic.name).options(**topic.options).save())
    else:
        df.select(*RECORD.names).write.mode("append").parquet(topic.location)
