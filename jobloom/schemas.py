"""Declared shapes of records and tables."""

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampType, VariantType,
)

BINARY, BOOLEAN, DOUBLE, FLOAT, INT, LONG, STRING, TIMESTAMP, VARIANT = (
    BinaryType(), BooleanType(), DoubleType(), FloatType(), IntegerType(), LongType(),
    StringType(), TimestampType(), VariantType(),
)


def shape(nullable: bool = True, **fields: DataType) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t in fields.items()])


# One record of an event topic, as the Kafka source yields it.
RECORD = shape(
    key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG,
    timestamp=TIMESTAMP, timestampType=INT,
)

OUTPUTS = ArrayType(shape(file=STRING, crc64nvme=STRING))

# Field names of a job document. Its outputs come in parts of bounded size: a job with few files has the
# one part 0, a job with many has several rows that repeat the other fields.
JOB = shape(
    id=STRING, user=STRING, state=STRING,
    image=shape(registered_by=STRING, registered_on=TIMESTAMP, name=STRING, digest=STRING,
                entrypoint=ArrayType(STRING), tag=STRING),
    job_input=shape(cluster=STRING, image=STRING, params=shape(args=ArrayType(STRING)),
                    output_dir=STRING, input_files=OUTPUTS),
    input_file_count=INT,
    transition_times=ArrayType(shape(state=STRING, time=STRING, trans_id=STRING,
                                     notif_sent=BOOLEAN)),
    output_file_count=LONG, outputs_part=INT, outputs=OUTPUTS,
)

REGISTRY = shape(image=STRING, module=STRING, source_file=STRING, meta=VARIANT)

DLQ = shape(
    value=BINARY, job_id=STRING, route=STRING, error_dlq=STRING, error_dlq_trace=STRING,
    src_topic=STRING, src_partition=INT, src_offset=LONG, batch_id=LONG,
)

# One change of a job's import status, made in batch `since`; the current status is a fold
# over these.
STATUS_CHANGE = shape(job_id=STRING, key=STRING, value=STRING, since=LONG, seq=LONG,
                      step=STRING, batch_id=LONG)

# A folded status: the last change of each key.
FOLDED = shape(job_id=STRING, key=STRING, value=STRING, since=LONG, seq=LONG)

# A job of a batch that could not be imported.
FAILURE = shape(id=STRING, error=STRING, trace=STRING)

EMPLOYEES = shape(nullable=False, employee_id=INT, employee_name=STRING)

# Column names and types of the quality table.
QUALITY = shape(
    Name=STRING, cts_job_id=STRING, Completeness=FLOAT, Contamination=FLOAT,
    Completeness_Model_Used=STRING, Translation_Table_Used=INT, Coding_Density=FLOAT,
    Contig_N50=INT, Average_Gene_Length=FLOAT, Genome_Size=INT, GC_Content=FLOAT,
    Total_Coding_Sequences=INT, Total_Contigs=INT, Max_Contig_Length=INT,
    Additional_Notes=STRING,
)
