"""Where records come from: a Kafka topic (batch or stream) or files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Every record of a topic from the earliest offset on, then as they arrive.

    Needs the Kafka connector on the class path. Pass ``maxOffsetsPerTrigger`` to bound a
    micro-batch and ``minPartitions`` to read one hot topic partition with several tasks.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def read_topic(
    spark: SparkSession, servers: str, topic: str,
    start: str = "earliest", end: str = "latest", **options: str,
) -> DataFrame:
    """The records of a topic between two offsets, as a batch."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("endingOffsets", end)
        .options(**options)
        .load()
    )


def parquet_replay(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    stream: bool = False, **options: str,
) -> DataFrame:
    """A recorded log from parquet, as a batch or as a file stream; a stream needs the schema.

    Timestamps without zone become instants (session time zone), as watermarks need them.
    """
    reader = spark.readStream if stream else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.options(**options).parquet(path)
    return rows.withColumns({
        field.name: F.col(field.name).cast("timestamp") for field in rows.schema.fields
        if isinstance(field.dataType, T.TimestampNTZType)
    })
