"""The wire form of every output topic, and the Kafka writers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from soleprint.functions.encoding import (
    encode_long,
    json_envelope,
    window_key,
    windowed_key_bytes,
)
from soleprint.schemas import ENRICHED_CLICK


def enriched_records(enriched: DataFrame, schema_id: int) -> DataFrame:
    """Enriched clicks as JSON messages keyed by product id, at the click's record time."""
    payload = F.struct(*[
        F.col("payload_ts" if name == "ts" else name).alias(name) for name in ENRICHED_CLICK.names
    ])
    return enriched.select(
        F.col("product_id").cast("binary").alias("key"),
        json_envelope(payload, schema_id).alias("value"), F.col("ts").alias("timestamp"),
    )


def view_records(views: DataFrame, key: str = "product_name") -> DataFrame:
    """Counts keyed by ``[name@start/end]``; on a compacted topic the last count stays."""
    text = window_key(F.col(key), F.col("window_start"), F.col("window_end"))
    return views.select(text.cast("binary").alias("key"), encode_long(F.col("views")).alias("value"))


def counter_records(totals: DataFrame) -> DataFrame:
    """Running totals under their key, at the time of the click counted."""
    return totals.select(
        F.col("key").cast("binary").alias("key"), encode_long(F.col("total")).alias("value"),
        F.col("ts").alias("timestamp"),
    )


def retained_records(views: DataFrame, key: str = "product_id") -> DataFrame:
    """Counts keyed by the binary windowed key."""
    return views.select(
        windowed_key_bytes(F.col(key), F.col("window_start")).alias("key"),
        encode_long(F.col("views")).alias("value"),
    )


def write_topic(records: DataFrame, servers: str, topic: str) -> None:
    """Append a batch of records to a topic. Needs the Kafka connector."""
    (
        records.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def stream_to_topic(
    records: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Write a stream of records to a topic, at least once. Needs the Kafka connector."""
    return (
        records.select("key", "value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .start()
    )
