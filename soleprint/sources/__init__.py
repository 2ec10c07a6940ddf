"""Sources: log topics, file replay, and decoding of records into fixed schemas."""

from soleprint.sources.records import decode_records, good_records, quarantined, violations
from soleprint.sources.topics import parquet_replay, read_topic, stream_topic

__all__ = [
    "decode_records", "good_records", "parquet_replay", "quarantined", "read_topic",
    "stream_topic", "violations",
]
