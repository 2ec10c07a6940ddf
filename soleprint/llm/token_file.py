"""Token ids in ORC files: sorted by document id, with row indexes and Bloom filters on the id.

ORC writes integers in run-length encoded stripes. Readers take stripes in parallel, and skip
stripes and row groups whose indexes or Bloom filters rule a document out.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soleprint.llm.encode import encoded
from soleprint.llm.tables import saved

STRIPE_BYTES = 64 << 20
ROWS_PER_INDEX = 1000


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    end_id: int = 0,
) -> None:
    """Write ``part``, ``seq``, ``doc_id`` and ``ids`` of each row to ORC files in ``path``.

    Rows are in ascending order of ``doc_id``, null first, those with the same id in order of
    their texts: ``part`` numbers the files, ``seq`` the rows of a file. A null text counts as an
    empty one, and ``end_id`` ends each list of ids. Repeated rows all stay.

    The texts are dealt out before they are encoded, so what is sorted is the smaller form. The
    many rows that one id may have are dealt out by the hash of their text as well.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    order = [F.asc_nulls_first("doc_id"), F.asc("mark")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select(
        F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
        rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    end = np.array([end_id], np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for others, ids in encoded(batches, tokenizer):
            offsets = np.cumsum([0, *(len(one) // 4 + 1 for one in ids)], dtype=np.int32)
            values = np.frombuffer(b"".join([one + end for one in ids]), np.int32)
            yield pa.RecordBatch.from_arrays(
                [others.column("part"), pa.array(np.arange(seq, seq + len(ids))),
                 others.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(values))],
                schema.names)
            seq += len(ids)

    (
        rows.mapInArrow(run, schema).write
        .option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
        .option("compression", "zstd").orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`write_tokens`; conditions on ``doc_id`` reach the files' indexes."""
    return spark.read.orc(path)


def token_index(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of each row that was read back.

    ``start`` is the number of ids in all rows before it, ``ids_crc32`` the CRC-32 of its ids as
    little-endian unsigned 32-bit integers. Only one number per file goes through one task.
    """
    schema = T.StructType([tokens.schema["part"], tokens.schema["seq"], tokens.schema["doc_id"],
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends = np.asarray(ids.offsets)
            data = np.asarray(ids.values).astype("<u4", copy=False)
            crcs = [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("seq"), batch.column("doc_id"),
                 pa.array(np.diff(ends).astype(np.int64)), pa.array(crcs, pa.int64())],
                schema.names)

    rows = saved(tokens.select("part", "seq", "doc_id", "ids").mapInArrow(run, schema))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)) + F.col("file_start")
    return rows.join(files, "part").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
