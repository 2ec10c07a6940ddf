"""Intermediate results that survive lost executors, and unions."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from soleprint.session import shared_dir


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder: for small rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Whether Spark deletes a query's shuffle files once the query has ended.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For writing a table: what was shuffled for it goes as soon as the table is there, as only the
    table is read from then on. The session's own setting comes back afterwards."""
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


# How much Spark puts together of what it reads (rows) and of what it sends to Python (bytes), and
# the files that a task may have open instead of sorting its rows by file.
BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": "256",
           "spark.sql.execution.arrow.maxBytesPerBatch": "2m",
           "spark.sql.maxConcurrentOutputFileWriters": "16"}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """For jobs run here on long texts: with so few in a batch its buffers stay small. The session's
    own settings come back afterwards."""
    before = {name: spark.conf.get(name) for name in BATCHES}
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def written(df: DataFrame, name: str, compression: str | None = None, **options) -> DataFrame:
    """``df`` computed once and kept as compressed Parquet in the shared checkpoint folder."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str, **options) -> DataFrame:
    """Like :func:`written`, as small as can be, and without leaving the shuffles behind it."""
    with shuffles_dropped(df.sparkSession):
        return written(df, name, "zstd", **options)


def has_maps(schema: StructType) -> bool:
    return any("map<" in field.dataType.simpleString() for field in schema)


def comparable(row: str, schema: StructType) -> Column:
    """The struct column ``row`` in a form that has an order: columns with maps as JSON text."""
    if not has_maps(schema):
        return F.col(row)
    own = [(F.col(row)[field.name], "map<" in field.dataType.simpleString()) for field in schema]
    return F.struct(*[(F.to_json(F.struct(value)) if maps else value).alias(f"c{i}")
                      for i, (value, maps) in enumerate(own)])


def least(row: str, schema: StructType) -> Column:
    """The smallest ``row`` of a group."""
    return F.min_by(row, comparable(row, schema)) if has_maps(schema) else F.min(row)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
