"""The three jobs as streaming queries.

Each function starts one query from streaming rows and writes a batch log under ``root``; the
checkpoint lies beside it. ``options`` go to the trigger: ``availableNow=True`` to catch up and
stop, ``processingTime="10 seconds"`` to keep running.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from soleprint.operators.counters import TOTAL_KEY, running_total
from soleprint.operators.joins import enrich
from soleprint.operators.tables import latest_by_key
from soleprint.operators.windows import HOPPING, TUMBLING, Windows, count_views
from soleprint.session import state_store
from soleprint.streaming.batchlog import (
    BATCH_ID,
    append_batch,
    batch_done,
    log_writer,
    make_dir,
    read_latest,
)

Trigger = dict[str, object]


def _start(
    rows: DataFrame, root: str, name: str, write: Callable[[DataFrame, int], None],
    mode: str, trigger: Trigger,
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/_checkpoints/{name}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def log_path(root: str, name: str) -> str:
    return f"{root}/{name}"


def start_reader(rows: DataFrame, root: str, name: str, **trigger: object) -> StreamingQuery:
    """Write every row as it comes to Parquet files in ``root``/``name``."""
    return (
        rows.writeStream.format("parquet").option("path", log_path(root, name))
        .option("checkpointLocation", f"{root}/_checkpoints/{name}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_console(rows: DataFrame, root: str, shown: int, **trigger: object) -> StreamingQuery:
    """Print the first ``shown`` rows of each micro-batch, to look at a source; use
    ``start_reader`` for all rows."""
    return (
        rows.writeStream.format("console").option("truncate", "false").option("numRows", shown)
        .option("checkpointLocation", f"{root}/_checkpoints/console")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_log(rows: DataFrame, root: str, name: str, mode: str, **trigger: object) -> StreamingQuery:
    """Write each micro-batch's rows of a keyed processor to the batch log ``root``/``name``."""
    with state_store(rows.sparkSession):
        return _start(rows, root, name, log_writer(log_path(root, name)), mode, trigger)


def start_shoe_table(
    shoes: DataFrame, root: str, order: Sequence[str], **trigger: object
) -> StreamingQuery:
    """Keep the latest version of each product in ``order``: reduce the micro-batch, then log it."""
    path = log_path(root, "shoes")
    reduce = log_writer(path, lambda batch: latest_by_key(batch, ["id"], order))
    return _start(shoes, root, "shoes", reduce, "append", trigger)


def current_shoes(
    spark: SparkSession, root: str, schema: T.StructType, missing_ok: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """The product table as the micro-batches finished so far left it.

    With the ``order`` of ``start_shoe_table`` it is the table that a batch over all updates gives,
    also where updates come late; without, a later micro-batch replaces an earlier one. Before the first of them it is an error to ask, as clicks joined with no product are lost;
    ``missing_ok`` gives an empty table instead.
    """
    return read_latest(spark, log_path(root, "shoes"), schema, ["id"], missing_ok, order)


def start_enrichment(
    clicks: DataFrame, shoes: Callable[[SparkSession], DataFrame], root: str, **trigger: object
) -> StreamingQuery:
    """Join each micro-batch of clicks with the product table as it is at that moment."""
    write = log_writer(
        log_path(root, "enriched"), lambda batch: enrich(batch, shoes(batch.sparkSession)))
    return _start(clicks, root, "enriched", write, "append", trigger)


def enriched_stream(spark: SparkSession, root: str, schema: T.StructType, **options: str) -> DataFrame:
    """The enriched clicks as a stream of the batches that ``start_enrichment`` publishes."""
    path = make_dir(spark, log_path(root, "enriched"))
    return spark.readStream.schema(schema).options(**options).parquet(f"{path}/{BATCH_ID}=*")


def start_view_counts(
    rows: DataFrame, key: str, windows: Windows, root: str, name: str, **trigger: object
) -> StreamingQuery:
    """Log every change of a count per key and window, one row per micro-batch at most."""
    counts = count_views(rows, key, windows)
    return _start(counts, root, name, log_writer(log_path(root, name)), "update", trigger)


def start_product_views(enriched: DataFrame, root: str, **trigger: object) -> StreamingQuery:
    """Views per product name in tumbling windows."""
    return start_view_counts(enriched, "product_name", TUMBLING, root, "product_views", **trigger)


def start_retained_views(clicks: DataFrame, root: str, **trigger: object) -> StreamingQuery:
    """Views per product id in hopping windows."""
    return start_view_counts(clicks, "product_id", HOPPING, root, "retained_views", **trigger)


def views_schema(key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("views", T.LongType()),
    ])


def current_views(spark: SparkSession, root: str, name: str, key: str) -> DataFrame:
    """The last count of every key and window."""
    return read_latest(
        spark, log_path(root, name), views_schema(key), [key, "window_start", "window_end"])


def start_click_counter(
    clicks: DataFrame, root: str, by: Sequence[str] = ("partition",),
    order: Sequence[str] = ("ts", "offset"), **trigger: object,
) -> StreamingQuery:
    """Number the clicks one by one, in ``order`` within each micro-batch.

    A micro-batch is numbered by the distributed scan and moved up by the totals before it. Each
    micro-batch writes the totals so far, one row per value of ``by``, and reads those of the one
    before it and no others.
    """
    by = list(by)
    totals_schema = T.StructType(
        [clicks.schema[name] for name in by]
        + [T.StructField("key", T.StringType()), T.StructField("before", T.LongType())])
    counter, totals = log_path(root, "counter"), log_path(root, "counter_totals")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = spark.createDataFrame([], totals_schema) if batch_id == 0 else (
            spark.read.schema(totals_schema).parquet(f"{totals}/{BATCH_ID}={batch_id - 1}"))
        batch = batch.select(*dict.fromkeys([*by, *order])).persist()
        try:
            if not batch_done(spark, counter, batch_id):
                numbered = running_total(batch, by, order).join(earlier, ["key", *by], "left")
                total = (F.col("total") + F.coalesce("before", F.lit(0))).alias("total")
                append_batch(
                    numbered.select("key", *dict.fromkeys([*by, *order]), total),
                    counter, batch_id)
            counted = batch.groupBy(*by).agg(F.count(F.lit(1)).alias("before")).withColumn(
                "key", F.lit(TOTAL_KEY))
            summed = counted.unionByName(earlier).groupBy("key", *by).agg(
                F.sum("before").alias("before"))
            append_batch(summed.where(F.col("before") > 0), totals, batch_id)
        finally:
            batch.unpersist()

    return _start(clicks, root, "counter", write, "append", trigger)
