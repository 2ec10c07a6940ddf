"""Joins of clicks with the product table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soleprint.operators.scan import SLICE_ROWS, Running, prefix_scan
from soleprint.session import shared_dir

# Rows of one key that may meet in one task of a shuffled join.
HOT_KEY_ROWS = 1_000_000
# Hot keys are looked for by a summary of so many keys, and so many of them are listed at most.
TRACKED_KEYS, LISTED_KEYS = 100_000, 1_000

_SPLITS, _SALT = "_splits", "_salt"


def broadcastable(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate keeps ``df`` within the session's broadcast threshold.

    The estimate starts from file sizes and does not shrink by filters or aggregates, so it is
    an upper bound for the tables joined here.
    """
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) <= limit


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, table_key: str,
    hot_key_rows: int = HOT_KEY_ROWS, salted: bool | None = None,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join of rows with a table that has one row per key; null keys never match.

    A small table is broadcast by Catalyst. A larger one is joined by shuffle, and the keys
    that hold more than ``hot_key_rows`` rows (see ``hot_keys``) are spread: their rows over several
    salts, by a hash of the columns ``salt_by`` (all, if not given), and their one table row copied
    to each. A stream has no counts to go by and takes the plain join; ``foreachBatch`` gives it
    this form per micro-batch.
    """
    rows = rows.where(F.col(key).isNotNull())
    if salted is None:
        salted = not rows.isStreaming and not broadcastable(table)
    if not salted:
        return rows.join(table, F.col(key) == F.col(table_key), "inner")

    hot = F.broadcast(hot_keys(rows, key, hot_key_rows))
    splits = F.coalesce(F.col(_SPLITS), F.lit(1))
    spread = (
        rows.join(hot, F.col(key) == F.col("_hot"), "left")
        # A hash of the row, not a random number: a task run again must choose the same salt.
        .withColumn(_SALT, F.pmod(F.xxhash64(*(salt_by or rows.columns)), splits).cast("int"))
        .drop("_hot", _SPLITS)
    )
    copies = (
        table.join(hot, F.col(table_key) == F.col("_hot"), "left")
        .withColumn("_table_salt", F.explode(F.sequence(F.lit(0), splits - 1)))
        .drop("_hot", _SPLITS)
    )
    matched = (F.col(key) == F.col(table_key)) & (F.col(_SALT) == F.col("_table_salt"))
    return spread.join(copies.hint("merge"), matched, "inner").drop(_SALT, "_table_salt")


def hot_keys(rows: DataFrame, key: str, hot_key_rows: int) -> DataFrame:
    """``_hot``: the keys with more than ``hot_key_rows`` rows, and ``_splits``: how many salts each
    gets, at most one per shuffle partition.

    A summary of frequent values finds them in one pass, without a row per key. It is of fixed size,
    and so is the list, which can be broadcast whatever the rows are. A key that the summary misses,
    having less than about four parts in ``TRACKED_KEYS`` of all rows, is joined without salts.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(`{key}`, {LISTED_KEYS}, {TRACKED_KEYS})")
    return rows.select(top.alias("_top")).selectExpr("inline(_top)").where(
        F.col("count") > hot_key_rows).select(
        F.col("item").alias("_hot"),
        F.least(F.ceil(F.col("count") / hot_key_rows), F.lit(tasks)).cast("int").alias(_SPLITS),
    ).checkpoint()


def enrich(
    clicks: DataFrame, shoes: DataFrame,
    hot_key_rows: int = HOT_KEY_ROWS, salted: bool | None = None,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Clicks with the name of their product; clicks of an unknown product are dropped.

    A product without a name keeps its clicks, with a null ``product_name``.
    """
    names = shoes.select(F.col("id").alias("_id"), F.col("name").alias("product_name"))
    joined = lookup_join(clicks, names, "product_id", "_id", hot_key_rows, salted, salt_by)
    return joined.select(*clicks.columns, "product_name")


def enrich_asof(
    clicks: DataFrame, updates: DataFrame, seq: str = "event_id",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Clicks with the product name that was current at the click's time.

    The table changes as updates arrive. Both logs are merged in time order, an update before a
    click of the same instant, and the last update seen is carried to each click. Clicks before
    the first update of their product are dropped. Linear in the rows: no pair of click and
    version is formed.
    """
    as_click = clicks.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").alias("_id"), F.col("ts").alias("_ts"), F.lit(1).alias("_side"),
        F.col(seq).alias("_seq"), F.struct(*clicks.columns).alias("_click"),
    )
    as_update = updates.where(F.col("id").isNotNull()).select(
        F.col("id").alias("_id"), F.col("ts").alias("_ts"), F.lit(0).alias("_side"),
        F.col(seq).alias("_seq"), F.struct("name").alias("_update"),
    )
    merged = as_click.unionByName(as_update, allowMissingColumns=True)
    current = prefix_scan(
        merged, ["_id"], ["_ts", "_side", "_seq"],
        [Running("_version", "last", F.col("_update"))], slice_rows=slice_rows,
    )
    return (
        current.where(F.col("_click").isNotNull() & F.col("_version").isNotNull())
        .select("_click.*", F.col("_version.name").alias("product_name"))
    )


def unmatched(
    rows: DataFrame, table: DataFrame, key: str = "product_id", table_key: str = "id"
) -> DataFrame:
    """Keys without a table row, with their number of rows. Counted before the join, so the
    join sees one row per key."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("clicks"))
    return counts.join(table, F.col(key) == F.col(table_key), "left_anti")


__all__: Sequence[str] = [
    "HOT_KEY_ROWS", "broadcastable", "enrich", "enrich_asof", "hot_keys", "lookup_join",
    "unmatched",
]
