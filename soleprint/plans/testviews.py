"""The clickstream read out of the test tables ``events`` and ``part``.

``events`` carries two topics: views, clicks and errors are clicks on product ``k``; sign-ups and
purchases publish a new version of product ``k``. A click that ended in an error page names a
product no catalogue knows. Thirty days are compressed 60-fold, so that windows fill up.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soleprint.functions.encoding import json_envelope
from soleprint.sources.topics import parquet_replay

EPOCH_MICROS = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z, the first day of the events
COMPRESSION = 60
PARTITIONS = 6

# Column order of a click's own fields, and the schema ids its records are written under.
CLICK_FIELDS = ("product_id", "user_id", "view_time", "page_url", "ip")
CLICK_SCHEMA_ID = 1
SHOE_SCHEMA_ID = 2
ENRICHED_SCHEMA_ID = 3


# The tables' columns, given so that no file is opened to find them out.
EVENT_COLUMNS = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
                 "value double, props string")
PART_COLUMNS = ("p_partkey long, p_name string, p_brand string, p_size int, "
                "p_retailprice double")


def events(spark: SparkSession, sf_dir: str, stream: bool = False, **options: str) -> DataFrame:
    """The event log with compressed time, the product key ``k`` and whole values ``v``."""
    # A file stream wants a folder or a pattern; the table may be a single file.
    path = f"{sf_dir}/events.parque[t]" if stream else f"{sf_dir}/events.parquet"
    return parquet_replay(spark, path, EVENT_COLUMNS, stream, **options).selectExpr(
        "event_id", "event_type",
        f"timestamp_micros({EPOCH_MICROS} + (unix_micros(ts) - {EPOCH_MICROS}) div {COMPRESSION})"
        " AS ts",
        "get_json_object(props, '$.k') AS k", "user_id", "CAST(floor(value) AS LONG) AS v",
    )


_CLICK_COLUMNS = (
    "event_id",
    "concat(IF(event_type = 'error', '404-', ''), k) AS product_id",
    "CAST(user_id AS STRING) AS user_id",
    "v AS view_time",
    "concat('/', event_type) AS page_url",
    "concat('10.0.0.', user_id % 256) AS ip",
    "unix_millis(ts) AS payload_ts",
    "ts",
    f"CAST(k AS INT) % {PARTITIONS} AS partition",
    "timestamp_micros(unix_micros(ts) + event_id * 7919 % 1009 * 1000000) AS arrival",
)


def clicks_of(events: DataFrame) -> DataFrame:
    """Clicks, with the order they arrived in: up to 17 minutes late, ties by ``event_id``."""
    return events.where("event_type IN ('view', 'click', 'error')").selectExpr(*_CLICK_COLUMNS)


def clicks(spark: SparkSession, sf_dir: str, stream: bool = False, **options: str) -> DataFrame:
    return clicks_of(events(spark, sf_dir, stream, **options))


def shoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalogue, one version per product."""
    return spark.read.schema(PART_COLUMNS).parquet(f"{sf_dir}/part.parquet").selectExpr(
        "CAST(p_partkey AS STRING) AS id", "CAST(p_retailprice AS STRING) AS sale_price",
        "p_brand AS brand", "p_name AS name", "p_size / 10.0D AS rating",
    )


def shoe_updates(
    spark: SparkSession, sf_dir: str, stream: bool = False, **options: str
) -> DataFrame:
    """New versions of products over time."""
    return (
        events(spark, sf_dir, stream, **options)
        .where("event_type IN ('signup', 'purchase')")
        .selectExpr("event_id", "k AS id", "concat('shoe-', k, '-v', v div 50) AS name", "ts")
    )


def click_payload() -> Column:
    """The click's wire fields as a struct."""
    return F.struct(*CLICK_FIELDS, F.col("payload_ts").alias("ts"))


def click_records(clicks: DataFrame) -> DataFrame:
    """Clicks as log records; the offset stands for the event id."""
    return clicks.select(
        F.col("product_id").cast("binary").alias("key"),
        json_envelope(click_payload(), CLICK_SCHEMA_ID).alias("value"),
        "partition", F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )


def shoe_records(shoes: DataFrame) -> DataFrame:
    """The catalogue as log records, published once a second; every fifth is damaged.

    Of those, ids that end in 0 lack the brand, which is allowed; ids that end in 5 have a text for
    a rating.
    """
    def text(brand="brand,", rating="rating"):
        return f"to_json(struct(id, sale_price, {brand} name, {rating}))"

    value = f"""CASE CAST(id AS LONG) % 10
        WHEN 0 THEN {text(brand='')}
        WHEN 5 THEN {text(rating="'good' AS rating")}
        ELSE {text()} END"""
    prefix = "00" + format(SHOE_SCHEMA_ID, "08X")
    return shoes.selectExpr(
        "CAST(id AS BINARY) AS key", f"concat(X'{prefix}', CAST({value} AS BINARY)) AS value",
        f"CAST(CAST(id AS LONG) % {PARTITIONS} AS INT) AS partition", "CAST(id AS LONG) AS offset",
        f"timestamp_micros({EPOCH_MICROS} + CAST(id AS LONG) * 1000000) AS timestamp",
    )


def damaged_records(events: DataFrame) -> DataFrame:
    """Every event as a click record, damaged by kind of event.

    Clicks are sound; views lack ``ip``; sign-ups have no value; purchases end early; errors
    have a field of the wrong type (odd values) or one the schema does not know.
    """
    payload = "product_id, user_id, {view_time}, page_url, {ip} payload_ts AS ts{more}"

    def text(view_time="view_time", ip="ip,", more=""):
        fields = payload.format(view_time=view_time, ip=ip, more=more)
        return f"to_json(struct({fields}))"

    value = f"""CASE event_type
        WHEN 'click' THEN {text()}
        WHEN 'view' THEN {text(ip='')}
        WHEN 'purchase' THEN substring({text()}, 1, length({text()}) - 1)
        WHEN 'error' THEN IF(view_time % 2 = 1, {text(view_time="'soon' AS view_time")},
                             {text(more=", 'home' AS referrer")})
        END"""
    prefix = "00" + format(CLICK_SCHEMA_ID, "08X")
    return events.selectExpr(*_CLICK_COLUMNS, "event_type").selectExpr(
        "CAST(product_id AS BINARY) AS key",
        f"concat(X'{prefix}', CAST({value} AS BINARY)) AS value",
        "partition", "event_id AS offset", "ts AS timestamp",
    )
