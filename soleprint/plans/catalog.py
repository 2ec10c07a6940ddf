"""Every registered query: an operator over the whole test tables.

Times are given without zone, as the tables hold them.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soleprint import sinks
from soleprint.operators import counters, joins, tables, windows
from soleprint.operators.peek import peek_report
from soleprint.functions import window_key
from soleprint.plans import jobs
from soleprint.plans import testviews as views
from soleprint.schemas import CLICK
from soleprint.session import shared_dir
from soleprint.sources.records import violations
from soleprint.streaming import jobs as streams
from soleprint.streaming import stateful
from soleprint.streaming.batchlog import BATCH_ID, publish, read_log
from soleprint.streaming.processors import ClickCounter, process_keyed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Instants as timestamps without zone, bytes as hex text."""
    def column(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.TimestampType):
            return f"CAST({name} AS TIMESTAMP_NTZ) AS {name}"
        if isinstance(field.dataType, T.BinaryType):
            return f"hex({name}) AS {name}"
        return name
    return df.selectExpr(*[column(field) for field in df.schema.fields])


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(query(spark, sf_dir))
    QUERIES[query.__name__] = run
    return query


# Sources and decoding

@register
def click_source(spark, sf_dir):
    return views.clicks(spark, sf_dir)


@register
def shoe_source(spark, sf_dir):
    # Both engines write the price with two digits.
    price = F.format_string("%.2f", F.col("sale_price").cast("double"))
    return views.shoes(spark, sf_dir).withColumn("sale_price", price)


@register
def raw_click_scan(spark, sf_dir):
    good, _ = jobs.decode_clicks(views.click_records(views.clicks(spark, sf_dir)))
    return good.select("record_key", *views.CLICK_FIELDS, "payload_ts")


@register
def decode_clicks(spark, sf_dir):
    good, _ = jobs.decode_clicks(views.damaged_records(views.events(spark, sf_dir)))
    return good


@register
def decode_shoes(spark, sf_dir):
    good, _ = jobs.decode_shoes(views.shoe_records(views.shoes(spark, sf_dir)))
    price = F.format_string("%.2f", F.col("sale_price").cast("double"))
    return good.withColumn("sale_price", price)


@register
def decode_enriched(spark, sf_dir):
    """What the sink writes is read again."""
    enriched = enriched_clicks(spark, sf_dir)
    records = sinks.enriched_records(
        enriched.withColumn("ts", F.col("ts").cast("timestamp")), views.ENRICHED_SCHEMA_ID)
    records = records.withColumns({
        "partition": F.lit(0), "offset": F.unix_micros("timestamp")})
    good, _ = jobs.decode_enriched(records, strict=True)
    return good.drop("partition")


@register
def bad_record_quarantine(spark, sf_dir):
    _, bad = jobs.decode_clicks(views.damaged_records(views.events(spark, sf_dir)))
    return bad.select("partition", "offset", "timestamp", "reason")


@register
def schema_violations(spark, sf_dir):
    bad = violations(views.damaged_records(views.events(spark, sf_dir)), CLICK)
    return bad.select("partition", "offset", "timestamp", "reason")


# Per-row operators and tables

@register
def rekey_clicks(spark, sf_dir):
    return tables.select_key(views.clicks(spark, sf_dir), "product_id").select(
        "key", "event_id", "ts")


@register
def window_key_string(spark, sf_dir):
    counted = views_tumbling(spark, sf_dir)
    key = window_key(F.col("product_name"), F.col("window_start"), F.col("window_end"))
    return counted.select(key.alias("key"), "views")


@register
def peek_metrics(spark, sf_dir):
    clicks, shoes = views.clicks(spark, sf_dir), views.shoes(spark, sf_dir)
    counted = windows.count_views_by_name(clicks, shoes)
    return peek_report(spark, {
        "clicks": clicks.select("ts"),
        "shoes": views.shoe_updates(spark, sf_dir).select("ts"),
        "views": counted.select(F.col("window_end").alias("ts")),
    })


@register
def shoe_changelog(spark, sf_dir):
    return tables.table_changelog(
        views.shoe_updates(spark, sf_dir), "id", ("ts", "event_id"))


@register
def shoe_table(spark, sf_dir):
    return tables.latest_by_key(
        views.shoe_updates(spark, sf_dir), ["id"], ("ts", "event_id"))


# Joins

@register
def enriched_clicks(spark, sf_dir):
    return joins.enrich(views.clicks(spark, sf_dir), views.shoes(spark, sf_dir))


@register
def enriched_clicks_salted(spark, sf_dir):
    # A low limit, so that small tables have hot keys too.
    return joins.enrich(views.clicks(spark, sf_dir), views.shoes(spark, sf_dir),
                        hot_key_rows=100, salted=True, salt_by=["event_id"])


@register
def enriched_clicks_asof(spark, sf_dir):
    return joins.enrich_asof(views.clicks(spark, sf_dir), views.shoe_updates(spark, sf_dir))


@register
def unmatched_clicks(spark, sf_dir):
    return joins.unmatched(views.clicks(spark, sf_dir), views.shoes(spark, sf_dir))


# Windows

@register
def views_tumbling(spark, sf_dir):
    return windows.count_views_by_name(views.clicks(spark, sf_dir), views.shoes(spark, sf_dir))


@register
def views_tumbling_before_join(spark, sf_dir):
    return windows.count_views_by_name(
        views.clicks(spark, sf_dir), views.shoes(spark, sf_dir), before_join=True)


@register
def views_hopping(spark, sf_dir):
    return windows.count_views(views.clicks(spark, sf_dir), "product_id", windows.HOPPING)


@register
def views_changelog(spark, sf_dir):
    enriched = joins.enrich(views.clicks(spark, sf_dir), views.shoes(spark, sf_dir))
    return windows.views_changelog(enriched, "product_name")


@register
def views_hopping_changelog(spark, sf_dir):
    return windows.views_changelog(
        views.clicks(spark, sf_dir), "product_id", windows.HOPPING)


@register
def views_compacted(spark, sf_dir):
    log = views_changelog(spark, sf_dir)
    last = tables.latest_by_key(
        log, ["product_name", "window_start", "window_end"], ("ts", "event_id"))
    return last.select("product_name", "window_start", "window_end", "views")


@register
def views_tumbling_late(spark, sf_dir):
    enriched = joins.enrich(views.clicks(spark, sf_dir), views.shoes(spark, sf_dir))
    timed = windows.with_stream_time(
        enriched.select("event_id", "product_name", "ts", "partition", "arrival"))
    return windows.count_views_on_time(timed, "product_name", windows.TUMBLING)


@register
def views_hopping_late(spark, sf_dir):
    timed = windows.with_stream_time(
        views.clicks(spark, sf_dir).select("event_id", "product_id", "ts", "partition", "arrival"))
    return windows.count_views_on_time(timed, "product_id", windows.HOPPING)


@register
def late_clicks(spark, sf_dir):
    timed = windows.with_stream_time(
        views.clicks(spark, sf_dir).select("event_id", "product_id", "ts", "partition", "arrival"))
    return timed.where(windows.is_late(windows.TUMBLING))


@register
def live_windows(spark, sf_dir):
    return windows.live_windows(views.clicks(spark, sf_dir), "product_id")


# Totals and clocks

@register
def running_total(spark, sf_dir):
    return counters.running_total(views.clicks(spark, sf_dir))


@register
def running_total_by_partition(spark, sf_dir):
    return counters.running_total(views.clicks(spark, sf_dir), ["partition"])


@register
def running_total_hourly(spark, sf_dir):
    return counters.running_total_hourly(views.clicks(spark, sf_dir))


@register
def stream_time_ticks(spark, sf_dir):
    return counters.stream_time_ticks(views.clicks(spark, sf_dir))


# Output records

@register
def encode_enriched(spark, sf_dir):
    return sinks.enriched_records(enriched_clicks_asof(spark, sf_dir), views.ENRICHED_SCHEMA_ID)


@register
def encode_views(spark, sf_dir):
    return sinks.view_records(views_tumbling(spark, sf_dir))


@register
def encode_counter(spark, sf_dir):
    return sinks.counter_records(running_total_by_partition(spark, sf_dir))


@register
def encode_retained(spark, sf_dir):
    return sinks.retained_records(views_hopping(spark, sf_dir))


# Streams: the whole event log read as a file stream, and the table it leaves

def _stream_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"


def _enriched_schema(clicks: DataFrame) -> T.StructType:
    return T.StructType(clicks.schema.fields + [T.StructField("product_name", T.StringType())])


def _run_enrichment(spark, sf_dir, root) -> T.StructType:
    clicks = views.clicks(spark, sf_dir, stream=True)
    streams.start_enrichment(
        clicks, lambda session: views.shoes(session, sf_dir), root).awaitTermination()
    return _enriched_schema(clicks)


@register
def shoe_table_stream(spark, sf_dir):
    root = _stream_root(spark)
    updates = views.shoe_updates(spark, sf_dir, stream=True)
    streams.start_shoe_table(updates, root, ("ts", "event_id")).awaitTermination()
    return streams.current_shoes(spark, root, updates.schema)


@register
def enriched_clicks_stream(spark, sf_dir):
    root = _stream_root(spark)
    schema = _run_enrichment(spark, sf_dir, root)
    return read_log(spark, streams.log_path(root, "enriched"), schema).drop(BATCH_ID)


@register
def views_tumbling_stream(spark, sf_dir):
    root = _stream_root(spark)
    schema = _run_enrichment(spark, sf_dir, root)
    enriched = streams.enriched_stream(spark, root, schema)
    streams.start_product_views(enriched, root).awaitTermination()
    return streams.current_views(spark, root, "product_views", "product_name")


@register
def views_hopping_stream(spark, sf_dir):
    root = _stream_root(spark)
    clicks = views.clicks(spark, sf_dir, stream=True)
    streams.start_retained_views(clicks, root).awaitTermination()
    return streams.current_views(spark, root, "retained_views", "product_id")


@register
def running_total_stream(spark, sf_dir):
    root = _stream_root(spark)
    clicks = views.clicks(spark, sf_dir, stream=True)
    streams.start_click_counter(clicks, root, order=("ts", "event_id")).awaitTermination()
    schema = T.StructType([
        T.StructField("key", T.StringType()), clicks.schema["partition"], clicks.schema["ts"],
        clicks.schema["event_id"], T.StructField("total", T.LongType()),
    ])
    return read_log(spark, streams.log_path(root, "counter"), schema).drop(BATCH_ID)


@register
def raw_click_stream(spark, sf_dir):
    root = _stream_root(spark)
    records = views.click_records(views.clicks(spark, sf_dir, stream=True))
    good, _ = jobs.decode_clicks(records)
    good = good.select("record_key", *views.CLICK_FIELDS, "payload_ts")
    streams.start_reader(good, root, "raw_clicks").awaitTermination()
    return spark.read.schema(good.schema).parquet(streams.log_path(root, "raw_clicks"))


# Streams over topics that grow: written in slices, with a run of the query after each, which goes
# on from its checkpoint

SLICES = 4
SLICE = "_slice"


def _grow(topics, *starts) -> None:
    """Publish each topic's slices one by one; after each, run the queries that ``starts`` start.

    ``topics`` has rows, the number of each row's slice, and a folder. A topic's slices are written
    in one pass beside the folder, and moved into it when their turn comes.
    """
    for rows, cut, folder in topics:
        rows.withColumn(SLICE, cut).where(F.col(SLICE).isNotNull()).write.partitionBy(
            SLICE).parquet(f"{folder}_slices")
    for number in range(SLICES):
        for rows, _, folder in topics:
            spark, slices = rows.sparkSession, f"{folder}_slices/{SLICE}={number}"
            if not publish(spark, slices, f"{folder}/{number}"):
                rows.limit(0).write.parquet(f"{folder}/{number}")
        for start in starts:
            start().awaitTermination()


def _topic(spark, rows, folder):
    return spark.readStream.schema(rows.schema).parquet(f"{folder}/*")


def _cut(rows: DataFrame, by: Column) -> Column:
    """Slices of equal width in ``by``."""
    low, high = rows.agg(F.min(by), F.max(by)).first()
    return F.floor((by - F.lit(low)) * SLICES / F.lit(max(1, high - low + 1)))


def _clicks_and_updates(spark, sf_dir, root):
    """Both topics, cut at the same event ids: what :func:`_grow` takes, and the two streams."""
    cut = _cut(views.events(spark, sf_dir), F.col("event_id"))
    clicks, updates = views.clicks(spark, sf_dir), views.shoe_updates(spark, sf_dir)
    topics = [(clicks, cut, f"{root}/clicks"), (updates, cut, f"{root}/updates")]
    return topics, *(_topic(spark, rows, folder) for rows, _, folder in topics)


def _enrich_by_state(spark, sf_dir, root, *more):
    topics, clicks, updates = _clicks_and_updates(spark, sf_dir, root)
    named = stateful.enrich_by_state(clicks, updates, slots=4)
    _grow(topics, lambda: stateful.start_keyed(named, root, "enriched"),
          *(lambda: start(named.schema) for start in more))
    return named.schema


@register
def product_views_job_stream(spark, sf_dir):
    root = _stream_root(spark)

    def count(schema):
        enriched = spark.readStream.schema(schema).parquet(streams.log_path(root, "enriched"))
        return streams.start_product_views(enriched, root)

    _enrich_by_state(spark, sf_dir, root, count)
    return streams.current_views(spark, root, "product_views", "product_name")


@register
def enriched_clicks_state_stream(spark, sf_dir):
    root = _stream_root(spark)
    schema = _enrich_by_state(spark, sf_dir, root)
    return spark.read.schema(schema).parquet(streams.log_path(root, "enriched"))


@register
def product_state_table(spark, sf_dir):
    root = _stream_root(spark)
    _enrich_by_state(spark, sf_dir, root)
    return stateful.product_table(spark, root, "enriched")


@register
def recent_updates_stream(spark, sf_dir):
    root = _stream_root(spark)
    topics, clicks, updates = _clicks_and_updates(spark, sf_dir, root)
    joined = stateful.recent_updates(clicks, updates, "10 MINUTES", "1 minute")
    _grow(topics, lambda: streams.start_reader(joined, root, "recent"))
    return spark.read.schema(joined.schema).parquet(streams.log_path(root, "recent"))


@register
def shoe_changelog_stream(spark, sf_dir):
    root = _stream_root(spark)
    topics, _, updates = _clicks_and_updates(spark, sf_dir, root)
    changes = stateful.table_changes(updates)
    _grow(topics[1:], lambda: stateful.start_keyed(changes, root, "changes"))
    return spark.read.schema(changes.schema).parquet(streams.log_path(root, "changes"))


@register
def stream_time_ticks_stream(spark, sf_dir):
    """Clicks come in order of arrival, up to 1,008 seconds after their event time."""
    root, clicks = _stream_root(spark), views.clicks(spark, sf_dir)
    folder = f"{root}/clicks"
    ticks = stateful.span_ticks(_topic(spark, clicks, folder), "1009 seconds")
    _grow([(clicks, _cut(clicks, F.unix_micros("arrival")), folder)],
          lambda: stateful.start_keyed(ticks, root, "ticks"))
    return spark.read.schema(ticks.schema).parquet(streams.log_path(root, "ticks"))


@register
def shoe_table_late_stream(spark, sf_dir):
    """Slices come last first, so that every update of an earlier one is late."""
    root, updates = _stream_root(spark), views.shoe_updates(spark, sf_dir)
    cut, order = SLICES - 1 - _cut(updates, F.col("event_id")), ("ts", "event_id")
    stream = _topic(spark, updates, f"{root}/updates")
    _grow([(updates, cut, f"{root}/updates")],
          lambda: streams.start_shoe_table(stream, root, order))
    return streams.current_shoes(spark, root, updates.schema, order=order)


@register
def running_total_arrival_stream(spark, sf_dir):
    """Clicks are numbered as they arrive, which is not in order of their event times."""
    root, clicks = _stream_root(spark), views.clicks(spark, sf_dir)
    order = ("arrival", "event_id")
    stream = _topic(spark, clicks, f"{root}/clicks")
    _grow([(clicks, _cut(clicks, F.unix_micros("arrival")), f"{root}/clicks")],
          lambda: streams.start_click_counter(stream, root, order=order))
    schema = T.StructType([
        T.StructField("key", T.StringType()), *(clicks.schema[n] for n in ("partition", *order)),
        T.StructField("total", T.LongType())])
    return read_log(spark, streams.log_path(root, "counter"), schema).drop(BATCH_ID)


@register
def live_windows_stream(spark, sf_dir):
    root = _stream_root(spark)
    topics, clicks, _ = _clicks_and_updates(spark, sf_dir, root)
    changes = stateful.retained_windows(clicks)
    _grow(topics[:1], lambda: streams.start_log(changes, root, "retained", "update"))
    return stateful.retained_table(spark, root, "retained")


def _count_by_state(spark, sf_dir, root):
    clicks = views.clicks(spark, sf_dir, stream=True).select("partition", "ts")
    counted = process_keyed(
        clicks, "partition", ClickCounter(), ClickCounter.SCHEMA, time_mode="processingTime")
    # One micro-batch: with processing-time timers a query always has a next one to run.
    stateful.start_keyed(counted, root, "out", once=True).awaitTermination()
    return counted.schema


@register
def click_counter_stateful(spark, sf_dir):
    root = _stream_root(spark)
    schema = _count_by_state(spark, sf_dir, root)
    return spark.read.schema(schema).parquet(streams.log_path(root, "out"))


@register
def counter_state_table(spark, sf_dir):
    root = _stream_root(spark)
    _count_by_state(spark, sf_dir, root)
    return stateful.state_table(spark, root, "out", "total").select(
        "key.partition", F.lit(counters.TOTAL_KEY).alias("key"), "value.total")
