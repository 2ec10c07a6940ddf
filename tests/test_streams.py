"""Streams over several files: equal to the batch, late rows, restart, replay, timers."""

import datetime as dt
import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compare import assert_same, duck
from soleprint import sinks
from soleprint.operators import counters, windows
from soleprint.operators.peek import peek
from soleprint.plans import jobs as jobs_batch
from soleprint.plans import testviews as views
from soleprint.plans.catalog import QUERIES
from soleprint.plans.oracles import ORACLES
from soleprint.schemas import CLICK, RECORD
from soleprint.sources import decode_records, good_records, quarantined
from soleprint.streaming import jobs
from soleprint.streaming.batchlog import append_batch, compact_log, read_latest, read_log
from soleprint.streaming.processors import ClickCounter, StreamClock, process_keyed
from soleprint.streaming.progress import Progress

SMALL = "/root/testdata/sf0.001"
FILES = 4


def write_part(df, folder, number):
    """One more file of a stream folder, newer than the ones before it."""
    target = f"{folder}/part-{number}"
    df.coalesce(1).write.parquet(target)
    for name in os.listdir(target):
        os.utime(f"{target}/{name}", (1_700_000_000 + number * 60,) * 2)


def write_clicks(spark, folder, numbers):
    clicks = views.clicks(spark, SMALL)
    cut = F.floor(F.col("event_id") * FILES / 1000)
    for number in numbers:
        write_part(clicks.where(cut == number), folder, number)


def open_clicks(spark, folder):
    schema = views.clicks(spark, SMALL).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


@pytest.fixture(scope="module")
def click_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clicks"))
    write_clicks(spark, folder, range(FILES))
    return folder


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_hopping_stream_equals_batch(spark, click_folder, tmp_path):
    root = str(tmp_path)
    jobs.start_retained_views(open_clicks(spark, click_folder), root).awaitTermination()
    expected = windows.count_views(views.clicks(spark, SMALL), "product_id", windows.HOPPING)
    got = jobs.current_views(spark, root, "retained_views", "product_id")
    assert rows(got) == rows(expected.select(got.columns))
    assert read_log(
        spark, f"{root}/retained_views", got.schema).select("batch_id").distinct().count() >= FILES


def test_records_are_decoded_and_encoded_in_a_stream(spark, tmp_path):
    """Log records in, quarantine and counted records out, in update mode."""
    events = views.events(spark, SMALL)
    folder = str(tmp_path / "in")
    write_part(views.damaged_records(events), folder, 0)
    records = spark.readStream.schema(RECORD).parquet(f"{folder}/*")
    decoded = decode_records(records, CLICK)
    counted = sinks.retained_records(
        windows.count_views(good_records(decoded), "product_id", windows.HOPPING))
    for name, df, mode in (("counted", counted, "update"), ("bad", quarantined(decoded), "append")):
        (
            df.writeStream.format("memory").queryName(name).outputMode(mode)
            .trigger(availableNow=True).start().awaitTermination()
        )
    good, bad = jobs_batch.decode_clicks(views.damaged_records(events))
    expected = sinks.retained_records(windows.count_views(good, "product_id", windows.HOPPING))
    assert rows(spark.table("counted")) == rows(expected)
    assert spark.table("bad").count() == bad.count() > 0


def test_product_views_stream_equals_batch(spark, click_folder, tmp_path):
    root = str(tmp_path)
    clicks = open_clicks(spark, click_folder)
    schema = T.StructType(clicks.schema.fields + [T.StructField("product_name", T.StringType())])
    jobs.start_enrichment(
        clicks, lambda session: views.shoes(session, SMALL), root).awaitTermination()
    enriched = jobs.enriched_stream(spark, root, schema, maxFilesPerTrigger="1")
    jobs.start_product_views(enriched, root).awaitTermination()
    expected = windows.count_views_by_name(views.clicks(spark, SMALL), views.shoes(spark, SMALL))
    got = jobs.current_views(spark, root, "product_views", "product_name")
    assert rows(got) == rows(expected.select(got.columns))


def test_counter_stream_restarts_and_replays(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    order = ("ts", "event_id")

    def run():
        jobs.start_click_counter(
            open_clicks(spark, folder), root, order=order).awaitTermination()

    write_clicks(spark, folder, range(2))
    run()
    write_clicks(spark, folder, range(2, FILES))
    run()
    # As after a crash between writing a batch and committing it: the batch runs again.
    commits = f"{root}/_checkpoints/counter/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    os.remove(f"{commits}/{last}")
    os.remove(f"{commits}/.{last}.crc")
    run()
    expected = counters.running_total(views.clicks(spark, SMALL), ["partition"], order)
    schema = T.StructType([*expected.schema.fields])
    got = read_log(spark, f"{root}/counter", schema).select(expected.columns)
    assert rows(got) == rows(expected)


def test_unfinished_batch_is_replaced(spark, tmp_path):
    from soleprint.streaming.batchlog import append_batch
    path = str(tmp_path / "log")
    one, two = spark.range(1), spark.range(2)
    append_batch(two, path, 0)
    append_batch(one, path, 0)
    assert spark.read.parquet(path).count() == 2
    os.remove(f"{path}/batch_id=0/_SUCCESS")
    append_batch(one, path, 0)
    assert spark.read.parquet(path).count() == 1


def test_table_is_refreshed_between_batches(spark, tmp_path):
    """A click sees the product table as its own micro-batch finds it."""
    folder, shoe_folder, root = (str(tmp_path / name) for name in ("in", "shoes", "out"))
    at = lambda minute: dt.datetime(2024, 1, 1, 0, minute, tzinfo=dt.timezone.utc)
    shoe_schema = "id string, name string, ts timestamp, offset long"
    click_schema = "event_id long, product_id string, ts timestamp"

    def stream(path, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")

    for number, name in enumerate(("old", "new")):
        shoe = spark.createDataFrame([("1", name, at(number), number)], shoe_schema)
        write_part(shoe, shoe_folder, number)
        jobs.start_shoe_table(
            stream(shoe_folder, shoe_schema), root, ("ts", "offset")).awaitTermination()
        write_part(spark.createDataFrame([(number, "1", at(5))], click_schema), folder, number)
        clicks = stream(folder, click_schema)
        jobs.start_enrichment(
            clicks, lambda session: jobs.current_shoes(session, root, shoe.schema), root,
        ).awaitTermination()
    got = spark.read.parquet(f"{root}/enriched").select("event_id", "product_name")
    assert rows(got) == [(0, "old"), (1, "new")]
    assert rows(jobs.current_shoes(spark, root, shoe.schema).select("name")) == [("new",)]


def test_enrichment_before_any_product(spark, click_folder, tmp_path):
    root = str(tmp_path)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    with pytest.raises(AnalysisException):
        jobs.current_shoes(spark, root, schema)
    jobs.start_enrichment(
        open_clicks(spark, click_folder),
        lambda session: jobs.current_shoes(session, root, schema, missing_ok=True),
        root).awaitTermination()
    assert read_log(spark, f"{root}/enriched", schema).count() == 0


def test_failed_attempt_is_never_seen(spark, tmp_path):
    """A job further down, running while a batch fails and is run again, counts it once."""
    path, out = str(tmp_path / "enriched"), str(tmp_path / "out")
    rows = spark.createDataFrame([(1,), (2,)], "id long")

    def follow():
        stream = jobs.enriched_stream(spark, str(tmp_path), rows.schema)
        jobs.start_reader(stream, out, "seen").awaitTermination()
        return spark.read.schema(rows.schema).parquet(f"{out}/seen").count()
    rows.write.parquet(f"{path}/_staged/batch_id=0")  # stopped before it was published
    assert follow() == 0
    append_batch(rows, path, 0)
    assert follow() == 2
    append_batch(rows, path, 0)
    assert follow() == 2 and read_log(spark, path, rows.schema).count() == 2


def test_reader_takes_every_row(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(500).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema("id long").parquet(folder)
    jobs.start_reader(stream, root, "raw").awaitTermination()
    assert spark.read.parquet(f"{root}/raw").count() == 500


def test_keyed_state_in_any_session(spark, sf_dir):
    plain = spark.newSession()
    plain.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    got = QUERIES["click_counter_stateful"](plain, sf_dir).toPandas()
    assert_same(got, duck(sf_dir).execute(ORACLES["click_counter_stateful"]).df())


def test_rows_past_the_watermark_are_dropped(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "product_id string, ts timestamp"

    def at(minute, second=0):
        return dt.datetime(2024, 1, 1, 0, minute, second, tzinfo=dt.timezone.utc)

    # A micro-batch drops what was late by the watermark its predecessor ran under.
    parts = ([("a", at(5)), ("a", at(12))], [("a", at(13))], [("a", at(9, 59)), ("a", at(14))])
    for number, part in enumerate(parts):
        write_part(spark.createDataFrame(part, schema), folder, number)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    seen = Progress()
    spark.streams.addListener(seen)
    try:
        query = jobs.start_view_counts(
            peek(stream, "clicks"), "product_id", windows.TUMBLING, root, "views")
        query.awaitTermination()
        deadline = time.time() + 20
        while time.time() < deadline and not any(s["late"] for s in seen.state.values()):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(seen)
    got = jobs.current_views(spark, root, "views", "product_id")
    assert rows(got.select(F.minute("window_start"), "views")) == [(0, 1), (10, 3)]
    assert "clicks" in seen.observed


def test_compaction_keeps_the_table(spark, click_folder, tmp_path):
    root = str(tmp_path)
    jobs.start_retained_views(open_clicks(spark, click_folder), root).awaitTermination()
    keys = ["product_id", "window_start", "window_end"]
    table = jobs.current_views(spark, root, "retained_views", "product_id")
    cutoff = F.lit(dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone.utc))
    compact_log(
        spark, f"{root}/retained_views", f"{root}/compact", table.schema, keys,
        keep=F.col("window_start") > cutoff)
    kept = read_latest(spark, f"{root}/compact", table.schema, keys)
    assert rows(kept) == rows(table.where(F.col("window_start") > cutoff))
    assert spark.read.parquet(f"{root}/compact").count() == kept.count()


def test_stateful_clock_equals_batch_ticks(spark, tmp_path):
    """Rows in arrival order, one partition per file, over two micro-batches."""
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    clicks = views.clicks(spark, SMALL).where("partition = 3").orderBy("arrival", "event_id")
    count = clicks.count()
    cut = clicks.limit(count // 2).agg(F.max("arrival")).first()[0]
    write_part(clicks.where(F.col("arrival") <= cut).coalesce(1), folder, 0)
    write_part(clicks.where(F.col("arrival") > cut).coalesce(1), folder, 1)
    stream = open_clicks(spark, folder).select("partition", "ts")
    ticks = process_keyed(stream, "partition", StreamClock(), StreamClock.SCHEMA)
    (
        ticks.writeStream.format("parquet").option("path", f"{root}/ticks")
        .option("checkpointLocation", f"{root}/_checkpoints").trigger(availableNow=True)
        .start().awaitTermination()
    )
    expected = counters.stream_time_ticks(views.clicks(spark, SMALL).where("partition = 3"))
    got = spark.read.schema(ticks.schema).parquet(f"{root}/ticks")
    assert rows(got.select(expected.columns)) == rows(expected)


def test_counter_is_reset_by_the_wall_clock(spark, tmp_path):
    """3 rows, a reset by timer, 2 rows: 1,2,3,1,2, and no row for the reset."""
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    clicks = views.clicks(spark, SMALL).where("partition = 3").select("partition", "ts")
    write_part(clicks.limit(3), folder, 0)
    stream = spark.readStream.schema(clicks.schema).parquet(f"{folder}/*")
    counted = process_keyed(
        stream, "partition", ClickCounter(reset_millis=15_000), ClickCounter.SCHEMA,
        time_mode="processingTime")
    query = (
        counted.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/_checkpoints")
        .trigger(processingTime="1 second").start()
    )

    def totals(wanted):
        deadline = time.time() + 120
        while time.time() < deadline:
            if query.exception() is not None:
                raise query.exception()
            try:
                found = spark.read.schema(counted.schema).parquet(f"{root}/out")
                found = sorted(row.total for row in found.collect())
            except Exception:
                found = []
            if len(found) >= wanted:
                return found
            time.sleep(1)
        raise AssertionError("no rows in time")

    try:
        assert totals(3) == [1, 2, 3]
        time.sleep(25)
        write_part(clicks.limit(2), folder, 1)
        assert totals(5) == [1, 1, 2, 2, 3]
    finally:
        query.stop()
