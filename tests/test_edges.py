"""Hand-made rows at the edges of each rule."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from soleprint import schemas, sinks
from soleprint.functions import decode_long, encode_long, window_key
from soleprint.operators import counters, joins, tables, windows
from soleprint.plans import jobs
from soleprint.sources import decode_records, good_records, quarantined

CLICKS = "event_id long, product_id string, ts timestamp, partition int, arrival timestamp"
SHOES = "id string, name string"


def at(text: str) -> dt.datetime:
    fmt = "%H:%M:%S.%f" if "." in text else "%H:%M:%S"
    clock = dt.datetime.strptime(text, fmt)
    return clock.replace(year=2024, month=1, day=1, tzinfo=dt.timezone.utc)


def clicks_at(spark, *rows):
    """Clicks of one partition, arriving in the order given."""
    data = [
        (i, key, at(time), 0, at("00:00:00") + dt.timedelta(seconds=i))
        for i, (key, time) in enumerate(rows)
    ]
    return spark.createDataFrame(data, CLICKS)


def starts(df):
    rows = df.select(F.date_format("window_start", "HH:mm").alias("s"), "views").collect()
    return {row.s: row.views for row in rows}


@pytest.mark.parametrize("spec,expected", [
    (windows.TUMBLING, {"00:10": 1}),
    (windows.HOPPING, {f"00:{m:02d}": 1 for m in range(1, 11)}),
])
def test_window_edge(spark, spec, expected):
    df = clicks_at(spark, ("a", "00:10:00"))
    assert starts(windows.count_views(df, "product_id", spec)) == expected


def on_time(spark, spec, *rows):
    df = windows.with_stream_time(clicks_at(spark, *rows))
    return df, starts(windows.count_views_on_time(df, "product_id", spec))


def test_late_by_exactly_the_grace(spark):
    df, counted = on_time(spark, windows.TUMBLING, ("a", "00:11:00"), ("a", "00:09:59"))
    assert counted == {"00:10": 1}
    assert df.where(windows.is_late(windows.TUMBLING)).count() == 1


def test_inside_the_grace(spark):
    df, counted = on_time(spark, windows.TUMBLING, ("a", "00:10:59.999"), ("a", "00:09:59"))
    assert counted == {"00:00": 1, "00:10": 1}
    assert df.where(windows.is_late(windows.TUMBLING)).count() == 0


def test_partly_late_hop(spark):
    late = windows.with_stream_time(clicks_at(spark, ("b", "00:11:00"), ("a", "00:05:30")))
    only = windows.count_views_on_time(
        late.where("product_id = 'a'"), "product_id", windows.HOPPING)
    assert starts(only) == {f"00:{m:02d}": 1 for m in range(1, 6)}


def test_later_update_wins(spark):
    rows = [("1", "old", at("00:00:00"), 1), ("1", "new", at("00:00:00"), 2), (None, "x", at("00:01:00"), 3)]
    df = spark.createDataFrame(rows, "id string, name string, ts timestamp, seq long")
    last = tables.latest_by_key(df, ["id"], ["ts", "seq"]).collect()
    assert [(row.id, row.name) for row in last] == [("1", "new")]


@pytest.mark.parametrize("slice_rows", [1, 10**6])
def test_click_sees_update_of_the_same_instant(spark, slice_rows):
    updates = spark.createDataFrame(
        [("1", "v1", at("00:00:00"), 9), ("1", "v2", at("00:05:00"), 10), ("2", None, at("00:00:00"), 11)],
        "id string, name string, ts timestamp, event_id long")
    clicks = clicks_at(
        spark, ("1", "00:04:59.999"), ("1", "00:05:00"), ("1", "23:00:00"), ("2", "00:01:00"),
        ("3", "00:01:00"), (None, "00:01:00"))
    got = joins.enrich_asof(clicks, updates, slice_rows=slice_rows)
    assert got.columns == [*clicks.columns, "product_name"]
    assert {(row.event_id, row.product_name) for row in got.collect()} == {
        (0, "v1"), (1, "v2"), (2, "v2"), (3, None)}


def test_click_before_first_update_is_dropped(spark):
    updates = spark.createDataFrame(
        [("1", "v1", at("00:05:00"), 9)], "id string, name string, ts timestamp, event_id long")
    clicks = clicks_at(spark, ("1", "00:04:59.999"))
    assert joins.enrich_asof(clicks, updates).count() == 0


@pytest.mark.parametrize("before_join", [True, False])
def test_null_name_is_kept_but_not_counted(spark, before_join):
    shoes = spark.createDataFrame([("1", None), ("2", "n"), ("3", "n")], SHOES)
    clicks = clicks_at(
        spark, ("1", "00:01:00"), ("2", "00:01:00"), ("3", "00:02:00"), (None, "00:01:00"))
    assert joins.enrich(clicks, shoes).count() == 3
    counted = windows.count_views_by_name(clicks, shoes, before_join=before_join).collect()
    assert [(row.product_name, row.views) for row in counted] == [("n", 2)]


def test_salted_join_equals_plain(spark):
    shoes = spark.createDataFrame([(str(i), f"n{i}") for i in range(20)], SHOES)
    clicks = clicks_at(spark, *[
        ("7" if i % 3 else str(i % 30), f"00:{i // 60:02d}:{i % 60:02d}") for i in range(600)])
    plain = joins.enrich(clicks, shoes, salted=False)
    salted = joins.enrich(clicks, shoes, hot_key_rows=50, salted=True)
    assert sorted(plain.collect()) == sorted(salted.collect())


def test_reset_each_hour(spark):
    clicks = clicks_at(
        spark, ("a", "00:10:00"), ("a", "00:20:00"), ("b", "00:59:59.999"), ("a", "01:00:00"),
        ("a", "01:30:00"))
    rows = counters.running_total_hourly(clicks).orderBy("event_id").collect()
    assert [row.total for row in rows] == [1, 2, 3, 1, 2]
    assert {row.key for row in rows} == {"TOTAL"}


def test_ticks_skip_spans_and_do_not_repeat(spark):
    clicks = clicks_at(
        spark, ("a", "00:00:01"), ("a", "00:00:09"), ("a", "00:00:31"), ("a", "00:00:12"),
        ("a", "00:00:39.999"), ("a", "00:00:40"))
    rows = counters.stream_time_ticks(clicks).orderBy("tick")
    got = rows.select(F.date_format("tick", "ss"), F.date_format("stream_time", "ss")).collect()
    assert [tuple(row) for row in got] == [("00", "01"), ("30", "31"), ("40", "40")]


def test_retention_is_measured_from_the_latest_row(spark):
    clicks = clicks_at(spark, ("a", "00:30:30"), ("a", "01:00:30"))
    live = starts(windows.live_windows(clicks, "product_id"))
    assert live == {"00:51": 1, "00:52": 1, "00:53": 1, "00:54": 1, "00:55": 1, "00:56": 1,
                    "00:57": 1, "00:58": 1, "00:59": 1, "01:00": 1}


GOOD = b'{"product_id":"1","user_id":"u","view_time":3,"page_url":"/p","ip":"i","ts":4}'
HEAD = b"\x00\x00\x00\x00\x01"


@pytest.mark.parametrize("value,reason,strict_reason", [
    (HEAD + GOOD, None, None),
    (None, "null_value", "null_value"),
    (HEAD + b"null", "null_value", "null_value"),
    (b"\x01\x00\x00\x00\x01" + GOOD, "bad_envelope", "bad_envelope"),
    (b"\x00\x00", "bad_envelope", "bad_envelope"),
    (HEAD + b"\xff\xfe", "bad_encoding", "bad_encoding"),
    (HEAD + b"{bad", "malformed_json", "malformed_json"),
    (HEAD + b"[1]", "malformed_json", "malformed_json"),
    (HEAD + GOOD.replace(b"3", b'"x"'), "wrong_type", "wrong_type"),
    (HEAD + GOOD[:-1] + b',"more":1}', "unknown_field", "unknown_field"),
    (HEAD + GOOD.replace(b'"ip":"i",', b""), None, "missing_field"),
    (HEAD + GOOD.replace(b'"i"', b"null"), None, "missing_field"),
])
def test_decoding(spark, value, reason, strict_reason):
    records = spark.createDataFrame(
        [(b"k", value, 0, 7, at("00:00:00"))], schemas.RECORD)
    for strict, expected in ((False, reason), (True, strict_reason)):
        decoded = decode_records(records, schemas.CLICK, strict)
        good, bad = good_records(decoded).collect(), quarantined(decoded).collect()
        if expected is None:
            assert not bad and good[0].product_id == "1" and good[0].payload_ts == 4
            assert good[0].record_key == "k" and good[0].offset == 7
        else:
            assert not good and bad[0].reason == expected and bad[0].value == value


def test_long_encoding(spark):
    df = spark.createDataFrame([(0,), (1,), (2**40 + 5,), (2**63 - 1,)], "n long")
    row = df.select("n", encode_long(F.col("n")).alias("b"))
    assert {(r.n, bytes(r.b)) for r in row.collect()} == {
        (n, n.to_bytes(8, "big")) for n in (0, 1, 2**40 + 5, 2**63 - 1)}
    assert row.where(decode_long(F.col("b")) == F.col("n")).count() == 4


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_window_key_does_not_follow_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(1).select(
            window_key(F.lit("a b"), F.timestamp_seconds(F.lit(1704067800)),
                       F.timestamp_millis(F.lit(1704068400500))).alias("k"))
        assert df.first().k == "[a b@2024-01-01T00:10:00Z/2024-01-01T00:20:00.500Z]"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_jobs_from_records(spark):
    """The three jobs from log records to output records."""
    shoes = [b'{"id":"1","sale_price":"9.5","brand":"b","name":"old","rating":4.5}',
             b'{"id":"1","sale_price":"9.5","brand":"b","name":"new","rating":4.5}']
    shoe_records = spark.createDataFrame(
        [(b"1", HEAD + text, 0, i, at("00:00:00")) for i, text in enumerate(shoes)],
        schemas.RECORD)
    click_records = spark.createDataFrame(
        [(b"1", HEAD + GOOD, 0, i, at(f"00:0{i}:00")) for i in range(3)]
        + [(b"1", HEAD + b"{", 0, 9, at("00:09:00"))], schemas.RECORD)
    clicks, bad = jobs.decode_clicks(click_records)
    catalogue, _ = jobs.decode_shoes(shoe_records)
    assert bad.count() == 1
    result = jobs.product_views(clicks, catalogue)
    assert [row.product_name for row in result.enriched.collect()] == ["new"] * 3
    record = sinks.view_records(result.views).first()
    assert bytes(record.key) == b"[new@2024-01-01T00:00:00Z/2024-01-01T00:10:00Z]"
    assert bytes(record.value) == (3).to_bytes(8, "big")
    sent = sinks.enriched_records(result.enriched, 3).orderBy("timestamp").first()
    assert bytes(sent.value) == b"\x00\x00\x00\x00\x03" + GOOD[:-1] + b',"product_name":"new"}'
    totals = jobs.click_counter(clicks).orderBy("ts").collect()
    assert [row.total for row in totals] == [1, 2, 3]
    retained = jobs.retained_views(clicks)
    assert sum(row.views for row in retained.views.collect()) == 30
    key = bytes(sinks.retained_records(retained.views).first().key)
    assert key[:1] == b"1" and len(key) == 9


def test_hot_keys_are_salted_without_a_shuffle_by_key(spark):
    """The list of hot keys is bounded and broadcast, so no exchange is by the hot key alone."""
    clicks = spark.createDataFrame(
        [("hot" if i % 3 == 0 else f"p{i}", i) for i in range(3000)], "product_id string, n int")
    shoes = spark.createDataFrame(
        [("hot", "h")] + [(f"p{i}", f"n{i}") for i in range(0, 3000, 2)], "id string, name string")
    hot = joins.hot_keys(clicks, "product_id", 100).collect()
    assert [(r["_hot"], r["_splits"]) for r in hot] == [("hot", 4)]  # as many as partitions
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        joined = joins.enrich(clicks, shoes, hot_key_rows=100, salted=True)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    exchanges = re.findall(r"hashpartitioning\(([^)]*), \d+\)", plan)
    assert exchanges and all("_salt" in e or "_table_salt" in e for e in exchanges), exchanges
    plain = clicks.join(shoes, clicks.product_id == shoes.id).select("product_id", "n", "name")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("spec", [windows.HOPPING, windows.TUMBLING, windows.Windows(600, 5, 60)])
@pytest.mark.parametrize("slice_rows", [3, 10**6])
def test_changelog_counts_each_window_row_by_row(spark, spec, slice_rows):
    rng = random.Random(4)
    start = at("00:00:00")
    data = [(i, rng.choice("aab"), start + dt.timedelta(seconds=rng.randrange(0, 3000)))
            for i in range(120)] + [(200, "a", start + dt.timedelta(hours=5)), (201, None, start)]
    df = spark.createDataFrame(data, "event_id long, product_id string, ts timestamp")
    got = windows.views_changelog(df, "product_id", spec, slice_rows=slice_rows).collect()
    want, held = [], {}
    for i, key, ts in sorted((r for r in data if r[1]), key=lambda r: (r[2], r[0])):
        second = int(ts.timestamp())
        first = second // spec.advance * spec.advance
        for begin in range(first, second - spec.size, -spec.advance):
            held[key, begin] = held.get((key, begin), 0) + 1
            want.append((i, key, begin, held[key, begin]))
    seconds = [(r["event_id"], r["product_id"], int(r["window_start"].replace(
        tzinfo=dt.timezone.utc).timestamp()), r["views"]) for r in got]
    assert sorted(seconds) == sorted(want)
