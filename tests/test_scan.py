"""The sliced scan against a plain loop, on skewed rows and with slices cut both ways."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from soleprint.operators import scan
from soleprint.operators.scan import Running, prefix_scan
from soleprint.session import shared_dir

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "key string, ts timestamp, seq long, v long"


def skewed_rows(n: int, seed: int) -> list[tuple]:
    """A third of the rows on one key, and a third of all at one instant."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"
        second = 1800 if rng.random() < 0.34 else rng.randrange(3600)
        value = rng.randrange(1000) if rng.random() < 0.3 else None
        rows.append((key, START + dt.timedelta(seconds=second), seq, value))
    rng.shuffle(rows)
    return rows


def brute_force(rows: list[tuple], keyed: bool) -> set[tuple]:
    state: dict = {}
    out = set()
    for key, ts, seq, v in sorted(rows, key=lambda row: (row[1], row[2])):
        count, high, last = state.get(key if keyed else None, (0, None, None))
        count += 1
        if v is not None:
            high = v if high is None else max(high, v)
            last = v
        state[key if keyed else None] = (count, high, last)
        out.add((key, ts, seq, v, count, high, last))
    return out


@pytest.mark.parametrize("slice_rows", [10, 200, 400, 900, 10**6])
@pytest.mark.parametrize("keyed", [True, False])
def test_scan_equals_loop(spark, keyed, slice_rows):
    rows = skewed_rows(2000, seed=slice_rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    scanned = prefix_scan(
        df, ["key"] if keyed else [], ["ts", "seq"],
        [Running("n", "count"), Running("high", "max", F.col("v")),
         Running("last", "last", F.col("v"))],
        slice_rows=slice_rows,
    )
    got = {
        (row.key, row.ts.replace(tzinfo=dt.timezone.utc) if row.ts.tzinfo is None else row.ts,
         *row[2:]) for row in scanned.collect()
    }
    assert got == brute_force(rows, keyed)


@pytest.mark.parametrize("listed", [0, 10_000])
def test_slices_hold_bounded_rows(spark, monkeypatch, listed):
    """However the rows are skewed, no slice is above the bound, and slices are in order."""
    shared_dir(spark)
    monkeypatch.setattr(scan, "BROADCAST_ROWS", listed)
    rows = skewed_rows(6000, seed=1)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_slice", F.lit(7).cast("long"))
    cut, sizes = scan._cut_full(df, ["key"], ["ts", "seq"], [Running("v", "max")], 100)
    found = cut.select("key", "_slice", "ts", "seq").collect()
    assert len(found) == 6000
    assert {(r["key"], r["_slice"]): r["_rows"] for r in sizes.collect()} == Counter(
        (r["key"], r["_slice"]) for r in found)
    assert max(r["_rows"] for r in sizes.collect()) <= 100
    ordered = sorted(found, key=lambda r: (r["key"], r["ts"], r["seq"]))
    assert all(a["_slice"] <= b["_slice"] for a, b in zip(ordered, ordered[1:], strict=False)
               if a["key"] == b["key"])


def test_rows_are_not_written_for_slicing(spark, monkeypatch):
    """Only lists of keys, slices and quantiles are checkpointed."""
    kind = type(spark.range(0))
    written, keep = [], kind.checkpoint
    def checkpoint(df, *args):
        written.append((df.count(), df.columns))
        return keep(df, *args)
    monkeypatch.setattr(kind, "checkpoint", checkpoint)
    df = spark.createDataFrame(skewed_rows(6000, seed=2), SCHEMA)
    prefix_scan(df, ["key"], ["ts", "seq"], [Running("n", "count")], slice_rows=300).count()
    assert written and not any("seq" in columns for _, columns in written)


@pytest.mark.parametrize("slice_rows", [2, 40, 10**6])
def test_rows_without_a_time_come_first(spark, slice_rows):
    rows = [("a", None if i % 10 == 0 else START + dt.timedelta(minutes=i), i, i)
            for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    scanned = prefix_scan(
        df, ["key"], ["ts", "seq"], [Running("n", "count")], slice_rows=slice_rows)
    ranked = sorted(rows, key=lambda row: (row[1] is not None, row[1] or START, row[2]))
    assert {row.seq: row.n for row in scanned.collect()} == {
        row[2]: n for n, row in enumerate(ranked, 1)}


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    for keys in (["key"], []):
        assert prefix_scan(df, keys, ["ts", "seq"], [Running("n", "count")]).count() == 0
