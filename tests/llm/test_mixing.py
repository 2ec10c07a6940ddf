"""Targets by the plain loop, rates by brute force, and copies that add up."""

import math
import re
from collections import defaultdict

import pytest

from soleprint.llm import mixing
from soleprint.llm.catalog import QUERIES


def plain_targets(sizes):
    """Share out, stop at the limit, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    targets, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total > 3 * sizes[s]}
        if not over:
            targets |= {s: left * weights[s] / total for s in free}
            break
        for s in over:
            targets[s] = 3.0 * sizes[s]
        left -= sum(3.0 * sizes[s] for s in over)
        free -= over
    return targets


def check(rows, got):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = plain_targets(sizes)
    by_id = {d: (text, source) for d, text, source in rows}
    taken, smallest = defaultdict(int), defaultdict(lambda: math.inf)
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, _, _ in rows)
    for r in got:
        text, source = by_id[r["doc_id"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[source] += r["taken"]
        smallest[source] = min(smallest[source], r["size"] or math.inf)
    for source, target in targets.items():
        if sizes[source]:
            assert abs(taken[source] - target) <= max(60, smallest[source], 0.01 * target)


def taken(df):
    return [r.asDict() | {"taken": r["size"] * r["copies"]} for r in df.collect()]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = QUERIES["op9_entropy_mix"](spark, sf_dir).collect()
    check(rows, got)
    again = QUERIES["op9_entropy_mix"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_edges(spark):
    rows = [(i, "w " * (1 + i % 40), ["a", "b", "É", None][i % 4]) for i in range(400)]
    rows += [(1000 + i, "same words here", "hot") for i in range(300)]
    rows += [(2000, None, "empty"), (2001, " \n", "empty"), (2002, "x " * 50_000, "long")]
    docs = spark.createDataFrame(
        [(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, n int")
    got = mixing.mix_copies(docs)
    check(rows, taken(got))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got.collect())
    assert mixing.mix_copies(docs.limit(0)).count() == 0
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame(
        [(None, "a b c", "x")] * 3 + [(1, "a b", "y")] * 2 + [(2, None, None)] * 2,
        "doc_id long, text string, source string")
    got = mixing.mix_copies(docs)
    assert got.count() == 7
    assert mixing.mix_documents(docs).count() == sum(r["copies"] for r in got.collect())


def test_rates_solve_the_dual(spark):
    counts = spark.createDataFrame(
        [("s", size, 10) for size in range(1, 60)] + [("t", 5, 400)],
        "source string, size long, n long")
    targets = spark.createDataFrame([("s", 17_700, 30_000.0), ("t", 2000, 500.0)],
                                    "source string, source_size long, target double")
    found = {r["source"]: r for r in mixing._solve(counts, targets, mixing.Mix()).collect()}
    s, t = found["s"], found["t"]
    total = sum(10 * z * min(3, math.exp(s["tilt"] * z / s["mean"])) for z in range(1, 60))
    assert total == pytest.approx(30_000, rel=2e-4)
    assert t["tilt"] == pytest.approx(math.log(0.25), rel=1e-3)


def test_columns_with_maps(spark):
    docs = spark.createDataFrame(
        [(1, "one two", "a", {"k": 1}), (1, "one two", "a", {"k": 2}), (2, "three", None, None)],
        "doc_id long, text string, source string, extra map<string, int>")
    got = mixing.mix_documents(docs)
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix_documents(docs).collect()))
