"""Fingerprints, links and components against brute force."""

import random

import pytest
import xxhash

from soleprint.llm import simhash
from soleprint.llm.catalog import QUERIES
from soleprint.llm.graph import components

U64 = (1 << 64) - 1


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, pairs):
    root = {n: n for n in nodes}
    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def plain_links(fps, distance=2):
    fps = sorted(fps)
    return {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:]
            if ((a ^ b) & U64).bit_count() <= distance}


def test_query_equals_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op1_simhash"](spark, sf_dir).collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts}
    by_fp = {}
    for d, fp in sorted(fps.items()):
        by_fp.setdefault(fp, d)
    roots = plain_components(
        by_fp.values(), [(by_fp[a], by_fp[b]) for a, b in plain_links(by_fp)])
    assert len(got) == len(texts)
    for d, fp in fps.items():
        assert got[d]["fingerprint"] == f"{fp:016x}"
        assert got[d]["component_id"] == roots[by_fp[fp]]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("crowd", [500, 3])
def test_links(spark, distance, crowd):
    rng = random.Random(distance)
    fps = {0, -1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            fp = centre
            for bit in rng.sample(range(64), rng.randrange(4)):
                fp ^= 1 << bit
            fps.add(fp - (1 << 64) if fp >> 63 else fp)
    rows = spark.createDataFrame([(fp,) for fp in fps], "fp long")
    got = {tuple(r) for r in simhash.links(rows, distance, crowd).collect()}
    assert got == plain_links(fps, distance)


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 160)]
    mixed = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    pairs = chain + star + mixed + [(7, 7), (5, 4)]
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    got = {r["node"]: r["label"] for r in components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == plain_components(nodes, [p for p in pairs if p[0] != p[1]])


def test_edges(spark):
    long_text = " ".join(f"w{i}" for i in range(300_000))
    rows = [(5, None, "x"), (3, "", "x"), (4, " \n", "x"), (9, "One\x0btwo", "x"),
            (8, "one two", "y"), (8, "one two", "y"), (None, "one two", "y"),
            (None, "far from all other texts here", "z"), (None, "another lone text", "z"),
            (2, long_text, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    assert {(r[0], r[3]) for r in got} == {
        (5, 3), (3, 3), (4, 3), (9, 8), (8, 8), (None, 8), (None, None), (2, 2)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 2, 3, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_columns_with_maps(spark):
    docs = spark.createDataFrame(
        [(1, "one two three", {"k": 2}), (1, "one two three", {"k": 1}), (2, "one two three", None),
         (3, "quite another text", {"k": 3})], "doc_id long, text string, extra map<string, int>")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert {(r["doc_id"], str(r["extra"])) for r in got.collect()} == {
        (1, "{'k': 1}"), (3, "{'k': 3}")}
