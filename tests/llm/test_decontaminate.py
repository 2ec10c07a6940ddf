"""Retrieval against brute force over all windows, subsequences, paraphrases and edge rows."""

import random

import numpy as np

from soleprint.llm import decontaminate as d
from soleprint.llm.catalog import QUERIES


def holds(words, part):
    return any(words[i:i + len(part)] == part for i in range(len(words) - len(part) + 1))


def test_query_finds_every_verbatim_item(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    parts = {r["item_id"]: d.words_of(r["text"].encode()) for r in items}
    want = set()
    for doc_id, text in docs:
        words = d.words_of(text.encode())
        want |= {(doc_id, i) for i, part in parts.items() if holds(words, part)}
    got = {(r["doc_id"], r["item_id"]): r
           for r in QUERIES["op2_decontamination"](spark, sf_dir).collect()}
    assert want and want <= set(got)
    texts = dict(docs)
    for (doc_id, item), row in got.items():  # the rest must be near misses
        words, part = d.words_of(texts[doc_id].encode()), parts[item]
        best = max(d.common_subsequence(part, words[i:i + 2 * len(part) + 20])
                   for i in range(0, max(1, len(words)), 5))
        assert best / len(part) >= 0.5 and row["share"] >= 0.5


def test_common_subsequence():
    rng = random.Random(3)
    def plain(a, b):
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(
                    table[i, j + 1], table[i + 1, j])
        return table[-1, -1]
    for _ in range(100):
        a = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(12))]
        b = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(12))]
        assert d.common_subsequence(a, b) == plain(a, b)


def test_paraphrases_and_edges(spark):
    rng = random.Random(4)
    def text(n):
        return [f"w{rng.randrange(4000)}" for _ in range(n)]
    items = [text(n) for n in (8, 15, 30, 59, 200)]
    rows = []
    for i, item in enumerate(items):
        changed = [w if k % 8 else f"other{k}" for k, w in enumerate(item, 1)]
        rows.append((i, " ".join(text(100) + changed + text(100))))
        rows.append((10 + i, " ".join(item)))
    rows += [(100 + i, " ".join(text(300))) for i in range(60)]
    rows += [(300, None), (301, ""), (302, "... !!"), (None, " ".join(items[1])),
             (303, " ".join(text(150_000) + items[2])), (11, " ".join(items[1]))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, share int")
    benchmark = spark.createDataFrame(
        [(i, " ".join(item)) for i, item in enumerate(items)] + [(8, None), (9, "")],
        "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, benchmark).collect()}
    assert got == ({(i, i) for i in range(5)} | {(10 + i, i) for i in range(5)}
                   | {(None, 1), (303, 2)})
    blocks = d.find_leaks(docs, benchmark, d.Search(block=2))
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == got
    clean = d.drop_leaks(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == 63
    assert d.find_leaks(docs.limit(0), benchmark).count() == 0
    assert d.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_latent_space_is_that_of_the_plain_svd(spark):
    rng = random.Random(5)
    texts = [" ".join(f"t{rng.randrange(60)}" for _ in range(30)) for _ in range(40)]
    items = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    idf = np.linspace(1, 2, d.BUCKETS)
    space = d.latent_space(items, idf, d.Search(dims=20))
    matrix = np.zeros((40, d.BUCKETS))
    for i, t in enumerate(texts):
        at, weights = d.weigh(d.words_of(t.encode()), idf)
        matrix[i, at] = weights
    used = np.flatnonzero(matrix.any(axis=0))
    right = np.linalg.svd(matrix[:, used])[2][:20]
    best = np.linalg.norm(matrix[:, used] @ right.T)
    assert np.array_equal(space.buckets, used)
    assert np.linalg.norm(matrix[:, used] @ space.rows) >= 0.97 * best
    assert np.allclose(space.rows.T @ space.rows, np.eye(20), atol=1e-4)


def zipf_words(rng, n, vocabulary=50_000):
    """Words whose frequencies fall as their rank grows."""
    return [f"v{int(vocabulary ** rng.random())}" for _ in range(n)]


def test_large_benchmark_loses_no_copy(spark):
    rng = random.Random(6)
    items = [zipf_words(rng, 40) for _ in range(2000)]
    docs, want = [], set()
    for i, item in enumerate(items):  # verbatim in one document, every ninth word changed elsewhere
        changed = [w if k % 9 else f"other{i}x{k}" for k, w in enumerate(item, 1)]
        for doc_id, copy in ((i, item), (10_000 + i, changed)):
            docs.append((doc_id, " ".join(zipf_words(rng, 40) + copy + zipf_words(rng, 40))))
            want.add((doc_id, i))
    got = d.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)],
                              "item_id long, text string"))
    assert want <= {(r["doc_id"], r["item_id"]) for r in got.collect()}


def test_copies_among_rare_words(spark):
    rng = random.Random(8)
    items = [[f"common{rng.randrange(60)}" for _ in range(n)] for n in (3, 4, 16, 31, 61)]
    docs = [(1000 + k, " ".join(f"common{rng.randrange(60)}" for _ in range(80)))
            for k in range(300)]
    for i, item in enumerate(items):
        rare = [f"rare{i}x{k}" for k in range(400)]
        docs.append((i, " ".join(rare[:200] + item + rare[200:])))
    got = d.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)],
                              "item_id long, text string"))
    assert {(i, i) for i in range(5)} <= {(r["doc_id"], r["item_id"]) for r in got.collect()}


def test_neighbours_change_nothing(spark):
    rng = random.Random(9)
    items = [[f"common{rng.randrange(300)}" for _ in range(n)] for n in (5, 16, 31, 100)]
    docs = []
    for i, item in enumerate(items):
        docs += [(10 * i, " ".join(item)),
                 (10 * i + 1, " ".join(item + [f"end{i}x{k}" for k in range(30)])),
                 (10 * i + 2, " ".join([f"start{i}x{k}" for k in range(30)] + item))]
        docs += [(1000 + 10 * i + k, " ".join(f"rare{i}x{k}x{m}" for m in range(200)))
                 for k in range(3)]
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)],
                                      "item_id long, text string")
    def found(rows, partitions):
        made = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
        return {tuple(r) for r in d.find_leaks(made.coalesce(partitions), benchmark).collect()}
    got = found(docs, 1)
    assert {(r[0], r[2]) for r in got} == {(10 * i + k, i) for i in range(4) for k in range(3)}
    assert found(docs[::-1], 1) == got and found(docs, 7) == got


def test_long_items_are_judged_as_a_whole(spark):
    rng = random.Random(10)
    sizes = {i: n for i, n in enumerate((121, 122, 241))}
    items = {i: [f"w{i}x{k}" for k in range(n)] for i, n in sizes.items()}
    items[3] = [f"q{k}" for k in range(200)] + ["so?", "answer", "is", "forty", "two"]
    def other(n):
        return [f"plain{rng.randrange(500)}" for _ in range(n)]
    docs = [(100 + k, " ".join(other(100))) for k in range(100)]
    for i, n in sizes.items():
        docs += [(i, " ".join(other(30) + items[i] + other(30))),
                 (10 + i, " ".join(other(40) + items[i][-1:] + other(40))),
                 (20 + i, " ".join(other(40) + items[i][:n // 3] + other(40)))]
    docs += [(3, " ".join(other(30) + items[3][:130] + other(60) + items[3][-5:] + other(30))),
             (13, " ".join(other(30) + items[3][:130] + other(60)))]
    got = d.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()],
                              "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["answer"] for r in got} == {
        (0, 0): True, (1, 1): True, (2, 2): True, (3, 3): True}


def test_ids_of_other_types(spark):
    text = "the quick brown fox jumps over the lazy dog again"
    others = [(f"{i}", f"nothing{i} like{i} it{i} here{i}") for i in range(9)]
    docs = spark.createDataFrame([("100", text), (None, text), *others], "doc_id string, text string")
    benchmark = spark.createDataFrame([("5", text)], "item_id string, text string")
    for kind in ("smallint", "decimal(9,2)", "binary", "timestamp", "double"):
        cast = "timestamp_seconds(cast({} AS int))" if kind == "timestamp" else "cast({} AS " + kind + ")"
        made = docs.selectExpr(cast.format("doc_id") + " AS doc_id", "text")
        items = benchmark.selectExpr(cast.format("item_id") + " AS item_id", "text")
        got = d.find_leaks(made, items)
        assert got.schema["doc_id"].dataType == made.schema["doc_id"].dataType
        want = made.where(f"text = '{text}'").select("doc_id").collect()
        assert sorted(map(str, (r["doc_id"] for r in got.collect()))) == sorted(
            str(r["doc_id"]) for r in want)


def test_passage_frequencies_against_plain_counting(spark):
    rng = random.Random(12)
    texts = [" ".join(zipf_words(rng, n, 300)) + " ... !" for n in (0, 1, 79, 80, 81, 400)]
    docs = spark.createDataFrame([(t,) for t in [*texts, texts[4]]], "text string").selectExpr("cast(text AS binary) AS text")
    counts, total = d.passage_frequencies(docs)
    want, parts = np.zeros(d.BUCKETS, int), 0
    for t in [*texts, texts[4]]:
        words = d.words_of(t.encode())
        for i in range(0, len(words), 80):
            parts += 1
            for b in {d.bucket(w) for w in words[i:i + 80]}:
                want[b] += 1
    assert total == parts and np.array_equal(counts, want)
