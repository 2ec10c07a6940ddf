"""Counts and base scores against brute force, the mixture against its definition."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from soleprint.llm import ngram
from soleprint.llm.catalog import QUERIES


def plain_tokens(text):
    return [*(text or "").encode().lower().split(), None]


def plain_base(rows, learned):
    counts = Counter(w for (_, t), use in zip(rows, learned, strict=True) if use
                     for w in plain_tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    for _, t in rows:
        own = plain_tokens(t)
        yield (len(own), sum(counts[w] > 0 for w in own), total,
               sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own))


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    got = {r["doc_id"]: r for r in QUERIES["op3_interpolated_lm"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    gain = 0
    for (d, _), h, (n, known, total, base) in zip(
            rows, held, plain_base(rows, [not h for h in held]), strict=True):
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            h, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        gain += (r["score"] - base) if h else 0
    assert gain > 0  # bigrams help on texts that were not learned from


def test_probabilities_add_up_and_chunks_do_not_matter(spark):
    texts = ["a b a b c", "a b", "c a", "", "b b b a c c a"]
    rows = [(i, t) for i, t in enumerate(texts)]
    probes = [(100 + i, f"a {w}") for i, w in enumerate("abc")]
    docs = spark.createDataFrame(rows + probes, "doc_id long, text string")
    learn = F.col("doc_id") < 100
    one = {r["doc_id"]: r for r in ngram.score_texts(docs, learn).collect()}
    many = {r["doc_id"]: r for r in ngram.score_texts(
        docs, learn, shape=ngram.Shape(chunk_bytes=4, parts=3)).collect()}
    for d, r in one.items():
        assert many[d]["score"] == pytest.approx(r["score"], rel=1e-9)
        assert many[d]["n_known"] == r["n_known"]
    # c(a b) / c(a) and so on, for all that may follow "a", with the rest for unseen words.
    table = np.zeros((ngram.BUCKETS, ngram.STEPS, ngram.STEPS))
    table[3, 5, 9] = 10
    weights = ngram.learn_weights(table, 0.1, 50)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0][0] == 0


def test_weights_maximise_held_out_likelihood():
    rng = np.random.default_rng(2)
    table = np.zeros((ngram.BUCKETS, ngram.STEPS, ngram.STEPS))
    for _ in range(300):
        table[4, rng.integers(0, 40), rng.integers(1, 90)] += rng.integers(1, 9)
    weights = ngram.learn_weights(table, 1e-4, 300)[4]
    value = np.where(np.arange(ngram.STEPS) > 0, 2.0 ** (-(np.arange(ngram.STEPS) - 1) / 4), 0)
    def likelihood(w):
        p = w[0] * value[:, None] + w[1] * value[None, :] + w[2] * 1e-4
        return (table[4] * np.log(p)).sum()
    best = max(likelihood(np.array([a, b, 1 - a - b])) for a in np.arange(0.01, 1, 0.01)
               for b in np.arange(0.01, 1 - a, 0.01) if a + b < 1)
    assert likelihood(weights) >= best - 0.05


def test_edges(spark):
    rows = [(1, "x y"), (1, "x y"), (None, None), (2, ""), (3, "w " * 200_000), (4, "X Y z")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = ngram.score_texts(docs, F.col("doc_id") != 4).collect()
    assert len(got) == 6 and all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    learned = [d not in (None, 4) for d, _ in rows]
    want = sorted((n, known, total) for n, known, total, _ in plain_base(rows, learned))
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == want
    assert ngram.score_texts(docs.limit(0), F.lit(True)).count() == 0
    none = ngram.score_texts(docs, F.lit(None).cast("boolean")).collect()
    assert all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in none)


def plain_scores(rows, learned, rounds):
    """The definition, token by token: ratios in steps of a quarter of a power of two, each token
    taken out of the counts, weights by expectation-maximisation per bucket of contexts."""
    texts = [plain_tokens(t) for _, t in rows]
    word, pair, context = Counter(), Counter(), Counter()
    for own, use in zip(texts, learned, strict=True):
        for u, w in zip(["start", *own], own, strict=False):
            word[w] += use
            pair[u, w] += use
            context[u] += use
    total, kinds = sum(word.values()), sum(c > 0 for c in word.values())

    def bucket(count):
        return min(int(count).bit_length(), ngram.BUCKETS - 1)

    def stepped(a, b):
        if a <= 0 or b <= 0:
            return 0.0
        return 2.0 ** (-min(round(-4 * math.log2(a / b)), ngram.STEPS - 2) / 4)

    seen = {}
    for own, use in zip(texts, learned, strict=True):
        for u, w in zip(["start", *own], own, strict=False):
            if use:
                c = context[u] - 1
                seen.setdefault(bucket(c), []).append(
                    (stepped(pair[u, w] - 1, c), stepped(word[w] - 1, max(1, total - 1)),
                     1 / (kinds + 1)))
    weights = {}
    for b, cells in [*seen.items(), (None, [c for own in seen.values() for c in own])]:
        mix = [1 / 3] * 3
        for _ in range(rounds):
            shares = [0.0] * 3
            for cell in cells:
                parts = [m * v for m, v in zip(mix, cell, strict=True)]
                for i, v in enumerate(parts):
                    shares[i] += v / sum(parts)
            mix = [s / len(cells) for s in shares]
        mix = [max(m, 1e-9) for m in mix]
        weights[b] = [m / sum(mix) for m in mix]
    zero = weights.get(0, weights[None])
    weights[0] = [0, *(m / sum(zero[1:]) for m in zero[1:])]
    for own in texts:
        score = 0.0
        for u, w in zip(["start", *own], own, strict=False):
            mix = weights.get(bucket(context[u]), weights[None])
            follows = pair[u, w] / context[u] if context[u] else 0
            score += math.log10(mix[0] * follows + mix[1] * word[w] / total + mix[2] / (kinds + 1))
        yield score


def test_scores_against_the_plain_definition(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where(
        "doc_id < 60")
    rows = [tuple(r) for r in docs.collect()] + [(-1, None), (-2, "never seen words"), (-3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learned = [d % 3 != 0 and d >= 0 for d, _ in rows]
    got = {r["doc_id"]: r["score"] for r in ngram.score_texts(
        docs, (F.col("doc_id") % 3 != 0) & (F.col("doc_id") >= 0),
        shape=ngram.Shape(chunk_bytes=5000, parts=5, rounds=10)).collect()}
    for (d, _), want in zip(rows, plain_scores(rows, learned, 10), strict=True):
        assert got[d] == pytest.approx(want, rel=1e-9)


def test_chunks_are_even_and_messages_grow_with_the_texts(spark):
    def sizes(copies, parts):
        rows = spark.createDataFrame(
            [(7, b"the same words again and again", True)] * copies,
            "doc_id long, text binary, learn boolean").coalesce(1)
        made = ngram.encode(rows, 300, parts)
        return made.where("part IS NULL").count(), made.where("part IS NOT NULL").count()
    # Ten equal rows to a chunk; six words and their ends and start, seven pairs.
    assert sizes(500, 4)[0] == 50
    chunks, messages = sizes(500, 1 << 30)
    assert messages <= chunks * 14
    assert sizes(1000, 1 << 31) == (2 * chunks, 2 * messages)


def test_ids_of_other_types(spark):
    rows = [(bytearray(b"\xff\x00"), "a b"), (bytearray(b"\xfe"), "b"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id binary, text string")
    got = ngram.score_texts(docs, F.lit(True)).collect()
    assert {r["doc_id"] and bytes(r["doc_id"]) for r in got} == {b"\xff\x00", b"\xfe", None}
    made = docs.select(F.struct("doc_id", F.lit(1).cast("smallint").alias("x")).alias("doc_id"),
                       "text")
    assert ngram.score_texts(made, F.lit(True)).schema["doc_id"].dataType == made.schema[0].dataType
    assert len(ngram.score_texts(made, F.lit(True)).collect()) == 3
