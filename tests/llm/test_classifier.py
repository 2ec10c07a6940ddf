"""Held-out accuracy, repeatability and edge rows of the classifier."""

import zlib

import numpy as np
import pytest

from soleprint.llm import classifier
from soleprint.llm.catalog import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op5_quality_embeddings"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["quality"], got[r["doc_id"]]["predicted"]) for r in labels
            if got[r["doc_id"]]["held_out"]]
    for label in (0, 1):
        own = [p == q for q, p in held if q == label]
        assert np.mean(own) >= 0.9, (label, np.mean(own), len(own))


def test_features_of_many_words_are_those_of_each():
    words = [b"a", b"bc", "ñandú".encode(), b"abcdef"]
    owners, buckets = classifier.word_features(words)
    for i, word in enumerate(words):
        alone = classifier.word_features([word])[1]
        assert sorted(buckets[owners == i]) == sorted(alone)
        assert len(alone) == 1 + sum(max(0, len(word) + 3 - n) for n in classifier.NGRAMS)


def test_score_is_softmax_of_averages():
    rng = np.random.default_rng(1)
    model = classifier.Model(rng.normal(size=1 << 16), 0.3)
    text = b"one two two three"
    used, share = classifier.text_features(text)
    assert share.sum() == pytest.approx(1)
    want = 1 / (1 + np.exp(-(share @ model.values[used] + 0.3)))
    assert classifier.score_texts([text, b""], model)[0] == pytest.approx(want)


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "good text", 5), (1, "good text", 5), (2, None, 5), (None, "bad", 5), (3, "", 5),
         (4, "w " * 300_000, 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (3, None), (4, 0), (4, 1)],
                                   "doc_id long, label int")
    model = classifier.train(docs, labels)
    got = classifier.score(docs, model)
    assert got.count() == 6 and got.where("score BETWEEN 0 AND 1").count() == 6
    assert classifier.score(docs.limit(0), model).count() == 0
    assert classifier.train(docs.limit(0), labels).bias == 0


def test_repeated_rows_of_an_id_are_one_training_row(spark):
    texts = [(i, ("good clear words " if i % 2 else "bad noisy marks ") * (1 + i % 5))
             for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")
    def model(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return classifier.train(docs, labels, classifier.Training(sample=10))
    once, often = model(texts), model(texts + [t for t in texts for _ in range(30)])
    assert np.array_equal(once.values, often.values) and once.bias == often.bias
