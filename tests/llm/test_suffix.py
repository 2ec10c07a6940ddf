"""Removed bytes against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from soleprint.llm import suffix
from soleprint.llm.catalog import QUERIES


def plain(texts, length):
    """For each text the bytes that stay and the number of removed runs."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield bytes(b for b, g in zip(t, gone, strict=True) if not g), runs


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = [(t or "").encode() for _, t in docs]
    got = {r["doc_id"]: r for r in QUERIES["op8_suffix_dedup"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    hit = 0
    for (doc_id, _), text, (kept, runs) in zip(docs, texts, plain(texts, 400), strict=True):
        row = got[doc_id]
        assert row["n_bytes"] == len(text) and row["n_removed"] == len(text) - len(kept), doc_id
        assert row["n_spans"] == runs
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        hit += runs > 0
    assert hit > 50


@pytest.mark.parametrize("length", [30, 100])
def test_made_up_texts(spark, length):
    rng = random.Random(length)
    def noise(n, alphabet="abcdefgh "):
        return "".join(rng.choice(alphabet) for _ in range(n))
    shared = [noise(n) for n in (length - 1, length, length + 1, 3 * length, 9 * length)]
    texts = [noise(rng.randrange(200)) + rng.choice(shared) + noise(rng.randrange(200))
             for _ in range(40)]
    texts += [shared[3], shared[3], "", None, "a" * (4 * length), "ab" * length, noise(40, "ab"),
              shared[4][: 2 * length] + "X" + shared[4][2 * length:], "é" * length,
              noise(500) + shared[4][5:] + shared[4][:-7], noise(30_000)]
    docs = spark.createDataFrame(
        [(i if i % 7 else None, t, 0, i) for i, t in enumerate(texts)],
        "doc_id long, text string, a int, t1 int")
    got = suffix.remove_repeats(docs, length).select("n_bytes", "kept", "removed").collect()
    raw = [(t or "").encode() for t in texts]
    want = sorted((len(t), kept, runs)
                  for t, (kept, runs) in zip(raw, plain(raw, length), strict=True))
    assert sorted((r["n_bytes"], bytes(r["kept"]), len(r["removed"])) for r in got) == want
    assert suffix.remove_repeats(docs.limit(0), length).count() == 0


def noise(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def test_a_chunk_sends_what_is_equal_in_it_once():
    rng, scale = random.Random(1), suffix.Scale(100)
    line = noise(rng, 250)

    def sent(texts):
        ends = np.cumsum([len(t) for t in texts])
        return suffix._sent_cells(suffix.cells("".join(texts).encode(), ends, scale))
    copy = noise(rng, 900)
    few, sure, left = sent([copy] * 2)
    many, more, _ = sent([copy] * 50)
    assert len(few) == len(many) > 0 and len(more) == 25 * len(sure) and not len(left)
    # A line that every text has, with other text around it: its cores go out once each.
    rows, _, left = sent([noise(rng, 300) + line + noise(rng, 300) for _ in range(50)])
    assert len(np.unique(rows["k"])) == len(rows) and len(left) >= 50
    assert (rows["known"] == suffix.SEVERAL).any()
    strings = suffix._strings((copy + copy).encode(), np.array([[0, 9], [900, 909]], np.int32), 100)
    rows, sure = suffix._sent_strings(strings)
    assert len(rows) == 10 and (rows["start"] < 0).all() and len(sure) == 20


@pytest.mark.parametrize("parts", [1, 40])
def test_chunks_of_all_tasks_meet(spark, parts):
    rng = random.Random(parts)
    line, copy = noise(rng, 260), noise(rng, 700)
    texts = [noise(rng, rng.randrange(300)) + line + noise(rng, rng.randrange(300))
             for _ in range(60)] + [copy] * 30
    texts += [copy[:i] + "X" + copy[i:] for i in range(0, 700, 35)] + [noise(rng, 400)] * 2
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix.remove_repeats(docs.repartition(parts), 100).select(
        "doc_id", "kept", F.size("removed")).collect()
    want = plain([t.encode() for t in texts], 100)
    assert sorted((d, bytes(k), n) for d, k, n in got) == [
        (i, kept, runs) for i, (kept, runs) in enumerate(want)]


def test_passages_go_by_bytes_not_by_words(spark):
    """60 short words under 400 bytes stay, as the contract has it; 400 bytes go."""
    rng = random.Random(3)
    short, long = (" ".join(noise(rng, n).replace(" ", "x") for _ in range(60)) for n in (5, 6))
    assert len(short) < 400 < len(long)
    texts = [noise(rng, 50) + p + noise(rng, 50) for p in (short, short, long, long)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = dict(suffix.remove_repeats(docs).select("doc_id", F.octet_length("kept")).collect())
    assert sizes[0] == sizes[1] == len(texts[0]) and max(sizes[2], sizes[3]) <= 100


def test_rows_hold_one_text_and_bounded_messages(spark):
    """Rows of many texts took an executor's heap; so do messages with all that a chunk knows."""
    rng = random.Random(4)
    texts = [noise(rng, rng.randrange(300)) for _ in range(200)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = suffix._chunks(docs, "doc_id", "text").select("doc_id", "bytes", "chunk", "no").collect()
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in rows} == {
        i: t or "" for i, t in enumerate(texts)}
    assert len({(r["chunk"], r["no"]) for r in rows}) == len(texts)
    size, rows = suffix.KNOWN_BYTES, np.zeros(9, suffix.STRING)
    rows["h1"], known = np.arange(9), rng.randbytes(5 * suffix.KNOWN_BYTES + 8)
    sent = suffix._asked(3, rows, "h1", 9, known, b"").to_pydict()
    assert sorted(map(len, sent["sure"])) == [0, 0, 0, 8] + [size] * 5
    assert b"".join(sent["sure"][3:] + sent["sure"][:3]) == known


def test_settings_come_back(spark):
    from soleprint.llm.tables import BATCHES
    before = {name: spark.conf.get(name) for name in BATCHES}
    docs = spark.createDataFrame([(1, "a" * 500)], "doc_id long, text string")
    assert [len(r["kept"]) for r in suffix.remove_repeats(docs).collect()] == [0]
    assert {name: spark.conf.get(name) for name in BATCHES} == before
