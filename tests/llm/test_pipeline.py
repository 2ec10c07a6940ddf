"""The pipeline's stages on whole small tables: each decision takes effect, and nothing else."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from soleprint.llm import decontaminate, mixing, quality, simhash
from soleprint.llm.catalog import tokenizer_path


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    tables, now = [docs.cache()], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir).cache()
        assert now.columns == docs.columns
        tables.append(now)
    raw, good, single, clean, mixed = tables
    judged = quality.line_quality(raw).where("kept").select("doc_id", "cleaned").collect()
    assert dict(good.select("doc_id", "text").collect()) == {r[0]: r[1] for r in judged}
    groups = simhash.near_duplicates(good).select("component_id").distinct().collect()
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(r[0] for r in groups)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = {r["doc_id"] for r in decontaminate.find_leaks(single, benchmark).collect()}
    assert leaked
    ids = {r["doc_id"] for r in single.collect()}
    assert {r["doc_id"] for r in clean.collect()} == ids - leaked
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_copies(clean).collect()}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in copies.items() if n}

    texts = sorted((r["doc_id"], r["text"]) for r in mixed.collect())
    result = corpus_pipeline.STAGES[-1][1](spark, mixed, sf_dir).orderBy("start").collect()
    assert [r["doc_id"] for r in result] == [d for d, _ in texts]
    plain, at = Tokenizer.from_file(tokenizer_path()), 0
    for row, (_, text) in zip(result, texts, strict=True):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (row["start"], row["n_tokens"]) == (at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes())
        at += len(ids)


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_odd_rows_through_all_stages(spark, sf_dir):
    """Null ids, texts and sources, repeated rows, and further columns, a map among them, under
    names that the operators use themselves."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = quality.line_quality(docs).where("kept").select("doc_id", "cleaned").orderBy("doc_id")
    texts = [r["cleaned"] for r in good.limit(12).collect()]
    long = " ".join(texts[:3] * 40)
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    rows += rows[:2] * 3 + [(None, texts[5], None, None, None), (None, None, None, None, None),
                            (90, None, "en", "s0", 0), (91, "", "en", None, 0),
                            (92, long, "en", "s1", len(long))]
    rows = [(*row, {"k": n}, n, "x", [n], 0.5) for n, row in enumerate(rows)]
    now = spark.createDataFrame(rows, (
        "doc_id long, text string, lang string, source string, n_chars int, fp map<string,int>, "
        "size int, part string, ids array<int>, copies double"))
    columns, left = now.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir).cache()
        assert now.columns == columns
        left.append(now.collect())
    judged, single, clean, mixed = left
    assert {r["doc_id"] for r in judged} >= set(range(12)) and None not in [r["text"] for r in judged]
    assert sum(r["doc_id"] == 0 for r in judged) == 4
    ids = [r["doc_id"] for r in single]
    assert len(ids) == len(set(ids)) and set(ids) <= {r["doc_id"] for r in judged}
    assert len({r["text"] for r in single}) == len(single) >= 5
    assert all(r in single for r in clean) and all(r in clean for r in mixed)
    result = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    assert sorted(r["doc_id"] or -1 for r in result) == sorted(r["doc_id"] or -1 for r in mixed)
