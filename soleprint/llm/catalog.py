"""Registered queries of this package, over whole tables, and their SQL where there is one."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soleprint.llm import (
    classifier, decontaminate, lexical, negatives, ngram, phrases, quality, simhash, suffix,
    url_filter,
)
from soleprint.llm.lengths import context_limits, length_histogram, token_lengths
from soleprint.llm.mixing import mix_copies
from soleprint.llm.oracles import ORACLES  # noqa: F401
from soleprint.llm.tables import shared_path, written
from soleprint.llm.token_file import read_tokens, token_index, write_tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op10_line_quality(spark, sf_dir):
    judged = quality.line_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@register
def op6_url_cascade(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.sample_list(pages))


@register
def op1_simhash(spark, sf_dir):
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op4_length_histogram(spark, sf_dir):
    lengths = token_lengths(table(spark, sf_dir, "documents"), tokenizer_path())
    # The suffix sums read the histogram twice; texts are encoded once.
    return context_limits(written(length_histogram(lengths), "lengths"))


@register
def op7_token_orc(spark, sf_dir):
    path = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_index(read_tokens(spark, path))


@register
def op9_entropy_mix(spark, sf_dir):
    mixed = mix_copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


@register
def op5_quality_embeddings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = F.coalesce(classifier.fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = classifier.train(docs, labels.where(~held_out))
    return classifier.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@register
def op2_decontamination(spark, sf_dir):
    leaks = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", F.round("share", 6).alias("share"),
                        F.round("cosine", 4).alias("cosine"), "answer")


@register
def op8_suffix_dedup(spark, sf_dir):
    cut = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return cut.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"),
                      F.octet_length("kept").cast("long").alias("n_kept"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@register
def op3_interpolated_lm(spark, sf_dir):
    held_out = F.coalesce(classifier.fold(F.col("doc_id"), 7) == 2, F.lit(False))
    scored = ngram.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@register
def op11_bond_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@register
def op12_shared_ranking(spark, sf_dir):
    return lexical.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op13_phrase_automata(spark, sf_dir):
    shape = phrases.Shape()
    texts, rows = phrases.remove_phrases(table(spark, sf_dir, "documents"), shape)
    digests = texts.withColumn("kept", F.sha2("kept", 256))
    cut = phrases.for_rows(digests, rows, shape, "kept", F.sha2(F.lit(""), 256))
    return cut.select("doc_id", "n_words", "n_removed",
                      (F.col("n_words") - F.col("n_removed")).alias("n_kept"),
                      F.col("kept").alias("kept_sha256"))
