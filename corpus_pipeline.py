"""The corpus pipeline: five stages from ``documents`` to token ids.

Each stage works on all rows that the one before it kept, and each but the last returns the columns
it was given.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from soleprint.llm import decontaminate, mixing, quality, simhash, token_file
from soleprint.llm.catalog import tokenizer_path
from soleprint.llm.tables import shared_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that lose too much or fail the base rules."""
    return quality.keep_quality(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, none to three times."""
    return mixing.mix_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files, and what the files hold: id, place, length and checksum."""
    path = shared_path(spark, "tokens")
    token_file.write_tokens(docs, path, tokenizer_path())
    return token_file.token_index(token_file.read_tokens(spark, path))


STAGES: list[tuple[str, Stage]] = [
    ("line_quality", quality_stage), ("simhash_dedup", dedup_stage),
    ("decontaminate", decontaminate_stage), ("entropy_mix", mix_stage),
    ("token_orc", token_stage),
]

# SQL can express neither the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; what each stage keeps is written to the shared folder and read
    again, so that no later one computes it anew."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
