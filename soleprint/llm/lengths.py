"""Exact token counts: a histogram of encoded lengths, and what suffix sums over it answer."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soleprint.llm.encode import encoded

# Lengths that one task sums up before blocks are put together.
BLOCK = 4096


def token_lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``n_tokens`` of each row; 0 for a null or empty text.

    Repeated rows are counted one by one, very long texts whole; an empty table gives none.
    """
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids in encoded(batches, tokenizer):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(one) // 4 for one in ids], pa.int64())], ["n_tokens"])

    return rows.mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens`` and ``n_docs``: the number of rows of each length, repeated rows included."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """What a context of ``n_tokens`` means for the whole table, for every length that occurs.

    Answers for the limits between two lengths follow from those of the next shorter one: if d
    documents are longer than L, a limit of L + x keeps x * d tokens more.

    ``n_docs``: documents of just that length; ``docs_over``: longer ones; ``tokens_over``: all
    tokens of the longer ones; ``total_tokens``: of all documents; ``kept_tokens``: what is left if
    every document is cut off at the limit; ``lost_tokens``: the rest; ``share_fitting``: the share
    of documents that fit, so that the p quantile is the smallest length with a share of p or more.
    An empty histogram gives no rows.

    Suffix sums are taken in two steps, within blocks of lengths and over the blocks, so no task
    gets all lengths.
    """
    rows = histogram.select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / BLOCK).alias("block"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    def over(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))
    blocks = rows.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens")).select(
        "block", over("block_docs", after).alias("docs_after"),
        over("block_tokens", after).alias("tokens_after"),
        F.sum("block_docs").over(every).alias("all_docs"),
        F.sum("block_tokens").over(every).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, -1)
    sums = rows.join(blocks, "block").select(
        "n_tokens", "n_docs", "all_docs", "total_tokens",
        (over("n_docs", inside) + F.col("docs_after")).alias("docs_over"),
        (over("tokens", inside) + F.col("tokens_after")).alias("tokens_over"))
    kept = (F.col("total_tokens") - F.col("tokens_over")
            + F.col("n_tokens") * F.col("docs_over"))
    return sums.select(
        "n_tokens", "n_docs", "docs_over", "tokens_over", "total_tokens",
        kept.alias("kept_tokens"), (F.col("total_tokens") - kept).alias("lost_tokens"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("share_fitting"))
