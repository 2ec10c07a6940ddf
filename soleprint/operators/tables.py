"""Keyed tables: upsert, their update log, and log compaction."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soleprint.operators.scan import SLICE_ROWS, Running, prefix_scan


def select_key(df: DataFrame, column: str, key: str = "key") -> DataFrame:
    """Set the record key to a field. No shuffle: a later join or grouping plans its own."""
    return df.withColumn(key, F.col(column).cast("string"))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in ``order``: a table from its log, or a compacted log.

    Rows without a key are dropped. The latest row is found map-side first, so a hot key
    sends one row per task through the shuffle.
    """
    rest = [name for name in df.columns if name not in keys]
    return (
        df.dropna("any", subset=list(keys))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*[F.col(name) if name in keys else F.col(f"_last.{name}") for name in df.columns])
    )


def table_changelog(
    df: DataFrame, key: str, order: Sequence[str], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Every update of a keyed table, in order, numbered per key from 1 in ``version``."""
    return prefix_scan(
        df.dropna("any", subset=[key]), [key], order, [Running("version", "count")],
        slice_rows=slice_rows,
    )
