"""Running values over ordered rows, without putting an unbounded group into one task.

``Window.partitionBy(key).orderBy(ts)`` sorts all rows of a key in one task. That is right for
keys of bounded size and is what happens here to those. A key that holds more rows is cut into
consecutive slices, each slice is reduced to one value per running column, those few values are
scanned to give what every slice starts with, and the rows are then scanned slice by slice. The
starting value enters a slice as one more row that sorts first, so rows are shuffled once and
never joined with it.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from soleprint.session import shared_dir

# The most rows one task is asked to sort as one group.
SLICE_ROWS = 4_000_000
# The most rows of a list of keys or slices that are broadcast; longer lists are shuffled.
BROADCAST_ROWS = 10_000
# A slice that is too full is cut at so many quantiles, found by sketches of this size, and what is
# still too full once more, up to so many times.
CUTS, SKETCH, ROUNDS = 63, 800, 3

_HOT, _SLICE, _ROWS, _IS_ROW, _FIXED = "_hot", "_slice", "_rows", "_is_row", "_fixed"
# Before any real span, and small enough to be cut further.
_NO_TIME = -(2**40)


@dataclass(frozen=True)
class Running:
    """One running column: ``count``, ``max`` or ``last`` (last non-null) of ``value`` so far."""

    name: str
    kind: str
    value: Column | None = None

    def source(self) -> Column:
        return F.lit(1).cast("long") if self.kind == "count" else self.value

    def scan(self) -> Column:
        held = F.col(self.name)
        if self.kind == "last":
            return F.last(held, ignorenulls=True)
        return F.sum(held) if self.kind == "count" else F.max(held)


def prefix_scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], running: Sequence[Running],
    slice_seconds: int = 60, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``df`` plus the running columns, per ``keys`` in ``order``, each row's own value included.

    ``order`` starts with a timestamp column and must tell rows of a key apart. Keys with more
    than ``slice_rows`` rows, and all rows where there are no keys, are sliced into spans of
    ``slice_seconds``; a span that still holds more is cut further, see ``_cut_full``, which no
    skew in keys or times makes uneven. Rows are never written or sampled for it.
    """
    keys, order = list(keys), list(order)
    columns = df.columns
    for item in running:
        df = df.withColumn(item.name, item.source())

    if keys:
        hot = _hot_groups(df, keys, slice_rows)
        if hot is None:
            return _scan_slices(df.withColumn(_SLICE, F.lit(0)), keys, order, running, columns)
        marked = _mark(df, hot, keys)
    else:
        shared_dir(df.sparkSession)
        marked = df.withColumn(_HOT, F.lit(True))

    # Rows without a time sort first, so they form the first slice.
    span = F.coalesce(F.floor(F.unix_seconds(order[0]) / slice_seconds), F.lit(_NO_TIME))
    rows = marked.withColumn(_SLICE, F.when(F.col(_HOT), span)).drop(_HOT)
    rows, sizes = _cut_full(rows, keys, order, running, slice_rows)
    sliced = rows.where(F.col(_SLICE).isNotNull())
    starts = _starts(sliced, sizes, keys, order, running)
    seeded = rows.withColumn(_IS_ROW, F.lit(True)).unionByName(
        starts.withColumn(_IS_ROW, F.lit(False)), allowMissingColumns=True)
    return _scan_slices(seeded, keys, [_IS_ROW, *order], running, columns, _IS_ROW)


def _hot_groups(df: DataFrame, keys: list[str], slice_rows: int) -> DataFrame | None:
    """The keys with more than ``slice_rows`` rows, if any: at most all rows / ``slice_rows``."""
    shared_dir(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    hot = counts.where(F.col(_ROWS) > slice_rows).select(*keys).withColumn(
        _HOT, F.lit(True)).checkpoint()
    return None if hot.isEmpty() else hot


def _attach(df: DataFrame, listed: DataFrame, by: list[str]) -> DataFrame:
    """``df`` with the other columns of ``listed``, a checkpointed list with one row per ``by``;
    nulls are equal. Broadcast only while it is short."""
    names = {name: f"_listed_{i}" for i, name in enumerate(by)}
    renamed = listed.withColumnsRenamed(names)
    if listed.count() <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    same = F.lit(True)
    for name, other in names.items():
        same = same & F.col(name).eqNullSafe(F.col(other))
    return df.join(renamed, same, "left").drop(*names.values())


def _mark(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``_hot``: true for rows of a hot key."""
    return _attach(df, hot, keys)


def _as_longs(df: DataFrame, order: list[str]) -> list[Column]:
    """The order's columns as long integers, up to the first that is no whole number or time."""
    found = []
    for name in order:
        kind = df.schema[name].dataType
        if isinstance(kind, T.TimestampType):
            found.append(F.unix_micros(name))
        elif isinstance(kind, T.IntegralType):
            found.append(F.col(name).cast("long"))
        else:
            break
    return [F.coalesce(value, F.lit(-(2**63))) for value in found]


def _cut_full(
    rows: DataFrame, keys: list[str], order: list[str], running: Sequence[Running],
    slice_rows: int,
) -> tuple[DataFrame, DataFrame]:
    """``rows`` with finer slices where one holds more than ``slice_rows`` rows, and their sizes.

    A sketch per full slice gives quantiles of the first order column whose values differ in it. A
    value that is a quantile becomes a slice of its own, and so do the values between two of them:
    few rows lie between two quantiles, and a value that very many rows share is cut by the next
    order column in the next round. The slice of a row is so an expression of its own columns and
    of its full slice's quantiles. Columns after one that is no whole number or time are not used.
    """
    values = _as_longs(rows, order)
    rows = rows.withColumn(_FIXED, F.lit(0))  # order columns that have one value in the slice
    sizes = _sizes(rows.where(F.col(_SLICE).isNotNull()), keys, running)
    ranks = ", ".join(f"{i / (CUTS + 1)}D" for i in range(1, CUTS + 1))
    for _ in range(ROUNDS):
        full = sizes.where((F.col(_ROWS) > slice_rows) & (F.col(_FIXED) < len(values)))
        full = full.select(*keys, _SLICE, F.lit(True).alias("_full")).checkpoint()
        if full.isEmpty():
            break
        by = [*keys, _SLICE]
        value = F.coalesce(*[F.when(F.col(_FIXED) == i, v) for i, v in enumerate(values)])
        quantiles = _attach(rows, full, by).where("_full").withColumn("_value", value).groupBy(
            *by).agg(F.expr(f"kll_sketch_agg_bigint(_value, {SKETCH})").alias("_sketch")).select(
            *by, F.expr("array_distinct(kll_sketch_get_quantile_bigint("
                        f"_sketch, array({ranks})))").alias("_cuts")).checkpoint()
        below = F.size(F.filter("_cuts", lambda cut: cut < value))
        on_cut = F.coalesce(F.array_contains("_cuts", value), F.lit(False)).cast("int")
        place = F.when(F.col("_cuts").isNull(), 0).otherwise(2 * below + on_cut)
        rows = _attach(rows, quantiles, by).withColumns({
            _SLICE: F.col(_SLICE) * (2 * CUTS + 2) + place, _FIXED: F.col(_FIXED) + on_cut,
        }).drop("_cuts")
        sizes = _sizes(rows.where(F.col(_SLICE).isNotNull()), keys, running)
    return rows.drop(_FIXED), sizes.drop(_FIXED)


def _starts(
    sliced: DataFrame, sizes: DataFrame, keys: list[str], order: list[str],
    running: Sequence[Running],
) -> DataFrame:
    """What each slice starts with: the running columns over all slices of the key before it.

    A hot key has a few rows here per slice, and as many slices as its rows need.
    """
    reduced = sizes.withColumn(_IS_ROW, F.lit(True))
    for item in running:
        if item.kind == "last":
            reduced = reduced.unionByName(
                _last_values(sliced, keys, order, item).withColumn(_IS_ROW, F.lit(False)),
                allowMissingColumns=True)
    before = Window.partitionBy(*keys).orderBy(_SLICE).rangeBetween(
        Window.unboundedPreceding, -1)
    return reduced.select(
        *keys, _SLICE, _IS_ROW,
        *[item.scan().over(before).alias(item.name) for item in running],
    ).where(_IS_ROW).drop(_IS_ROW).dropna("all", subset=[item.name for item in running])


def _scan_slices(
    rows: DataFrame, keys: list[str], order: list[str], running: Sequence[Running],
    columns: list[str], keep: str | None = None,
) -> DataFrame:
    within = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    scanned = rows.select(
        "*", *[item.scan().over(within).alias(f"_run_{item.name}") for item in running])
    if keep:
        scanned = scanned.where(keep)
    return scanned.select(
        *columns, *[F.col(f"_run_{item.name}").alias(item.name) for item in running])


def _sizes(sliced: DataFrame, keys: list[str], running: Sequence[Running]) -> DataFrame:
    """Rows, counts and maxima per key and slice, written once: it is read for the size check
    and for the scan. Plain numbers only, so the aggregate is a hash aggregate."""
    return sliced.groupBy(*keys, _SLICE).agg(
        F.count(F.lit(1)).alias(_ROWS), F.max(_FIXED).alias(_FIXED),
        *[(F.sum if item.kind == "count" else F.max)(item.name).alias(item.name)
          for item in running if item.kind != "last"],
    ).checkpoint()


def _last_values(
    sliced: DataFrame, keys: list[str], order: list[str], item: Running
) -> DataFrame:
    """The last value per key and slice, from the rows that have one."""
    return sliced.where(F.col(item.name).isNotNull()).groupBy(*keys, _SLICE).agg(
        F.max_by(item.name, F.struct(*order)).alias(item.name))
