"""Event-time windows: counts, their update log, grace and retention.

Windows are half-open, aligned to the epoch. Rows without a key are not counted.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soleprint.operators.joins import broadcastable, enrich
from soleprint.operators.scan import SLICE_ROWS, Running, prefix_scan


@dataclass(frozen=True)
class Windows:
    """Window size, advance and grace in seconds; the advance divides the size."""

    size: int
    advance: int
    grace: int

    def __post_init__(self) -> None:
        if self.size % self.advance:
            raise ValueError("the advance must divide the size")

    @property
    def tumbling(self) -> bool:
        return self.size == self.advance


# The windows and the retention of the two view counts.
TUMBLING = Windows(size=600, advance=600, grace=60)
HOPPING = Windows(size=600, advance=60, grace=60)
RETENTION_SECONDS = 1800

# The most windows of one block that are counted side by side.
MAX_COLUMNS = 60


def _seconds(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' SECOND")


def _align(seconds: Column, step: int) -> Column:
    """The last multiple of ``step`` up to a number of epoch seconds."""
    return seconds - F.pmod(seconds, F.lit(step))


def _with_bounds(df: DataFrame, windows: Windows, start: str) -> DataFrame:
    """Turn the epoch second in ``start`` into ``window_start`` and ``window_end``."""
    return (
        df.withColumn("window_start", F.timestamp_seconds(start))
        .withColumn("window_end", F.timestamp_seconds(F.col(start) + windows.size))
        .drop(start)
    )


def count_views(df: DataFrame, key: str, windows: Windows, ts: str = "ts") -> DataFrame:
    """Rows per key and window, as ``views``.

    On a stream this is one windowed aggregate behind a watermark of the grace; run it in
    update mode.
    """
    keyed = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if df.isStreaming:
        window = F.window(ts, f"{windows.size} seconds", f"{windows.advance} seconds")
        counted = (
            keyed.withWatermark(ts, f"{windows.grace} seconds")
            .groupBy(window.alias("_window"), key)
            .agg(F.count(F.lit(1)).alias("views"))
        )
        return counted.select(
            key, F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"), "views",
        )
    pane = _align(F.unix_seconds(ts), windows.advance)
    if windows.tumbling:
        counted = keyed.groupBy(key, pane.alias("_start")).agg(F.count(F.lit(1)).alias("views"))
        return _with_bounds(counted, windows, "_start").select(
            key, "window_start", "window_end", "views")
    placed = keyed.select(key, pane.alias("_last")).withColumn(
        "_first", F.col("_last") - (windows.size - windows.advance))
    return _count_starts(placed, key, windows)


def _count_starts(placed: DataFrame, key: str, windows: Windows) -> DataFrame:
    """Count each row in the windows that start from second ``_first`` to ``_last``.

    A row lies in up to size / advance windows, but their starts fall into at most two blocks
    of one window size. So a row is copied twice at most, and the windows that start in a block
    are counted side by side, one column each, in one aggregate with one shuffle.
    """
    per_block = windows.size // windows.advance
    if per_block > MAX_COLUMNS:
        starts = F.sequence("_first", "_last", F.lit(windows.advance))
        counted = placed.select(key, F.explode(starts).alias("_start")).groupBy(
            key, "_start").agg(F.count(F.lit(1)).alias("views"))
    else:
        blocks = F.sequence(
            _align(F.col("_first"), windows.size), _align(F.col("_last"), windows.size),
            F.lit(windows.size))
        offsets = [i * windows.advance for i in range(per_block)]
        side_by_side = placed.select("*", F.explode(blocks).alias("_block")).groupBy(
            key, "_block").agg(*[
                F.expr(f"count_if(_block + {offset} BETWEEN _first AND _last) AS _{offset}")
                for offset in offsets
            ])
        cells = ", ".join(f"struct(_block + {offset} AS start, _{offset} AS n)" for offset in offsets)
        counted = side_by_side.selectExpr(
            f"`{key}`", f"inline(array({cells})) AS (_start, views)").where("views > 0")
    return _with_bounds(counted, windows, "_start").select(
        key, "window_start", "window_end", "views")


def count_views_by_name(
    clicks: DataFrame, shoes: DataFrame, windows: Windows = TUMBLING,
    before_join: bool | None = None,
) -> DataFrame:
    """Views per product *name* and window; products that share a name are counted together.

    With a table too large to broadcast, clicks are counted per product id and window first,
    and one row per id and window is joined and summed. That removes hot products from the join.
    """
    if before_join is None:
        before_join = not clicks.isStreaming and not broadcastable(shoes)
    if not before_join:
        return count_views(enrich(clicks, shoes, salted=False), "product_name", windows)
    by_id = count_views(clicks, "product_id", windows)
    named = enrich(by_id, shoes, salted=False).where(F.col("product_name").isNotNull())
    return named.groupBy("product_name", "window_start", "window_end").agg(
        F.sum("views").alias("views"))


def views_changelog(
    df: DataFrame, key: str, windows: Windows = TUMBLING,
    order: Sequence[str] = ("ts", "event_id"), slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per counted row: the new count of its key and window, nothing merged.

    For hopping windows each row updates every window it lies in. A row is numbered once, within
    its advance; what its windows held before that is a sum of whole advances, the same for all rows
    of the advance. So rows are shuffled as they are, and copied to their windows afterwards.
    """
    keyed = df.where(F.col(key).isNotNull() & F.col("ts").isNotNull()).select(
        key, *order, _align(F.unix_seconds("ts"), windows.advance).alias("_pane"))
    steps = windows.size // windows.advance
    if steps > MAX_COLUMNS:
        starts = F.sequence(F.col("_pane") - (windows.size - windows.advance), "_pane",
                            F.lit(windows.advance))
        placed = _with_bounds(
            keyed.select(key, *order, F.explode(starts).alias("_start")), windows, "_start")
        return prefix_scan(
            placed, [key, "window_start", "window_end"], order, [Running("views", "count")],
            slice_rows=slice_rows,
        )
    numbered = prefix_scan(
        keyed, [key, "_pane"], order, [Running("_n", "count")], slice_rows=slice_rows)
    back = F.sequence(F.lit(1), F.lit(steps - 1)) if steps > 1 else F.array().cast("array<int>")
    later = keyed.groupBy(key, "_pane").agg(F.count(F.lit(1)).alias("_rows")).select(
        key, "_pane", "_rows", F.explode(back).alias("_back"))
    earlier = later.groupBy(
        key, (F.col("_pane") + F.col("_back") * windows.advance).alias("_pane")).agg(F.array(*[
            F.sum(F.when(F.col("_back") <= step, F.col("_rows")).otherwise(0))
            for step in range(steps)]).alias("_before"))
    none = F.array_repeat(F.lit(0).cast("long"), steps)
    counted = numbered.join(earlier, [key, "_pane"], "left").select(
        key, *order, "_pane", "_n", F.posexplode(F.coalesce("_before", none)).alias("_step", "_held"))
    placed = _with_bounds(
        counted.withColumn("_start", F.col("_pane") - F.col("_step") * windows.advance),
        windows, "_start")
    return placed.select(key, *order, "window_start", "window_end",
                         (F.col("_n") + F.col("_held")).alias("views"))


def with_stream_time(
    df: DataFrame, partition: str = "partition", order: Sequence[str] = ("arrival", "event_id"),
    ts: str = "ts", slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``stream_time``: the largest event time that arrived so far in the partition."""
    return prefix_scan(
        df, [partition], order, [Running("stream_time", "max", F.col(ts))],
        slice_rows=slice_rows,
    )


def is_late(windows: Windows, ts: str = "ts") -> Column:
    """Whether every window of a row had closed when it arrived."""
    last_end = F.timestamp_seconds(
        _align(F.unix_seconds(ts), windows.advance) + windows.size)
    return last_end <= F.col("stream_time") - _seconds(windows.grace)


def count_views_on_time(
    df: DataFrame, key: str, windows: Windows, ts: str = "ts"
) -> DataFrame:
    """Rows per key and window, as a record-by-record run over the arrival order counts them.

    ``df`` comes from ``with_stream_time``. A row counts in a window while the window's end lies
    after stream time less the grace, so a late row may reach only the later of its windows.
    """
    keyed = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    pane = _align(F.unix_seconds(ts), windows.advance)
    # The smallest start whose window ends after stream time less the grace. Whole seconds
    # decide: starts are whole, and a fraction of stream time never moves a whole start past it.
    closed = F.unix_seconds("stream_time") - (windows.grace + windows.size)
    first_open = _align(closed, windows.advance) + windows.advance
    first = F.greatest(pane - (windows.size - windows.advance), first_open)
    placed = keyed.select(key, first.alias("_first"), pane.alias("_last"))
    return _count_starts(placed.where(F.col("_first") <= F.col("_last")), key, windows)


def live_windows(
    clicks: DataFrame, key: str, windows: Windows = HOPPING,
    retention: int = RETENTION_SECONDS, ts: str = "ts",
) -> DataFrame:
    """The counts still readable: windows that start within ``retention`` of the latest time.

    Only rows of that span are counted; no older row lies in a live window.
    """
    cutoff = clicks.select(F.max(ts) - _seconds(retention)).scalar()
    recent = clicks.where(F.col(ts) > cutoff)
    return count_views(recent, key, windows, ts).where(F.col("window_start") > cutoff)
