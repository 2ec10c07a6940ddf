"""Running totals and the clock that ticks with event time."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soleprint.operators.scan import SLICE_ROWS, Running, prefix_scan
from soleprint.operators.windows import with_stream_time

# The key all totals are written under, and the clocks' periods.
TOTAL_KEY = "TOTAL"
RESET_SECONDS = 3600
TICK_SECONDS = 10


def running_total(
    clicks: DataFrame, by: Sequence[str] = (), order: Sequence[str] = ("ts", "event_id"),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per click: key ``TOTAL`` and the number of clicks so far.

    ``by`` keeps a total of its own for each value, as tasks with a store each do.
    """
    scanned = prefix_scan(
        clicks.select(*dict.fromkeys([*by, *order])), list(by), order,
        [Running("total", "count")], slice_rows=slice_rows,
    )
    return scanned.select(F.lit(TOTAL_KEY).alias("key"), *dict.fromkeys([*by, *order]), "total")


def running_total_hourly(
    clicks: DataFrame, order: Sequence[str] = ("ts", "event_id"), slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The running total set to zero at each full hour of event time; a reset emits nothing."""
    hour = F.timestamp_seconds(
        F.unix_seconds("ts") - F.pmod(F.unix_seconds("ts"), F.lit(RESET_SECONDS)))
    return running_total(clicks.withColumn("hour", hour), ["hour"], order, slice_rows)


def stream_time_ticks(
    clicks: DataFrame, partition: str = "partition",
    order: Sequence[str] = ("arrival", "event_id"), slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per partition and 10-second span that stream time enters.

    ``tick`` is the start of the span and ``stream_time`` the time it was entered with. Spans
    that stream time jumps over give no row of their own.
    """
    seen = with_stream_time(
        clicks.select(partition, *order, "ts"), partition, order, slice_rows=slice_rows)
    seconds = F.unix_seconds("stream_time")
    return seen.groupBy(
        partition, (seconds - F.pmod(seconds, F.lit(TICK_SECONDS))).alias("_tick")
    ).agg(F.min("stream_time").alias("stream_time")).select(
        partition, F.timestamp_seconds("_tick").alias("tick"), "stream_time")
