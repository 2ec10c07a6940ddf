"""Keyed state with timers, for what windows and scans cannot say: a reset by the wall clock.

These run in Python workers on Arrow batches, one key's rows after the other. Key by log
partition, as here, so that a topic's partitions share the work; ``start_click_counter`` is
the form without Python.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from soleprint.operators.counters import RESET_SECONDS, TICK_SECONDS, TOTAL_KEY

# Python workers get these classes with the query, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def process_keyed(
    rows: DataFrame, key: str, processor: StatefulProcessor, schema: str,
    mode: str = "append", time_mode: str = "none",
) -> DataFrame:
    """Run a stateful processor per key. ``time_mode`` is ``none``, ``processingTime`` or
    ``eventTime``; the last needs a watermark on ``rows``. Start the query within
    ``session.state_store``, unless the session has such a store anyway, as ``build_session``'s has.
    """
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode=time_mode)


class ClickCounter(StatefulProcessor):
    """Counts a key's rows, emits the count with each, and sets it to zero by a timer.

    The rows of a micro-batch are numbered in order of their event time. The first row of a key
    starts the timer. A reset emits nothing.
    """

    SCHEMA = "partition int, key string, total long, ts timestamp"

    def __init__(self, reset_millis: int = RESET_SECONDS * 1000) -> None:
        self.reset_millis = reset_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "total long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        if self.total.exists():
            total = self.total.get()[0]
        else:
            total = 0
            self._start_timer(timerValues)
        times = np.sort(np.concatenate([batch["ts"].to_numpy("datetime64[us]") for batch in rows]))
        yield pd.DataFrame({"partition": key[0], "key": TOTAL_KEY,
                            "total": total + np.arange(1, len(times) + 1), "ts": times})
        self.total.update((int(total + len(times)),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.total.update((0,))
        self._start_timer(timerValues)
        yield pd.DataFrame()

    def _start_timer(self, timer_values) -> None:
        now = timer_values.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(now + self.reset_millis)

    def close(self) -> None:
        pass


class StreamClock(StatefulProcessor):
    """Emits one row whenever a key's event time enters a new 10-second span.

    Rows must reach the processor in arrival order; behind a shuffle they may not, so use
    ``stateful.span_ticks``, whose timers do not depend on it, where several tasks feed a key.
    """

    SCHEMA = "partition int, tick timestamp, stream_time timestamp"

    def __init__(self, tick_seconds: int = TICK_SECONDS) -> None:
        self.tick = np.timedelta64(tick_seconds, "s")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "micros long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        latest = np.iinfo(np.int64).min
        if self.latest.exists():
            latest = self.latest.get()[0]
        span = self.tick.astype("timedelta64[us]").astype(np.int64)
        for batch in rows:
            micros = batch["ts"].values.astype("datetime64[us]").astype(np.int64)
            running = np.maximum(np.maximum.accumulate(micros), latest)
            before = np.concatenate(([latest], running[:-1]))
            entered = running[running // span > before // span]
            latest = running[-1]
            yield pd.DataFrame({
                "partition": key[0],
                "tick": (entered // span * span).astype("datetime64[us]"),
                "stream_time": entered.astype("datetime64[us]"),
            })
        self.latest.update((int(latest),))

    def close(self) -> None:
        pass
