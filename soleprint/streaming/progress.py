"""What running queries report: observed counts and the size of their state."""

from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQueryListener


@dataclass
class Progress(StreamingQueryListener):
    """Keeps the last progress of each query. Add with ``spark.streams.addListener``.

    ``observed`` maps the name of a ``peek`` to its last values; ``state`` maps a query to its
    state rows: held, updated, and dropped as too late.
    """

    observed: dict[str, dict[str, object]] = field(default_factory=dict)
    state: dict[str, dict[str, int]] = field(default_factory=dict)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in (progress.observedMetrics or {}).items():
            self.observed[name] = row.asDict()
        operators = progress.stateOperators
        if operators:
            self.state[progress.name or str(progress.id)] = {
                "rows": sum(item.numRowsTotal for item in operators),
                "updated": sum(item.numRowsUpdated for item in operators),
                "late": sum(item.numRowsDroppedByWatermark for item in operators),
            }

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
