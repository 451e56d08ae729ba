"""Row counts of a run, taken while its tables are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql.streaming import StreamingQueryListener


class RunCounts:
    """Counts observed on the way: each frame has to be written once before values()."""

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def on(self, df: DataFrame, **counts: Column) -> DataFrame:
        observation = Observation()
        self._observed.append(observation)
        return df.observe(observation, *[column.alias(name) for name, column in counts.items()])

    def values(self) -> dict[str, int]:
        return {name: value or 0 for observation in self._observed for name, value in observation.get.items()}


class StreamCounts(StreamingQueryListener):
    """Sums, per query name, of the rows read, of the rows an operator dropped as late, and of observed counts."""

    def __init__(self) -> None:
        self.found: dict[str, dict[str, int]] = {}

    def _add(self, query: str, name: str, value: int) -> None:
        own = self.found.setdefault(query, {})
        own[name] = own.get(name, 0) + value

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query = progress.name or str(progress.id)
        self._add(query, "rows_read", progress.numInputRows)
        self._add(query, "rows_late", sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators))
        for metrics in progress.observedMetrics.values():
            for name, value in metrics.asDict().items():
                self._add(query, name, value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
