"""Metric windows over a live training log."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textmill.operators.traininglog import percent_if_accuracy
from textmill.streaming.idle import IdleTimer

WINDOW = "rank bigint, metric string, step bigint, mean double, n bigint, late boolean"


class StepWindows(StatefulProcessor):
    """State of one metric of one rank: sum and count of each open window, the last step and the last window given."""

    def __init__(self, freq: int, late: int, idle_ms: int):
        self.freq, self.late, self.idle_ms = freq, late, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "step long", "total double, n long")
        self.top = handle.getValueState("top", "top long, given long")
        self.timer = IdleTimer(handle, self.idle_ms)

    def _give(self, key, step: int, total: float, n: int, late: bool) -> Row:
        return Row(rank=key[0], metric=key[1], step=step, mean=total / n, n=n, late=late)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        top, given = self.top.get() if self.top.exists() else (-(1 << 62), -(1 << 62))
        new: dict[int, tuple[float, int]] = {}
        for r in rows:
            if r.value is None:
                continue
            step = -(-r.step // self.freq) * self.freq
            total, n = new.get(step, (0.0, 0))
            new[step] = (total + r.value, n + 1)
            top = max(top, r.step)
        for step in sorted(s for s in new if s <= given):
            yield self._give(key, step, *new.pop(step), True)
        # Only windows that stay open over a batch are in the state: few, however many steps a batch brings.
        before = {k[0]: tuple(v) for k, v in self.open.iterator()}
        for step, (total, n) in before.items():
            more, count = new.get(step, (0.0, 0))
            new[step] = (total + more, n + count)
        for step in sorted(new):
            if step <= top - self.late:
                yield self._give(key, step, *new[step], False)
                given = max(given, step)
                if step in before:
                    self.open.removeKey((step,))
            elif new[step] != before.get(step):
                self.open.updateValue((step,), new[step])
        self.top.update((top, given))
        self.timer.touch(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.timer.over(expiredTimerInfo):
            return
        top, given = self.top.get()
        for (step,), kept in sorted((tuple(k), tuple(v)) for k, v in self.open.iterator()):
            yield self._give(key, step, *kept, False)
            given = max(given, step)
        self.open.clear()
        self.top.update((top, given))
        self.timer.stop()

    def close(self) -> None:
        pass


def metric_windows_stream(log: DataFrame, freq: int = 10, late: int = 0, idle_ms: int = 60_000) -> DataFrame:
    """(rank, metric, step, value, n, late) from a stream of (rank, metric, step, value): the mean of every ``freq`` steps.

    A window leaves when a step ``late`` steps behind its last one has come, and the last windows ``idle_ms`` after
    the log has gone quiet. A value for a window that has left leaves as a row of its own with ``late`` set, as what
    has been written cannot be changed; ``n`` lets a reader put both together. Null values count nowhere.
    """
    means = log.groupBy("rank", "metric").transformWithState(
        StepWindows(freq, late, idle_ms), WINDOW, "append", "processingTime"
    )
    return means.select(
        "rank", "metric", "step", percent_if_accuracy(F.col("metric"), F.col("mean")).alias("value"), "n", "late"
    )
