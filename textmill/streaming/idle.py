"""Keys without input for a while, and streams without work left."""

from __future__ import annotations

import time

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle


class IdleTimer:
    """Fires once a key has had no input for ``idle_ms``. One timer a key; input moves it on."""

    def __init__(self, handle: StatefulProcessorHandle, idle_ms: int):
        self.handle, self.idle_ms = handle, idle_ms
        self.due = handle.getValueState("due", "due long")

    def touch(self, now) -> None:
        self.stop()
        due = now.getCurrentProcessingTimeInMs() + self.idle_ms
        self.handle.registerTimer(due)
        self.due.update((due,))

    def over(self, expired) -> bool:
        """Whether this is the key's last timer, not one that input has put off."""
        return self.due.exists() and self.due.get()[0] <= expired.getExpiryTimeInMs()

    def stop(self) -> None:
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
            self.due.clear()


def run_until_idle(query: StreamingQuery, quiet_s: float, most_s: float | None = None) -> None:
    """Ends a stream with timers once ``quiet_s`` have gone by without input, output or change of state.

    Such a stream has no end of its own, since a timer may always be due later. The time counts from the first batch
    that found nothing to do, so ``quiet_s`` has to be longer than what timers wait for. How long the work takes grows
    with the input, so there is no limit to it unless ``most_s`` sets one.
    """
    begin = time.monotonic()
    quiet: float | None = None
    last = -1
    while most_s is None or time.monotonic() - begin < most_s:
        if query.exception() is not None:
            raise query.exception()
        for progress in query.recentProgress:
            if progress["batchId"] > last:
                last = progress["batchId"]
                busy = any(s["numRowsUpdated"] or s["numRowsRemoved"] for s in progress["stateOperators"])
                quiet = None if progress["numInputRows"] or busy else quiet or time.monotonic()
        if quiet is not None and time.monotonic() - quiet >= quiet_s:
            query.stop()
            query.awaitTermination()
            return
        time.sleep(0.1)
    query.stop()
    raise TimeoutError(f"the stream was still at work after {most_s} s")
