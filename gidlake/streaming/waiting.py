"""The state of a gid that waits for its source record."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Executors get this module with the processor itself, so they need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Waiting(StatefulProcessor):
    """Of each gid: whether it is wanted, whether a source knows it, and whether it has been handed on."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "wanted boolean, known boolean, done boolean")

    def handleInputRows(self, key, rows, timerValues):
        """Each call of the handle or of a state asks Spark over a socket, so there are as few as can be: a timer is left to run out when its gid is
        handed on, and the state is written only if it changed."""
        before = wanted, known, done = tuple(self.seen.get() or (False, False, False))
        arrived = 0
        for row in rows:
            wanted, known, arrived = wanted or row.wanted, known or not row.wanted, max(arrived, row.millis)
        ready = wanted and known and not done
        if wanted and not known and not before[0]:
            self.handle.registerTimer(arrived + self.wait_ms)
        if (wanted, known, done or ready) != before:
            self.seen.update((wanted, known, done or ready))
        if ready:
            yield Row(gid=key[0], ready=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """A gid still unknown after the wait is reported, and again after each further wait."""
        _, known, done = self.seen.get() or (False, False, False)
        if not known and not done:
            self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self.wait_ms)
            yield Row(gid=key[0], ready=False)

    def close(self) -> None:
        pass
