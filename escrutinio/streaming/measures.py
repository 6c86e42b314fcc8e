"""Counts that the streaming queries take on their way, without reading anything twice."""

import time
from collections import Counter, defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Measures(StreamingQueryListener):
    """Sums of the observed counts of all micro-batches: ``totals[layer][measure]``.

    A micro-batch is counted once: one that is repeated after a restart reports its number again.
    """

    def __init__(self):
        self._batches: dict = {}
        self._running: set = set()

    def onQueryStarted(self, event) -> None:
        self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for layer, row in progress.observedMetrics.items():
            self._batches[str(progress.id), progress.batchId, layer] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._running.discard(str(event.runId))

    @property
    def totals(self) -> dict[str, Counter]:
        found = defaultdict(Counter)
        for (_, _, layer), counts in list(self._batches.items()):
            found[layer].update({name: n or 0 for name, n in counts.items()})
        return dict(found)

    def wait(self, seconds: float = 30) -> None:
        """Until the reports of all ended queries have come; they come later than the data."""
        end = time.monotonic() + seconds
        while self._running and time.monotonic() < end:
            time.sleep(0.05)


def measured(spark: SparkSession) -> Measures:
    """A listener on the session's queries; take it off with ``spark.streams.removeListener``."""
    found = Measures()
    spark.streams.addListener(found)
    return found
