"""Which sinks have had which batch, so that a replayed batch goes to the others only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textpulse.sinks.folders import SharedFolder

Sink = Callable[[DataFrame, int], None]

# Batches whose entries are kept; a query replays its last batch alone.
BATCHES_KEPT = 20


class SinkLedger:
    """An entry for every (query, batch, sink), made after the sink has taken the batch.

    A sink that fails between taking a batch and its entry gets the batch again, as any sink
    may that is not itself safe to repeat.
    """

    def __init__(self, spark: SparkSession, path: str, query_id: str) -> None:
        self._folder = SharedFolder(spark, f"{path}/{query_id}")
        self._done = set(self._folder.names())

    @staticmethod
    def _entry(batch_id: int, sink: str) -> str:
        return f"{batch_id:012d}-{sink}"

    def has(self, batch_id: int, sink: str) -> bool:
        return self._entry(batch_id, sink) in self._done

    def add(self, batch_id: int, sink: str) -> None:
        entry = self._entry(batch_id, sink)
        self._folder.put_new(entry, "")
        self._done.add(entry)

    def tidy(self, batch_id: int) -> None:
        """Forget batches that cannot come again."""
        oldest = self._entry(max(0, batch_id - BATCHES_KEPT), "")
        for entry in sorted(self._done):
            if entry >= oldest:
                break
            self._folder.delete(entry)
            self._done.discard(entry)

    def deliver(self, batch_id: int, sinks: dict[str, Callable[[], None]]) -> None:
        """Run the sinks that have not had the batch; one that fails does not stop the others.

        The first failure is raised at the end, so that the batch is replayed.
        """
        failures: list[Exception] = []
        for name, run in sinks.items():
            if self.has(batch_id, name):
                continue
            try:
                run()
            except Exception as error:  # noqa: BLE001
                failures.append(error)
            else:
                self.add(batch_id, name)
        if failures:
            raise failures[0]
        self.tidy(batch_id)
