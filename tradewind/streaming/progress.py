"""Totals of a whole stream run, however many batches it has.

A query object keeps only its last progress reports, so sums over those are too
small for long runs. A listener is told about every batch.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener


class _Totals(StreamingQueryListener):
    def __init__(self):
        self.events: list[tuple[str, int, dict]] = []
        self.ended: set[str] = set()
        self.change = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        report = event.progress
        seen = {name: row.asDict() for name, row in report.observedMetrics.items()}
        with self.change:
            self.events.append((str(report.runId), report.numInputRows, seen))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.change:
            self.ended.add(str(event.runId))
            self.change.notify_all()


def run_to_end(spark: SparkSession, writer: DataStreamWriter, observed: str | None = None,
               patience: float = 120.0) -> tuple[int, dict[str, int]]:
    """Starts the writer, waits for its end; returns input rows and the sums of one observation."""
    totals = _Totals()
    spark.streams.addListener(totals)
    try:
        query = writer.start()
        query.awaitTermination()
        run = str(query.runId)
        with totals.change:  # reports arrive behind the query, and the end last of all
            if not totals.change.wait_for(lambda: run in totals.ended, patience):
                raise TimeoutError("the end of the stream was not reported")
            mine = [e for e in totals.events if e[0] == run]
    finally:
        spark.streams.removeListener(totals)
    sums: dict[str, int] = {}
    for _, _, seen in mine:
        for name, value in seen.get(observed, {}).items():
            sums[name] = sums.get(name, 0) + (value or 0)
    return sum(rows for _, rows, _ in mine), sums
