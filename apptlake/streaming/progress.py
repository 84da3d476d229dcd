"""How streams are started, and what their micro-batches took and wrote."""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter


def started(writer: DataStreamWriter, pull_seconds: int | None) -> StreamingQuery:
    """Start a query that pulls at an interval, or with None takes what is there and stops."""
    if pull_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{pull_seconds} seconds").start()


def observed(rows: DataFrame, **counts: Column) -> tuple[DataFrame, str]:
    """Count rows of each micro-batch as they pass, under the names given; and a name for the query.

    The counts come with the progress of a micro-batch, at no job of their own.
    """
    name = f"{'-'.join(counts)}-{uuid.uuid4().hex[:12]}"
    return rows.observe("counts", *[count.alias(key) for key, count in counts.items()]), name


class BatchCounts(StreamingQueryListener):
    """What each micro-batch of each running query read and what was counted in it, by the query's
    name. Register it with ``spark.streams.addListener``; ``total`` sums a query up."""

    def __init__(self) -> None:
        self.batches: dict[str, dict[int, dict[str, int]]] = defaultdict(dict)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get("counts")
        found = {"read": progress.numInputRows} | (counts.asDict() if counts is not None else {})
        self.batches[progress.name or str(progress.id)][progress.batchId] = found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, name: str) -> dict[str, int]:
        sums: dict[str, int] = defaultdict(int)
        for counts in self.batches[name].values():
            for key, count in counts.items():
                sums[key] += count
        return dict(sums)
