"""Starting continuous queries."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from skytally.sinks.write import Writer, fan_out


def start(
    result: DataFrame,
    name: str,
    checkpoint: str,
    writers: Sequence[Writer],
    mode: str = "append",
    interval: timedelta | None = None,
    bounded: bool = False,
) -> StreamingQuery:
    """Run ``result`` as a named query that hands each micro-batch to all ``writers``.

    ``append`` emits every window once, when the watermark has passed its end; ``update`` emits the
    windows each batch changed. The checkpoint folder holds offsets and state: pass the same one to
    resume, a new one to start over. ``bounded`` takes what the source holds now and stops; windows
    the watermark has not passed by then stay unemitted, unlike in a batch run. ``interval`` is the
    least time between micro-batches, each of which commits offsets and state.
    """
    writer = result.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if bounded:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=f"{interval // timedelta(milliseconds=1)} milliseconds")
    return writer.foreachBatch(fan_out(writers)).start()


def dropped_late_rows(query: StreamingQuery) -> list[int]:
    """Rows each of the last micro-batches dropped as late, over all stateful operators.

    Goes back as far as the query's progress does, 100 batches by default; :class:`LateRows` counts all.
    """
    return [
        sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
        for progress in query.recentProgress
    ]


class LateRows(StreamingQueryListener):
    """Adds up the rows that stateful queries drop as late, over all their micro-batches while it listens.

    Counts by query id, which a checkpoint keeps over restarts. Spark tells of a batch a moment after it
    ended, so counts are whole once ``ended`` has the query's run.
    """

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()
        self.batches: Counter[str] = Counter()
        self.ended: set[str] = set()

    def listen(self, spark: SparkSession) -> LateRows:
        spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        progress = event.progress
        self.batches[str(progress.id)] += 1
        self.dropped[str(progress.id)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self.ended.add(str(event.runId))
