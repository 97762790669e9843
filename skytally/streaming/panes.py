"""Continuous windows over a log of panes.

A hopping window of an hour every five seconds keeps 720 open windows a key. Here no window is state. Each
micro-batch is aggregated per key and slide-long pane, the parts of every measure (counts, sums, minima,
maxima) are appended to a log, and the windows that the batch closes are finished from the panes of the
log by the running totals of a batch hop, or, if they are few, by adding up once the panes that all of them share. A batch thus writes one row for each key and pane in it,
whatever the number of windows, and reads the panes of one window size and what the batch adds.

The log is a folder a batch, merged every ``COMPACT`` batches into one that drops what no open window
sees. A batch that is repeated after a failure overwrites its own folder, and its windows follow from the folders
up to it, so its result is the same again.

A window closes when the latest event time so far, less ``delay``, has passed its end. This holds from the
batch that brought that time, whose own rows all count; a row of a later batch is late if all its windows
were closed before the batch began, else it counts in those still open. (Spark's watermark, one batch behind, lets such rows
in for a batch longer.) Late rows are counted for good and can be written, each one, by writers of their own.

``mode="changes"`` emits what each batch changed instead: for every window with a new result a row with
``change`` false and the result it replaces, if there was one, and a row with ``change`` true and the new one.
Added up with their signs, changes give the result; a window's last change is its last result.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytally.functions.measures import ALL_ROWS, Measure, check_types, distinct_parts, for_keys, for_types
from skytally.operators.windows import DEFAULT_DELAY, _expand_runs, _finished, _instant, _named, _panes, _us, micros
from skytally.sinks.write import Writer, fan_out
from skytally.streaming.files import Folder

#: Batches after which their panes are merged.
COMPACT = 16
#: Windows of a key closed by one batch, up to which their common panes are added up instead of running totals.
FEW = 16
MODES = ("append", "changes")


class Windows:
    """Tumbling (``slide`` = ``size``) or hopping windows of a stream, a query and what it keeps under ``checkpoint``.

    ``finish`` maps each batch's windows to the rows that the writers get. ``late`` writers get the late
    rows. Both take a batch's number; an end-of-input batch (:meth:`flush`) after batch b has the number -(b + 1).
    """

    def __init__(
        self,
        rows: DataFrame,
        time: str,
        size: timedelta,
        slide: timedelta,
        keys: Sequence[str],
        measures: Sequence[Measure],
        checkpoint: str,
        writers: Sequence[Writer],
        bounds: tuple[str, str] = ("hopStart", "hopEnd"),
        delay: timedelta = DEFAULT_DELAY,
        finish: Callable[[DataFrame], DataFrame] = lambda windows: windows,
        late: Sequence[Writer] = (),
        mode: str = "append",
        partitions: int | None = None,
    ) -> None:
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        if micros(size) % micros(slide):
            raise ValueError("a log of panes needs a size that is a multiple of the slide")
        check_types(measures, rows.schema)
        self.measures = for_types(for_keys(measures, keys), rows.schema)
        self.parts = distinct_parts(self.measures)
        self.rows, self.time, self.keys, self.bounds, self.mode = rows, time, list(keys), bounds, mode
        self.size, self.slide, self.delay = size, slide, delay
        self.writers, self.finish, self.late = list(writers), finish, list(late)
        self.spark = rows.sparkSession
        self.partitions = partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.checkpoint = checkpoint.rstrip("/")
        self.log, self.marks = Folder(self.spark, f"{self.checkpoint}/panes"), Folder(self.spark, f"{self.checkpoint}/marks")
        self.schema = None

    # --- running ---------------------------------------------------------------------------------

    def start(self, name: str, interval: timedelta | None = None, bounded: bool = False) -> StreamingQuery:
        """Run as a named query; the same checkpoint resumes. ``bounded`` takes what the source holds now and stops."""
        writer = self.rows.writeStream.queryName(name).option("checkpointLocation", self.checkpoint)
        if bounded:
            writer = writer.trigger(availableNow=True)
        elif interval is not None:
            writer = writer.trigger(processingTime=f"{interval // timedelta(milliseconds=1)} milliseconds")
        return writer.foreachBatch(self._process).start()

    def flush(self) -> None:
        """End of input, after the query has stopped: emits all windows still open and closes them for good.

        Rows that come after a restart count in windows that end later; for the others they are late.
        In mode ``changes`` every result is out already, and windows are only closed.
        """
        batch = self._last()
        if batch is None:
            return
        mark = self._mark(batch)
        if mark["latest"] is None:
            return
        closed = max(mark["latest"] + micros(self.size), mark["closed"])
        before = mark.get("before_flush", mark["closed"])  # a flush that is repeated gives the same rows again
        if self.mode == "append":
            self._write(self._closing(batch, before, closed), -(batch + 1))
        self.marks.write(str(batch), json.dumps({**mark, "closed": closed, "before_flush": before}))

    def counts(self) -> dict[str, int]:
        """Rows ``kept`` and ``late`` since the query first began, whatever was restarted between."""
        batch = self._last()
        mark = self._mark(-1 if batch is None else batch)
        return {"kept": mark["kept"], "late": mark["late"]}

    # --- a micro-batch ---------------------------------------------------------------------------

    def _last(self) -> int | None:
        return max(map(int, self.marks.names()), default=None)

    def _mark(self, batch: int) -> dict:
        if batch < 0:
            return {"latest": None, "closed": None, "kept": 0, "late": 0}
        return json.loads(self.marks.read(str(batch)))

    def _process(self, batch: DataFrame, number: int) -> None:
        before = self._mark(number - 1)
        us = F.unix_micros(F.col(f"`{self.time}`").cast("timestamp"))
        if self.late:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # rows too late for all their windows go along as panes that no window reads: so they are counted in the same pass
            panes = _panes(batch, self.time, self.slide, self.keys, self.measures, F.max(us).alias("__latest"))
            self.schema = panes.drop("__latest").schema
            if number and number % COMPACT == 0:
                self._compact(number, before)
            panes.write.mode("overwrite").parquet(f"{self.log.path}/{number}")
            got = self._told(panes, number, before["closed"])
            latest = max((t for t in (before["latest"], got["latest"]) if t is not None), default=None)
            passed = None if latest is None else latest - micros(self.delay)
            closed = max((t for t in (before["closed"], passed) if t is not None), default=None)
            if self.mode == "changes":
                self._write(self._changed(number, before["closed"], got), number)
            elif closed is not None and closed != before["closed"]:
                self._write(self._closing(number, before["closed"], closed), number)
            if self.late:
                pane_end = us - F.pmod(us, _us(self.slide)) + _us(self.size)
                fan_out(self.late)(batch.where(self._is_late(pane_end, before["closed"])), number)
        finally:
            if self.late:
                batch.unpersist()
        mark = {"latest": latest, "closed": closed, "kept": before["kept"] + got["kept"], "late": before["late"] + got["late"]}
        self.marks.write(str(number), json.dumps(mark))
        if number % COMPACT == 0:
            for old in range(max(0, number - 2 * COMPACT), number - COMPACT):
                for folder, name in ((self.log, str(old)), (self.log, f"merged-{old}"), (self.marks, str(old))):
                    folder.delete(name)

    @staticmethod
    def _is_late(end: Column, closed: int | None) -> Column:
        """Whether all windows of a row or pane, the last of which ends at ``end``, were closed before."""
        return F.lit(False) if closed is None else F.coalesce(end <= F.lit(closed), F.lit(False))

    def _told(self, panes: DataFrame, number: int, closed: int | None) -> dict:
        """What the panes of a batch tell of its rows."""
        rows, late = F.col(f"`{ALL_ROWS.name}`"), self._is_late(F.col("__pane") + _us(self.size), closed)
        told = self.spark.read.schema(panes.schema).parquet(f"{self.log.path}/{number}").agg(
            F.max("__latest").alias("latest"), F.min(F.when(~late, F.col("__pane"))).alias("first"),
            F.coalesce(F.sum(F.when(~late, rows)), F.lit(0)).alias("kept"), F.coalesce(F.sum(F.when(late, rows)), F.lit(0)).alias("late"),
        )
        return told.first().asDict()

    def _write(self, windows: DataFrame, number: int) -> None:
        fan_out(self.writers)(self.finish(windows), number)

    # --- the log ---------------------------------------------------------------------------------

    def _paths(self, low: int, high: int) -> list[str]:
        """Folders that hold the panes of batches up to ``high``, merged up to ``low``."""
        merged = [f"{self.log.path}/merged-{low}"] if low else []
        return merged + [f"{self.log.path}/{i}" for i in range(low, high + 1)]

    def _until(self, batch: int) -> list[str]:
        return self._paths(batch // COMPACT * COMPACT, batch)

    def _read(self, paths: list[str]) -> DataFrame:
        schema = self.schema or _panes(self._empty(), self.time, self.slide, self.keys, self.measures).schema
        return self.spark.read.schema(schema).parquet(*paths)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.rows.schema)

    def _compact(self, number: int, before: dict) -> None:
        """One folder of the panes of earlier batches that an open window may still see."""
        held = self._read(self._paths(number - COMPACT, number - 1))
        if before["closed"] is not None:
            held = held.where(F.col("__pane") + _us(self.size) > F.lit(before["closed"]))
        merged = held.groupBy(*_named(self.keys), "__pane").agg(*[p.over_parts(F.col(f"`{p.name}`")).alias(p.name) for p in self.parts])
        merged.write.mode("overwrite").parquet(f"{self.log.path}/merged-{number}")

    def _panes_of(self, paths: list[str], low: int | None, high: int | None) -> DataFrame:
        """Panes that windows starting from ``low`` to ``high`` see, a row for each folder."""
        panes = self._read(paths)
        if low is not None:
            panes = panes.where(F.col("__pane") >= F.lit(low))
        if high is not None:
            panes = panes.where(F.col("__pane") < F.lit(high + micros(self.size)))
        return panes

    def _closing(self, batch: int, after: int | None, until: int) -> DataFrame:
        """Windows that end after ``after`` and not after ``until``."""
        size, slide = micros(self.size), micros(self.slide)
        low = None if after is None else ((after - size) // slide + 1) * slide
        high = (until - size) // slide * slide
        panes = self._panes_of(self._until(batch), low, high)
        if low is not None and low <= high and (high - low) // slide < min(FEW, size // slide):
            found = self._few(panes, low, high)
        else:
            found = _expand_runs(panes, self.size, self.slide, self.keys, self.parts, self.partitions, low, high, merge=True)
        return found.select(*_named(self.keys), *self._edges(), *_finished(self.measures))

    def _few(self, panes: DataFrame, low: int, high: int) -> DataFrame:
        """The windows that start from ``low`` to ``high``, few of them: all share most panes, which are added up once."""
        added = [p.over_parts(F.col(f"`{p.name}`")).alias(p.name) for p in self.parts]
        pane, size, slide = F.col("__pane"), _us(self.size), _us(self.slide)
        shared = (pane >= F.lit(high)) & (pane < F.lit(low) + size)
        merged = panes.withColumn("__pane", F.when(shared, F.lit(high)).otherwise(pane)).groupBy(*_named(self.keys), "__pane").agg(*added)
        starts = F.sequence(F.greatest(F.lit(low), pane - size + slide), F.least(F.lit(high), pane), slide)
        return merged.withColumn("__start", F.explode(starts)).groupBy(*_named(self.keys), "__start").agg(*added)

    def _edges(self) -> list[Column]:
        return [_instant(F.col("__start"), False).alias(self.bounds[0]), _instant(F.col("__start") + _us(self.size), False).alias(self.bounds[1])]

    def _changed(self, batch: int, closed: int | None, got: Mapping) -> DataFrame:
        """For open windows that the batch changed, the results before and after."""
        size, slide = micros(self.size), micros(self.slide)
        first, last = (got["first"], got["latest"]) if got["kept"] else (0, -size)
        low = first // slide * slide - size + slide
        if closed is not None:
            low = max(low, ((closed - size) // slide + 1) * slide)
        high = last // slide * slide
        old = [replace(p, tag="_old") for p in self.parts]
        mine, *earlier = reversed(self._until(batch))
        mine = self._read([mine]).where(F.col("__pane") >= F.lit(low))
        pairs = [(F.col(f"`{p.name}`"), o.name, mine.schema[p.name].dataType) for p, o in zip(self.parts, old)]
        both = mine.select("*", *[F.lit(None).cast(kind).alias(name) for _, name, kind in pairs])
        if earlier:
            keys = mine.select(*[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(self.keys)]).distinct()
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(self.keys)]
            others = self._panes_of(earlier, low, high).join(keys, same, "left_semi")
            both = both.union(others.select("*", *[value.alias(name) for value, name, _ in pairs]))
        rows, rows_before = F.col(f"`{ALL_ROWS.name}`"), F.col(f"`{replace(ALL_ROWS, tag='_old').name}`")
        changed = rows > F.coalesce(rows_before, F.lit(0))
        found = _expand_runs(both, self.size, self.slide, self.keys, [*self.parts, *old], self.partitions, low, high, merge=True, where=changed)
        was = F.struct(*[m.value(lambda p: F.col(f"`{replace(p, tag='_old').name}`")) for m in self.measures])
        now = F.struct(*_finished(self.measures))
        flagged = lambda flag, of: F.struct(F.lit(flag).alias("change"), of.alias("m"))
        both_ways = F.when(rows_before.isNull(), F.array(flagged(True, now))).when(
            ~was.eqNullSafe(now), F.array(flagged(False, was), flagged(True, now))
        )
        return (
            found.select(*_named(self.keys), *self._edges(), F.explode(both_ways).alias("__change"))
            .select(*_named(self.keys), *_named(list(self.bounds)), "__change.change", "__change.m.*")
        )
