"""Tumbling and hopping event-time windows per key.

Windows are ``[start, end)``, aligned to the epoch. A hopping window of ``size`` that starts every
``slide`` puts each row into ``size / slide`` windows, 720 for one hour every five seconds, so how
the windows share work decides the cost. Four ways to compute the same rows:

``window``   Spark's own sliding window: every row is copied once per window before the aggregate.
``explode``  the same copies, made by a generator, which scales to many windows: the way on streams.
``panes``    aggregate per slide-long pane first, then copy the pane rows.
``runs``     aggregate per pane, then find, per key and window-sized block, the stretches of window
             starts whose contents do not change, and write each stretch out. A pane row crosses
             the network twice, whatever the number of windows, and no group handled by one task
             exceeds ``2 * size / slide`` rows, however hot its key is. Batch only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.measures import ALL_ROWS, Measure, check_types, distinct_parts, for_keys, for_types
from skytally.streaming.eventtime import has_watermark, with_watermark

STRATEGIES = ("window", "explode", "panes", "runs")
BATCH_ONLY = ("panes", "runs")
DEFAULT_DELAY = timedelta(seconds=30)
# Tasks that copy the rows of a key and window length on a stream, at most.
KEY_PARTS = 16


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def duration(span: timedelta) -> str:
    return f"{micros(span)} microseconds"


def _us(span: timedelta) -> Column:
    return F.lit(micros(span)).cast("bigint")


def _named(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def tumble(
    rows: DataFrame,
    time: str,
    size: timedelta,
    keys: Sequence[str],
    measures: Sequence[Measure],
    bounds: tuple[str, str] | None = ("windowStart", "windowEnd"),
    delay: timedelta = DEFAULT_DELAY,
) -> DataFrame:
    """One row per key and non-empty window. ``bounds=None`` leaves the window's times out.

    On a stream, ``delay`` is how long a window stays open for late rows.
    """
    check_types(measures, rows.schema)
    measures = for_types(for_keys(measures, keys), rows.schema)
    grouped = with_watermark(rows, time, delay).groupBy(
        F.window(f"`{time}`", duration(size)).alias("__window"), *_named(keys)
    )
    parts = distinct_parts(measures)
    totals = grouped.agg(*[p.over_rows().alias(p.name) for p in parts])
    edges = [] if bounds is None else [
        F.col("__window.start").alias(bounds[0]),
        F.col("__window.end").alias(bounds[1]),
    ]
    return totals.select(*_named(keys), *edges, *_finished(measures))


def hop(
    rows: DataFrame,
    time: str,
    size: timedelta,
    slide: timedelta,
    keys: Sequence[str],
    measures: Sequence[Measure],
    bounds: tuple[str, str] = ("hopStart", "hopEnd"),
    strategy: str = "auto",
    delay: timedelta = DEFAULT_DELAY,
    partitions: int | None = None,
) -> DataFrame:
    """One row per key and non-empty window of ``size``, a window starting every ``slide``.

    ``partitions`` sets how many tasks write the ``runs`` result (default: the session's shuffle
    partitions). It is fixed rather than left to adaptive execution, which would see the small pane
    rows and merge them into a few tasks that each expand into a huge result.
    """
    check_types(measures, rows.schema)
    measures = for_types(for_keys(measures, keys), rows.schema)
    if strategy == "auto":
        strategy = _pick(rows, time, size, slide)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if strategy in BATCH_ONLY and rows.isStreaming:
        raise ValueError(f"strategy {strategy!r} needs all panes of a window at once: batch only")
    if strategy != "window" and micros(size) % micros(slide):
        raise ValueError(f"strategy {strategy!r} needs a size that is a multiple of the slide")
    if strategy == "window":
        return _by_window(rows, time, size, slide, keys, measures, bounds, delay)
    if strategy == "explode":
        if has_watermark(rows, time):
            raise ValueError(
                "the stream has a watermark already and Spark allows one: pass it without, with delay=, "
                "or choose strategy='window'"
            )
        return _by_explode(rows, time, size, slide, keys, measures, bounds, delay)
    zoneless = _check_zone(rows, time)
    if strategy == "panes":
        starts = _expand_panes(_panes(rows, time, slide, keys, measures), size, slide, keys, measures)
    else:
        if partitions is None:
            partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        panes = _panes(rows, time, slide, keys, measures)
        starts = _expand_runs(panes, size, slide, keys, distinct_parts(measures), partitions)
    return starts.select(
        *_named(keys),
        _instant(F.col("__start"), zoneless).alias(bounds[0]),
        _instant(F.col("__start") + _us(size), zoneless).alias(bounds[1]),
        *_finished(measures),
    )


def _pick(rows: DataFrame, time: str, size: timedelta, slide: timedelta) -> str:
    """The same way for windows of any number; ``window`` where it is the only one."""
    if micros(size) % micros(slide) or has_watermark(rows, time):
        return "window"
    return "explode" if rows.isStreaming else "runs"


def _check_zone(rows: DataFrame, time: str) -> bool:
    zoneless = isinstance(rows.schema[time].dataType, T.TimestampNTZType)
    if zoneless and rows.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        raise ValueError("a time column without zone needs spark.sql.session.timeZone=UTC")
    return zoneless


def _finished(measures: Sequence[Measure]) -> list[Column]:
    return [m.value(lambda p: F.col(f"`{p.name}`")) for m in measures]


def _by_window(rows, time, size, slide, keys, measures, bounds, delay) -> DataFrame:
    window = F.window(f"`{time}`", duration(size), duration(slide)).alias("__window")
    totals = (
        with_watermark(rows, time, delay)
        .groupBy(window, *_named(keys))
        .agg(*[p.over_rows().alias(p.name) for p in distinct_parts(measures)])
    )
    return totals.select(
        *_named(keys),
        F.col("__window.start").alias(bounds[0]),
        F.col("__window.end").alias(bounds[1]),
        *_finished(measures),
    )


def _by_explode(rows, time, size, slide, keys, measures, bounds, delay) -> DataFrame:
    """Copy each row to the ends of its windows, then group.

    On a stream the watermark sits on the window end and allows for the window's size, so windows
    close exactly when a watermark on the event time would close them (size and delay being
    multiples of the slide; otherwise less than one slide later).
    """
    parts = distinct_parts(measures)
    pane_end = F.window(f"`{time}`", duration(slide)).end.alias("__pane_end")
    used = dict.fromkeys([*keys, *(p.column for p in parts if p != ALL_ROWS)])
    placed = rows.select(*_named(list(used)), pane_end)
    if rows.isStreaming:
        # A micro-batch may be a single input partition. Rows with most windows in common meet in a task before
        # they are copied: the copying is as wide as the shuffle, and most copies merge where they are made. A
        # key is spread over the parts of a window, so that a hot one is not one task's work.
        block = F.call_function("div", F.unix_micros(F.col("__pane_end").cast("timestamp")), _us(size / KEY_PARTS))
        placed = placed.repartition(*_named(keys), block)
    step = F.expr(f"INTERVAL '{micros(slide) / 1e6:.6f}' SECOND")
    ends = F.transform(
        F.sequence(F.lit(0), F.lit(size // slide - 1)), lambda k: F.col("__pane_end") + k * step
    )
    copies = placed.select("*", F.explode(ends).alias("__end")).drop("__pane_end")
    totals = (
        with_watermark(copies, "__end", size + delay)
        .groupBy("__end", *_named(keys))
        .agg(*[p.over_rows().alias(p.name) for p in parts])
    )
    return totals.select(
        *_named(keys),
        (F.col("__end") - F.expr(f"INTERVAL '{micros(size) / 1e6:.6f}' SECOND")).alias(bounds[0]),
        F.col("__end").alias(bounds[1]),
        *_finished(measures),
    )


def _instant(us: Column, zoneless: bool) -> Column:
    moment = F.timestamp_micros(us)
    return moment.cast("timestamp_ntz") if zoneless else moment


def _panes(rows, time, slide, keys, measures, *further) -> DataFrame:
    """Parts per key and slide-long pane, ``__pane`` being its start in microseconds.

    The one pass over raw rows: combined map-side, and spread by key *and* pane, so rows of one key
    end up in many tasks.
    """
    us = F.unix_micros(F.col(f"`{time}`").cast("timestamp"))
    pane = us - F.pmod(us, _us(slide))
    return (
        rows.where(F.col(f"`{time}`").isNotNull())
        .groupBy(*_named(keys), pane.alias("__pane"))
        .agg(*[p.over_rows().alias(p.name) for p in distinct_parts(measures)], *further)
    )


def _expand_panes(panes, size, slide, keys, measures) -> DataFrame:
    starts = F.sequence(
        F.col("__pane") - _us(size - slide), F.col("__pane"), _us(slide)
    )
    parts = distinct_parts(measures)
    return (
        panes.withColumn("__start", F.explode(starts))
        .groupBy(*_named(keys), "__start")
        .agg(*[p.over_parts(F.col(f"`{p.name}`")).alias(p.name) for p in parts])
    )


def _expand_runs(panes, size, slide, keys, parts, partitions, low=None, high=None, merge=False, where=None) -> DataFrame:
    """Windows from runs of equal windows.

    Cut time into blocks of one window size, ``n`` window starts each, and let ``s`` count the
    starts within a block. A window starting in block ``b`` sees panes of ``b`` and of ``b + 1``
    only: pane ``o`` of block ``b`` while ``s < o + 1``, pane ``o`` of block ``b + 1`` once
    ``s >= o + 1``. So a pane sent to both blocks changes the contents at one step, ``o + 1``, of
    each. Sorted by step, the windows of a run between two steps hold the block's own panes from the
    upper step onwards, and the following block's panes up to the lower step: two running totals.

    ``low`` and ``high`` are the first and the last window start wanted, and ``where`` a condition on the
    parts of a run. With ``merge`` a pane may come in several rows, added up where they meet.
    """
    n = size // slide
    # the hash tells apart the groups of a block whatever the key columns are, constant ones included
    group = [F.col("__block"), F.col("__group"), *_named(keys)]
    own = F.col("__own")  # the pane lies in the block itself, not in the following one

    offset = F.pmod(F.col("__pane"), _us(size))
    block = F.col("__pane") - offset
    spread = (
        panes.select(
            *_named(keys),
            *_named([p.name for p in parts]),
            (F.call_function("div", offset, _us(slide)) + 1).cast("int").alias("__step"),
            F.explode(
                F.array(
                    F.struct(block.alias("block"), F.lit(True).alias("own")),
                    F.struct((block - _us(size)).alias("block"), F.lit(False).alias("own")),
                )
            ).alias("__to"),
        )
        .select("*", F.col("__to.block").alias("__block"), F.col("__to.own").alias("__own"))
        .drop("__to")
        # the last pane of the following block enters no window that starts in this one
        .where(own | (F.col("__step") < n))
        .withColumn("__group", F.xxhash64(*_named(keys), "__block"))
        # A task gets the groups of a stretch of time, block by block. Its rows then have few window starts, which
        # columnar files write as short codes that recur from key to key; spread over all of time they are most of the result.
        .repartitionByRange(partitions, "__block", "__group")
    )
    if merge:
        spread = spread.groupBy(*group, "__step", "__own").agg(*[p.over_parts(F.col(f"`{p.name}`")).alias(p.name) for p in parts])

    upward = Window.partitionBy(*group).orderBy(F.col("__step"), own)
    downward = Window.partitionBy(*group).orderBy(F.col("__step").desc(), own.desc())
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    from_here = downward.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def mine(p):
        return F.when(own, F.col(f"`{p.name}`"))

    def theirs(p):
        return F.when(~own, F.col(f"`{p.name}`"))

    steps = spread.select(
        *_named(keys),
        "__block",
        F.lag("__step", 1, 0).over(upward).alias("__low"),
        F.col("__step"),
        F.lead("__step").over(upward).isNull().alias("__last"),
        *[p.over_parts(theirs(p)).over(before).alias(f"{p.name}_before") for p in parts],
        *[theirs(p).alias(f"{p.name}_entering") for p in parts],
        *[p.over_parts(mine(p)).over(from_here).alias(f"{p.name}_ahead") for p in parts],
    )

    def run(low, high, left, right):
        return F.struct(
            low.alias("low"),
            high.alias("high"),
            *[
                p.merge(F.col(f"`{p.name}_{left}`"), F.col(f"`{p.name}_{right}`")).alias(p.name)
                for p in parts
            ],
        )

    up_to_step = run(F.col("__low"), F.col("__step"), "ahead", "before")
    past_last_step = run(F.col("__step"), F.lit(n), "before", "entering")
    runs = (
        steps.select(
            *_named(keys),
            "__block",
            F.explode(
                F.when(F.col("__last"), F.array(up_to_step, past_last_step)).otherwise(F.array(up_to_step))
            ).alias("__run"),
        )
        .where((F.col("__run.low") < F.col("__run.high")) & F.col(f"__run.{ALL_ROWS.name}").isNotNull())
        .select(*_named(keys), "__block", "__run.*")
    )
    first = F.col("__block") + F.col("low") * _us(slide)
    last = F.col("__block") + (F.col("high") - 1) * _us(slide)
    if where is not None:
        runs = runs.where(where)
    if low is not None:
        first = F.greatest(first, F.lit(low))
    if high is not None:
        last = F.least(last, F.lit(high))
    if low is not None or high is not None:
        runs = runs.where(first <= last)
    return runs.select(
        *_named(keys),
        *_named([p.name for p in parts]),
        F.explode(F.sequence(first, last, _us(slide))).alias("__start"),
    )
