"""Naming tables and streams for SQL text."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from skytally.functions.measures import ALL_ROWS, ROWS, Measure, Part, check_types, distinct_parts, for_keys, for_types
from skytally.operators.windows import hop
from skytally.streaming.eventtime import with_watermark

#: A size to take a result's column types from.
_ANY = timedelta(seconds=1)


def register_view(
    rows: DataFrame,
    name: str,
    columns: Sequence[str] | None = None,
    time: str | None = None,
    delay: timedelta = timedelta(seconds=30),
) -> DataFrame:
    """Expose ``columns`` of a table or stream under ``name``, with a watermark on ``time`` if a stream."""
    if columns is not None:
        rows = rows.select(*[f"`{c}`" for c in columns])
    if time is not None:
        rows = with_watermark(rows, time, delay)
    rows.createOrReplaceTempView(name)
    return rows


def register_hops(
    rows: DataFrame,
    name: str,
    time: str,
    size: timedelta,
    slide: timedelta,
    keys: Sequence[str],
    measures: Sequence[Measure],
    **options,
) -> DataFrame:
    """Expose the hopping windows of a table or stream under ``name``, a row per key and window.

    SQL text then runs on the plan of :func:`skytally.operators.windows.hop`, which ``options`` go to.
    """
    hops = hop(rows, time, size, slide, keys, measures, **options)
    hops.createOrReplaceTempView(name)
    return hops


def by_sql(text: str, view: str) -> Callable[[DataFrame], DataFrame]:
    """Continuous SQL: a function of each batch's rows that names them ``view`` and runs ``text`` over them."""

    def finish(rows: DataFrame) -> DataFrame:
        rows.createOrReplaceTempView(view)
        return rows.sparkSession.sql(text)

    return finish


def _over_rows(part: Part) -> str:
    if part.column == ROWS:
        return "count(1)"
    if part.kind == "wide_sum":
        return f"sum(CAST(`{part.column}` AS decimal(20,0)))"
    return f"{part.kind}(`{part.column}`)"


def _over_parts(part: Part, value: str) -> str:
    return f"{part.kind if part.kind in ('min', 'max') else 'sum'}({value})"


def _merged(part: Part, left: str, right: str) -> str:
    if part.kind in ("min", "max"):
        return f"{'least' if part.kind == 'min' else 'greatest'}({left}, {right})"
    return f"coalesce({left} + {right}, {left}, {right})"


def _value(measure: Measure) -> str:
    got = [f"`{p.name}`" for p in measure.parts()]
    if measure.kind in ("mean", "long_mean"):
        return f"CAST({got[0]} AS double) / nullif({got[1]}, 0)"
    if measure.kind == "whole_mean":
        return f"{got[0]} div nullif({got[1]}, 0)"
    if measure.kind == "key_count":
        return f"CASE WHEN `{measure.column}` IS NOT NULL THEN {got[0]} ELSE 0L END"
    return got[0]


def register_hop_function(
    rows: DataFrame,
    name: str,
    time: str,
    keys: Sequence[str],
    measures: Sequence[Measure],
    bounds: tuple[str, str] = ("hopStart", "hopEnd"),
) -> None:
    """A table function ``name(slide, size)`` of intervals: the hopping windows of ``rows``, as SQL text asks for them.

        SELECT icao, pings, hopEnd FROM planes_hop(INTERVAL '5' SECOND, INTERVAL '1' HOUR)

    ``rows`` is a table, exposed as the view ``<name>_rows``. The plan is that of the ``runs`` way of
    :func:`skytally.operators.windows.hop`, whose docstring tells how windows come from running totals: the
    arguments are constants in it, and as many tasks as the session has shuffle partitions write each result. A size
    that is no multiple of the slide is an error.
    """
    if rows.isStreaming:
        raise ValueError("a table function reads a table; on a stream use streaming.panes with by_sql")
    check_types(measures, rows.schema)
    measures = for_types(for_keys(measures, keys), rows.schema)
    parts = distinct_parts(measures)
    result = hop(rows, time, _ANY, _ANY, keys, measures, bounds)
    rows.createOrReplaceTempView(f"{name}_rows")
    key = ", ".join(f"`{k}`" for k in keys)
    named = ", ".join(f"`{p.name}`" for p in parts)
    size, slide = "unix_micros(timestamp_micros(0) + size)", "unix_micros(timestamp_micros(0) + slide)"
    size = f"CASE WHEN {size} % {slide} = 0 THEN {size} ELSE raise_error('size must be a multiple of slide') END"
    within = f"PARTITION BY __block, __group, {key}"
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    upward, downward = f"{within} ORDER BY __step, __own", f"{within} ORDER BY __step DESC, __own DESC"
    totals = ", ".join(
        f"{_over_parts(p, f'CASE WHEN NOT __own THEN `{p.name}` END')} OVER ({upward} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS `{p.name}_before`, "
        f"CASE WHEN NOT __own THEN `{p.name}` END AS `{p.name}_entering`, "
        f"{_over_parts(p, f'CASE WHEN __own THEN `{p.name}` END')} OVER ({downward} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS `{p.name}_ahead`"
        for p in parts
    )

    def run(low: str, high: str, left: str, right: str) -> str:
        merged = ", ".join(f"{_merged(p, f'`{p.name}_{left}`', f'`{p.name}_{right}`')} AS `{p.name}`" for p in parts)
        return f"struct({low} AS low, {high} AS high, {merged})"

    zoneless = dict(result.dtypes)[bounds[0]] == "timestamp_ntz"
    instant = (lambda us: f"CAST(timestamp_micros({us}) AS timestamp_ntz)") if zoneless else (lambda us: f"timestamp_micros({us})")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema)
    text = f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(slide INTERVAL DAY TO SECOND, size INTERVAL DAY TO SECOND) RETURNS TABLE ({columns}) RETURN
SELECT {key}, {instant("__start")}, {instant(f"__start + {size}")}, {", ".join(_value(m) for m in measures)}
FROM (SELECT {key}, __run.*, explode(sequence(__block + __run.low * {slide}, __block + (__run.high - 1) * {slide}, {slide})) AS __start
FROM (SELECT {key}, __block, explode(CASE WHEN __last THEN array({run("__low", "__step", "ahead", "before")},
      {run("__step", f"CAST({size} div {slide} AS int)", "before", "entering")}) ELSE array({run("__low", "__step", "ahead", "before")}) END) AS __run
FROM (SELECT {key}, __block, lag(__step, 1, 0) OVER ({upward}) AS __low, __step, lead(__step) OVER ({upward}) IS NULL AS __last, {totals}
FROM (SELECT /*+ REPARTITION_BY_RANGE({partitions}, __block, __group) */ *, xxhash64({key}, __block) AS __group
FROM (SELECT {key}, {named}, CAST(pmod(__pane, {size}) div {slide} + 1 AS int) AS __step, __to.block AS __block, __to.own AS __own
FROM (SELECT *, explode(array(struct(__pane - pmod(__pane, {size}) AS block, true AS own),
      struct(__pane - pmod(__pane, {size}) - {size} AS block, false AS own))) AS __to
FROM (SELECT {key}, __us - pmod(__us, {slide}) AS __pane, {", ".join(f"{_over_rows(p)} AS `{p.name}`" for p in parts)}
FROM (SELECT *, unix_micros(CAST(`{time}` AS timestamp)) AS __us FROM {name}_rows WHERE `{time}` IS NOT NULL)
GROUP BY {key}, __us - pmod(__us, {slide}))))
WHERE __own OR __step < {size} div {slide})))
WHERE __run.low < __run.high AND __run.`{ALL_ROWS.name}` IS NOT NULL)"""
    rows.sparkSession.sql(text)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """SQL over registered views; over a streaming view the result is a stream."""
    return spark.sql(text)
