"""The four continuous queries.

Each ``*_result`` function maps rows to rows and is the same for tables and streams; each ``run_*``
function wires a topic, the query and its sinks together. The ``run_*`` functions also register their
decoded stream, and its hopping windows, under view names SQL text can use. ``view`` replaces the name
``planes``, ``flights`` or ``foobar`` and ``name`` the query's, for two runs of a job in one session. A
The hopping jobs keep a log of panes under their checkpoint (:mod:`skytally.streaming.panes`), whose further
``options`` they take: writers of ``late`` rows, ``mode="changes"``. A
topic is read from ``starting`` on, ``max_offsets`` records to a micro-batch: set the latter before
replaying a large topic, whose first micro-batch otherwise is all of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytally.functions import measures as M
from skytally.functions.aircraft import is_military, register_functions
from skytally.operators.decode import decode_aircraft, decode_flights, decode_nested, rejects
from skytally.operators.windows import hop, tumble
from skytally.schemas import NESTED_COLUMNS, PLANES_COLUMNS
from skytally.session import apply_conf
from skytally.sinks.encode import json_rows, key_count, key_count_json, text_rows
from skytally.sinks.write import Writer, to_console, to_split, to_topic
from skytally.sources.kafka import read_topic_stream
from skytally.sources.views import register_hops, register_view
from skytally.streaming.eventtime import record_time
from skytally.streaming.panes import Windows
from skytally.streaming.run import start

# Window sizes, the common slide, and the two lateness rules.
SLIDE = timedelta(seconds=5)
FIVE_MINUTES = timedelta(minutes=5)
ONE_HOUR = timedelta(hours=1)
NO_DELAY = timedelta(0)
DELAY = timedelta(seconds=30)

PINGS = M.count("icao", "pings")
ALTITUDES = (
    M.mean("altitude", "avgAltitude"),
    M.largest("altitude", "maxAltitude"),
    M.smallest("altitude", "minAltitude"),
)
STATS_ROW = ("icao", "pings", "hopStart", "hopEnd", "avgAltitude", "maxAltitude", "minAltitude")

# The jobs as SQL text, for tables and streams alike: the tumbling one over the view `flights`, the
# others over the views of hopping windows that `register_*` makes, whose plans they share.
PLANES_SQL = """
SELECT icao, pings, hopStart, hopEnd, avgAltitude, maxAltitude, minAltitude,
       isMilitary(icao) AS IsMilitaryPlane
FROM planes_hop5m
"""
FLIGHTS_HOURLY_SQL = """
SELECT icao, pings, hopStart, hopEnd, avgAltitude, maxAltitude, minAltitude FROM flights_hop1h
"""
FLIGHTS_TUMBLING_SQL = """
SELECT icao, count(icao) AS pings, altitude, window.start AS windowStart, window.end AS windowEnd
FROM flights
WHERE icao IS NOT NULL AND altitude IS NOT NULL
GROUP BY window(mytimestamp, '5 seconds'), icao, altitude
"""
NESTED_SQL = "SELECT mycount, field1, hopStart, hopEnd FROM foobar_hop1h"


def measured(rows: DataFrame) -> DataFrame:
    """Rows that have both a key and an altitude."""
    return rows.where(F.col("icao").isNotNull() & F.col("altitude").isNotNull())


def planes_result(
    planes: DataFrame, delay: timedelta = NO_DELAY, strategy: str = "auto", partitions: int | None = None
) -> DataFrame:
    """Per aircraft: pings and altitudes over the last five minutes, every five seconds."""
    stats = hop(
        measured(planes), "mytimestamp", FIVE_MINUTES, SLIDE, ["icao"], [PINGS, *ALTITUDES],
        strategy=strategy, delay=delay, partitions=partitions,
    )
    return _planes_row(stats)


def _planes_row(stats: DataFrame) -> DataFrame:
    military = is_military(F.col("icao")).alias("IsMilitaryPlane")
    return stats.select(*_flag(stats), *STATS_ROW, military)


def _flag(stats: DataFrame) -> list[str]:
    """The flag of changes, where a result has one, comes first."""
    return [c for c in ("change",) if c in stats.columns]


def planes_windows(
    planes: DataFrame, checkpoint: str, writers: Sequence[Writer], delay: timedelta = NO_DELAY, finish=_planes_row, **options
) -> Windows:
    """:func:`planes_result` of a stream, as a query over a log of panes."""
    return Windows(
        measured(planes), "mytimestamp", FIVE_MINUTES, SLIDE, ["icao"], [PINGS, *ALTITUDES], checkpoint, writers,
        delay=delay, finish=finish, **options,
    )


def flights_hourly_result(
    flights: DataFrame, delay: timedelta = DELAY, strategy: str = "auto", partitions: int | None = None
) -> DataFrame:
    """Per aircraft: pings and altitudes over the last hour, every five seconds."""
    stats = hop(
        measured(flights), "mytimestamp", ONE_HOUR, SLIDE, ["icao"], [PINGS, *ALTITUDES],
        strategy=strategy, delay=delay, partitions=partitions,
    )
    return stats.select(*STATS_ROW)


def flights_hourly_windows(
    flights: DataFrame, checkpoint: str, writers: Sequence[Writer], delay: timedelta = DELAY, finish=None, **options
) -> Windows:
    """:func:`flights_hourly_result` of a stream, as a query over a log of panes."""
    return Windows(
        measured(flights), "mytimestamp", ONE_HOUR, SLIDE, ["icao"], [PINGS, *ALTITUDES], checkpoint, writers, delay=delay,
        finish=finish or (lambda stats: stats.select(*_flag(stats), *STATS_ROW)), **options,
    )


def flights_tumbling_result(flights: DataFrame, delay: timedelta = DELAY, bounds: bool = True) -> DataFrame:
    """Pings per aircraft and altitude in each five seconds; ``bounds`` adds the window's times."""
    counts = tumble(
        measured(flights), "mytimestamp", SLIDE, ["icao", "altitude"], [PINGS],
        bounds=("windowStart", "windowEnd") if bounds else None, delay=delay,
    )
    return counts.select("icao", "pings", "altitude", *(["windowStart", "windowEnd"] if bounds else []))


def flights_tumbling_by_key_result(flights: DataFrame, delay: timedelta = DELAY) -> DataFrame:
    """Pings per aircraft in each five seconds, with or without an altitude."""
    keyed = flights.where(F.col("icao").isNotNull())
    return tumble(keyed, "mytimestamp", SLIDE, ["icao"], [PINGS], delay=delay)


def nested_result(
    foobar: DataFrame, delay: timedelta = DELAY, strategy: str = "auto", partitions: int | None = None
) -> DataFrame:
    """Messages per ``field1`` over the last hour, every five seconds."""
    counts = hop(
        foobar, "mytimestamp", ONE_HOUR, SLIDE, ["field1"], [M.count_rows("mycount")],
        strategy=strategy, delay=delay, partitions=partitions,
    )
    return counts.select("mycount", "field1", "hopStart", "hopEnd")


def nested_windows(
    foobar: DataFrame, checkpoint: str, writers: Sequence[Writer], delay: timedelta = DELAY, finish=None, **options
) -> Windows:
    """:func:`nested_result` of a stream, as a query over a log of panes."""
    row = lambda counts: counts.select(*_flag(counts), "mycount", "field1", "hopStart", "hopEnd")
    return Windows(
        foobar, "mytimestamp", ONE_HOUR, SLIDE, ["field1"], [M.count_rows("mycount")], checkpoint, writers, delay=delay,
        finish=finish or row, **options,
    )


def register_planes(planes: DataFrame, delay: timedelta = NO_DELAY, view: str = "planes") -> None:
    """The views ``planes`` and ``planes_hop5m``."""
    register_view(planes, view, time="mytimestamp", delay=delay)
    register_hops(
        measured(planes), f"{view}_hop5m", "mytimestamp", FIVE_MINUTES, SLIDE, ["icao"], [PINGS, *ALTITUDES], delay=delay
    )


def register_flights(flights: DataFrame, delay: timedelta = DELAY, view: str = "flights") -> None:
    """The views ``flights`` and, unless its altitude is text, ``flights_hop1h``."""
    register_view(flights, view, time="mytimestamp", delay=delay)
    if dict(flights.dtypes)["altitude"] != "string":
        register_hops(
            measured(flights), f"{view}_hop1h", "mytimestamp", ONE_HOUR, SLIDE, ["icao"], [PINGS, *ALTITUDES], delay=delay
        )


def register_foobar(foobar: DataFrame, delay: timedelta = DELAY, view: str = "foobar") -> None:
    """The views ``foobar`` and ``foobar_hop1h``."""
    register_view(foobar, view, NESTED_COLUMNS, time="mytimestamp", delay=delay)
    register_hops(
        foobar, f"{view}_hop1h", "mytimestamp", ONE_HOUR, SLIDE, ["field1"], [M.count_rows("mycount")], delay=delay
    )


def planes_table(messages: DataFrame, blank: str = "zero") -> DataFrame:
    """The columns of the ``planes`` view, event time taken from the record."""
    decoded = record_time(decode_aircraft(messages, blank=blank), "record_time")
    return decoded.select(*PLANES_COLUMNS)


def _split(options: dict) -> tuple[dict, bool]:
    """Options of the windows, and whether the run takes what its source holds now and stops."""
    return {k: v for k, v in options.items() if k != "bounded"}, options.get("bounded", False)


def run_planes(
    spark: SparkSession,
    read_topic: str,
    write_topic: str,
    properties: Mapping[str, str],
    checkpoint: str,
    delay: timedelta = NO_DELAY,
    interval: timedelta = SLIDE,
    messages: DataFrame | None = None,
    writers: list[Writer] | None = None,
    name: str | None = None,
    view: str = "planes",
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options,
) -> StreamingQuery:
    """Five-minute statistics as JSON rows to a topic and to the console.

    ``messages`` and ``writers`` replace the topic and the sinks, for instance with recorded files.
    """
    apply_conf(spark)
    register_functions(spark)
    source = messages if messages is not None else read_topic_stream(spark, read_topic, properties, starting, max_offsets)
    planes = planes_table(source)
    register_planes(planes, delay, view)
    sinks = writers or [to_topic(write_topic, properties, json_rows), to_console()]
    windows, bounded = _split(options)
    return planes_windows(planes, checkpoint, sinks, delay, **windows).start(name or f"planes from {read_topic}", interval, bounded)


def run_flights_hourly(
    spark: SparkSession,
    read_topic: str,
    write_topic: str,
    properties: Mapping[str, str],
    checkpoint: str,
    delay: timedelta = DELAY,
    interval: timedelta = SLIDE,
    messages: DataFrame | None = None,
    writers: list[Writer] | None = None,
    name: str | None = None,
    view: str = "flights",
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options,
) -> StreamingQuery:
    """One-hour statistics as comma-joined text to a topic and to the console."""
    apply_conf(spark)
    source = messages if messages is not None else read_topic_stream(spark, read_topic, properties, starting, max_offsets)
    flights = decode_flights(source)
    register_flights(flights, delay, view)
    sinks = writers or [to_console(), to_topic(write_topic, properties, text_rows)]
    windows, bounded = _split(options)
    return flights_hourly_windows(flights, checkpoint, sinks, delay, **windows).start(name or "flights hourly", interval, bounded)


def run_flights_tumbling(
    spark: SparkSession,
    read_topic: str,
    write_topic: str,
    properties: Mapping[str, str],
    checkpoint: str,
    delay: timedelta = DELAY,
    interval: timedelta = SLIDE,
    messages: DataFrame | None = None,
    writers: list[Writer] | None = None,
    name: str | None = None,
    view: str = "flights",
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options,
) -> StreamingQuery:
    """Five-second counts: whole rows to the console, key and count as JSON to a topic."""
    apply_conf(spark)
    source = messages if messages is not None else read_topic_stream(spark, read_topic, properties, starting, max_offsets)
    flights = decode_flights(source, altitude="string", rowtime="payload")
    register_flights(flights, delay, view)
    pairs = to_topic(write_topic, properties, lambda rows: key_count_json(key_count(rows))) if not writers else None
    return start(
        flights_tumbling_result(flights, delay), name or "flights tumbling", checkpoint,
        writers or [to_console(), pairs], interval=interval, **options,
    )


def run_nested(
    spark: SparkSession,
    read_topic: str,
    properties: Mapping[str, str],
    checkpoint: str,
    delay: timedelta = DELAY,
    interval: timedelta = SLIDE,
    messages: DataFrame | None = None,
    writers: list[Writer] | None = None,
    name: str | None = None,
    view: str = "foobar",
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options,
) -> StreamingQuery:
    """Hourly message counts of nested messages: schema and rows to the console."""
    apply_conf(spark)
    source = messages if messages is not None else read_topic_stream(spark, read_topic, properties, starting, max_offsets)
    foobar = decode_nested(source)
    register_foobar(foobar, delay, view)
    nested_result(foobar, delay).printSchema()
    windows, bounded = _split(options)
    return nested_windows(foobar, checkpoint, writers or [to_console()], delay, **windows).start(name or "nested hourly", interval, bounded)


def run_decoded(
    spark: SparkSession,
    read_topic: str,
    folder: str,
    properties: Mapping[str, str],
    checkpoint: str,
    key: str = "icao",
    blank: str = "zero",
    interval: timedelta = SLIDE,
    messages: DataFrame | None = None,
    name: str | None = None,
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options,
) -> StreamingQuery:
    """Aircraft messages, read and parsed once, to two tables: decoded rows, and rejects with a reason.

    :func:`decoded_table` and :func:`rejected_table` read them, as tables or as streams that other jobs start from.
    """
    source = messages if messages is not None else read_topic_stream(spark, read_topic, properties, starting, max_offsets)
    rows = decode_aircraft(source, blank=blank, key=key).withColumn("bad", F.col("reason").isNotNull())
    return start(
        rows, name or f"decoded {read_topic}", checkpoint, [to_split(folder, "bad", ("decoded", "rejects"))],
        interval=interval, **options,
    )


def _side(spark: SparkSession, folder: str, part: str, schema: str, stream: bool, files_per_batch: int | None) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).schema(schema)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/batch=*/part={part}")


def decoded_table(spark: SparkSession, folder: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """The decoded rows that :func:`run_decoded` wrote, in the columns of the ``planes`` view."""
    record = "flight string, timestamp_verbose string, msg_type int, track int, timestamp bigint, altitude int, counter bigint, lon double, lat double, icao string, speed int"
    rows = _side(spark, folder, "decoded", f"{record}, record_time timestamp", stream, files_per_batch)
    return record_time(rows, "record_time").select(*PLANES_COLUMNS)


def rejected_table(spark: SparkSession, folder: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """``value, reason, record_time`` of the messages that :func:`run_decoded` found no key in."""
    rows = _side(spark, folder, "rejects", "rejected string, reason string, record_time timestamp", stream, files_per_batch)
    return rows.withColumnRenamed("rejected", "value")


def run_rejects(
    spark: SparkSession,
    read_topic: str,
    key: str,
    properties: Mapping[str, str],
    checkpoint: str,
    writers: list[Writer],
    interval: timedelta = SLIDE,
    messages: DataFrame | None = None,
    name: str | None = None,
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options,
) -> StreamingQuery:
    """The messages of a topic that the other jobs find no ``key`` in, with the reason."""
    source = messages if messages is not None else read_topic_stream(spark, read_topic, properties, starting, max_offsets)
    return start(
        rejects(source, key), name or f"rejects of {read_topic}", checkpoint, writers, interval=interval, **options
    )
