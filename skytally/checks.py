"""Queries over the test tables, each with the same result in SQL where SQL can state it.

``CHECKS`` maps a name to a query ``(spark, folder of Parquet tables) -> DataFrame`` and its SQL, or
None. Both sides read the whole ``events`` table through the mapping in :mod:`skytally.fixtures`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally import fixtures as X
from skytally.functions import aircraft
from skytally.functions import measures as M
from skytally.functions.casts import lenient_double, lenient_int, lenient_long
from skytally.operators.decode import decode_aircraft, decode_flights, decode_nested, json_text, rejects
from skytally.operators.windows import hop, tumble
from skytally.plans import jobs
from skytally.session import work_dir
from skytally.sinks.encode import json_rows, key_count, key_count_json, text_rows
from skytally.sinks.write import to_console, to_parquet, to_text, with_ledger
from skytally.sources.files import read_recorded
from skytally.sources.views import by_sql, register_hop_function, register_view, run_sql
from skytally.streaming.eventtime import payload_time
from skytally.streaming.panes import Windows
from skytally.streaming.run import start

Query = Callable[[SparkSession, str], DataFrame]
CHECKS: dict[str, tuple[Query, str | None]] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        CHECKS[query.__name__] = (query, sql)
        return query

    return add


# --- SQL building blocks -------------------------------------------------------------------------

_RAW = X.RAW_SQL.format(text="varchar", events="events")
_WITH_PLANES = f"WITH raw AS ({_RAW}), planes AS ({X.PLANES_SQL.format(raw='raw')})"
_MEASURED = "icao IS NOT NULL AND altitude IS NOT NULL"
_STATS = """count(icao) AS pings, cast(sum(altitude) // count(altitude) AS bigint) AS avgAltitude,
    max(altitude) AS maxAltitude, min(altitude) AS minAltitude"""
_FIVE_SECONDS = "time_bucket(INTERVAL 5 SECOND, mytimestamp)"


def _hop_sql(keys: str, select: str, windows: int, source: str = "planes", where: str = _MEASURED) -> str:
    return f"""SELECT {keys}, hopStart, hopStart + INTERVAL {5 * windows} SECOND AS hopEnd, {select}
    FROM (SELECT *, {_FIVE_SECONDS} - k * INTERVAL 5 SECOND AS hopStart
          FROM {source}, range({windows}) t(k) WHERE {where})
    GROUP BY {keys}, hopStart"""


_HOP5M = f"""{_WITH_PLANES}, hops AS ({_hop_sql('icao', _STATS, 60)})
SELECT icao, pings, hopStart, hopEnd, avgAltitude, maxAltitude, minAltitude,
       starts_with(upper(icao), 'AE') AS IsMilitaryPlane FROM hops"""
_HOP1H = f"{_WITH_PLANES} {_hop_sql('icao', _STATS, 720)}"


def _planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.planes(X.events(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.messages(X.events(spark, sf_dir))


def _zoneless(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- projection, filter, decoding ----------------------------------------------------------------


@check(f"""{_WITH_PLANES} SELECT counter, icao, msg_type, altitude, mytimestamp FROM planes WHERE {_MEASURED}""")
def q_filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.measured(_planes(spark, sf_dir))


@check(f"{_WITH_PLANES} SELECT * FROM planes")
def q_star_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(_planes(spark, sf_dir), "planes_all")
    return run_sql(spark, "SELECT * FROM planes_all")


_AIRCRAFT_SQL = f"""SELECT icao, CASE WHEN msg_type = 1 THEN concat('FL', counter) END AS flight,
    strftime(mytimestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_verbose, msg_type,
    cast(NULL AS int) AS track, cast(NULL AS varchar) AS equipment, cast(NULL AS varchar) AS tail,
    mytimestamp AS record_time, cast(floor(epoch(mytimestamp)) AS bigint) AS "timestamp",
    CASE WHEN msg_type IN (3, 5, 7) THEN coalesce(try_cast(altitude_txt AS int), 0) END AS altitude,
    counter,
    CASE WHEN msg_type = 3 THEN cast(concat('-97.', counter % 1000) AS double) END AS lon,
    CASE WHEN msg_type = 3 THEN counter % 90 + 0.5::double END AS lat,
    CASE WHEN msg_type = 4 THEN CASE WHEN counter % 3 = 0 THEN 0 ELSE cast(counter % 500 AS int) END END AS speed
    FROM ({_RAW})"""


@check(f"SELECT * FROM ({_AIRCRAFT_SQL})")
def q_decode_by_msg_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_aircraft(_messages(spark, sf_dir))


@check(f"""SELECT icao, concat('FL', counter) AS flight, cast(msg_type AS varchar) AS msg_type,
    date_trunc('second', mytimestamp) AS "timestamp", try_cast(altitude_txt AS bigint) AS altitude,
    cast(counter AS varchar) AS counter, concat('-97.', counter % 1000) AS lon, concat(counter % 90, '.5') AS lat,
    '' AS vr, '' AS track, strftime(mytimestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_verbose, CASE WHEN counter % 3 = 0 THEN '' ELSE cast(counter % 500 AS varchar) END AS speed,
    mytimestamp FROM ({_RAW})""")
def q_decode_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = decode_flights(_messages(spark, sf_dir))
    return _zoneless(flights, "timestamp")


@check("""SELECT event_type AS field1, cast(user_id AS varchar) AS field2,
    regexp_extract(props, '"k": ([0-9]+)', 1) AS field3nested1, ts AS mytimestamp FROM events""")
def q_nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_nested(X.nested_messages(X.events(spark, sf_dir)))


@check("""SELECT event_id, regexp_extract(props, '"k": ([0-9]+)', 1) AS k FROM events""")
def q_json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.events(spark, sf_dir).select("event_id", json_text(F.col("props"), "$.k").alias("k"))


@check(f"""SELECT counter, CASE WHEN counter % 41 = 0 THEN 'malformed' ELSE 'missing_key' END AS reason
    FROM ({_RAW}) WHERE counter % 41 = 0 OR icao IS NULL""")
def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = X.broken_messages(X.events(spark, sf_dir))
    return rejects(broken, "icao").select("counter", "reason")


@check(f"""SELECT counter, CASE WHEN counter % 7 = 0 THEN NULL ELSE icao END AS icao,
    CASE WHEN msg_type = 1 AND counter % 5 <> 0 THEN concat('FL', counter) END AS flight,
    CASE WHEN counter % 3 <> 0 THEN strftime(mytimestamp, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp_verbose,
    counter % 7 = 0 OR icao IS NULL AS rejected FROM ({_RAW})""")
def q_text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, booleans and objects in text fields are null, and such keys are rejected."""
    odd = X.odd_text_messages(X.events(spark, sf_dir))
    decoded = decode_aircraft(odd).select("counter", "icao", "flight", "timestamp_verbose")
    rejected = rejects(odd, "icao").select(F.get_json_object("value", "$.counter").cast("bigint").alias("c"))
    joined = decoded.join(rejected, F.col("counter") == F.col("c"), "left")
    return joined.withColumn("rejected", F.col("c").isNotNull()).drop("c")


_TEXTS = ("digits", "padded", "decimal_text", "too_long", "scientific", "words")


@check("""SELECT event_id,
    cast(event_id AS int) AS digits_int, event_id AS digits_long, cast(event_id AS double) AS digits_double,
    cast(event_id AS int) AS digits_int_null,
    cast(user_id AS int) AS padded_int, user_id AS padded_long, cast(user_id AS double) AS padded_double,
    cast(user_id AS int) AS padded_int_null,
    cast(-user_id AS int) AS decimal_text_int, -user_id AS decimal_text_long,
    -user_id - 0.75::double AS decimal_text_double, cast(-user_id AS int) AS decimal_text_int_null,
    0 AS too_long_int, (user_id + 100) * 100000000000 AS too_long_long,
    cast((user_id + 100) * 100000000000 AS double) AS too_long_double, cast(NULL AS int) AS too_long_int_null,
    CASE WHEN user_id % 40 < 10 THEN cast(pow(10, user_id % 40) AS int) ELSE 2147483647 END AS scientific_int,
    CASE WHEN user_id % 40 < 19 THEN cast(pow(10, user_id % 40) AS bigint)
         ELSE 9223372036854775807 END AS scientific_long,
    cast(concat('1e', user_id % 40) AS double) AS scientific_double,
    CASE WHEN user_id % 40 < 10 THEN cast(pow(10, user_id % 40) AS int) ELSE 2147483647 END AS scientific_int_null,
    0 AS words_int, cast(0 AS bigint) AS words_long, cast(0 AS double) AS words_double,
    cast(NULL AS int) AS words_int_null
    FROM events""")
def q_lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = X.number_texts(X.events(spark, sf_dir))
    casts = []
    for name in _TEXTS:
        text = F.col(name)
        casts += [
            lenient_int(text).alias(f"{name}_int"),
            lenient_long(text).alias(f"{name}_long"),
            lenient_double(text).alias(f"{name}_double"),
            lenient_int(text, "null").alias(f"{name}_int_null"),
        ]
    return texts.select("event_id", *casts)


@check(f"""SELECT counter, date_trunc('second', mytimestamp) AS eventTime FROM ({_RAW})""")
def q_epoch_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = payload_time(decode_aircraft(_messages(spark, sf_dir)), "timestamp", "eventTime")
    return _zoneless(decoded.select("counter", "eventTime"), "eventTime")


# --- functions -----------------------------------------------------------------------------------


@check(f"""SELECT DISTINCT icao, starts_with(upper(icao), 'AE') AS military, starts_with(icao, 'AE') AS exactCase,
    starts_with(upper(icao), 'AE') AS fromSql FROM ({_RAW})""")
def q_is_military(spark: SparkSession, sf_dir: str) -> DataFrame:
    aircraft.register_functions(spark)
    icao = F.col("icao")
    return _planes(spark, sf_dir).select("icao").distinct().select(
        "icao",
        aircraft.is_military(icao).alias("military"),
        aircraft.is_military_exact_case(icao).alias("exactCase"),
        F.expr("isMilitary(icao)").alias("fromSql"),
    )


def _shown(column: str) -> str:
    return f"coalesce(cast({column} AS varchar), 'null')"


@check(f"""SELECT counter, 'icao: ' || {_shown('icao')} || ' flight: ' || {_shown('flight')} || ' timestamp: ' ||
    "timestamp" || ' msg_type: ' || msg_type || ' altitude: ' || {_shown('altitude')} || ' speed: ' ||
    {_shown('speed')} || ' lat: ' || coalesce(printf('%.6f', lat), 'null') || ' lon: ' ||
    coalesce(printf('%.6f', lon), 'null') || ' counter: ' || counter || ' equipment: null tail: null' AS line
    FROM ({_AIRCRAFT_SQL})""")
def q_report_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_aircraft(_messages(spark, sf_dir)).select("counter", aircraft.report_line().alias("line"))


# --- windows -------------------------------------------------------------------------------------


@check(f"""{_WITH_PLANES} SELECT icao, altitude, count(icao) AS pings, {_FIVE_SECONDS} AS windowStart,
    {_FIVE_SECONDS} + INTERVAL 5 SECOND AS windowEnd FROM planes WHERE {_MEASURED} GROUP BY ALL""")
def q_tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flights_tumbling_result(_planes(spark, sf_dir))


@check(f"""SELECT icao, pings, altitude FROM ({_WITH_PLANES} SELECT icao, altitude, {_FIVE_SECONDS} AS w,
    count(icao) AS pings FROM planes WHERE {_MEASURED} GROUP BY ALL)""")
def q_tumble_count_no_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flights_tumbling_result(_planes(spark, sf_dir), bounds=False)


@check(f"""{_WITH_PLANES} SELECT icao, count(icao) AS pings, {_FIVE_SECONDS} AS windowStart,
    {_FIVE_SECONDS} + INTERVAL 5 SECOND AS windowEnd FROM planes WHERE icao IS NOT NULL GROUP BY ALL""")
def q_tumble_count_by_icao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flights_tumbling_by_key_result(_planes(spark, sf_dir))


@check(_HOP5M)
def q_hop5m_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.planes_result(_planes(spark, sf_dir))


@check(_HOP5M)
def q_hop5m_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    aircraft.register_functions(spark)
    jobs.register_planes(_planes(spark, sf_dir))
    return run_sql(spark, jobs.PLANES_SQL)


@check(_HOP1H)
def q_hop1h_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flights_hourly_result(_planes(spark, sf_dir))


_NESTED_SQL = """SELECT event_type AS field1, ts AS mytimestamp FROM events"""


@check(_hop_sql("field1", "count(*) AS mycount", 720, f"({_NESTED_SQL})", "true"))
def q_hop1h_count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.nested_result(decode_nested(X.nested_messages(X.events(spark, sf_dir))))


_MEANS = "count(icao) AS pings, avg(altitude) AS avgAltitude, sum(altitude)::bigint AS sumAltitude"


@check(f"{_WITH_PLANES} {_hop_sql('icao', _MEANS, 60)}")
def q_hop5m_double_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [
        jobs.PINGS,
        M.mean("altitude", "avgAltitude", mode="double"),
        M.total("altitude", "sumAltitude"),
    ]
    rows = jobs.measured(_planes(spark, sf_dir))
    return hop(rows, "mytimestamp", jobs.FIVE_MINUTES, jobs.SLIDE, ["icao"], measures)


@check(f"""{_WITH_PLANES} SELECT icao, {_FIVE_SECONDS} AS windowStart, {_FIVE_SECONDS} + INTERVAL 5 SECOND AS windowEnd,
    {_STATS} FROM planes WHERE icao IS NOT NULL GROUP BY ALL""")
def q_tumble_stats_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _planes(spark, sf_dir).where(F.col("icao").isNotNull())
    return tumble(keyed, "mytimestamp", jobs.SLIDE, ["icao"], [jobs.PINGS, *jobs.ALTITUDES])


@check(_HOP1H)
def q_hop1h_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.register_flights(_planes(spark, sf_dir))
    return run_sql(spark, jobs.FLIGHTS_HOURLY_SQL)


@check(f"""{_WITH_PLANES} SELECT icao, count(icao) AS pings, altitude, {_FIVE_SECONDS} AS windowStart,
    {_FIVE_SECONDS} + INTERVAL 5 SECOND AS windowEnd FROM planes WHERE {_MEASURED} GROUP BY ALL""")
def q_tumble_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.register_flights(_planes(spark, sf_dir))
    return run_sql(spark, jobs.FLIGHTS_TUMBLING_SQL)


@check(_hop_sql("field1", "count(*) AS mycount", 720, f"({_NESTED_SQL})", "true"))
def q_nested_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.register_foobar(decode_nested(X.nested_messages(X.events(spark, sf_dir))))
    return run_sql(spark, jobs.NESTED_SQL)


# --- jobs end to end, from JSON text -------------------------------------------------------------


@check(_HOP5M)
def q_planes_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.planes_result(jobs.planes_table(_messages(spark, sf_dir)))


_HOURLY_JOB = f"""WITH raw AS ({_RAW}), planes AS (SELECT icao, try_cast(altitude_txt AS bigint) AS altitude, mytimestamp
    FROM raw) {_hop_sql('icao', _STATS, 720)}"""


@check(_HOURLY_JOB)
def q_flights_hourly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flights_hourly_result(decode_flights(_messages(spark, sf_dir)))


@check(f"""SELECT icao, altitude_txt AS altitude, count(*) AS pings,
    time_bucket(INTERVAL 5 SECOND, date_trunc('second', mytimestamp)) AS windowStart,
    time_bucket(INTERVAL 5 SECOND, date_trunc('second', mytimestamp)) + INTERVAL 5 SECOND AS windowEnd
    FROM ({_RAW}) WHERE icao IS NOT NULL GROUP BY ALL""")
def q_flights_tumbling_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = decode_flights(_messages(spark, sf_dir), altitude="string", rowtime="payload")
    return _zoneless(jobs.flights_tumbling_result(flights), "windowStart", "windowEnd")


# --- sinks ---------------------------------------------------------------------------------------

_JAVA_TIME = "'%Y-%m-%d %H:%M:%S.0'"
_JSON_TIME = "'%Y-%m-%dT%H:%M:%S.000Z'"


@check(f"""SELECT concat_ws(',', icao, pings, strftime(hopStart, {_JAVA_TIME}), strftime(hopEnd, {_JAVA_TIME}),
    avgAltitude, maxAltitude, minAltitude, IsMilitaryPlane) AS value FROM ({_HOP5M})""")
def q_sink_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_rows(jobs.planes_result(_planes(spark, sf_dir)))


@check(f"""{_WITH_PLANES} SELECT coalesce(icao, 'null') || ',' || counter || ',' ||
    coalesce(cast(altitude AS varchar), 'null') AS value FROM planes""")
def q_sink_text_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_rows(_planes(spark, sf_dir).select("icao", "counter", "altitude"))


_PAIRS = f"""{_WITH_PLANES} SELECT icao, altitude, {_FIVE_SECONDS} AS w, count(icao) AS pings
    FROM planes WHERE {_MEASURED} GROUP BY ALL"""


@check(f"""SELECT '{{"icao":"' || icao || '","count":"' || pings || '"}}' AS value FROM ({_PAIRS})""")
def q_sink_json_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_count_json(key_count(jobs.flights_tumbling_result(_planes(spark, sf_dir))))


@check(f"SELECT icao, pings FROM ({_PAIRS})")
def q_typed_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_count(jobs.flights_tumbling_result(_planes(spark, sf_dir), bounds=False))


@check(f"""SELECT '{{"icao":"' || icao || '","pings":' || pings || ',"hopStart":"' || strftime(hopStart, {_JSON_TIME})
    || '","hopEnd":"' || strftime(hopEnd, {_JSON_TIME}) || '","avgAltitude":' || avgAltitude || ',"maxAltitude":' ||
    maxAltitude || ',"minAltitude":' || minAltitude || ',"IsMilitaryPlane":' || IsMilitaryPlane || '}}' AS value
    FROM ({_HOP5M})""")
def q_sink_json_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_rows(jobs.planes_result(_planes(spark, sf_dir)))


# --- streams -------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = X.events(spark, sf_dir).schema
    return read_recorded(spark, sf_dir, stream=True, schema=schema, pattern="events.parquet")


def _collected(
    result: DataFrame, folder: str, mode: str = "append", keep_batch: bool = False
) -> DataFrame:
    """Run a stream over what its source holds and read back what it wrote."""
    spark = result.sparkSession
    query = start(
        result, folder.rsplit("/", 1)[-1], f"{folder}/checkpoint", [to_parquet(f"{folder}/rows")],
        mode=mode, bounded=True,
    )
    query.awaitTermination()
    schema = T.StructType([*result.schema, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{folder}/rows")
    return rows if keep_batch else rows.drop("batch")


def _windowed(spark: SparkSession, label: str, make, flush: bool = False) -> DataFrame:  # noqa: ANN001
    """Run windows over a log of panes to the end of their source and read back what they wrote."""
    folder = work_dir(spark, label)
    windows = make(f"{folder}/checkpoint", [to_parquet(f"{folder}/rows")])
    windows.start(folder.rsplit("/", 1)[-1], bounded=True).awaitTermination()
    if flush:
        windows.flush()
    return _zoneless(spark.read.parquet(f"{folder}/rows").drop("batch"), "hopStart", "hopEnd")


# Rows the final watermark leaves in open windows are not emitted by a bounded run.
_CLOSED = f"""(SELECT max(mytimestamp) - INTERVAL 30 SECOND FROM planes WHERE {_MEASURED})"""


_HOP5M_CLOSED = f"""{_WITH_PLANES}, hops AS ({_hop_sql('icao', _STATS, 60)})
SELECT icao, pings, hopStart, hopEnd, avgAltitude, maxAltitude, minAltitude,
       starts_with(upper(icao), 'AE') AS IsMilitaryPlane FROM hops WHERE hopEnd <= {_CLOSED}"""


@check(_HOP5M_CLOSED)
def q_stream_hop5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    planes = X.planes(_event_stream(spark, sf_dir))
    return _windowed(spark, "hop5m", lambda *to: jobs.planes_windows(planes, *to, delay=jobs.DELAY))


_TUMBLE_CLOSED = f"""{_WITH_PLANES}, counts AS (SELECT icao, altitude, {_FIVE_SECONDS} AS windowStart,
    {_FIVE_SECONDS} + INTERVAL 5 SECOND AS windowEnd, count(icao) AS pings
    FROM planes WHERE {_MEASURED} GROUP BY ALL) SELECT * FROM counts WHERE windowEnd <= {_CLOSED}"""


@check(_TUMBLE_CLOSED)
def q_stream_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = jobs.flights_tumbling_result(X.planes(_event_stream(spark, sf_dir)))
    return _zoneless(_collected(result, work_dir(spark, "tumble")), "windowStart", "windowEnd")


_NESTED_STREAM = f"""WITH foobar AS ({_NESTED_SQL}), hops AS
    ({_hop_sql('field1', 'count(*) AS mycount', 720, 'foobar', 'true')})
    SELECT * FROM hops WHERE hopEnd <= (SELECT max(mytimestamp) - INTERVAL 30 SECOND FROM foobar)"""


@check(_NESTED_STREAM)
def q_stream_hop1h_count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    foobar = decode_nested(X.nested_messages(_event_stream(spark, sf_dir)))
    return _windowed(spark, "nested", lambda *to: jobs.nested_windows(foobar, *to))


@check(_HOP5M_CLOSED.replace("INTERVAL 30 SECOND", "INTERVAL 0 SECOND"))
def q_stream_hop5m_no_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship's own rule: a watermark without delay. One micro-batch takes all, so none is late."""
    planes = X.planes(_event_stream(spark, sf_dir))
    return _windowed(spark, "hop5m-no-delay", lambda *to: jobs.planes_windows(planes, *to))


@check(_HOP5M)
def q_stream_hop5m_flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an end-of-input batch, a bounded run gives every window of the batch query."""
    planes = X.planes(_event_stream(spark, sf_dir))
    return _windowed(spark, "hop5m-flushed", lambda *to: jobs.planes_windows(planes, *to, delay=jobs.DELAY), flush=True)


# The four texts, continuously: the hopping ones over the windows that each batch closes.


@check(_HOP5M_CLOSED)
def q_stream_sql_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    aircraft.register_functions(spark)
    planes = X.planes(_event_stream(spark, sf_dir))
    text = by_sql(jobs.PLANES_SQL.replace("planes_hop5m", "planes_live_hop5m"), "planes_live_hop5m")
    return _windowed(spark, "sql-planes", lambda *to: jobs.planes_windows(planes, *to, delay=jobs.DELAY, finish=text))


@check(f"SELECT * FROM ({_HOP1H}) WHERE hopEnd <= ({_WITH_PLANES} SELECT max(mytimestamp) - INTERVAL 30 SECOND FROM planes WHERE {_MEASURED})")
def q_stream_sql_flights_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    planes = X.planes(_event_stream(spark, sf_dir))
    text = by_sql(jobs.FLIGHTS_HOURLY_SQL.replace("flights_hop1h", "flights_live_hop1h"), "flights_live_hop1h")
    return _windowed(spark, "sql-hourly", lambda *to: jobs.flights_hourly_windows(planes, *to, finish=text))


@check(_TUMBLE_CLOSED)
def q_stream_sql_flights_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs.register_flights(jobs.measured(X.planes(_event_stream(spark, sf_dir))), view="flights_counted")
    text = jobs.FLIGHTS_TUMBLING_SQL.replace("FROM flights", "FROM flights_counted")
    return _zoneless(_collected(run_sql(spark, text), work_dir(spark, "sql-tumbling")), "windowStart", "windowEnd")


@check(_NESTED_STREAM)
def q_stream_sql_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    foobar = decode_nested(X.nested_messages(_event_stream(spark, sf_dir)))
    text = by_sql(jobs.NESTED_SQL.replace("foobar_hop1h", "foobar_live_hop1h"), "foobar_live_hop1h")
    return _windowed(spark, "sql-nested", lambda *to: jobs.nested_windows(foobar, *to, finish=text))


@check(f"""SELECT sink, value FROM (SELECT '{{"icao":"' || icao || '","count":"' || pings || '"}}' AS pair,
    icao || ',' || pings || ',' || altitude || ',' || strftime(windowStart, {_JAVA_TIME}) || ',' ||
    strftime(windowEnd, {_JAVA_TIME}) AS line FROM ({_TUMBLE_CLOSED})),
    LATERAL (VALUES ('text', line), ('pairs', pair)) t(sink, value)""")
def q_stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream to the console and two topic-shaped sinks; the rows of those, read back."""
    folder = work_dir(spark, "fan-out")
    result = jobs.flights_tumbling_result(X.planes(_event_stream(spark, sf_dir)))
    pairs = to_text(f"{folder}/pairs", lambda rows: key_count_json(key_count(rows)))
    writers = [to_console(lambda line: None), to_text(f"{folder}/text", text_rows), pairs]
    start(result, folder.rsplit("/", 1)[-1], f"{folder}/checkpoint", writers, bounded=True).awaitTermination()
    sinks = [spark.read.text(f"{folder}/{s}").select(F.lit(s).alias("sink"), "value") for s in ("text", "pairs")]
    return sinks[0].union(sinks[1])


# Rows arrive in three batches of ten days; some come one or two batches late.
_ARRIVAL = """least(2, cast(floor((day(ts) - 1) / 10) AS int)
    + CASE WHEN event_id % 17 = 0 THEN 1 WHEN event_id % 19 = 0 THEN 2 ELSE 0 END)"""
_ARRIVALS = 3
_KEPT = f"""{_WITH_PLANES}, arrived AS (
        SELECT p.*, {_ARRIVAL} AS arrival FROM planes p JOIN events e ON p.counter = e.event_id WHERE {_MEASURED}),
    marks AS (SELECT a.arrival, (SELECT max(mytimestamp) - INTERVAL 30 SECOND FROM arrived b
                                 WHERE b.arrival < a.arrival) AS mark
              FROM (SELECT DISTINCT arrival FROM arrived) a),
    kept AS (SELECT icao, arrived.arrival, {_FIVE_SECONDS} AS windowStart,
                    {_FIVE_SECONDS} + INTERVAL 5 SECOND AS windowEnd
             FROM arrived JOIN marks USING (arrival)
             WHERE mark IS NULL OR {_FIVE_SECONDS} + INTERVAL 5 SECOND > mark)"""


def _arriving(spark: SparkSession, sf_dir: str, label: str, mode: str) -> DataFrame:
    """Feed the arrivals one at a time to a query that stops after each and resumes from its checkpoint."""
    folder = work_dir(spark, label)
    events = X.events(spark, sf_dir)
    rows = None
    for arrival in range(_ARRIVALS):
        events.where(F.expr(_ARRIVAL) == arrival).write.mode("append").parquet(f"{folder}/source")
        stream = read_recorded(spark, f"{folder}/source", stream=True, schema=events.schema)
        planes = jobs.measured(X.planes(stream))
        result = tumble(planes, "mytimestamp", jobs.SLIDE, ["icao"], [jobs.PINGS], delay=jobs.DELAY)
        rows = _collected(result, folder, mode, keep_batch=True)
    return _zoneless(rows, "windowStart", "windowEnd")


@check(f"""{_KEPT} SELECT icao, windowStart, windowEnd, count(icao) AS pings FROM kept
    WHERE windowEnd <= (SELECT max(mytimestamp) - INTERVAL 30 SECOND FROM arrived)
    GROUP BY icao, windowStart, windowEnd""")
def q_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arriving(spark, sf_dir, "late", "append").drop("batch")


@check(f"""{_KEPT} SELECT icao, windowStart, windowEnd, count(icao) AS pings FROM kept
    GROUP BY icao, windowStart, windowEnd""")
def q_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _arriving(spark, sf_dir, "update", "update")
    keys = ["icao", "windowStart", "windowEnd"]
    return changes.groupBy(*keys).agg(F.max_by("pings", "batch").alias("pings"))


# Windows over a log of panes, fed the same arrivals.


def _arrivals(spark: SparkSession, sf_dir: str, label: str, mode: str = "append") -> str:
    """Feed the arrivals one at a time to five-second windows of a resumed query; the folder of what it wrote."""
    folder = work_dir(spark, label)
    events = X.events(spark, sf_dir)
    for arrival in range(_ARRIVALS):
        events.where(F.expr(_ARRIVAL) == arrival).write.mode("append").parquet(f"{folder}/source")
        stream = read_recorded(spark, f"{folder}/source", stream=True, schema=events.schema)
        windows = Windows(
            jobs.measured(X.planes(stream)), "mytimestamp", jobs.SLIDE, jobs.SLIDE, ["icao"], [jobs.PINGS], f"{folder}/checkpoint",
            [to_parquet(f"{folder}/rows")], bounds=("windowStart", "windowEnd"), late=[to_parquet(f"{folder}/late")], mode=mode,
        )
        windows.start(folder.rsplit("/", 1)[-1], bounded=True).awaitTermination()
    return folder


@check(f"""{_KEPT}, counted AS (SELECT icao, windowStart, windowEnd, arrival, count(*) AS n FROM kept GROUP BY ALL),
    results AS (SELECT icao, windowStart, windowEnd, arrival,
        cast(sum(n) OVER (PARTITION BY icao, windowStart ORDER BY arrival) AS bigint) AS new, n FROM counted)
    SELECT cast(arrival AS bigint) AS batch, icao, windowStart, windowEnd, true AS change, new AS pings FROM results
    UNION ALL SELECT cast(arrival AS bigint), icao, windowStart, windowEnd, false, new - n FROM results WHERE new > n""")
def q_stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result as changes: what each batch takes back, and what it puts in its place."""
    folder = _arrivals(spark, sf_dir, "changes", "changes")
    rows = spark.read.parquet(f"{folder}/rows").withColumn("batch", F.col("batch").cast("bigint"))
    return _zoneless(rows, "windowStart", "windowEnd")


@check(f"""{_KEPT} SELECT icao, mytimestamp, altitude, counter, arrived.arrival AS batch FROM arrived JOIN marks USING (arrival)
    WHERE mark IS NOT NULL AND {_FIVE_SECONDS} + INTERVAL 5 SECOND <= mark""".replace("arrived.arrival AS batch", "cast(arrived.arrival AS bigint) AS batch"))
def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that came too late for every window of theirs, with the batch they came in."""
    folder = _arrivals(spark, sf_dir, "late-rows")
    rows = spark.read.parquet(f"{folder}/late").withColumn("batch", F.col("batch").cast("bigint"))
    return _zoneless(rows.select("icao", "mytimestamp", "altitude", "counter", "batch"), "mytimestamp")


@check(f"""SELECT sink, icao, pings, altitude, windowStart, windowEnd FROM ({_TUMBLE_CLOSED}),
    LATERAL (VALUES ('first'), ('second')) t(sink)""")
def q_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sinks that append; the query dies between them, and the ledger keeps the first from a second copy."""
    folder = work_dir(spark, "once")
    dies = {"left": 1}

    def append(sink: str):  # noqa: ANN202
        def write(batch: DataFrame, number: int) -> None:
            if sink == "second" and dies["left"]:
                dies["left"] -= 1
                raise RuntimeError("killed between two sinks")
            batch.write.mode("append").parquet(f"{folder}/{sink}")

        return write

    for _ in range(2):
        result = jobs.flights_tumbling_result(X.planes(_event_stream(spark, sf_dir)))
        writers = with_ledger({s: append(s) for s in ("first", "second")}, f"{folder}/written")
        query = start(result, folder.rsplit("/", 1)[-1], f"{folder}/checkpoint", writers, bounded=True)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if "killed between two sinks" not in str(error):
                raise
    sinks = [spark.read.parquet(f"{folder}/{s}").withColumn("sink", F.lit(s)) for s in ("first", "second")]
    return _zoneless(sinks[0].union(sinks[1]), "windowStart", "windowEnd")


# --- windows whose size is in the SQL text -------------------------------------------------------


def _sized(slide: int, size: int, label: str) -> str:
    parts = size // slide
    bucket = f"time_bucket(INTERVAL {slide} SECOND, mytimestamp)"
    return f"""SELECT '{label}' AS label, icao, pings, hopStart, hopEnd, avgAltitude, maxAltitude, minAltitude FROM (
    SELECT icao, hopStart, hopStart + INTERVAL {size} SECOND AS hopEnd, {_STATS}
    FROM (SELECT *, {bucket} - k * INTERVAL {slide} SECOND AS hopStart FROM planes, range({parts}) t(k) WHERE {_MEASURED})
    GROUP BY icao, hopStart)"""


@check(f"{_WITH_PLANES} {_sized(5, 300, 'a')} UNION ALL {_sized(60, 3600, 'b')} UNION ALL {_sized(10, 10, 'c')}")
def q_hop_sizes_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table function, three sizes and slides, all from the text."""
    register_hop_function(jobs.measured(_planes(spark, sf_dir)), "planes_hop", "mytimestamp", ["icao"], [jobs.PINGS, *jobs.ALTITUDES])
    columns = "icao, pings, hopStart, hopEnd, avgAltitude, maxAltitude, minAltitude"
    hops = (("a", "'5' SECOND", "'5' MINUTE"), ("b", "'1' MINUTE", "'1' HOUR"), ("c", "'10' SECOND", "'10' SECOND"))
    texts = [f"SELECT '{label}' AS label, {columns} FROM planes_hop(INTERVAL {slide}, INTERVAL {size})" for label, slide, size in hops]
    return run_sql(spark, " UNION ALL ".join(texts))


@check(f"""WITH raw AS ({_RAW}) SELECT 'decoded' AS side, icao AS name, count(*) AS n FROM raw
    WHERE counter % 41 <> 0 AND icao IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'rejects', CASE WHEN counter % 41 = 0 THEN 'malformed' ELSE 'missing_key' END, count(*) FROM raw
    WHERE counter % 41 = 0 OR icao IS NULL GROUP BY ALL""")
def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read and parsed once, to decoded rows and to rejects; both read back as tables."""
    folder = work_dir(spark, "decoded")
    messages = X.broken_messages(_event_stream(spark, sf_dir)).select("value", "timestamp")
    jobs.run_decoded(
        spark, "planes", f"{folder}/out", {}, f"{folder}/checkpoint", messages=messages, name=folder.rsplit("/", 1)[-1], bounded=True
    ).awaitTermination()
    sides = (("decoded", jobs.decoded_table, "icao"), ("rejects", jobs.rejected_table, "reason"))
    counts = [of(spark, f"{folder}/out").groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).withColumn("side", F.lit(s)) for s, of, c in sides]
    return counts[0].union(counts[1])
