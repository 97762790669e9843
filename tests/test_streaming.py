import os
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from skytally.functions import measures as M
from skytally.operators.decode import decode_aircraft, rejects
from skytally.operators.windows import hop, tumble
from skytally.plans import jobs
from skytally.schemas import MESSAGE
from skytally.session import work_dir
from skytally.sinks.encode import json_rows, text_rows
from skytally.sinks.write import to_console, to_parquet, to_text, with_ledger
from skytally.sources.files import read_lines, read_recorded
from skytally.sources.views import register_hop_function, register_view, run_sql
from skytally.streaming.run import LateRows, dropped_late_rows, start
from tests.helpers import plan, rows

SECOND = timedelta(seconds=1)
START = 1522075000
# one file per micro-batch: (seconds after START, key, altitude)
FILES = [
    [(0, "A", 100), (3, "A", 201), (7, "B", 50), (61, "A", 10)],
    [(20, "LATE", 1), (40, "OKLATE", 1), (103, "A", 7)],
    [(200, "Z", 1), (30, "LATE2", 5), (2, "VLATE", 5)],
    [(260, "Z", 1), (30, "L3", 5), (95, "L4", 5)],
]
SCHEMA = "t timestamp, icao string, altitude int"
MEASURES = [M.count("icao", "pings"), M.total("altitude", "sum"), M.largest("altitude", "high")]


def recorded(spark, files, schema=SCHEMA):
    """Write one Parquet file after the other, so that the stream reads them in order."""
    folder = work_dir(spark, "source")
    for file in files:
        data = [(t, k, a) for t, k, a in file]
        df = spark.createDataFrame(data, "s long, icao string, altitude int").coalesce(1)
        df.select(F.timestamp_seconds(F.col("s") + START).alias("t"), "icao", "altitude").write.mode(
            "append"
        ).parquet(folder)
        time.sleep(0.02)
    struct = spark.createDataFrame([], schema).schema
    return read_recorded(spark, folder, stream=True, schema=struct, files_per_batch=1), folder


def run(spark, result, mode="append"):
    folder = work_dir(spark, "run")
    query = start(result, "test", f"{folder}/checkpoint", [to_parquet(f"{folder}/rows")], mode, bounded=True)
    query.awaitTermination()
    out = spark.read.parquet(f"{folder}/rows")
    return out, query


@pytest.mark.parametrize("strategy", ["window", "explode"])
def test_hop_with_late_rows(spark, strategy):
    stream, _ = recorded(spark, FILES)
    result = hop(
        stream, "t", 15 * SECOND, 5 * SECOND, ["icao"], MEASURES, strategy=strategy, delay=30 * SECOND
    )
    out, query = run(spark, result)
    by_batch = {r.batch: r["count"] for r in out.groupBy("batch").count().collect()}
    assert [by_batch.get(i, 0) for i in range(5)] == [0, 8, 9, 7, 3]
    assert dropped_late_rows(query) == [0, 0, 3, 3, 0]
    keys = {r.icao for r in out.select("icao").distinct().collect()}
    assert "OKLATE" in keys and not keys & {"VLATE", "L3"}


def test_stream_equals_batch_where_windows_closed(spark):
    steady = [[(i * 40 + s, f"K{s % 3}", s) for s in range(40)] for i in range(4)]
    stream, folder = recorded(spark, steady)
    batch = spark.read.parquet(folder)
    closed = F.col("hopEnd") <= F.timestamp_seconds(F.lit(START + 159 - 30))
    expected = rows(hop(batch, "t", 60 * SECOND, 5 * SECOND, ["icao"], MEASURES).where(closed))
    for strategy in ("auto", "window", "explode"):
        out, query = run(spark, hop(stream, "t", 60 * SECOND, 5 * SECOND, ["icao"], MEASURES, strategy=strategy))
        assert rows(out.drop("batch")) == expected, strategy
        assert sum(dropped_late_rows(query)) == 0


def test_batch_only_strategies_are_refused(spark):
    stream, _ = recorded(spark, FILES)
    for strategy in ("panes", "runs"):
        with pytest.raises(ValueError, match="batch only"):
            hop(stream, "t", 15 * SECOND, 5 * SECOND, ["icao"], MEASURES, strategy=strategy)


def test_zoneless_stream(spark):
    stream, _ = recorded(spark, FILES)
    zoneless = stream.withColumn("t", F.col("t").cast("timestamp_ntz"))
    result = tumble(zoneless, "t", 5 * SECOND, ["icao"], MEASURES)
    out, _ = run(spark, result)
    assert out.count() > 0 and dict(result.dtypes)["windowStart"] == "timestamp"


def test_resume_and_replay(spark):
    """The same checkpoint goes on where it stopped; a new one starts over."""
    folder = work_dir(spark, "grow")
    struct = spark.createDataFrame([], SCHEMA).schema

    def add(file):
        df = spark.createDataFrame(file, "s long, icao string, altitude int")
        df.select(F.timestamp_seconds(F.col("s") + START).alias("t"), "icao", "altitude").write.mode(
            "append"
        ).parquet(folder)

    def take(checkpoint):
        stream = read_recorded(spark, folder, stream=True, schema=struct)
        result = tumble(stream, "t", 5 * SECOND, ["icao"], MEASURES)
        query = start(result, "grow", f"{checkpoint}/c", [to_parquet(f"{checkpoint}/rows")], bounded=True)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    first = work_dir(spark, "first")
    add([(0, "A", 1), (70, "A", 1)])
    assert take(first) == 2
    add([(71, "A", 1), (200, "A", 1)])
    assert take(first) == 2
    assert take(work_dir(spark, "second")) == 4
    got = spark.read.parquet(f"{first}/rows").orderBy("windowStart")
    assert [r.pings for r in got.collect()] == [1, 2]


def test_update_mode_repeats_changed_windows(spark):
    stream, _ = recorded(spark, [[(0, "A", 1)], [(1, "A", 1)], [(2, "A", 1)]])
    out, _ = run(spark, tumble(stream, "t", 5 * SECOND, ["icao"], MEASURES), mode="update")
    assert [r.pings for r in out.orderBy("batch").collect()] == [1, 2, 3]


def test_fan_out_feeds_every_writer(spark, capsys):
    stream, _ = recorded(spark, FILES)
    folder = work_dir(spark, "fan")
    result = tumble(stream, "t", 5 * SECOND, ["icao"], MEASURES)
    writers = [to_console(), to_text(f"{folder}/text", text_rows), to_text(f"{folder}/json", json_rows),
               to_parquet(f"{folder}/rows")]
    start(result, "fan", f"{folder}/checkpoint", writers, bounded=True).awaitTermination()
    n = spark.read.parquet(f"{folder}/rows").count()
    assert n > 0
    assert spark.read.text(f"{folder}/text").count() == n
    assert spark.read.json(f"{folder}/json").count() == n
    assert "batch 0" in capsys.readouterr().out


def _write_line(path):
    def show(line):
        with open(f"{path}/{os.getpid()}", "a") as out:
            out.write(line + "\n")

    return show


@pytest.mark.parametrize("beside", [0, 1])
def test_console_prints_every_row_and_commits_all_state(spark, tmp_path, beside):
    files = [[(i * 200 + s, f"K{s % 50}", s) for s in range(120)] for i in range(4)]
    stream, folder = recorded(spark, files)
    out = work_dir(spark, "console")
    result = tumble(stream, "t", 5 * SECOND, ["icao"], MEASURES)
    writers = [to_console(_write_line(str(tmp_path))), *[to_parquet(f"{out}/rows")] * beside]
    start(result, "console", f"{out}/c", writers, bounded=True).awaitTermination()
    printed = sorted(line for f in tmp_path.iterdir() for line in f.read_text().splitlines())
    closed = F.col("windowEnd") <= F.timestamp_seconds(F.lit(START + 719 - 30))
    expected = text_rows(tumble(spark.read.parquet(folder), "t", 5 * SECOND, ["icao"], MEASURES).where(closed))
    assert len(printed) > 300 and printed == sorted(r.value for r in expected.collect())


def test_a_writer_that_reads_little_leaves_no_state_uncommitted(spark):
    files = [[(i * 200 + s, f"K{s % 50}", s) for s in range(120)] for i in range(4)]
    for writers in ([lambda b, n: b.show(1)], [lambda b, n: None, lambda b, n: b.take(1)]):
        stream, _ = recorded(spark, files)
        out = work_dir(spark, "lazy")
        query = start(tumble(stream, "t", 5 * SECOND, ["icao"], MEASURES), "lazy", f"{out}/c", writers, bounded=True)
        query.awaitTermination()
        assert len(query.recentProgress) >= 4


def test_jobs_with_their_default_console(spark):
    """Every job runs several stateful batches with the console as its sink."""
    _, folder = messages_file(spark)
    spark.read.parquet(folder).repartition(4).write.parquet(f"{folder}-4")
    for job, arguments in ((jobs.run_planes, ("t", "w", {})), (jobs.run_flights_hourly, ("t", "w", {})), (jobs.run_nested, ("t", {}))):
        stream = read_recorded(spark, f"{folder}-4", stream=True, schema=MESSAGE, files_per_batch=1)
        if job is jobs.run_nested:
            stream = stream.withColumn("value", F.concat(F.lit('{"field1":"a'), F.col("timestamp").cast("string"), F.lit('"}')))
        writers = {} if job is jobs.run_nested else {"writers": [to_console()]}
        out = work_dir(spark, "job")
        query = job(spark, *arguments, f"{out}/c", messages=stream, name=out[-8:], view=f"v{out[-8:]}", bounded=True, **writers)
        query.awaitTermination()
        assert len(query.recentProgress) >= 4


def messages_file(spark):
    folder = work_dir(spark, "messages")
    df = spark.range(0, 400).select(
        F.format_string(
            '{"flight":"F","timestamp_verbose":"x","msg_type":"%s","track":"","timestamp":%s,"altitude":"%s",'
            '"counter":%s,"lon":"1.5","icao":"%s","vr":"","lat":"2.5","speed":""}',
            F.when(F.col("id") % 4 == 0, "8").otherwise("5"),
            F.col("id") + START,
            F.when(F.col("id") % 9 == 0, "").otherwise((F.col("id") * 10).cast("string")),
            F.col("id"),
            F.concat(F.lit("ae"), (F.col("id") % 3).cast("string")),
        ).alias("value"),
        F.timestamp_seconds(F.col("id") + START).alias("timestamp"),
    )
    df.write.parquet(folder)
    return df, folder


@pytest.mark.parametrize(
    ("job", "result", "table", "options"),
    [
        (jobs.run_planes, jobs.planes_result, jobs.planes_table, {"delay": jobs.DELAY}),
        (jobs.run_flights_hourly, jobs.flights_hourly_result, jobs.decode_flights, {}),
    ],
)
def test_jobs_from_recorded_messages(spark, job, result, table, options):
    batch, folder = messages_file(spark)
    stream = read_recorded(spark, folder, stream=True, schema=MESSAGE)
    out = work_dir(spark, "job")
    query = job(
        spark, "planes", "stats", {}, f"{out}/checkpoint", messages=stream, writers=[to_parquet(f"{out}/rows")],
        bounded=True, **options,
    )
    query.awaitTermination()
    closed = F.col("hopEnd") <= F.timestamp_seconds(F.lit(START + 399 - 30))
    expected = rows(result(table(batch)).where(closed))
    assert expected and rows(spark.read.parquet(f"{out}/rows").drop("batch")) == expected


def test_tumbling_and_nested_jobs(spark, capsys):
    _, folder = messages_file(spark)
    stream = read_recorded(spark, folder, stream=True, schema=MESSAGE)
    out = work_dir(spark, "job")
    jobs.run_flights_tumbling(
        spark, "planes", "counts", {}, f"{out}/c1", messages=stream, writers=[to_parquet(f"{out}/r1")], bounded=True
    ).awaitTermination()
    got = spark.read.parquet(f"{out}/r1")
    assert got.where("altitude = ''").count() > 0 and dict(got.dtypes)["altitude"] == "string"
    nested = stream.withColumn("value", F.lit('{"field1":"a","field2":"b","field3":{"nested1":"c"}}'))
    jobs.run_nested(
        spark, "nested", {}, f"{out}/c2", messages=nested, writers=[to_parquet(f"{out}/r2")], bounded=True
    ).awaitTermination()
    assert spark.read.parquet(f"{out}/r2").columns[:4] == ["mycount", "field1", "hopStart", "hopEnd"]
    assert "mycount: long" in capsys.readouterr().out


def test_rejects_job(spark):
    folder, out = work_dir(spark, "mixed"), work_dir(spark, "rejects")
    texts = ['{"icao":"A"}', "nope", '{"flight":"F"}', '{"icao":null}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    df.withColumn("timestamp", F.timestamp_seconds(F.lit(START))).write.parquet(folder)
    stream = read_recorded(spark, folder, stream=True, schema=MESSAGE)
    jobs.run_rejects(
        spark, "planes", "icao", {}, f"{out}/c", [to_parquet(f"{out}/rows")], messages=stream, bounded=True
    ).awaitTermination()
    got = {r.value: r.reason for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {texts[1]: "malformed", texts[2]: "missing_key", texts[3]: "missing_key"}


def test_input_with_a_watermark(spark):
    stream, _ = recorded(spark, FILES)
    marked = stream.withWatermark("t", "30 seconds")
    for compute in (
        lambda s: hop(s, "t", 15 * SECOND, 5 * SECOND, ["icao"], MEASURES, strategy="window"),
        lambda s: tumble(s, "t", 5 * SECOND, ["icao"], MEASURES),
    ):
        assert rows(run(spark, compute(stream))[0]) == rows(run(spark, compute(marked))[0])
    with pytest.raises(ValueError, match="watermark"):
        hop(marked, "t", 60 * SECOND, 5 * SECOND, ["icao"], MEASURES, strategy="explode")
    for size in (60, 65):  # whatever the number of windows, a marked stream is taken
        hop(marked, "t", size * SECOND, 5 * SECOND, ["icao"], MEASURES)


def test_delay_that_is_no_multiple_of_the_slide(spark):
    """``explode`` may close a window up to one slide later than ``window``, with the same rows."""
    results = []
    for strategy in ("window", "explode"):
        stream, _ = recorded(spark, FILES)
        out, _ = run(spark, hop(stream, "t", 15 * SECOND, 5 * SECOND, ["icao"], MEASURES, strategy=strategy, delay=31 * SECOND))
        results.append({(r.icao, r.hopStart): r.pings for r in out.collect()})
    window, explode = results
    assert window.items() >= explode.items()
    assert len(window) - len(explode) <= 3


def test_sql_over_a_streaming_view(spark):
    batch, folder = messages_file(spark)
    stream = read_recorded(spark, folder, stream=True, schema=MESSAGE)
    jobs.register_functions(spark)
    jobs.register_planes(jobs.planes_table(stream), jobs.DELAY)
    out, _ = run(spark, run_sql(spark, jobs.PLANES_SQL))
    closed = F.col("hopEnd") <= F.timestamp_seconds(F.lit(START + 399 - 30))
    assert rows(out.drop("batch")) == rows(jobs.planes_result(jobs.planes_table(batch)).where(closed))


def test_lines_take_their_time_from_the_payload(spark):
    folder = work_dir(spark, "lines")
    spark.createDataFrame([('{"timestamp": 1522075071}',), ("nope",)], "value string").write.text(folder)
    assert read_lines(spark, folder, stream=True, files_per_batch=1).isStreaming
    times = [r[0] for r in read_lines(spark, folder).selectExpr("unix_seconds(timestamp)").collect()]
    assert sorted(times, key=str) == [1522075071, None]


def test_a_ledger_repeats_no_sink(spark):
    """Sinks that append; the second dies in the second batch, once before and once after it wrote."""
    stream, folder = recorded(spark, [[(i * 100 + s, "A", s) for s in range(4)] for i in range(4)])
    out = work_dir(spark, "ledger")
    dies = {"second": [1, 2]}

    def append(name):
        def write(batch, number):
            if name == "second" and number in dies["second"]:
                dies["second"].remove(number)
                raise RuntimeError("killed")
            batch.withColumn("number", F.lit(number)).write.mode("append").parquet(f"{out}/{name}")

        return write

    for attempt in range(3):
        writers = with_ledger({n: append(n) for n in ("first", "second", "third")}, f"{out}/written")
        query = start(stream, "ledger", f"{out}/c", writers, bounded=True)
        if attempt < 2:
            with pytest.raises(Exception, match="killed"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    expected = rows(spark.read.parquet(folder))
    for name in ("first", "second", "third"):
        assert rows(spark.read.parquet(f"{out}/{name}").drop("number")) == expected
    assert not dies["second"] and sorted(os.listdir(f"{out}/written/third".removeprefix("file:")))[-4:] == ["0", "1", "2", "3"]


def test_late_rows_are_counted_over_all_batches(spark):
    """Progress is kept for two batches here; the listener counts them all."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    listener = LateRows().listen(spark)
    try:
        stream, _ = recorded(spark, FILES)
        result = hop(stream, "t", 15 * SECOND, 5 * SECOND, ["icao"], MEASURES, delay=30 * SECOND)
        _, query = run(spark, result)
        for _ in range(100):
            if str(query.runId) in listener.ended:
                break
            time.sleep(0.1)
        assert listener.dropped[str(query.id)] == 6 and listener.batches[str(query.id)] >= 5
        assert sum(dropped_late_rows(query)) < 6
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set(key, before)


class _Event:
    def __init__(self, drops):
        self.progress = type("P", (), {"id": "q", "stateOperators": [type("O", (), {"numRowsDroppedByWatermark": d}) for d in drops]})


def test_listener_adds_up_more_batches_than_progress_keeps():
    listener = LateRows()
    for i in range(250):
        listener.onQueryProgress(_Event([i % 3, 1]))
    assert listener.batches["q"] == 250 and listener.dropped["q"] == 250 + sum(i % 3 for i in range(250))


def test_messages_are_decoded_once_for_both_sides(spark):
    """Decoded rows and rejects of one pass, and windows that stream from the decoded table."""
    batch, folder = messages_file(spark)
    bad = spark.createDataFrame([("nope",), ('{"flight":"F"}',), ('{"icao":7}',)], "value string")
    bad.withColumn("timestamp", F.timestamp_seconds(F.lit(START))).write.mode("append").parquet(folder)
    whole = spark.read.schema(MESSAGE).parquet(folder)
    stream = read_recorded(spark, folder, stream=True, schema=MESSAGE)
    out = work_dir(spark, "sides")
    jobs.run_decoded(spark, "planes", f"{out}/t", {}, f"{out}/c1", messages=stream, bounded=True).awaitTermination()
    got = rows(jobs.rejected_table(spark, f"{out}/t").select("value", "reason"))
    assert got == rows(rejects(whole, "icao").select("value", "reason")) and len(got) == 3
    good = jobs.planes_table(whole).where("icao IS NOT NULL")
    assert rows(jobs.decoded_table(spark, f"{out}/t")) == rows(good)
    typed = jobs.decoded_table(spark, f"{out}/t", stream=True)
    work = jobs.planes_windows(typed, f"{out}/c2", [to_parquet(f"{out}/rows")])
    work.start("from decoded", bounded=True).awaitTermination()
    work.flush()
    assert rows(spark.read.parquet(f"{out}/rows").drop("batch")) == rows(jobs.planes_result(good))


def test_one_decode_reads_its_messages_once(spark):
    batch, _ = messages_file(spark)
    sides = decode_aircraft(batch, key="icao").withColumn("bad", F.col("reason").isNotNull())
    text = plan(sides)
    assert text.count("FileScan") + text.count("Scan parquet") <= 2 and text.count("try_parse_json") <= 2


def test_hop_function(spark):
    data = [(i * 7 % 400, "AB"[i % 2] if i % 11 else None, i if i % 5 else None) for i in range(300)]
    table = spark.createDataFrame(data, "s long, icao string, altitude int").withColumn("t", F.timestamp_seconds(F.col("s") + START))
    measures = [M.count("icao", "pings"), M.total("altitude", "sum"), M.mean("altitude", "mean"), M.smallest("altitude", "low"), M.largest("altitude", "high"), M.mean("s", "s_mean", "double")]
    for zone in ("timestamp", "timestamp_ntz"):
        timed = table.withColumn("t", F.col("t").cast(zone))
        register_hop_function(timed, "hops", "t", ["icao"], measures)
        for slide, size in ((5, 5), (5, 60), (20, 300)):
            got = run_sql(spark, f"SELECT * FROM hops(INTERVAL '{slide}' SECOND, INTERVAL '{size}' SECOND)")
            expected = hop(timed, "t", size * SECOND, slide * SECOND, ["icao"], measures)
            assert got.schema.simpleString() == expected.schema.simpleString() and rows(got) == rows(expected)
            assert "Expand" not in plan(got)
    by_name = run_sql(spark, "SELECT count(*) AS n FROM hops(size => INTERVAL '1' MINUTE, slide => INTERVAL '20' SECOND)")
    assert by_name.first().n == hop(table, "t", 60 * SECOND, 20 * SECOND, ["icao"], measures).count()
    with pytest.raises(Exception, match="multiple"):
        run_sql(spark, "SELECT * FROM hops(INTERVAL '7' SECOND, INTERVAL '1' MINUTE)").collect()
    stream, _ = recorded(spark, FILES[:1])
    with pytest.raises(ValueError, match="table"):
        register_hop_function(stream, "hops", "t", ["icao"], MEASURES)


def test_hop_function_keeps_its_tasks(spark):
    """Adaptive execution does not merge the small pane rows into a few tasks; each writes a stretch of time."""
    table = spark.range(3000).select((F.col("id") % 50).cast("string").alias("icao"), F.timestamp_seconds(F.col("id") * 30).alias("t"))
    register_hop_function(table, "kept_hops", "t", ["icao"], [M.count_rows("n")])
    got = run_sql(spark, "SELECT * FROM kept_hops(INTERVAL '1' MINUTE, INTERVAL '1' HOUR)")
    tasks = got.groupBy(F.spark_partition_id()).agg(F.countDistinct("hopStart").alias("starts"), F.count("*").alias("n")).collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r.n for r in tasks) < 2 * got.count() / len(tasks)
    assert sum(r.starts for r in tasks) < 1.5 * got.select("hopStart").distinct().count()


def test_jobs_that_emit_changes(spark):
    _, folder = messages_file(spark)
    stream = read_recorded(spark, folder, stream=True, schema=MESSAGE)
    out = work_dir(spark, "job")
    jobs.run_planes(
        spark, "planes", "stats", {}, f"{out}/c", messages=stream, writers=[to_parquet(f"{out}/rows")], mode="changes", bounded=True
    ).awaitTermination()
    got = spark.read.parquet(f"{out}/rows")
    assert got.columns[0] == "change" and rows(got.drop("change", "batch")) == rows(jobs.planes_result(jobs.planes_table(spark.read.parquet(folder))))
