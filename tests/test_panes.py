import json
import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from skytally.functions import measures as M
from skytally.operators.windows import hop
from skytally.session import work_dir
from skytally.sinks.write import to_parquet
from skytally.sources.files import read_recorded
from skytally.streaming import panes
from skytally.streaming.files import Folder
from skytally.streaming.panes import Windows
from tests.helpers import rows
from tests.test_streaming import FILES, MEASURES, SECOND, START, recorded

WINDOW = {"size": 15 * SECOND, "slide": 5 * SECOND}
ALL = [*MEASURES, M.mean("altitude", "mean"), M.smallest("altitude", "low"), M.count_rows("n")]


def job(stream, folder, size=15 * SECOND, slide=5 * SECOND, measures=ALL, **options):
    return Windows(stream, "t", size, slide, ["icao"], measures, f"{folder}/c", [to_parquet(f"{folder}/rows")], **options)


def ran(stream, **options):
    folder = work_dir(stream.sparkSession, "panes")
    work = job(stream, folder, **options)
    work.start("panes", bounded=True).awaitTermination()
    return work, folder


def model(files, size=15, slide=5, delay=30):
    """Windows by loops: per batch those closed, the rows that were late, and the windows as they stand."""
    held, emitted, late, latest = {}, [], [], None
    for file in files:
        closed = None if latest is None else latest - delay
        for t, key, high in file:
            first = t - t % slide
            if closed is not None and first + size <= closed:
                late.append((t, key))
                continue
            for start in range(first, first - size, -slide):
                if closed is None or start + size > closed:
                    held.setdefault((key, start), []).append(high)
        latest = max([t for t, _, _ in file] + ([] if latest is None else [latest]))
        now = latest - delay
        emitted.append({(k, s): len(v) for (k, s), v in held.items() if (closed is None or s + size > closed) and s + size <= now})
    return emitted, late, held


def test_windows_close_by_batch_as_by_loops(spark):
    stream, _ = recorded(spark, FILES)
    work, folder = ran(stream)
    emitted, late, _ = model(FILES)
    out = spark.read.parquet(f"{folder}/rows")
    got = [{} for _ in FILES]
    for r in out.collect():
        got[r.batch][r.icao, int(r.hopStart.timestamp()) - START] = r.pings
    assert got == emitted and sum(map(len, got)) > 15
    assert work.counts() == {"kept": sum(map(len, FILES)) - len(late), "late": len(late)}


@pytest.mark.parametrize("compact, size, few", [(2, 5, 16), (2, 15, 16), (16, 15, 0), (2, 60, 16), (16, 60, 3)])
def test_random_batches(spark, monkeypatch, compact, size, few):
    """Many batches, with rows out of order; every closed window equals the batch operator over the rows kept."""
    monkeypatch.setattr(panes, "COMPACT", compact)
    monkeypatch.setattr(panes, "FEW", few)
    pick = random.Random(size)
    files = [[(max(0, i * 20 + pick.randrange(-60, 25)), pick.choice("ABC"), pick.randrange(100)) for _ in range(15)] for i in range(5)]
    stream, _ = recorded(spark, files)
    work, folder = ran(stream, size=size * SECOND, delay=10 * SECOND)
    work.flush()
    emitted, late, held = model(files, size, 5, 10)
    out = spark.read.parquet(f"{folder}/rows")
    got = {(r.icao, int(r.hopStart.timestamp()) - START): (r.pings, r.sum, r.high, r.low) for r in out.collect()}
    assert got == {k: (len(v), sum(v), max(v), min(v)) for k, v in held.items()} and out.count() == len(held)
    assert work.counts()["late"] == len(late) and bool(late) == (size < 60)


def test_late_rows_are_written(spark):
    stream, folder = recorded(spark, FILES)
    out = work_dir(spark, "late")
    work, _ = ran(stream, late=[to_parquet(f"{out}/late")])
    _, late, _ = model(FILES)
    got = spark.read.parquet(f"{out}/late")
    assert Counter((int(r.t.timestamp()) - START, r.icao) for r in got.collect()) == Counter(late) and late
    assert work.counts()["kept"] + got.count() == spark.read.parquet(folder).count()


def grow(spark, folder, file):
    df = spark.createDataFrame(file, "s long, icao string, altitude int").coalesce(1)
    df.select(F.timestamp_seconds(F.col("s") + START).alias("t"), "icao", "altitude").write.mode("append").parquet(folder)


def test_flush_equals_batch_and_restart_goes_on(spark):
    source, folder = work_dir(spark, "source"), work_dir(spark, "flush")
    struct = spark.createDataFrame([], "t timestamp, icao string, altitude int").schema
    grow(spark, source, [(s, "AB"[s % 2], s) for s in range(100)])
    work = job(read_recorded(spark, source, stream=True, schema=struct), folder)
    work.flush()  # nothing has run
    work.start("flush", bounded=True).awaitTermination()
    work.flush()
    got = spark.read.parquet(f"{folder}/rows").drop("batch")
    assert rows(got) == rows(hop(spark.read.parquet(source), "t", keys=["icao"], measures=ALL, **WINDOW))
    n = got.count()
    work.flush()  # once more: the same rows in the same place
    assert spark.read.parquet(f"{folder}/rows").count() == n
    # a new run: rows of closed windows are late, others count
    grow(spark, source, [(50, "A", 1), (99, "A", 1), (300, "A", 1)])
    again = job(read_recorded(spark, source, stream=True, schema=struct), folder)
    again.start("flush", bounded=True).awaitTermination()
    again.flush()
    new = spark.read.parquet(f"{folder}/rows").where(F.col("hopEnd") > F.timestamp_seconds(F.lit(START + 120)))
    assert [r.pings for r in new.collect()] == [1, 1, 1] and again.counts() == {"kept": 101, "late": 2}
    assert spark.read.parquet(f"{folder}/rows").count() == n + 3


def test_a_repeated_batch_gives_the_same_rows(spark):
    """The result's writer fails in the second batch; the run is taken up again and repeats it."""
    stream, _ = recorded(spark, FILES)
    folder = work_dir(spark, "repeat")

    def broken(batch, number):
        if number == 1:
            raise RuntimeError("lost")

    work = job(stream, folder)
    work.writers.append(broken)
    with pytest.raises(Exception, match="lost"):
        work.start("repeat", bounded=True).awaitTermination()
    again = job(stream, folder)
    again.start("repeat", bounded=True).awaitTermination()
    whole, other = ran(stream)
    assert rows(spark.read.parquet(f"{folder}/rows")) == rows(spark.read.parquet(f"{other}/rows"))
    assert again.counts() == whole.counts()


@pytest.mark.parametrize("size", [5, 15])
def test_changes_add_up_to_the_result(spark, size):
    pick = random.Random(size)
    files = [[(max(0, i * 20 + pick.randrange(-60, 25)), pick.choice("ABC"), pick.randrange(100)) for _ in range(12)] for i in range(4)]
    stream, _ = recorded(spark, files)
    _, folder = ran(stream, size=size * SECOND, mode="changes")
    _, _, held = model(files, size)
    out = spark.read.parquet(f"{folder}/rows").orderBy("batch", "change").collect()
    sums, last = Counter(), {}
    for r in out:
        key = (r.icao, int(r.hopStart.timestamp()) - START)
        sums[key, r.pings, r["sum"], r.high] += 1 if r.change else -1
        if not r.change:
            assert last.pop(key) == (r.pings, r["sum"], r.high)  # takes back what stood
        else:
            assert key not in last
            last[key] = (r.pings, r["sum"], r.high)
    assert +sums == Counter({(k, len(v), sum(v), max(v)): 1 for k, v in held.items()}) and any(not r.change for r in out)


def test_rows_written_follow_keys_and_panes_not_windows(spark):
    """What a batch writes is a row for each key and pane, whatever the window's size."""
    steady = [[(i * 5 + s % 5, f"K{s}", s) for s in range(40)] for i in range(3)]
    for size in (5, 3600):
        stream, _ = recorded(spark, steady)
        _, folder = ran(stream, size=size * SECOND)
        assert [spark.read.parquet(f"{folder}/c/panes/{i}").count() for i in range(3)] == [40, 40, 40]


def test_old_panes_go(spark, monkeypatch):
    monkeypatch.setattr(panes, "COMPACT", 2)
    files = [[(i * 60 + s, "A", s) for s in range(0, 60, 10)] for i in range(7)]
    stream, _ = recorded(spark, files)
    work, folder = ran(stream, delay=timedelta(0))
    assert set(work.log.names()) == {"4", "5", "6", "merged-4", "merged-6"} and set(work.marks.names()) == set("456")
    assert spark.read.parquet(f"{folder}/c/panes/merged-6").count() <= 6
    mark = json.loads(work.marks.read("6"))
    assert mark["kept"] == 42 and mark["late"] == 0


def test_empty_batches_and_missing_times(spark):
    stream, _ = recorded(spark, [[(0, "A", 1)], [(100, None, None)]])
    work, folder = ran(stream.withColumn("t", F.when(F.col("icao") == "A", F.col("t"))))
    work.flush()
    assert [r.pings for r in spark.read.parquet(f"{folder}/rows").collect()] == [1, 1, 1] and work.counts() == {"kept": 1, "late": 0}
    none, _ = ran(stream.where("icao = 'nobody'"))
    none.flush()
    assert none.counts() == {"kept": 0, "late": 0}


def test_sizes_that_do_not_fit(spark):
    stream, _ = recorded(spark, FILES[:1])
    with pytest.raises(ValueError, match="multiple"):
        job(stream, "/tmp/x", size=14 * SECOND)
    with pytest.raises(ValueError, match="mode"):
        job(stream, "/tmp/x", mode="update")


def test_folder_of_texts(spark, tmp_path):
    folder = Folder(spark, f"{tmp_path}/a/b")
    assert folder.names() == [] and "x" not in folder
    folder.write("x", "one")
    folder.write("x", "twö")
    assert folder.read("x") == "twö" and folder.names() == ["x"] and "x" in folder
    folder.delete("x")
    folder.delete("x")
    assert folder.names() == []


def test_files_hold_stretches_of_time(spark):
    files = [[(20 * i, "ABCDEFGH"[i % 8], i) for i in range(2000)]]
    stream, _ = recorded(spark, files)
    _, folder = ran(stream, size=3600 * SECOND, partitions=4)
    got = spark.read.parquet(f"{folder}/rows")
    starts = got.select("hopStart").distinct().count()
    parts = got.groupBy(F.input_file_name()).agg(F.countDistinct("hopStart").alias("starts")).collect()
    assert len(parts) == 4 and sum(r.starts for r in parts) < 1.5 * starts
