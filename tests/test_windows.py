import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skytally.functions import measures as M
from skytally.operators.windows import STRATEGIES, hop, tumble
from tests.helpers import exchanges, plan, rows

SECOND = timedelta(seconds=1)
MEASURES = [
    M.count("v", "n"), M.count_rows("all"), M.total("v", "sum"), M.smallest("v", "low"),
    M.largest("v", "high"), M.mean("v", "whole"), M.mean("v", "exact", mode="double"),
]


def table(spark, data):
    """Rows of (key, microseconds since the epoch, value)."""
    df = spark.createDataFrame(data, "k string, us long, v int")
    return df.select("k", F.timestamp_micros("us").alias("t"), "v")


def brute_force(data, size, slide):
    windows = defaultdict(list)
    size, slide = size // timedelta(microseconds=1), slide // timedelta(microseconds=1)
    for k, us, v in data:
        start = us - us % slide
        while start > us - size:
            windows[k, start].append(v)
            start -= slide
    out = []
    for (k, start), vs in windows.items():
        some = [v for v in vs if v is not None]
        begin = datetime.fromtimestamp(0, UTC) + timedelta(microseconds=start)
        out.append((
            k, begin.replace(tzinfo=None), (begin + timedelta(microseconds=size)).replace(tzinfo=None),
            len(some), len(vs), sum(some) if some else None, min(some, default=None), max(some, default=None),
            int(sum(some) / len(some)) if some else None, sum(some) / len(some) if some else None,
        ))
    return sorted(out, key=repr)


def random_rows(seed, n, span, edge):
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        us = pick.randrange(-span, span)
        if pick.random() < 0.4:  # on, just before or just after a window's edge
            us = us - us % edge + pick.choice([0, -1, 1])
        key = "hot" if pick.random() < 0.4 else pick.choice(["a", "b", None])
        out.append((key, us, pick.choice([None, *range(-20, 20)])))
    return out


@pytest.mark.parametrize("strategy", [*STRATEGIES, "auto"])
@pytest.mark.parametrize(
    ("size", "slide", "span"),
    [(15, 5, 60), (300, 5, 1000), (20, 20, 100), (10, 5, 3000), (3600, 5, 9000)],
)
def test_hop_equals_brute_force(spark, strategy, size, slide, span):
    n = 20 if size == 3600 and strategy == "window" else 150  # 720 copies of a row through Spark's own window take long
    size, slide = size * SECOND, slide * SECOND
    data = random_rows(size.seconds, n, span * 1_000_000, 5_000_000)
    zoneless = table(spark, data).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = hop(zoneless, "t", size, slide, ["k"], MEASURES, strategy=strategy)
    assert got.columns[:3] == ["k", "hopStart", "hopEnd"]
    assert rows(got) == brute_force(data, size, slide)


def test_size_that_is_no_multiple_of_the_slide(spark):
    data = random_rows(7, 100, 50_000_000, 4_000_000)
    zoneless = table(spark, data).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = hop(zoneless, "t", 10 * SECOND, 4 * SECOND, ["k"], MEASURES)
    assert rows(got) == brute_force(data, 10 * SECOND, 4 * SECOND)
    with pytest.raises(ValueError, match="multiple"):
        hop(zoneless, "t", 10 * SECOND, 4 * SECOND, ["k"], MEASURES, strategy="runs")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_strategies_keep_the_time_type_and_several_keys(spark, strategy):
    data = random_rows(3, 80, 40_000_000, 5_000_000)
    df = table(spark, data).withColumn("odd key", F.col("v") % 2)
    got = hop(df, "t", 15 * SECOND, 5 * SECOND, ["k", "odd key"], [M.count_rows("n")], strategy=strategy)
    assert dict(got.dtypes)["hopStart"] == "timestamp"
    expected = hop(df, "t", 15 * SECOND, 5 * SECOND, ["k", "odd key"], [M.count_rows("n")], strategy="window")
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_counts_of_keys(spark, strategy):
    """A null key has windows, but none of its rows counts."""
    df = table(spark, random_rows(4, 80, 40_000_000, 5_000_000))
    measures = [M.count("k", "keys"), M.count_rows("all")]
    got = hop(df, "t", 15 * SECOND, 5 * SECOND, ["k"], measures, strategy=strategy)
    assert got.where("k IS NULL AND keys = 0 AND all > 0").count() > 0
    assert got.where("k IS NULL AND keys != 0 OR k IS NOT NULL AND keys != all").count() == 0
    flat = tumble(df, "t", 5 * SECOND, ["k"], measures)
    assert flat.where("k IS NULL AND keys != 0 OR k IS NOT NULL AND keys != all").count() == 0


def test_rows_without_time_are_in_no_window(spark):
    df = spark.createDataFrame([("a", None, 1)], "k string, t timestamp, v int")
    for strategy in STRATEGIES:
        assert hop(df, "t", 15 * SECOND, 5 * SECOND, ["k"], MEASURES, strategy=strategy).count() == 0
    assert tumble(df, "t", 5 * SECOND, ["k"], MEASURES).count() == 0


def test_tumble_equals_brute_force(spark):
    data = random_rows(5, 200, 30_000_000, 5_000_000)
    zoneless = table(spark, data).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = tumble(zoneless, "t", 5 * SECOND, ["k"], MEASURES)
    assert rows(got) == brute_force(data, 5 * SECOND, 5 * SECOND)
    assert tumble(zoneless, "t", 5 * SECOND, ["k"], MEASURES, bounds=None).columns == ["k", *[m.alias for m in MEASURES]]


def test_double_and_decimal_sums(spark):
    df = table(spark, random_rows(9, 60, 30_000_000, 5_000_000)).selectExpr(
        "k", "t", "v / 4D AS d", "cast(v AS decimal(9, 2)) AS c"
    )
    measures = [M.total("d", "ds"), M.mean("d", "dm", mode="double"), M.total("c", "cs"), M.largest("c", "ch")]
    results = [rows(hop(df, "t", 15 * SECOND, 5 * SECOND, ["k"], measures, strategy=s)) for s in STRATEGIES]
    assert results.count(results[0]) == len(STRATEGIES)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_nan_overflow_and_struct_keys(spark, strategy):
    """The strategies agree where aggregates are delicate."""
    base = table(spark, random_rows(2, 40, 30_000_000, 5_000_000)).withColumn("key", F.struct("k", F.lit(1).alias("x")))
    high = [M.largest("d", "high"), M.smallest("d", "low")]
    doubles = base.withColumn("d", F.when(F.col("v") == 3, float("nan")).otherwise(F.col("v") + 0.5))

    def by(measures, df, s=strategy):
        return hop(df, "t", 15 * SECOND, 5 * SECOND, ["key"], measures, strategy=s)

    assert repr(rows(by(high, doubles))) == repr(rows(by(high, doubles, "window")))  # a NaN is not equal to itself
    big = base.withColumn("v", F.lit(2**62 + 2**61))
    wide = [M.mean("v", "m", mode="double")]
    assert {r.m for r in by(wide, big).select("m").distinct().collect()} == {float(2**62 + 2**61)}
    with pytest.raises(Exception, match="OVERFLOW"):
        by([M.total("v", "s")], big).collect()


def test_whole_mean_needs_whole_numbers(spark):
    df = spark.createDataFrame([("a", None, 1.5)], "k string, t timestamp, v double")
    with pytest.raises(TypeError, match="double"):
        hop(df, "t", 15 * SECOND, 5 * SECOND, ["k"], [M.mean("v", "m")])


def test_zoneless_time_needs_utc(spark):
    df = spark.createDataFrame([("a", None, 1)], "k string, t timestamp_ntz, v int")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        with pytest.raises(ValueError, match="UTC"):
            hop(df, "t", 15 * SECOND, 5 * SECOND, ["k"], MEASURES)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_plans(spark, tmp_path):
    table(spark, random_rows(1, 50, 10_000_000, 5_000_000)).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").where("k IS NOT NULL AND v IS NOT NULL")
    few = [M.count("k", "n"), M.mean("v", "m")]
    assert exchanges(tumble(df, "t", 5 * SECOND, ["k"], few)) == 1
    hopped = hop(df, "t", 3600 * SECOND, 5 * SECOND, ["k"], few)
    assert exchanges(hopped) == 2
    text = plan(hopped)
    assert "PushedFilters: [IsNotNull(k), IsNotNull(v), IsNotNull(t)]" in text
    assert "partial_" in text and "Python" not in text and "Broadcast" not in text and "Expand" not in text
    # the writing stage keeps its width: adaptive execution must not merge the small pane partitions
    assert "REPARTITION_BY_NUM" in text


def test_no_task_sees_more_than_two_windows_of_panes(spark):
    """All rows under one key: the groups one task handles stay bounded by the window, not the key."""
    n = 200_000
    hot = spark.range(n).select(
        F.when(F.col("id") >= 0, "hot").alias("k"), F.timestamp_micros(F.col("id") * 100_000).alias("t"), F.lit(1).alias("v")
    )
    got = hop(hot, "t", 60 * SECOND, 5 * SECOND, ["k"], [M.count_rows("n")], partitions=8)
    full = got.where("n = 600").count()
    assert full == n // 50 - 11  # every window that lies within the data holds all its 600 rows
    assert got.agg(F.sum("n")).collect()[0][0] == n * 12
    spread = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 0.3 * n // 50


def test_tasks_write_stretches_of_time(spark):
    """Rows of a task have few window starts, which recur from key to key: files of them stay small."""
    keyed = spark.range(40 * 60).select(
        (F.col("id") % 40).cast("string").alias("k"), F.timestamp_micros(F.col("id") * 97_000_000).alias("t"), F.lit(1).alias("v")
    )
    got = hop(keyed, "t", 3600 * SECOND, 5 * SECOND, ["k"], [M.count_rows("n")], partitions=8)
    starts = got.select("hopStart").distinct().count()
    tasks = got.groupBy(F.spark_partition_id()).agg(F.countDistinct("hopStart").alias("starts")).collect()
    assert len(tasks) == 8 and sum(r.starts for r in tasks) < 1.5 * starts
