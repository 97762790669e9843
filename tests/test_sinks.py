from pyspark.sql import functions as F

from skytally.functions import aircraft
from skytally.functions.aircraft import is_military, is_military_exact_case, register_functions
from skytally.sinks.encode import json_rows, key_count, key_count_json, text_rows


def values(df):
    return [r.value for r in df.collect()]


def result(spark):
    df = spark.createDataFrame([("AE1", 3, None), (None, 4, True)], "icao string, pings long, flag boolean")
    return df.coalesce(1).withColumn("hopStart", F.timestamp_seconds(F.lit(1522075070)))


def test_text(spark):
    rows = result(spark).withColumn("fine", F.timestamp_millis(F.lit(1522075070250)))
    assert values(text_rows(rows)) == [
        "AE1,3,null,2018-03-26 14:37:50.0,2018-03-26 14:37:50.25",
        "null,4,true,2018-03-26 14:37:50.0,2018-03-26 14:37:50.25",
    ]


def test_key_count_json(spark):
    assert values(key_count_json(result(spark)))[0] == '{"icao":"AE1","count":"3"}'
    pair = key_count(result(spark))
    assert pair.dtypes == [("icao", "string"), ("pings", "bigint")]


def test_json_rows(spark):
    zoned, zoneless = result(spark), result(spark).withColumn("hopStart", F.col("hopStart").cast("timestamp_ntz"))
    expected = '{"icao":"AE1","pings":3,"hopStart":"2018-03-26T14:37:50.000Z"}'
    assert values(json_rows(zoned))[0] == values(json_rows(zoneless))[0] == expected
    assert values(json_rows(zoned, keep_nulls=True))[0] == expected.replace(',"hop', ',"flag":null,"hop')


def test_military(spark):
    register_functions(spark)
    df = spark.createDataFrame([("AE12",), ("ae12",), ("A0AE",), (None,)], "icao string").coalesce(1)
    got = df.select(is_military(F.col("icao")), is_military_exact_case(F.col("icao")), F.expr("isMilitary(icao)"))
    assert [tuple(r) for r in got.collect()] == [
        (True, True, True), (True, False, True), (False, False, False), (None, None, None),
    ]


def test_report_line(spark):
    fields = dict.fromkeys(aircraft.REPORT_FIELDS)
    df = spark.range(1).select(
        *[F.lit(v).cast("string").alias(k) for k, v in fields.items() if k in ("flight", "equipment", "tail")],
        F.lit("AC0DD9").alias("icao"), F.lit(1522075071).cast("long").alias("timestamp"), F.lit(3).alias("msg_type"),
        F.lit(36000).alias("altitude"), F.lit(None).cast("int").alias("speed"), F.lit(30.09942).alias("lat"),
        F.lit(-97.62028).alias("lon"), F.lit(35672).cast("long").alias("counter"),
    )
    assert df.select(aircraft.report_line()).collect()[0][0] == (
        "icao: AC0DD9 flight: null timestamp: 1522075071 msg_type: 3 altitude: 36000 speed: null "
        "lat: 30.099420 lon: -97.620280 counter: 35672 equipment: null tail: null"
    )
