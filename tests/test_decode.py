import json

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pytest import mark

from skytally.operators.decode import decode_aircraft, decode_flights, decode_nested, rejects
from skytally.schemas import MESSAGE
from tests.helpers import plan

STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, TIME = T.DoubleType(), T.TimestampType()


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Declared table `flights`; altitude is LONG for the hopping job and STRING for the tumbling one.
FLIGHTS = _struct(
    icao=STRING, flight=STRING, timestamp_verbose=STRING, msg_type=STRING, track=STRING,
    timestamp=TIME, altitude=LONG, counter=STRING, lon=STRING, lat=STRING, vr=STRING,
    speed=STRING, mytimestamp=TIME,
)
FLIGHTS_TEXT_ALTITUDE = T.StructType(
    [T.StructField(f.name, STRING if f.name == "altitude" else f.dataType) for f in FLIGHTS]
)

# Decoded aircraft record.
AIRCRAFT = _struct(
    flight=STRING, timestamp_verbose=STRING, msg_type=INT, track=INT, timestamp=LONG,
    altitude=INT, counter=LONG, lat=DOUBLE, lon=DOUBLE, icao=STRING, speed=INT,
    equipment=STRING, tail=STRING,
)

A = {
    "flight": "TST204", "timestamp_verbose": "2020-05-04 03:02:01.000009", "msg_type": "3", "track": "",
    "timestamp": 1588561321, "altitude": "21500", "counter": 517, "lon": "-12.5625", "icao": "B01C2D",
    "vr": "", "lat": "48.03125", "speed": "",
}
B = {
    "flight": "", "timestamp_verbose": "2020-05-04 04:05:06.000007", "msg_type": "8", "track": "",
    "timestamp": 1588565106, "altitude": "", "counter": 518, "lon": "", "icao": "B0FFEE", "vr": "",
    "lat": "", "speed": "",
}


def messages(spark, *texts):
    rows = [(t if t is None or isinstance(t, str) else json.dumps(t),) for t in texts]
    df = spark.createDataFrame(rows, "value string").coalesce(1)
    return df.withColumn("timestamp", F.timestamp_seconds(F.lit(1588561322)))


def one(spark, message, **kw):
    return decode_aircraft(messages(spark, message), **kw).collect()[0].asDict()


def test_sample_with_position(spark):
    got = one(spark, A)
    assert got["msg_type"] == 3 and got["altitude"] == 21500 and got["counter"] == 517
    assert (got["lat"], got["lon"]) == (48.03125, -12.5625)
    assert got["timestamp"] == 1588561321 and got["icao"] == "B01C2D"
    assert got["flight"] is None and got["speed"] is None


def test_sample_without_measurements(spark):
    got = one(spark, B)
    assert got["msg_type"] == 8 and got["icao"] == "B0FFEE"
    assert all(got[c] is None for c in ("altitude", "lat", "lon", "flight", "speed", "track", "equipment", "tail"))


@mark.parametrize(
    ("kind", "filled"),
    [
        ("1", {"flight"}),
        ("2", set()),
        ("3", {"altitude", "lat", "lon"}),
        ("4", {"speed"}),
        ("5", {"altitude"}),
        ("6", set()),
        ("7", {"altitude"}),
        ("8", set()),
    ],
)
def test_columns_by_message_type(spark, kind, filled):
    got = one(spark, {**A, "msg_type": kind, "speed": "410"})
    assert {c for c in ("flight", "altitude", "lat", "lon", "speed") if got[c] is not None} == filled


def test_blank_measurements(spark):
    blank = {**A, "altitude": "", "lat": "", "lon": " "}
    zero = one(spark, blank)
    assert (zero["altitude"], zero["lat"], zero["lon"]) == (0, 0.0, 0.0)
    null = one(spark, blank, blank="null")
    assert (null["altitude"], null["lat"], null["lon"]) == (None, None, None)


def test_json_null_is_blank_and_missing_is_null(spark):
    assert one(spark, {**A, "altitude": None})["altitude"] == 0
    assert one(spark, {k: v for k, v in A.items() if k != "altitude"})["altitude"] is None


def test_numbers_may_come_unquoted(spark):
    got = one(spark, {**A, "msg_type": 3, "altitude": 36000.9, "icao": 123456})
    assert (got["msg_type"], got["altitude"], got["icao"]) == (3, 36000, None)


def test_text_fields_take_strings_only(spark):
    for other in (123, 1.5, True, {"a": 1}, ["a"], None):
        got = one(spark, {**A, "msg_type": "1", "icao": other, "flight": other, "timestamp_verbose": other})
        assert (got["icao"], got["flight"], got["timestamp_verbose"]) == (None, None, None)
        assert [r.reason for r in rejects(messages(spark, {**A, "icao": other}), "icao").collect()] == ["missing_key"]
    assert one(spark, {**A, "icao": "123"})["icao"] == "123"


def test_decoded_types(spark):
    got = {f.name: f.dataType for f in decode_aircraft(messages(spark, A)).schema}
    assert all(got[f.name] == f.dataType for f in AIRCRAFT)


def test_bad_messages_yield_no_key_and_are_rejected(spark):
    texts = ['{"icao":"A', "nope", "", None, '"abc"', "[1]", "{}", {"icao": None}, A]
    source = messages(spark, *texts)
    assert decode_aircraft(source).where("icao IS NOT NULL").count() == 1
    got = rejects(source, "icao").collect()
    assert [r.reason for r in got] == ["malformed"] * 4 + ["missing_key"] * 4
    assert [r.value for r in got][:2] == texts[:2]


def test_declared_table(spark):
    source = messages(spark, A, B)
    hopping = decode_flights(source)
    assert [(f.name, f.dataType) for f in hopping.schema] == [(f.name, f.dataType) for f in FLIGHTS]
    a, b = hopping.collect()
    assert a.altitude == 21500 and b.altitude is None and a.msg_type == "3" and a.counter == "517"
    assert a.mytimestamp.timestamp() == 1588561322
    tumbling = decode_flights(source, altitude="string", rowtime="payload")
    assert [(f.name, f.dataType) for f in tumbling.schema] == [(f.name, f.dataType) for f in FLIGHTS_TEXT_ALTITUDE]
    a, b = tumbling.collect()
    assert a.altitude == "21500" and b.altitude == "" and a.mytimestamp.timestamp() == 1588561321


def test_nested(spark):
    source = messages(
        spark,
        {"field1": "a", "field2": "b", "field3": {"nested1": "c"}},
        {"field1": "a", "field2": 2, "field3": {"nested1": 5}},
        {"field1": "a", "field2": "b", "field3": {"nested1": None}},
        {"field1": "a", "field2": "b"},
        {"field1": "a", "field2": "b", "field3": "text"},
        "nope",
    )
    got = [tuple(r)[:3] for r in decode_nested(source).collect()]
    assert got == [
        ("a", "b", "c"), ("a", "2", "5"), ("a", "b", None), ("a", "b", None), ("a", "b", None), (None, None, None),
    ]


def test_message_is_parsed_once_under_filters(spark, tmp_path):
    messages(spark, A).write.parquet(f"{tmp_path}/m")
    source = spark.read.schema(MESSAGE).parquet(f"{tmp_path}/m")
    text = plan(decode_aircraft(source).where("icao IS NOT NULL AND altitude IS NOT NULL").select("icao"))
    assert text.split("\n\n")[0].count("Generate (") == 3
    assert "from_json" not in text and "json_tuple" not in text and "Python" not in text
    details = text.split("\n\n")[1:]
    filters = [d for d in details if " Filter" in d.split("\n")[0]]
    assert filters and not any("cast" in d or "RLIKE" in d or "variant" in d.lower() for d in filters)
