from pyspark.sql import functions as F
from pytest import approx, mark

from skytally.functions.casts import lenient_double, lenient_int, lenient_long

# text, int, long, double; None in "null" mode wherever `blank` is set
CASES = [
    ("12", 12, 12, 12.0, False),
    (" 12 ", 12, 12, 12.0, False),
    ("+5", 5, 5, 5.0, False),
    ("-7", -7, -7, -7.0, False),
    ("36000.7", 36000, 36000, 36000.7, False),
    ("-36000.7", -36000, -36000, -36000.7, False),
    ("1e3", 1000, 1000, 1000.0, False),
    ("1e20", 2**31 - 1, 2**63 - 1, 1e20, False),
    ("-1e20", -(2**31), -(2**63), -1e20, False),
    ("9007199254740993", 0, 9007199254740993, 9007199254740992.0, False),
    ("", 0, 0, 0.0, True),
    ("   ", 0, 0, 0.0, True),
    ("abc", 0, 0, 0.0, True),
    ("12 34", 0, 0, 0.0, True),
]


@mark.parametrize("mode", ["zero", "null"])
def test_lenient_casts(spark, mode):
    texts = spark.createDataFrame([(c[0],) for c in CASES], "x string").coalesce(1)
    got = texts.select(
        lenient_int(F.col("x"), mode), lenient_long(F.col("x"), mode), lenient_double(F.col("x"), mode)
    ).collect()
    for (text, as_int, as_long, as_double, blank), row in zip(CASES, got, strict=True):
        if mode == "null":
            as_int = None if blank or text == "9007199254740993" else as_int
            as_long, as_double = (None, None) if blank else (as_long, as_double)
        assert row[0] == as_int, text
        assert row[1] == as_long, text
        assert row[2] == (None if as_double is None else approx(as_double)), text


def test_not_a_number_text_counts_as_zero(spark):
    df = spark.createDataFrame([("NaN",)], "x string")
    assert df.select(lenient_int(F.col("x")), lenient_long(F.col("x"))).collect()[0] == (0, 0)


def test_null_stays_null_unless_present(spark):
    df = spark.createDataFrame([(None, True), (None, False)], "x string, there boolean").coalesce(1)
    got = df.select(
        lenient_int(F.col("x")).alias("plain"), lenient_int(F.col("x"), "zero", F.col("there")).alias("known")
    ).collect()
    assert [tuple(r) for r in got] == [(None, 0), (None, None)]
