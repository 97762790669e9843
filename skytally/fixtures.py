"""Aircraft messages derived from the test data's ``events`` table, for checks and benchmarks.

Each event becomes one aircraft message. The SQL texts serve Spark and the checking engine alike;
``{text}`` is the name of the text type. Keys are missing, altitudes blank and message types mixed
at fixed rates, so that every rule of the decoder meets rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_SQL = """
SELECT event_id AS counter,
       CASE WHEN event_id % 37 = 0 THEN NULL
            ELSE concat(CASE WHEN user_id % 10 = 0 THEN 'ae' ELSE 'A0' END,
                        lpad(cast(user_id AS {text}), 4, '0')) END AS icao,
       CASE WHEN event_id % 11 = 0 THEN 8 WHEN event_type = 'click' THEN 1
            WHEN event_type = 'view' THEN 3 WHEN event_type = 'purchase' THEN 4
            WHEN event_type = 'signup' THEN 5 ELSE 7 END AS msg_type,
       CASE WHEN event_id % 13 = 0 THEN ''
            ELSE cast(cast(floor(value * 100) AS int) AS {text}) END AS altitude_txt,
       ts AS mytimestamp
FROM {events}
"""

PLANES_SQL = """
SELECT counter, icao, msg_type,
       CASE WHEN msg_type IN (3, 5, 7) THEN coalesce(try_cast(altitude_txt AS int), 0) END AS altitude,
       mytimestamp
FROM {raw}
"""

# Texts that the lenient casts treat in different ways, one column per rule.
NUMBER_TEXTS_SQL = """
SELECT event_id,
       cast(event_id AS {text}) AS digits,
       concat('  ', cast(user_id AS {text}), ' ') AS padded,
       concat('-', cast(user_id AS {text}), '.75') AS decimal_text,
       concat(cast(user_id + 100 AS {text}), '00000000000') AS too_long,
       concat('1e', cast(user_id % 40 AS {text})) AS scientific,
       CASE WHEN event_id % 2 = 0 THEN '' ELSE event_type END AS words
FROM {events}
"""

# Nested messages take event type, user and the number in props as their three fields.
NESTED_SQL = """
SELECT event_type AS field1, cast(user_id AS {text}) AS field2, {k} AS field3nested1, ts AS mytimestamp
FROM {events}
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_planes(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.sql(RAW_SQL.replace("{text}", "string"), events=rows)


def planes(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.sql(PLANES_SQL, raw=raw_planes(rows))


def number_texts(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.sql(NUMBER_TEXTS_SQL.replace("{text}", "string"), events=rows)


def messages(rows: DataFrame) -> DataFrame:
    """Aircraft messages as JSON text with the event's time as record time."""
    raw = raw_planes(rows)
    text = F.to_json(
        F.struct(
            F.concat(F.lit("FL"), F.col("counter").cast("string")).alias("flight"),
            F.date_format("mytimestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp_verbose"),
            F.col("msg_type").cast("string").alias("msg_type"),
            F.lit("").alias("track"),
            F.unix_seconds(F.col("mytimestamp").cast("timestamp")).alias("timestamp"),
            F.col("altitude_txt").alias("altitude"),
            "counter",
            F.concat(F.lit("-97."), (F.col("counter") % 1000).cast("string")).alias("lon"),
            "icao",
            F.lit("").alias("vr"),
            F.concat((F.col("counter") % 90).cast("string"), F.lit(".5")).alias("lat"),
            F.when(F.col("counter") % 3 == 0, "").otherwise((F.col("counter") % 500).cast("string")).alias("speed"),
        )
    )
    return raw.select(text.alias("value"), F.col("mytimestamp").alias("timestamp"))


def broken_messages(rows: DataFrame) -> DataFrame:
    """The same with the closing brace missing from every 41st text."""
    counter = F.get_json_object("value", "$.counter").cast("bigint")
    open_end = F.when(counter % 41 == 0, F.rtrim(F.col("value"), F.lit("}"))).otherwise(F.col("value"))
    return messages(rows).select(counter.alias("counter"), open_end.alias("value"), "timestamp")


def odd_text_messages(rows: DataFrame) -> DataFrame:
    """The same with numbers, booleans and objects in place of some strings."""
    counter = F.get_json_object("value", "$.counter").cast("bigint")

    def odd(text, field: str, every: int, instead: str):  # noqa: ANN001, ANN202
        other = F.regexp_replace(text, rf'"{field}":"[^"]*"', f'"{field}":{instead}')
        return F.when(counter % every == 0, other).otherwise(text)

    text = odd(F.col("value"), "icao", 7, "123")
    text = odd(odd(text, "flight", 5, "true"), "timestamp_verbose", 3, '{"a":1}')
    return messages(rows).withColumn("value", text)


def nested_messages(rows: DataFrame) -> DataFrame:
    text = F.to_json(
        F.struct(
            F.col("event_type").alias("field1"),
            F.col("user_id").alias("field2"),
            F.struct(F.get_json_object("props", "$.k").cast("int").alias("nested1")).alias("field3"),
        )
    )
    return rows.select(text.alias("value"), F.col("ts").alias("timestamp"))
