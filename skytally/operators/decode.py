"""JSON messages to typed rows.

A message is one JSON object in a text column. Its fields are read as text in one parse and cast
leniently after, so a bad message never fails a query: text that is no JSON object, or lacks its
key, yields a null key here and shows up in :func:`rejects` with a reason.

The parse is a generator on purpose. Filters on decoded columns stop at it; with a plain parsing
expression they would be pushed below the projection and parse every message a second time.

Text fields of aircraft records are null unless the message has a string there; the declared and the
nested table take the text of any scalar. A JSON null in a numeric field counts as blank; a field the
message does not have is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.functions.casts import lenient_double, lenient_int, lenient_long
from skytally.schemas import AIRCRAFT_FIELDS
from skytally.streaming.eventtime import payload_time

# Which message types carry which measurement.
FLIGHT_TYPES = (1,)
POSITION_TYPES = (3,)
SPEED_TYPES = (4,)
ALTITUDE_TYPES = (3, 5, 7)


def _fields(value: str, names: tuple[str, ...]) -> Column:
    return F.json_tuple(F.col(f"`{value}`"), *names).alias(*[f"__{n}" for n in names])


def _parsed(messages: DataFrame, value: str) -> DataFrame:
    """``messages`` with the parsed text as the variant ``__message``; null if it is no JSON."""
    return messages.select("*", F.explode(F.array(F.try_parse_json(F.col(f"`{value}`")))).alias("__message"))


def _member(field: str) -> Column:
    return F.try_variant_get(F.col("__message"), f"$.{field}", "variant")


def _string(field: str) -> Column:
    """A member that is a JSON string; null for any other value."""
    return F.when(F.schema_of_variant(_member(field)) == "STRING", F.try_variant_get("__message", f"$.{field}", "string"))


def decode_aircraft(messages: DataFrame, value: str = "value", blank: str = "zero", key: str | None = None) -> DataFrame:
    """Aircraft records whose measurements depend on the message type.

    Type 1 sets the flight; 3 altitude and position; 4 speed; 5 and 7 altitude; others none. Blank
    text in a measurement its type does set becomes 0 (or null with ``blank="null"``). Text fields
    take JSON strings only and are null for other values. The other columns of ``messages`` follow;
    the record time ``timestamp`` among them as ``record_time``.

    Each message is parsed once and each field cast once: the cast fields are one array element of a
    generator, which filters on them do not cross.

    With a ``key``, such as ``icao``, two columns tell of messages that have none, as in :func:`rejects`:
    ``reason``, null for good ones, and the message's text ``rejected``, of others only.
    """
    carried = {c: "record_time" if c == "timestamp" else c for c in messages.columns if c != value}

    def number(field: str, cast: Callable[..., Column]) -> Column:
        # a JSON null is blank, a missing field null
        return cast(F.try_variant_get("__message", f"$.{field}", "string"), blank, _member(field).isNotNull())

    def of(kinds: tuple[int, ...], field: Column) -> Column:
        return F.when(F.col("__type").isin(*kinds), field)

    parsed = _parsed(messages, value)
    kind = F.explode(F.array(number("msg_type", lenient_int))).alias("__type")
    fields = F.struct(
        _string("icao").alias("icao"),
        of(FLIGHT_TYPES, _string("flight")).alias("flight"),
        _string("timestamp_verbose").alias("timestamp_verbose"),
        F.col("__type").alias("msg_type"),
        F.lit(None).cast("int").alias("track"),
        number("timestamp", lenient_long).alias("timestamp"),
        of(ALTITUDE_TYPES, number("altitude", lenient_int)).alias("altitude"),
        number("counter", lenient_long).alias("counter"),
        of(POSITION_TYPES, number("lon", lenient_double)).alias("lon"),
        of(POSITION_TYPES, number("lat", lenient_double)).alias("lat"),
        of(SPEED_TYPES, number("speed", lenient_int)).alias("speed"),
        F.lit(None).cast("string").alias("equipment"),
        F.lit(None).cast("string").alias("tail"),
    )
    typed = parsed.select("*", kind).select("*", F.explode(F.array(fields)).alias("__fields"))
    told = []
    if key is not None:
        reason = _reason(F.col(f"__fields.{key}"))
        told = [reason.alias("reason"), F.when(reason.isNotNull(), F.col(f"`{value}`")).alias("rejected")]
    return typed.select("__fields.*", *[F.col(f"`{c}`").alias(name) for c, name in carried.items()], *told)


def decode_flights(
    messages: DataFrame,
    value: str = "value",
    altitude: str = "bigint",
    rowtime: str = "record",
    blank: str = "null",
) -> DataFrame:
    """The declared ``flights`` table: text columns, an event time and an altitude.

    ``altitude`` is ``"bigint"`` or ``"string"``; a text altitude keeps blanks as values of their
    own. ``rowtime`` takes ``mytimestamp`` from the ``"record"`` (the messages' ``timestamp``
    column) or the ``"payload"`` (its epoch seconds).
    """
    if altitude not in ("bigint", "string"):
        raise ValueError(f"altitude must be 'bigint' or 'string', got {altitude!r}")
    if rowtime not in ("record", "payload"):
        raise ValueError(f"rowtime must be 'record' or 'payload', got {rowtime!r}")
    text = messages.select("*", _fields(value, AIRCRAFT_FIELDS))
    if rowtime == "record":
        text = text.withColumn("__rowtime", F.col("`timestamp`"))
    else:
        text = payload_time(text, "__timestamp", "__rowtime")
    high = F.col("__altitude") if altitude == "string" else lenient_long(F.col("__altitude"), blank)
    typed = {
        "timestamp": F.timestamp_seconds(F.col("__timestamp").try_cast("bigint")),
        "altitude": high,
    }
    return text.select(
        *[typed.get(f, F.col(f"__{f}")).alias(f) for f in AIRCRAFT_FIELDS],
        F.col("__rowtime").alias("mytimestamp"),
    )


def decode_nested(messages: DataFrame, value: str = "value", record: str | None = "timestamp") -> DataFrame:
    """Flatten ``{field1, field2, field3: {nested1}}``; ``record`` names the column with the event time."""
    times = [F.col(f"`{record}`").alias("mytimestamp")] if record else []
    return messages.select("*", _fields(value, ("field1", "field2", "field3"))).select(
        F.col("__field1").alias("field1"),
        F.col("__field2").alias("field2"),
        json_text(F.col("__field3"), "$.nested1").alias("field3nested1"),
        *times,
    )


def json_text(value: Column, path: str) -> Column:
    """One scalar of a JSON text by path, such as ``$.field3.nested1``."""
    return F.get_json_object(value, path)


def _reason(key: Column) -> Column:
    return F.when(F.col("__message").isNull(), "malformed").when(key.isNull(), "missing_key")


def rejects(messages: DataFrame, key: str, value: str = "value") -> DataFrame:
    """The messages the decoders of records find no ``key`` in, with a ``reason``.

    ``malformed`` is text that does not parse as JSON; ``missing_key`` JSON whose key is absent, null
    or no string, or that is no object.
    """
    return _parsed(messages, value).withColumn("reason", _reason(_string(key))).where("reason IS NOT NULL").drop("__message")
