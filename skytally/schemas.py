"""Row shapes: raw messages, decoded tables and results."""

from __future__ import annotations

from pyspark.sql import types as T

# What a broker source delivers: the message text and the broker's record time.
MESSAGE = T.StructType([T.StructField("value", T.StringType()), T.StructField("timestamp", T.TimestampType())])

# Every field of an aircraft message. Read as text: blank strings stand for "missing" in numeric
# fields, and a typed JSON read of "36000" would give null.
AIRCRAFT_FIELDS = (
    "icao", "flight", "timestamp_verbose", "msg_type", "track", "timestamp",
    "altitude", "counter", "lon", "lat", "vr", "speed",
)

# The columns the `planes` view exposes.
PLANES_COLUMNS = (
    "icao", "flight", "timestamp_verbose", "msg_type", "track", "timestamp",
    "altitude", "counter", "lon", "lat", "speed", "mytimestamp",
)

# The columns of the flattened nested message.
NESTED_COLUMNS = ("field1", "field2", "field3nested1", "mytimestamp")
