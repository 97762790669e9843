"""Aircraft predicates and the record report line, as built-in expressions and SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: address prefix of military aircraft.
MILITARY_PREFIX = "AE"

# The report line, its fields in order.
REPORT_FORMAT = (
    "icao: %s flight: %s timestamp: %d msg_type: %d altitude: %d speed: %d "
    "lat: %f lon: %f counter: %d equipment: %s tail: %s"
)
REPORT_FIELDS = (
    "icao", "flight", "timestamp", "msg_type", "altitude", "speed",
    "lat", "lon", "counter", "equipment", "tail",
)


def is_military(icao: Column) -> Column:
    """Whether the address, in any letter case, carries the military prefix; null for null."""
    return F.startswith(F.upper(icao), F.lit(MILITARY_PREFIX))


def is_military_exact_case(icao: Column) -> Column:
    return F.startswith(icao, F.lit(MILITARY_PREFIX))


def register_functions(spark: SparkSession) -> None:
    """Make ``isMilitary`` callable from SQL text; Catalyst inlines it, so no call is left at run time."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION isMilitary(icao STRING) RETURNS BOOLEAN "
        f"RETURN startswith(upper(icao), '{MILITARY_PREFIX}')"
    )


def report_line(columns: dict[str, Column] | None = None) -> Column:
    """One text line per record; unset fields print ``null``."""
    columns = columns or {}
    return F.format_string(REPORT_FORMAT, *[columns.get(f, F.col(f)) for f in REPORT_FIELDS])
