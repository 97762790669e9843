"""Result rows as message texts: one ``value`` column per row, built from expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TIMES = (T.TimestampType, T.TimestampNTZType)


def _as_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, _TIMES):
        # whole seconds keep one decimal: 2018-03-26 14:37:50.0
        text = column.cast("string")
        return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))
    return column.cast("string")


def text_rows(rows: DataFrame) -> DataFrame:
    """All columns joined by commas, nulls as ``null``."""
    texts = [_as_text(F.col(f"`{f.name}`"), f.dataType) for f in rows.schema]
    return rows.select(F.array_join(F.array(*texts), ",", "null").alias("value"))


def key_count_json(rows: DataFrame, key: str = "icao", count: str = "pings") -> DataFrame:
    """``{"icao": …, "count": …}`` with the count as text."""
    pair = F.struct(
        F.col(f"`{key}`").cast("string").alias("icao"), F.col(f"`{count}`").cast("string").alias("count")
    )
    return rows.select(F.to_json(pair).alias("value"))


def json_rows(rows: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """The whole row as a JSON object; times as UTC with milliseconds, null members left out."""
    columns = [
        F.col(f"`{f.name}`").cast("timestamp").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f"`{f.name}`")
        for f in rows.schema
    ]
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return rows.select(F.to_json(F.struct(*columns), options).alias("value"))


def key_count(rows: DataFrame, key: str = "icao", count: str = "pings") -> DataFrame:
    """The typed pair: key and BIGINT count."""
    return rows.select(F.col(f"`{key}`"), F.col(f"`{count}`").cast("bigint").alias(count))
