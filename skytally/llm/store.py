"""Where operators keep tables between their passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.session import work_dir

#: Rows and bytes of one Arrow batch: a batch of long texts must fit a Python worker several times over.
BATCH_ROWS = 1024
BATCH_BYTES = "4m"


def configured(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def saved(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, lost executors cost nothing."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configured(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def checksum(key: str | Column) -> Column:
    """CRC-32 of a key's text; a null key counts as empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def free(df: DataFrame, *names: str) -> None:
    """Raise ValueError if ``df`` has a column of one of these names, which are to be added; case does not tell names apart."""
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken or len({n.lower() for n in names}) < len(names):
        raise ValueError(f"choose other names for the new columns: {sorted(taken) or list(names)} taken")
