"""Writers a running query hands each micro-batch to.

A writer is a function of a batch DataFrame and the batch number. Delivery is at least once: a batch
that is repeated after a failure is written again, except by :func:`to_parquet` and :func:`to_text`, which give every
batch a folder of its own and overwrite it. :func:`with_ledger` keeps sinks that have a batch from getting
it again when a later sink of the same batch fails; what remains is a sink that fails after it took the
batch and before the ledger says so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from skytally.sinks.encode import text_rows
from skytally.sources.kafka import writer_options
from skytally.streaming.files import Folder

Writer = Callable[[DataFrame, int], None]
Encoder = Callable[[DataFrame], DataFrame]
#: Only a query's last batch can be repeated; some more notes stay for people to read.
KEPT_NOTES = 100


def _whole(writer: Writer) -> Writer:
    """Mark a writer that reads its batch to the end."""
    writer.reads_whole_batch = True
    return writer


def to_console(show: Callable[[str], None] = print) -> Writer:
    """Print every row of each batch where it is computed: on a cluster, to the executors' output.

    ``show`` takes a row's text and runs on the executors.
    """

    def write(batch: DataFrame, number: int) -> None:
        print(f"batch {number}")

        def each(rows: Iterator[Row]) -> None:
            for row in rows:
                show(row.value)

        text_rows(batch).foreachPartition(each)

    return _whole(write)


def to_topic(topic: str, properties: Mapping[str, str], encode: Encoder) -> Writer:
    options = writer_options(topic, properties)

    def write(batch: DataFrame, number: int) -> None:
        encode(batch).write.format("kafka").options(**options).save()

    return _whole(write)


def to_text(path: str, encode: Encoder) -> Writer:
    """Encoded rows as text files, one folder per batch."""

    def write(batch: DataFrame, number: int) -> None:
        encode(batch).write.mode("overwrite").text(f"{path}/batch={number}")

    return _whole(write)


def to_parquet(path: str) -> Writer:
    """Rows as Parquet, one folder per batch; read ``path`` back to get them all, with the batch number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _whole(write)


def with_ledger(writers: Mapping[str, Writer], folder: str) -> list[Writer]:
    """The writers, each of which notes in ``folder`` which batches it has written, and skips those.

    A note is written in one step after the writer has returned, under the sink's name and the batch's number,
    so a query that failed between two sinks goes on with the second. Names must stay the same over restarts;
    a new checkpoint needs a new folder. Numbers below ``KEPT_NOTES`` before the last are removed.
    """

    def noted(name: str, writer: Writer) -> Writer:
        def write(batch: DataFrame, number: int) -> None:
            ledger = Folder(batch.sparkSession, f"{folder.rstrip('/')}/{name}")
            if str(number) in ledger:
                return
            writer(batch, number)
            ledger.write(str(number), "")
            ledger.delete(str(number - KEPT_NOTES))

        return write

    return [noted(name, writer) for name, writer in writers.items()]


def to_split(path: str, flag: str, names: tuple[str, str]) -> Writer:
    """Rows in two Parquet tables ``path/names``, by whether ``flag`` is false or true, in one pass over the batch.

    Each has a folder per batch. Written as one table of two parts, so that the batch is computed once.
    """

    def write(batch: DataFrame, number: int) -> None:
        named = batch.withColumn("part", F.when(F.col(flag), names[1]).otherwise(names[0])).drop(flag)
        named.write.mode("overwrite").partitionBy("part").parquet(f"{path}/batch={number}")

    return _whole(write)


def fan_out(writers: Sequence[Writer]) -> Writer:
    """Feed one result to several writers while computing it once.

    A stateful query fails if a batch leaves partitions uncomputed, whose state is then not
    committed. So the batch is computed whole before the writers get it, unless the only writer is
    known to read it to the end.
    """

    def write(batch: DataFrame, number: int) -> None:
        if len(writers) == 1 and getattr(writers[0], "reads_whole_batch", False):
            writers[0](batch, number)
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            batch.write.format("noop").mode("overwrite").save()
            for writer in writers:
                writer(batch, number)
        finally:
            batch.unpersist()

    return write
