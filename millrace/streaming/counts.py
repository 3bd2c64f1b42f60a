"""Counting streams: per batch, running, and recoverable.

Each run takes what is there (``availableNow``) and stops; with ``interval`` it keeps going instead. Results of a batch go
to their own folder, written with overwrite: a batch that is run again after a failure replaces itself.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

Transform = Callable[[DataFrame], DataFrame]


def split_words(stream: DataFrame, column: str = "value") -> DataFrame:
    return stream.select(F.explode(F.split(column, " ")).alias("word"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def start(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None], mode: str, interval: str | None) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def drain(query: StreamingQuery) -> None:
    """Wait for the end of an ``availableNow`` run; a failed batch raises here."""
    query.awaitTermination()


def per_batch(stream: DataFrame, transform: Transform, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Apply ``transform`` to every micro-batch on its own; nothing is carried over."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return start(stream, checkpoint, write, "append", interval)


def running(
    stream: DataFrame, keys: list[str], totals: dict[str, Column], out: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Running aggregates per key, kept in the state store; each batch writes the keys it changed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    state = stream.groupBy(*keys).agg(*[c.alias(name) for name, c in totals.items()])
    return start(state, checkpoint, write, "update", interval)


def latest(results: DataFrame, keys: list[str]) -> DataFrame:
    """The last value written per key by :func:`running`."""
    values = [c for c in results.columns if c not in keys and c != "batch_id"]
    last = results.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("last"))
    return last.select(*keys, "last.*")


def sql_per_batch(stream: DataFrame, view: str, sql: str, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Register every micro-batch as ``view`` and run ``sql`` on it; an error ends the stream."""

    def run(batch: DataFrame) -> DataFrame:
        batch.createOrReplaceTempView(view)
        return batch.sparkSession.sql(sql)

    return per_batch(stream, run, out, checkpoint, interval)


def printing(
    stream: DataFrame, transform: Transform, out: str, checkpoint: str, rows: int = 10, emit: Callable[[str], None] = log.info, interval: str | None = None
) -> StreamingQuery:
    """As :func:`per_batch`, and the first rows of each batch's result are shown, read from what was written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out}/batch_id={batch_id}"
        result = transform(batch)
        result.write.mode("overwrite").parquet(folder)
        for row in batch.sparkSession.read.schema(result.schema).parquet(folder).take(rows):
            emit(str(row))

    return start(stream, checkpoint, write, "append", interval)
