"""The loads as a stream: every micro-batch goes into all tables that its source feeds, once, however often it runs."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.ingest.run import KEPT, batch_folder, keep, now_text, pull, read_watermark, stamp, table_properties, write_batch
from millrace.ingest.specs import IngestSpec
from millrace.streaming.counts import start

#: Tables that one micro-batch is written to at the same time.
TABLES_AT_ONCE = 4


@dataclass(frozen=True)
class Feed:
    """One table of a stream: its name, its specification, and the columns of the specification from the stream's."""

    target: str
    spec: IngestSpec
    shape: Callable[[DataFrame], DataFrame]


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote to the checkpoint; a new checkpoint is another stream, whose batches count from 0 again."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def load_batch(batch: DataFrame, batch_id: int, stream: str, feed: Feed, load_time: str) -> int | None:
    """Write one micro-batch into one table; None if the ledger has it already.

    The ledger is a property of the table, with the last batch of each stream that is in it. A batch is written to a folder named by stream and
    batch: one that failed before the ledger knew it replaces its own rows.
    """
    spark = batch.sparkSession
    ledger = f"millrace.stream.{stream}"
    known = table_properties(spark, feed.target)
    if int(known.get(ledger, "-1")) >= batch_id:
        return None
    folder = batch_folder(spark, feed.target, f"{stream}-{batch_id:09d}")
    rows = write_batch(stamp(pull(feed.shape(batch), feed.spec, None), feed.spec, load_time), feed.target, folder)
    latest = None if feed.spec.changed is None else read_watermark(rows)
    since = datetime.datetime.fromisoformat(known[KEPT]) if known.get(KEPT) else None
    until = max((t for t in (since, latest) if t is not None), default=None)
    keep(spark, feed.target, {KEPT: until.isoformat() if until else "", ledger: str(batch_id)})
    return rows.count()


def ingest_stream(
    stream: DataFrame, feeds: list[Feed], checkpoint: str, load_time: str | None = None, interval: str | None = None
) -> StreamingQuery:
    """Load every row of the stream into each table once, also those that arrive late: there is no watermark to miss them.

    A table without a change time gets the rows as they come; a stream has nothing to refresh. A failed batch ends the query, and the next
    query on the same checkpoint runs it again: tables that have it are passed over, the others replace what it left.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = stream_id(batch.sparkSession, checkpoint)
        loaded = load_time or now_text()
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            for done in [pool.submit(load_batch, batch, batch_id, own, feed, loaded) for feed in feeds]:
                done.result()

    return start(stream, checkpoint, write, "append", interval)
