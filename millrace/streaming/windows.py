"""Event-time windows that close: state is kept until the watermark passes the end of a window, then its row is written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.counts import start


def closed_windows(
    stream: DataFrame,
    time_col: str,
    delay: str,
    window: Column,
    keys: list[str],
    totals: dict[str, Column],
    out: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Aggregates per window and key of every window that has closed: ``start``, ``end``, keys and totals.

    ``window`` is ``F.window`` (tumbling or sliding) or ``F.session_window`` over ``time_col``. The watermark stays ``delay`` behind the latest time of all
    batches before; a row counts for the windows that end behind it and is left out of the others. Sessions that meet become one as long as
    they are open. Each batch writes a folder of its own, so one that runs again replaces its rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    grouped = stream.withWatermark(time_col, delay).groupBy(window.alias("w"), *keys).agg(*[c.alias(n) for n, c in totals.items()])
    closed = grouped.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, *totals)
    return start(closed, checkpoint, write, "append", interval)
