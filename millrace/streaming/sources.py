"""Stream sources. Every one gives a streaming DataFrame; the counts do not know which it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Input that one micro-batch takes at most (bytes); a backlog is worked off in batches of this size.
BATCH_BYTES = 512 * 1024**3


def line_files(spark: SparkSession, folder: str) -> DataFrame:
    """New text files of a folder, one row (value) per line."""
    return spark.readStream.option("maxBytesPerTrigger", str(BATCH_BYTES)).text(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP server that the caller runs; for trials only, as a socket cannot be replayed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def broker_pairs(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """(key, value) text pairs of a message broker, e.g. ``fmt="kafka"`` with its package on the cluster."""
    stream = spark.readStream.format(fmt).options(**options).load()
    return stream.select(F.col("key").cast("string"), F.col("value").cast("string"))


def parquet_files(spark: SparkSession, folder: str, schema, max_bytes: int | None = None) -> DataFrame:
    """New Parquet files of a folder; without ``max_bytes`` everything that is there makes one batch."""
    reader = spark.readStream.schema(schema)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.parquet(folder)


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """One of the tables as a stream; the pattern fits a single file and a folder of files alike."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return parquet_files(spark, f"{sf_dir}/{name}.parque[t]", schema, max_bytes)
