"""Writers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import PACKED


#: The table property that says that folders inside the table's own are read.
NESTED = "millrace.nested"

#: Rows that one bucket is asked to hold.
ROWS_PER_BUCKET = 20_000_000


def bucket_count(rows: int, least: int = 42) -> int:
    """Buckets for a table of that many rows; sides that are to be joined need the same number."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def save_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    keys: list[str],
    partition_by: str | None = None,
    sort_by: str | None = None,
) -> DataFrame:
    """A bucketed table in a shared folder; equal bucketing lets later joins on ``keys`` skip the shuffle.

    Rows are grouped by bucket before the write; otherwise every task would open a file
    per bucket. A later scan reads one bucket in one task: add a salt to the keys where one key may be hot.
    """
    grouped = df.hint("rebalance", buckets, *[F.col(k) for k in keys])
    writer = grouped.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys)
    if sort_by is not None:
        writer = writer.sortBy(sort_by)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_table(spark: SparkSession, name: str, schema: str, path: str) -> None:
    """A table that also reads the folders inside its own, where loads put their batches."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet OPTIONS (recursiveFileLookup 'true') "
        f"LOCATION '{path}' TBLPROPERTIES ('{NESTED}' = 'true')"
    )


def append_by_name(df: DataFrame, name: str) -> None:
    """Append with columns matched by name, whatever their order in ``df``."""
    target = df.sparkSession.table(name).columns
    if set(target) != set(df.columns):
        raise ValueError(f"columns {sorted(df.columns)} do not fit {name}")
    df.select(*target).write.insertInto(name, overwrite=False)


def insert_values(spark: SparkSession, name: str, columns: list[str], rows: list[tuple], rows_at_once: int = 1000) -> None:
    """``INSERT INTO name (columns) VALUES ...`` for rows that the driver holds anyway; values are bound, never put into the text."""
    kinds = dict(spark.table(name).dtypes)
    for at in range(0, len(rows), rows_at_once):
        part = rows[at : at + rows_at_once]
        marks = ", ".join(f"({', '.join(f'CAST(:v{i}_{j} AS {kinds[c]})' for j, c in enumerate(columns))})" for i in range(len(part)))
        values = {f"v{i}_{j}": v for i, row in enumerate(part) for j, v in enumerate(row)}
        spark.sql(f"INSERT INTO {name} ({', '.join(f'`{c}`' for c in columns)}) VALUES {marks}", args=values)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]


def truncate_load(df: DataFrame, name: str, keep_if_empty: bool = False) -> int:
    """Replace the content of ``name`` and return the number of rows; with ``keep_if_empty`` an empty result leaves the table alone.

    The new content goes to its own folder and the table is pointed there once it is complete: readers meet
    the old rows or the new rows, never an empty table, and a failed load changes nothing.
    """
    spark = df.sparkSession
    folder = f"{table_location(spark, name).rstrip('/')}-{uuid.uuid4().hex}"
    target = spark.table(name)
    df.select(*target.columns).write.format("parquet").option("compression", PACKED).save(folder)
    # the row count comes from the file footers
    rows = spark.read.schema(target.schema).parquet(folder).count()
    if rows > 0 or not keep_if_empty:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    return rows


def upsert(current: DataFrame, changes: DataFrame, key: str, version: Column) -> DataFrame:
    """Latest row per key after the changes: replaced when the key exists, added when it is new.

    ``max_by`` reduces before the shuffle, so many changes of one key never meet in one task.
    """
    columns = current.columns
    merged = current.withColumn("__v", F.struct(F.lit(0).alias("side"), version.alias("v"))).unionByName(
        changes.withColumn("__v", F.struct(F.lit(1).alias("side"), version.alias("v")))
    )
    rest = [c for c in columns if c != key]
    latest = merged.groupBy(key).agg(F.max_by(F.struct(*rest), "__v").alias("__row"))
    return latest.select(key, *[F.col("__row")[c].alias(c) for c in rest]).select(*columns)


def to_cells(df: DataFrame, key: str, family: str) -> DataFrame:
    """Column-store puts: one (row, family, qualifier, value) per non-key column."""
    values = [c for c in df.columns if c != key]
    text = df.select(F.col(key).cast("string").alias("row"), *[F.col(c).cast("string").alias(c) for c in values])
    cells = text.unpivot("row", values, "qualifier", "value")
    return cells.select("row", F.lit(family).alias("family"), "qualifier", "value")
