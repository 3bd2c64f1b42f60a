"""Readers and writers for external stores.

One entry point per direction, so that a job does not know which store it talks to. JDBC is part of Spark; Avro,
Kafka and wide-column stores need their vendor package on the cluster. The same functions run on the
built-in formats, which is how the projection and cell logic is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def read_connector(spark: SparkSession, fmt: str, options: dict[str, str], schema: str | None = None) -> DataFrame:
    """Load any batch format; ``schema`` narrows self-describing files to the named fields."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def write_connector(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "append") -> None:
    df.write.format(fmt).options(**options).mode(mode).save()


def avro_options(path: str, reader_schema: str | None = None) -> dict[str, str]:
    """Options for ``format("avro")``; the reader schema keeps a subset of the record's fields."""
    options = {"path": path}
    if reader_schema is not None:
        options["avroSchema"] = reader_schema
    return options


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Read options for one table.

    Without a partition column a JDBC scan is one task, which no large table survives: give the column,
    its bounds and the number of slices. Filters and column lists are pushed down by Spark.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "pushDownPredicate": "true"}
    if driver:
        options["driver"] = driver
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition_column is not None:
        if bounds is None or partitions < 2:
            raise ValueError("a partitioned read needs bounds and at least two partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def jdbc_max(url: str, table: str, column: str, **login: str) -> dict[str, str]:
    """Options that make the database itself compute ``max(column)``: one row crosses the wire."""
    return jdbc_options(url, f"(select max({column}) as w from {table}) t", **login)


def jdbc_writer(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    driver: str | None = None,
    column_types: str | None = None,
    truncate: bool = False,
    batch_size: int = 5_000,
    connections: int | None = None,
) -> DataFrameWriter:
    """A batched JDBC writer; call ``.save()`` on it.

    ``truncate`` keeps the table's definition on overwrite. ``connections`` bounds the number of tasks that write at
    one time (merging partitions, no shuffle).
    """
    if connections is not None:
        df = df.coalesce(connections)
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if driver:
        writer = writer.option("driver", driver)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if truncate:
        writer = writer.option("truncate", True)
    return writer
