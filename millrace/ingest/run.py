"""Incremental and full loads of one table, driven by an :class:`IngestSpec`."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.fingerprint import python_text, row_md5
from millrace.ingest.specs import IngestSpec
from millrace.session import PACKED, remove_folder
from millrace.sinks.writers import NESTED, table_location, truncate_load

#: Table properties: the latest change time loaded, and the number of loads that are done.
KEPT, LOADS = "millrace.loaded_until", "millrace.loads"


def now_text() -> str:
    return datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def watermark(target: DataFrame) -> DataFrame:
    """One row: the latest change time already loaded (rows that had none do not count)."""
    return target.agg(F.max(F.col("updatets").try_cast("timestamp_ntz")).alias("max"))


def read_watermark(target: DataFrame) -> datetime.datetime | None:
    """The watermark as a scalar, so that the filter built from it reaches the source's scan."""
    return watermark(target).first()["max"]


def pull(source: DataFrame, spec: IngestSpec, since: datetime.datetime | None, inclusive: bool = False) -> DataFrame:
    """Source rows changed after ``since``; everything on the first load.

    The strict form loses rows that arrive later with exactly the boundary time. The inclusive form reads the
    boundary again; :func:`drop_loaded` then takes out what the target holds.
    """
    picked = source.select(*spec.hashed)
    if spec.changed is None or since is None:
        return picked
    edge = F.lit(since).cast("timestamp_ntz")
    changed = F.col(spec.changed)
    return picked.filter(changed >= edge if inclusive else changed > edge)


def stamp(rows: DataFrame, spec: IngestSpec, load_time: str) -> DataFrame:
    """Business columns, constants, fingerprint, load time and change time, all as text in target order."""
    loaded = F.lit(load_time)
    if spec.changed is None:
        changed = loaded
    else:
        changed = python_text(F.col(spec.changed), rows.schema[spec.changed].dataType)
    return rows.select(
        *[F.col(c).cast("string").alias(c) for c in spec.columns],
        F.lit(spec.cust_no).alias("cust_no"),
        F.lit(spec.isvalid).alias("isvalid"),
        row_md5(spec.template, spec.hashed, rows.schema).alias("src_fields_md5"),
        loaded.alias("createts"),
        changed.alias("updatets"),
    )


def drop_loaded(stamped: DataFrame, target: DataFrame, spec: IngestSpec, since: datetime.datetime | None) -> DataFrame:
    """Leave out rows the target already has (same key and fingerprint); only the boundary can repeat."""
    if since is None:
        return stamped
    edge = F.lit(since).cast("timestamp_ntz")
    seen = target.filter(F.col("updatets").try_cast("timestamp_ntz") >= edge).select(spec.key, "src_fields_md5").distinct()
    return stamped.join(seen, [spec.key, "src_fields_md5"], "left_anti").select(*stamped.columns)


def table_properties(spark: SparkSession, target: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}


def loaded_until(spark: SparkSession, target: str) -> datetime.datetime | None:
    """The watermark kept with the table by the last load; only a table without one is scanned."""
    kept = table_properties(spark, target).get(KEPT)
    if kept is None:
        return read_watermark(spark.table(target))
    return datetime.datetime.fromisoformat(kept) if kept else None


def batch_folder(spark: SparkSession, target: str, label: str) -> str:
    """The folder of one batch inside the table, emptied of what a batch of this name left when it failed."""
    if table_properties(spark, target).get(NESTED) != "true":
        raise ValueError(f"{target} does not read folders inside its own; make it with create_table")
    folder = f"{table_location(spark, target).rstrip('/')}/batch-{label}"
    remove_folder(spark, folder)
    spark.catalog.refreshTable(target)
    return folder


def write_batch(rows: DataFrame, target: str, folder: str) -> DataFrame:
    """Write the rows once, into their place in the table; what is read back is the batch alone."""
    spark = rows.sparkSession
    schema = spark.table(target).schema
    rows.select(*schema.names).write.mode("overwrite").option("compression", PACKED).parquet(folder)
    spark.catalog.refreshTable(target)
    return spark.read.schema(schema).parquet(folder)


def keep(spark: SparkSession, target: str, values: dict[str, str]) -> None:
    """Keep all values with the table, in one step."""
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in values.items())})")


def ingest(source: DataFrame, target: str, spec: IngestSpec, load_time: str | None = None, inclusive: bool = False) -> int:
    """Load one table and return the number of rows written, at the cost of the batch, not of the table.

    The batch is written once, to a folder of the table that is named by the number of the load; the folder gives its rows (from the footers) and its latest
    change time. That time and the number of the next load are then kept with the table in one step. A load that fails before has changed neither: when
    it is repeated, it reads from the same time on and replaces its folder, so no row comes twice.
    """
    spark = source.sparkSession
    loaded = load_time or now_text()
    if spec.changed is None:
        return truncate_load(stamp(pull(source, spec, None), spec, loaded), target)
    number = int(table_properties(spark, target).get(LOADS, "0"))
    folder = batch_folder(spark, target, f"{number:09d}")
    since = loaded_until(spark, target)
    rows = stamp(pull(source, spec, since, inclusive), spec, loaded)
    if inclusive:
        rows = drop_loaded(rows, spark.table(target), spec, since)
    batch = write_batch(rows, target, folder)
    written = batch.count()
    latest = read_watermark(batch)
    until = max((t for t in (since, latest) if t is not None), default=None)
    keep(spark, target, {KEPT: until.isoformat() if until else "", LOADS: str(number + 1)})
    return written
