"""Finding the physical table behind a logical name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingRoute(LookupError):
    """The control table has no entry for a task."""


def active_table(control: DataFrame, task: str) -> str:
    """Name of the copy that the control table marks as current for ``task``."""
    found = control.filter(F.col("taskname") == task).select("which_for_cs").limit(1).collect()
    if not found or found[0][0] is None:
        raise MissingRoute(f"no active table for task {task}")
    return found[0][0]


def catalog_map(tables: DataFrame, prefix: str = "ets_") -> DataFrame:
    """``target`` (prefix + lower-case name) -> ``source`` (the name as stored)."""
    return tables.select(
        F.concat(F.lit(prefix), F.lower("source")).alias("target"),
        F.col("source"),
    )


def list_tables(spark: SparkSession, pattern: str = "*") -> DataFrame:
    return spark.sql(f"SHOW TABLES LIKE '{pattern}'").select(F.col("tableName").alias("source"))


def strip_shard(name: str) -> str:
    """``ets_score_0`` -> ``ets_score``."""
    return re.sub(r"_\d$", "", name)
