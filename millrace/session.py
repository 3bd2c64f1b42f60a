"""Session set-up, table access and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: How Parquet files are packed: fingerprints and keys take about half the bytes of the default.
PACKED = "zstd"

_local_scratch: dict[str, str] = {}
_scopes: list[list[str]] = []


def build_session(app: str = "millrace", cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may run without it: it gets one temporary folder per application.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _local_scratch.get(sc.applicationId)
        if base is None:
            base = tempfile.mkdtemp(prefix="millrace-")
            _local_scratch[sc.applicationId] = base
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; never handed out twice."""
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was put below the scratch folder meanwhile; results that stay are written to a path taken before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, in whatever store it lies."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_name(label: str) -> str:
    """A fresh catalog name, so that parallel runs in one session do not meet."""
    return f"{label}_{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows starts from files: a lost executor costs no recomputation, later scans read only the columns they
    need, and Spark knows the true size when it picks a join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
