"""Loads that fail and are repeated, in batches and as a stream: every row once."""

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import millrace.ingest.run as run
import millrace.ingest.stream as ingest_stream_module
from millrace.ingest.run import ingest, loaded_until
from millrace.ingest.specs import IngestSpec, labelled
from millrace.ingest.stream import Feed, ingest_stream
from millrace.session import scratch_name, scratch_path
from millrace.sinks.writers import append_by_name, create_table
from millrace.streaming.counts import drain
from millrace.streaming.sources import parquet_files

SPEC = IngestSpec("t", ["id", "name"], "updated_at", labelled("T", 3))


def source(spark, low, high):
    day = F.make_timestamp_ntz(F.lit(2020), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) + F.make_dt_interval(F.col("id").cast("int"))
    return spark.range(low, high).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"), day.alias("updated_at"))


def target(spark):
    name = scratch_name("target")
    create_table(spark, name, ", ".join(f"{c} string" for c in SPEC.layout), scratch_path(spark, "target"))
    return name


def ids(spark, name):
    return sorted(int(r["id"]) for r in spark.table(name).collect())


class Broken(Exception):
    pass


def broken(*_):
    raise Broken


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("point", ["write_batch", "read_watermark", "keep"])
def test_a_load_that_fails_is_repeated(spark, monkeypatch, point, inclusive):
    """Failing before the rows are in the table, between rows and watermark, and in the step that keeps it."""
    name = target(spark)
    ingest(source(spark, 0, 10), name, SPEC, "L1")
    with monkeypatch.context() as broken_run:
        broken_run.setattr(run, point, broken)
        for _ in range(2):
            with pytest.raises(Broken):
                ingest(source(spark, 0, 20), name, SPEC, "L2", inclusive=inclusive)
    assert ingest(source(spark, 0, 20), name, SPEC, "L3", inclusive=inclusive) == 10
    assert ids(spark, name) == list(range(20))
    assert ingest(source(spark, 0, 20), name, SPEC, "L4", inclusive=inclusive) == 0
    assert loaded_until(spark, name) == datetime.datetime(2020, 1, 20)


def test_rows_are_doubled_without_the_folder(spark, monkeypatch):
    """The test above can fail: with a folder of another name for every attempt, the rows of the broken one stay."""
    name = target(spark)
    ingest(source(spark, 0, 2), name, SPEC, "L0")
    folders = iter(range(10))
    original = run.batch_folder
    monkeypatch.setattr(run, "batch_folder", lambda s, t, label: original(s, t, f"{label}-{next(folders)}"))
    with monkeypatch.context() as broken_run:
        broken_run.setattr(run, "keep", broken)
        with pytest.raises(Broken):
            ingest(source(spark, 0, 5), name, SPEC, "L1")
    ingest(source(spark, 0, 5), name, SPEC, "L2")
    assert len(ids(spark, name)) > 5


def test_every_batch_is_written_once(spark):
    name = target(spark)
    append_by_name(run.stamp(run.pull(source(spark, 0, 3), SPEC, None), SPEC, "L0"), name)
    ingest(source(spark, 0, 8), name, SPEC, "L1")
    files = spark.table(name).inputFiles()
    assert ids(spark, name) == list(range(8)) and len([f for f in files if "/batch-000000000/" in f]) >= 1


def test_a_table_that_reads_no_inner_folders_is_refused(spark):
    name = scratch_name("plain")
    spark.sql(f"CREATE TABLE {name} ({', '.join(f'{c} string' for c in SPEC.layout)}) USING parquet LOCATION '{scratch_path(spark, 'plain')}'")
    with pytest.raises(ValueError):
        ingest(source(spark, 0, 3), name, SPEC, "L1")


def stream_of(spark, folder):
    return parquet_files(spark, folder, source(spark, 0, 1).schema)


def test_a_stream_that_fails_is_restarted(spark, monkeypatch):
    names = [target(spark) for _ in range(3)]
    feeds = [Feed(n, SPEC, lambda b: b) for n in names]
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "checkpoint")
    original = ingest_stream_module.keep
    for wave, (low, high) in enumerate([(0, 5), (20, 30), (5, 20)]):  # the last wave is late
        source(spark, low, high).write.mode("append").parquet(folder)

        def keep_or_fail(s, name, values):
            if name == names[wave]:
                raise Broken
            original(s, name, values)

        with monkeypatch.context() as broken_run:
            broken_run.setattr(ingest_stream_module, "keep", keep_or_fail)
            with pytest.raises(StreamingQueryException):
                drain(ingest_stream(stream_of(spark, folder), feeds, checkpoint, "L"))
        drain(ingest_stream(stream_of(spark, folder), feeds, checkpoint, "L"))
        drain(ingest_stream(stream_of(spark, folder), feeds, checkpoint, "L"))
    assert all(ids(spark, n) == list(range(30)) for n in names)
    assert all(loaded_until(spark, n) == datetime.datetime(2020, 1, 30) for n in names)


def test_a_new_checkpoint_is_another_stream(spark):
    name = target(spark)
    for low, high in ((0, 5), (5, 9)):
        folder = scratch_path(spark, "in")
        source(spark, low, high).write.parquet(folder)
        drain(ingest_stream(stream_of(spark, folder), [Feed(name, SPEC, lambda b: b)], scratch_path(spark, "checkpoint"), "L"))
    assert ids(spark, name) == list(range(9))
