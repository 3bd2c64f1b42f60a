"""Streams: equal to the batch result, restartable, errors not swallowed."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming.counts import count_by, drain, latest, per_batch, printing, running, split_words, sql_per_batch
from millrace.streaming.sources import line_files, parquet_files, table_stream


def folders(spark):
    return scratch_path(spark, "in"), scratch_path(spark, "out"), scratch_path(spark, "ckpt")


def test_queue_of_five(spark):
    source, out, ckpt = folders(spark)
    for _ in range(5):
        spark.range(1, 1001, 1, 10).write.mode("append").parquet(source)
        stream = parquet_files(spark, source, "id bigint")
        drain(per_batch(stream, lambda b: count_by(b.select((F.col("id") % 10).alias("key")), "key"), out, ckpt))
    got = spark.read.parquet(out).groupBy("batch_id", "key").agg(F.sum("n").alias("n")).collect()
    assert len(got) == 50 and {r["n"] for r in got} == {100}


def test_restart_reads_only_what_is_new(spark):
    source, out, ckpt = folders(spark)
    for text in ("a b a", "b c", "a  d"):
        spark.createDataFrame([(text,)], "value string").write.mode("append").text(source)
        drain(running(split_words(line_files(spark, source)), ["word"], {"n": F.count(F.lit(1))}, out, ckpt))
    # a run with nothing new changes nothing
    drain(running(split_words(line_files(spark, source)), ["word"], {"n": F.count(F.lit(1))}, out, ckpt))
    got = {r["word"]: r["n"] for r in latest(spark.read.parquet(out), ["word"]).collect()}
    assert got == {"a": 3, "b": 2, "c": 1, "d": 1, "": 1}


def test_bad_sql_ends_the_stream(spark, sf_dir):
    _, out, ckpt = folders(spark)
    query = sql_per_batch(table_stream(spark, sf_dir, "events"), "v_bad", "SELECT nothing_here FROM v_bad", out, ckpt)
    with pytest.raises(StreamingQueryException):
        drain(query)


def test_printing_shows_some_rows(spark, sf_dir):
    _, out, ckpt = folders(spark)
    seen = []
    drain(printing(table_stream(spark, sf_dir, "events"), lambda b: count_by(b, "event_type"), out, ckpt, rows=2, emit=seen.append))
    assert len(seen) == 2 and spark.read.parquet(out).count() == 5


def test_bounded_batches(spark, tmp_path):
    source, out, ckpt = folders(spark)
    spark.range(0, 1000, 1, 4).write.parquet(source)
    stream = parquet_files(spark, source, "id bigint", max_bytes=1)
    drain(per_batch(stream, lambda b: b.agg(F.count(F.lit(1)).alias("n")), out, ckpt))
    got = spark.read.parquet(out)
    assert got.count() > 1 and got.agg(F.sum("n")).first()[0] == 1000


STREAMS = ["stm_files", "stm_socket", "stm_kafka", "stm_broker_other", "stm_queue", "stm_batch_count", "stm_running_count", "stm_sql_per_batch", "stm_recoverable", "stm_sink_print", "udf_state_update"]


@pytest.mark.parametrize("name", STREAMS)
def test_several_batches_give_the_same(spark, sf_dir, name, monkeypatch, tmp_path):
    """Every stream query over tables of four files, one file a batch, against its SQL on the whole tables."""
    import harness
    from millrace.queries import stream_queries
    from millrace.registry import ORACLES, QUERIES
    from millrace.streaming import sources

    for t in ("documents", "events", "conversations", "orders"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(4).write.parquet(f"{tmp_path}/{t}.parquet")
    narrow = lambda f, at: lambda *a: f(*a[:at], max_bytes=1)
    monkeypatch.setattr(stream_queries, "table_stream", narrow(sources.table_stream, 3))
    monkeypatch.setattr(stream_queries, "line_files", lambda spark, folder: spark.readStream.option("maxFilesPerTrigger", "1").text(folder))
    assert harness.compare(QUERIES[name](spark, str(tmp_path)), harness.connect(sf_dir), ORACLES[name]) is None
