"""Closing windows and ordered state: late rows, restarts, brute force."""

import datetime
import random

from pyspark.sql import functions as F

from millrace.queries import stream_queries
from millrace.registry import QUERIES
from millrace.session import scratch_path
from millrace.streaming.counts import drain, latest
from millrace.streaming.sources import parquet_files
from millrace.streaming.visits import PROVIDER, last_values, visits
from millrace.streaming.windows import closed_windows

DAY = datetime.datetime(2024, 1, 1)


def fed(spark, waves, schema, process):
    folder, out, checkpoint = (scratch_path(spark, x) for x in ("in", "out", "checkpoint"))
    for rows in waves:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        stream = parquet_files(spark, folder, spark.createDataFrame([], schema).schema)
        drain(process(stream, out, checkpoint))
    return spark.read.parquet(out)


def at(minutes):
    return DAY + datetime.timedelta(minutes=minutes)


def test_late_rows_are_partly_kept(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    counted = QUERIES["stm_window_watermark"](spark, sf_dir).agg(F.sum("n")).first()[0]
    late = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_id % 10 = 0 or event_id % 25 = 0").count()
    assert events - late < counted < events and stream_queries.WAVES == 5


def test_a_late_row_joins_two_open_sessions(spark):
    waves = [[(at(0), 1), (at(30), 1), (at(31), 2)], [(at(15), 1), (at(200), 2)], [(at(1), 1)], [(at(10_000), 9)]]

    def process(stream, out, checkpoint):
        return closed_windows(stream, "t", "60 minutes", F.session_window("t", "20 minutes"), ["k"], {"n": F.count(F.lit(1))}, out, checkpoint)

    rows = fed(spark, waves, "t timestamp, k int", process).collect()
    # the row of the third wave comes after the watermark of minute 140
    assert sorted((r["k"], r["n"], r["start"], r["end"]) for r in rows) == [
        (1, 3, at(0), at(50)),
        (2, 1, at(31), at(51)),
        (2, 1, at(200), at(220)),
    ]


def test_sliding_windows_overlap(spark):
    def process(stream, out, checkpoint):
        return closed_windows(stream, "t", "0 minutes", F.window("t", "10 minutes", "5 minutes"), ["k"], {"n": F.count(F.lit(1))}, out, checkpoint)

    rows = fed(spark, [[(at(7), 1)], [(at(100), 1)]], "t timestamp, k int", process).collect()
    assert sorted((r["start"], r["n"]) for r in rows) == [(at(0), 1), (at(5), 1)]


def cut(rows, gap, last):
    out, visit = [], None
    for time, _, kind in sorted(rows):
        if visit and (time - visit[1]).total_seconds() > gap:
            out.append((*visit, "gap"))
            visit = None
        visit = (visit[0], time, visit[2] + 1, kind) if visit else (time, time, 1, kind)
        if kind == last:
            out.append((*visit, "last"))
            visit = None
    return out + ([(*visit, "gap")] if visit else [])


def test_visits_in_the_order_of_time(spark):
    rng = random.Random(4)
    rows = [(rng.randint(1, 4), at(rng.randint(0, 3000)), k, rng.choice(["view", "view", "buy"])) for k in range(200)]
    # three waves, out of order by up to two hours, within the delay
    arrived = sorted(rows, key=lambda r: r[1] + datetime.timedelta(minutes=rng.randint(0, 120)))
    waves = [arrived[:70], arrived[70:140], arrived[140:], [(99, at(100_000), 999, "view")]]

    def process(stream, out, checkpoint):
        return visits(stream, "300 minutes", 1800, "buy", out, checkpoint)

    before = spark.conf.get(PROVIDER)
    got = fed(spark, waves, "key bigint, time timestamp, id bigint, kind string", process).collect()
    want = [(k, *v) for k in range(1, 5) for v in cut([r[1:] for r in rows if r[0] == k], 1800, "buy")]
    assert sorted((r["key"], r["started"], r["ended"], r["n"], r["last_kind"], r["reason"]) for r in got) == sorted(want)
    assert spark.conf.get(PROVIDER) == before


def test_a_row_behind_the_watermark_is_left_out_of_visits(spark):
    waves = [[(1, at(0), 1, "view"), (1, at(500), 2, "view")], [(1, at(10), 3, "view")], [(9, at(100_000), 4, "view")]]

    def process(stream, out, checkpoint):
        return visits(stream, "60 minutes", 1800, "buy", out, checkpoint)

    got = fed(spark, waves, "key bigint, time timestamp, id bigint, kind string", process).collect()
    assert sorted((r["started"], r["n"]) for r in got) == [(at(0), 1), (at(500), 1)]


def test_last_values_keep_their_order(spark):
    waves = [[(1, at(5), 1, 5.0), (1, at(9), 2, 9.0), (2, at(1), 3, 1.0)], [(1, at(7), 4, 7.0), (1, at(1), 5, 1.0)]]
    got = fed(spark, waves, "key bigint, time timestamp, id bigint, value double", lambda s, o, c: last_values(s, 2, o, c))
    assert {r["key"]: r["last"] for r in latest(got, ["key"]).collect()} == {1: [7.0, 9.0], 2: [1.0]}
