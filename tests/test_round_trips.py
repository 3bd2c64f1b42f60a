"""What passes a shuffle, a disk or the state store, and how often."""

import glob

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from millrace.operators.intervals import contained_in
from millrace.session import cut_lineage, scratch_name, scratch_path
from millrace.sinks.writers import create_table, truncate_load
from millrace.streaming.visits import Visits


def test_attempts_outside_all_windows_go_no_further(spark):
    attempts = spark.createDataFrame([(1, t, t + 1) for t in range(100)] + [(2, 5, 6), (3, None, 7)], "person int, s int, e int")
    windows = spark.createDataFrame([(1, 10, 13), (1, 20, 22), (2, 9, 8)], "person int, s int, e int")
    at = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    found = contained_in(attempts.select("person", at("s").alias("starttime"), at("e").alias("endtime"), "s"), windows.select("person", at("s").alias("start_dt"), at("e").alias("end_dt")), once=True)
    assert sorted({r["s"] for r in found.collect()}) == [10, 11, 12, 20, 21]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__first" in text and "__last" in text


def codecs(folder):
    held = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)]
    return {m.row_group(k).column(0).compression for m in held for k in range(m.num_row_groups)}


def test_loads_and_scratch_tables_are_packed(spark):
    path, name = scratch_path(spark, "packed"), scratch_name("packed")
    create_table(spark, name, "id bigint", path)
    assert truncate_load(spark.range(5), name) == 5
    assert codecs(f"{path}-*") == {"ZSTD"}
    (folder,) = {f.removeprefix("file://").rsplit("/", 1)[0] for f in cut_lineage(spark.range(5)).inputFiles()}
    assert codecs(folder) == {"ZSTD"}


class Store:
    """One value and the calls on it; also the handle that gives it out."""

    def __init__(self):
        self.value, self.calls = None, []

    def getValueState(self, name, schema):
        return self

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name == "update":
                self.value = args[0]
            return self.value if name == "get" else None

        return call


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_key_costs_one_read_and_one_write_a_call():
    store, visits = Store(), Visits(10, "end")
    visits.init(store)
    rows = pd.DataFrame({"time": pd.to_datetime([3, 1, 2, 50], unit="s"), "id": [1, 2, 3, 4], "kind": ["end", "a", "b", "a"]})
    assert list(visits.handleInputRows((7,), iter([rows]), Clock(0))) == []
    assert sorted(store.calls) == ["get", "registerTimer", "update"]
    store.calls.clear()
    (out,) = visits.handleExpiredTimer((7,), Clock(40_000), None)
    assert out[["key", "n", "last_kind", "reason"]].values.tolist() == [[7, 3, "end", "last"]] and sorted(store.calls) == ["get", "registerTimer", "update"]
