"""The cell store: round trip, skipped files, commits; nearest vectors and words; inserted values."""

import glob
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import Word2Vec
from pyspark.sql import functions as F

from millrace.ml.nearest import _first, nearest, nearest_words, word_vectors
from millrace.session import scratch_name, scratch_path
from millrace.sinks.writers import create_table, insert_values
from millrace.sources import cells
from millrace.sources.connectors import read_connector, write_connector


def cell_rows(spark, n, family="f"):
    return spark.range(0, n, 1, 4).select(
        F.format_string("%04d", "id").alias("row"), F.lit(family).alias("family"), F.concat(F.lit("q"), F.col("id") % 3).alias("qualifier"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("value")
    )


def store(spark):
    cells.register(spark)
    return scratch_path(spark, "cell-store")


def data_files(path):
    return glob.glob(f"{path}/data/*.parquet")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_round_trip_append_overwrite(spark):
    path = store(spark)
    first, second = cell_rows(spark, 50), cell_rows(spark, 30, "g")
    write_connector(first, "cells", {"path": path})
    write_connector(second.select("value", "row", "qualifier", "family"), "cells", {"path": path})
    assert same(read_connector(spark, "cells", {"path": path}), first.unionByName(second))
    write_connector(second, "cells", {"path": path}, "overwrite")
    assert same(read_connector(spark, "cells", {"path": path}), second)
    write_connector(second.limit(0), "cells", {"path": path}, "overwrite")
    assert read_connector(spark, "cells", {"path": path}).count() == 0


def test_filters_skip_files_and_rows(spark):
    path = store(spark)
    both = cell_rows(spark, 100).unionByName(cell_rows(spark, 100, "g"))
    write_connector(both, "cells", {"path": path})
    for rule in ("family = 'g'", "row < '0010'", "row >= '0090' and family = 'f'", "family in ('f', 'x')", "qualifier = 'q1' and row > '0050'", "value is null", "row = 'none'", "family = 'g' or row = '0001'"):
        assert same(read_connector(spark, "cells", {"path": path}).filter(rule), both.filter(rule))
    reader = cells.CellReader(path)
    everything = len(reader.partitions())
    assert list(reader.pushFilters([cells.EqualTo(("family",), "g"), cells.LessThan(("row",), "0010")])) == []
    assert 0 < len(reader.partitions()) < everything == 8
    plan = read_connector(spark, "cells", {"path": path}).filter("family = 'g'")._jdf.queryExecution().executedPlan().toString()
    assert ") Filter " not in plan


def test_a_failed_task_leaves_nothing(spark):
    path = store(spark)
    write_connector(cell_rows(spark, 40), "cells", {"path": path})
    before = sorted(data_files(path))
    # the last task meets a cell without a family
    bad = cell_rows(spark, 100).withColumn("family", F.when(F.col("row") < "0099", F.col("family")))
    with pytest.raises(Exception, match="without a row or a family"):
        write_connector(bad, "cells", {"path": path})
    assert sorted(data_files(path)) == before and len(os.listdir(f"{path}/manifests")) == 1
    assert read_connector(spark, "cells", {"path": path}).count() == 40


def test_files_that_no_manifest_names_are_not_read(spark):
    path = store(spark)
    write_connector(cell_rows(spark, 10), "cells", {"path": path})
    cells.CellWriter(path, False).write(iter(cell_rows(spark, 7, "lost").toArrow().to_batches()))
    assert read_connector(spark, "cells", {"path": path}).count() == 10


def test_other_columns_are_refused(spark):
    with pytest.raises(Exception, match="text columns"):
        write_connector(cell_rows(spark, 3).withColumn("value", F.lit(1)), "cells", {"path": store(spark)})


def test_large_families_go_on_in_another_file(spark, monkeypatch):
    path = store(spark)
    monkeypatch.setattr(cells, "FILE_ROWS", 10)
    batches = cell_rows(spark, 40).coalesce(1).toArrow().to_batches(max_chunksize=10)
    writer = cells.CellWriter(path, False)
    message = writer.write(iter(batches))
    writer.commit([message, None])
    assert len(message.files) == len(data_files(path)) == 4 and read_connector(spark, "cells", {"path": path}).count() == 40


def brute(vectors, asked, k):
    out = []
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors if v is not None and np.isfinite(v).all() and np.any(v)}
    for i in asked:
        if i in unit:
            near = sorted((-round(float(unit[i] @ u), 9), j) for j, u in unit.items() if j != i)[:k]
            out += [(i, r + 1, j) for r, (_, j) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("block", [8_000_000, 20])
def test_nearest_vectors(spark, block):
    rng = random.Random(6)
    vectors = [(k, [rng.gauss(0, 1) for _ in range(4)]) for k in range(150)]
    vectors += [(200 + k, vectors[0][1]) for k in range(20)] + [(300, None), (301, [0.0] * 4), (302, [float("nan")] * 4), (303, [float("inf"), 0.0, 0.0, 1.0])]
    df = spark.createDataFrame(vectors, "id int, vector array<double>").repartition(6)
    asked = [0, 3, 77, 149, 205, 300, 301, 302]
    got = nearest(df, df.filter(F.col("id").isin(asked)), 7, block).collect()
    assert sorted((r["asked"], r["rank"], r["id"]) for r in got) == brute(vectors, asked, 7)
    assert nearest(df.limit(0), df, 7).count() == 0 and nearest(df, df.limit(0), 7).count() == 0


def test_nearest_words_as_the_model_says(spark):
    rng = random.Random(8)
    lines = [([rng.choice([f"w{k}" for k in range(70)]) for _ in range(30)],) for _ in range(60)]
    model = Word2Vec(vectorSize=5, minCount=0, seed=1, maxIter=1, inputCol="t", outputCol="v").fit(spark.createDataFrame(lines, "t array<string>"))
    words = spark.createDataFrame([("w1",), ("w1",), ("w69",), ("unknown",)], "word string")
    got = nearest_words(model, words).collect()
    vectors = [(r["id"], list(r["vector"])) for r in word_vectors(model).collect()]
    assert sorted((r["word"], r["rank"], r["near"]) for r in got) == brute(vectors, ["w1", "w69"], 40)
    for word in ("w1", "w69"):
        ours = [r["near"] for r in sorted(got, key=lambda r: r["rank"]) if r["word"] == word]
        assert set(ours[:10]) == {r["word"] for r in model.findSynonyms(word, 10).collect()}


def test_words_are_handed_out_once_and_few_candidates_are_kept(spark):
    lines = [([f"w{k % 30}" for k in range(90)],)]
    model = Word2Vec(vectorSize=3, minCount=0, seed=1, maxIter=1, inputCol="t", outputCol="v").fit(spark.createDataFrame(lines, "t array<string>"))
    found = nearest_words(model, spark.createDataFrame([("w1",)], "word string"))
    assert "Local" not in found._jdf.queryExecution().optimizedPlan().toString()
    entries = pa.table({"question": [1, 0, 1, 0, 1, 0], "similarity": [0.5, 0.1, 0.5, 0.2, 0.4, 0.2], "id": ["b", "c", "a", "z", "d", "y"]})
    assert _first(entries, 2).to_pylist() == [{"question": q, "similarity": s, "id": i} for q, s, i in [(0, 0.2, "y"), (0, 0.2, "z"), (1, 0.5, "a"), (1, 0.5, "b")]]


def test_values_are_bound(spark):
    name = scratch_name("values")
    create_table(spark, name, "a int, b string, c double", scratch_path(spark, "values"))
    insert_values(spark, name, ["b", "a"], [("it's; DROP TABLE x --", 1), (None, 2), ("", None)], rows_at_once=2)
    assert sorted(map(str, spark.table(name).collect())) == sorted(["Row(a=1, b=\"it's; DROP TABLE x --\", c=None)", "Row(a=2, b=None, c=None)", "Row(a=None, b='', c=None)"])
