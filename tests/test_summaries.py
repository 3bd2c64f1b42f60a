"""Aggregates of the caller's, sketches, table functions, multisets."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import aggregator, sketches
from millrace.operators.aggregator import GeometricMean, Occurrences, aggregate, modes
from millrace.operators.tables import stretches
from millrace.queries.summary_queries import order_kinds


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, "a", "b"]) if k % 3 else "hot", rng.randint(0, 2), rng.choice([None, -1.0, 1.5, 2.0, 8.0]), rng.choice([None, "x", "y", "z"])) for k in range(n)]


def frame(spark, n, seed=1):
    return spark.createDataFrame(rows(n, seed), "g string, h int, value double, word string")


def means(data):
    groups = {}
    for g, h, v, _ in data:
        groups.setdefault((g, h), []).append(v)
    out = {}
    for key, values in groups.items():
        logs = [math.log(v) for v in values if v is not None and v > 0]
        out[key] = 0.0 if 0.0 in values else math.exp(sum(logs) / len(logs)) if logs else None
    return out


@pytest.mark.parametrize("state_rows", [1 << 16, 4])
@pytest.mark.parametrize("n", [500, 1, 0])
def test_geometric_mean(spark, monkeypatch, n, state_rows):
    monkeypatch.setattr(aggregator, "STATE_ROWS", state_rows)
    data = rows(n) + ([("zero", 1, 0.0, None), ("zero", 1, 3.0, None), ("none", 1, None, None)] if n else [])
    df = spark.createDataFrame(data, "g string, h int, value double, word string").repartition(7)
    got = {(r["g"], r["h"]): r["geometric_mean"] for r in aggregate(df, ["g", "h"], GeometricMean("value")).collect()}
    want = means(data)
    assert got.keys() == want.keys()
    assert all(got[k] == want[k] if want[k] in (None, 0.0) else math.isclose(got[k], want[k]) for k in want)


@pytest.mark.parametrize("state_rows", [1 << 16, 4])
def test_modes_with_ties(spark, monkeypatch, state_rows):
    monkeypatch.setattr(aggregator, "STATE_ROWS", state_rows)
    for n, seed in ((300, 1), (12, 2), (40, 3)):
        got = {r["g"]: (r["n"], r["modes"]) for r in modes(frame(spark, n, seed).repartition(5), ["g"], "word").collect()}
        counts = {}
        for g, _, _, word in rows(n, seed):
            if word is not None:
                counts.setdefault(g, Counter())[word] += 1
        assert got == {g: (max(c.values()), sorted(w for w, k in c.items() if k == max(c.values()))) for g, c in counts.items()}


def test_states_are_reduced_before_the_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 3).alias("g"), F.lit("w").alias("word"))
    found = aggregate(df, ["g"], Occurrences())
    plan = found._jdf.queryExecution().executedPlan().toString()
    reduced, shuffled = plan.rindex("MapInArrow"), plan.index("Exchange hashpartitioning")
    assert plan.index("MapInArrow") < shuffled < reduced
    assert sum(r["n"] for r in found.collect()) == 200_000


def test_a_task_sends_one_state_a_key(spark):
    class Sent(Occurrences):
        """Counts states instead of rows."""

        def merge(self, states, keys):
            return super().merge(states.set_column(states.schema.get_field_index("n"), "n", pa.array([1] * states.num_rows, pa.int64())), keys)

    df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 3).alias("g"))
    # a merge of n states says n: eight tasks sent one each, whatever they read
    assert {r["n"] for r in aggregate(df, ["g"], Sent()).collect()} == {8}


def test_merged_sketches(spark):
    df = spark.range(0, 60_000, 1, 6).select((F.col("id") % 5).alias("day"), (F.col("id") % 20_000).alias("who"), (F.col("id") * 7 % 60_000).alias("x"))
    daily = sketches.sketch(df, ["day"], {"who": F.col("who")}, {"x": F.col("x")})
    whole = sketches.merge(daily.withColumn("all", F.lit(1)), ["all"], ["who"], ["x"])
    for q in (0.01, 0.5, 0.9):
        r = sketches.estimates(whole, ["all"], ["who"], {"x": q}).first()
        assert abs(r["who"] - 20_000) < 20_000 * sketches.distinct_error()
        assert abs(r["x"] / 60_000 - q) < sketches.rank_error()
    # a sketch that misses a day is out of bounds
    part = sketches.merge(daily.filter("day < 2").withColumn("all", F.lit(1)), ["all"], ["who"], ["x"])
    assert abs(sketches.estimates(part, ["all"], ["who"], {"x": 0.5}).first()["who"] - 20_000) > 20_000 * sketches.distinct_error()


def test_sketches_of_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", 1.0), (2, None, None)], "day int, who string, x double")
    found = sketches.estimates(sketches.sketch(df, ["day"], {"who": F.col("who")}, {"x": F.col("x")}), ["day"], ["who"], {"x": 0.5})
    assert sorted((r["day"], r["who"], r["x"]) for r in found.collect()) == [(1, 0, None), (2, 1, 1.0)]


def test_stretches(spark):
    data = [("a", 3, "x"), ("a", 1, "x"), ("a", 2, "x"), ("a", 9, "y"), ("b", 1, None), ("b", 2, None), ("b", 3, "x"), (None, 1, "z")]
    df = spark.createDataFrame(data, "k string, t int, v string").repartition(4)
    got = Counter(tuple(r) for r in stretches(df, "k", "t", "v").collect())
    assert got == Counter(
        [("a", 1, "x", 3), ("a", 9, "y", 1), ("a", None, None, -4), ("b", 1, None, 2), ("b", 3, "x", 1), ("b", None, None, -3), (None, 1, "z", 1), (None, None, None, -1)]
    )
    assert stretches(df.limit(0), "k", "t", "v").count() == 0
    assert dict(stretches(df, "k", "t", "v").dtypes) == {"k": "string", "t": "int", "v": "string", "length": "bigint"}
    with pytest.raises(AnalysisException, match="no column gone"):
        stretches(df, "k", "gone", "v")


def test_multisets_with_one_exchange(spark, sf_dir):
    early, late = order_kinds(spark, sf_dir)
    for found, rule in ((early.intersectAll(late), min), (early.exceptAll(late), lambda a, b: max(0, a - b))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1
        a, b = (Counter(tuple(r) for r in side.collect()) for side in (early, late))
        want = {k: rule(a[k], b[k]) for k in a}
        assert Counter(tuple(r) for r in found.collect()) == Counter({k: n for k, n in want.items() if n})
        assert any(None in k for k in a)


def test_totals_are_told_from_nulls(spark, sf_dir):
    from millrace.registry import QUERIES

    found = QUERIES["agg_grouping_sets"](spark, sf_dir).collect()
    nulls = {r["level"] for r in found if r["segment"] is None}
    # level 0b010: region and segment are known; 0b001: the segment is a total
    assert nulls == {0b010, 0b001, 0b110, 0b111}
