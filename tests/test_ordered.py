"""Large groups in small ranges: the same rows as plain windows and brute force, and no range with a whole hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.ordered import LargeGroups, asof_join, ranked


@pytest.fixture
def many_ranges(spark):
    """Sixteen ranges, none of them put together."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def frame(spark, n=400):
    rng = random.Random(n)
    rows = [(rng.choice([None, "a", "b", "c"]) if k % 2 else "hot", k, rng.randint(0, 9), rng.choice([None, rng.randint(0, 5)])) for k in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key string, id int, value int, sparse int")


def same(got, want):
    columns = sorted(want.columns)
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))


def test_no_range_holds_the_hot_key(spark, many_ranges):
    groups = LargeGroups(frame(spark), ["key"], [F.col("id")])
    hot = groups.rows.filter("key = 'hot'").groupBy("__range").count().collect()
    assert len(hot) > 4 and max(r["count"] for r in hot) < 100
    # what is carried: one row a range at most
    carried = groups.carried({"n": (F.count(F.lit(1)), F.sum)})
    assert carried.groupBy("__range").count().agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("n", [400, 17, 1, 0])
def test_running_and_last_known(spark, many_ranges, n):
    df = frame(spark, n)
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    groups = LargeGroups(df, ["key"], [F.col("id")])
    got = groups.running({"total": F.col("value")}, "nth")
    same(got, df.withColumn("total", F.sum("value").over(w)).withColumn("nth", F.count(F.lit(1)).over(w)))
    got = groups.last_known({"known": F.col("sparse")})
    same(got, df.withColumn("known", F.last("sparse", ignorenulls=True).over(w)))


@pytest.mark.parametrize("n", [400, 30, 3])
@pytest.mark.parametrize("before", [1, 7, 40])
def test_nearby(spark, many_ranges, n, before):
    df = frame(spark, n)

    def outputs(part):
        return {"back": F.lag("value", before).over(part), "moving": F.sum("value").over(part.rowsBetween(-before, 0)), "most": F.max("sparse").over(part.rowsBetween(-before, -1))}

    got = LargeGroups(df, ["key"], [F.col("id")]).nearby(outputs, before)
    plain = Window.partitionBy("key").orderBy("id")
    same(got, df.select("*", *[c.alias(n) for n, c in outputs(plain).items()]))


def test_nearby_looks_back(spark):
    with pytest.raises(ValueError):
        LargeGroups(frame(spark, 3), ["key"], [F.col("id")]).nearby(lambda w: {}, 0)


@pytest.mark.parametrize("descending", [False, True])
def test_rank_with_ties_over_ranges(spark, many_ranges, descending):
    df = frame(spark)
    by = F.col("sparse").desc() if descending else F.col("sparse").asc()
    w = Window.partitionBy("key").orderBy(by)
    want = df.withColumn("rank", F.rank().over(w).cast("bigint")).withColumn("row_number", F.row_number().over(Window.partitionBy("key").orderBy(by, "id")).cast("bigint"))
    same(ranked(df, ["key"], F.col("sparse"), [F.col("id")], descending), want)


def sides(spark, n):
    rng = random.Random(n + 1)
    key = lambda k: None if rng.random() < 0.05 else "hot" if k % 2 else rng.choice(["a", "b", "only-" + str(n % 2)])
    left = [(k, key(k), None if rng.random() < 0.05 else rng.randint(0, n)) for k in range(n)]
    right = [(k, key(k), None if rng.random() < 0.05 else rng.randint(0, n), rng.choice([None, "x", "y"])) for k in range(n)]
    return left, right


@pytest.mark.parametrize("n", [300, 5, 0])
@pytest.mark.parametrize("exact", [True, False])
def test_asof_join(spark, many_ranges, n, exact):
    left, right = sides(spark, n)
    a = spark.createDataFrame(left, "left_id int, key string, at int")
    b = spark.createDataFrame(right, "right_id int, key string, seen int, what string")
    for tolerance in (None, 3):
        got = asof_join(a, b, ["key"], "at", "seen", "right_id", None if tolerance is None else F.lit(tolerance), exact)
        want = []
        for i, key, at in left:
            fits = [r for r in right if r[1] == key and key is not None and None not in (at, r[2]) and (r[2] <= at if exact else r[2] < at)]
            best = max(fits, key=lambda r: (r[2], r[0]), default=None)
            if best and tolerance is not None and best[2] + tolerance < at:
                best = None
            want.append((i, key, at, *((best[0], best[2], best[3]) if best else (None,) * 3)))
        rows = [(r["left_id"], r["key"], r["at"], r["right_id"], r["seen"], r["what"]) for r in got.collect()]
        assert sorted(map(str, rows)) == sorted(map(str, want))


def test_asof_join_refuses_clashing_names(spark):
    df = spark.range(1).selectExpr("id", "id as at", "id as key")
    with pytest.raises(ValueError):
        asof_join(df, df, ["key"], "at", "at", "id")
