"""Factor models in blocks against the estimator's own rounds and predictions."""

import math
import random

import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from millrace.ml import factors
from millrace.queries import model_queries
from millrace.registry import QUERIES

PARAMS = dict(rank=10, regParam=0.01, userCol="user", itemCol="item", ratingCol="rating", seed=42)


@pytest.fixture(scope="module")
def known(spark):
    draw = random.Random(3)
    pairs = {(draw.randint(1, 40), draw.randint(1, 25)) for _ in range(300)} | {(7, i) for i in range(1, 26)} | {(u, 3) for u in range(1, 41)}
    rows = [(float(draw.randint(1, 50)), u, i) for u, i in sorted(pairs)]
    return spark.createDataFrame(rows, "rating double, user int, item int").cache()


def test_rounds_are_those_of_the_estimator(spark, known, monkeypatch):
    """Chunks are shorter than the ratings of one user, and the blocks are more than the estimator's."""
    want = []
    for rounds in (1, 2, 3):
        model = ALS(maxIter=rounds, **PARAMS).fit(known)
        want.append(model.transform(known).agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)))).first()[0])
    monkeypatch.setattr(factors, "RATINGS_PER_CHUNK", 9)
    found = factors.errors_by_round(known, 3, rank=10, reg=0.01, seed=42, per_block=25)
    assert found == pytest.approx(want, rel=1e-4)


def test_rounds_are_trained_once(spark, sf_dir, monkeypatch):
    trained, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, *a: trained.append(self.getMaxIter()) or fit(self, *a))
    assert [r["rounds"] for r in QUERIES["it_als"](spark, sf_dir).orderBy("rounds").collect()] == [1, 2, 3, 4, 5]
    assert sum(trained) <= 5


def test_missing_ratings_are_refused(spark, known):
    with pytest.raises(Exception, match="(?i)nan|null"):
        factors.errors_by_round(known.union(spark.createDataFrame([(None, 7, 3)], known.schema)), 1, rank=10, reg=0.01, seed=42)


def test_scores_are_those_of_the_model(spark, known, monkeypatch):
    """Repeated pairs count as often as they come; users and items that the model does not know have no score."""
    model = ALS(maxIter=2, **PARAMS).fit(known)
    asked = known.union(known.limit(20)).union(spark.createDataFrame([(1.0, 7, 99), (2.0, 99, 3), (3.0, 99, 99)], known.schema))
    monkeypatch.setattr(factors, "RATINGS_PER_CHUNK", 9)
    rows = lambda df: sorted((r["rating"], -1e9 if math.isnan(r["prediction"]) else r["prediction"]) for r in df.select("rating", "prediction").collect())
    found, want = rows(factors.scored(asked, model, per_block=25)), rows(model.transform(asked))
    assert len(found) == len(want) and [x for pair in found for x in pair] == pytest.approx([x for pair in want for x in pair], rel=1e-5)


def test_item_blocks_do_not_change_the_model(spark, known):
    a, b = (ALS(maxIter=3, numItemBlocks=n, **PARAMS).fit(known).userFactors.orderBy("id").collect() for n in (10, model_queries.ITEM_BLOCKS))
    assert [x for r in a for x in r["features"]] == pytest.approx([x for r in b for x in r["features"]], rel=1e-3, abs=1e-4)
    assert model_queries.ITEM_BLOCKS < 10


def test_ratings_number_keys_as_before(spark, tmp_path):
    """Null keys take a number and lose their rows; orders without lines, repeated orders and parts of nobody."""
    lines = [(1, 10, 5.0), (1, 10, 7.0), (1, 30, 1.0), (2, 20, 2.0), (3, 40, 3.0), (4, None, 9.0), (5, 10, 4.0), (9, 50, 1.0), (None, 60, 1.0)]
    orders = [(1, 200), (2, 100), (3, None), (4, 50), (5, 200), (5, 200), (6, 10)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    found = model_queries.ratings(spark, str(tmp_path))
    # customers: null, 50, 100, 200; parts: null, 10, 20, 30
    assert sorted((r["user"], r["item"], r["rating"]) for r in found.collect()) == [(3, 3, 2.0), (4, 2, 5.0), (4, 4, 1.0)]
    assert found.dtypes == [("rating", "double"), ("user", "int"), ("item", "int")]


def test_model_is_that_of_the_estimator(spark, known, monkeypatch):
    """Trained in small blocks and chunks; the estimator itself fits no round."""
    want = ALS(maxIter=3, **PARAMS).fit(known)
    fit_rounds, whole = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, *a: fit_rounds.append(self.getMaxIter()) or whole(self, *a))
    monkeypatch.setattr(factors, "RATINGS_PER_CHUNK", 9)
    found = factors.fit(known, 3, rank=10, reg=0.01, seed=42, per_block=25)
    for a, b in ((found.userFactors, want.userFactors), (found.itemFactors, want.itemFactors)):
        a, b = (df.orderBy("id").collect() for df in (a, b))
        assert [r["id"] for r in a] == [r["id"] for r in b]
        assert [x for r in a for x in r["features"]] == pytest.approx([x for r in b for x in r["features"]], rel=1e-3, abs=1e-4)
    assert fit_rounds == [0]


def test_query_trains_in_blocks(spark, sf_dir, monkeypatch):
    fit_rounds, whole = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, *a: fit_rounds.append(self.getMaxIter()) or whole(self, *a))
    assert QUERIES["ml_als_holds"](spark, sf_dir).first() is not None
    assert sum(fit_rounds) == 0
