"""Models: better than a guess, structurally right, repeatable."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.queries import model_checks
from millrace.queries.feature_queries import ENGLISH_STOP_WORDS
from millrace.queries.model_queries import dense_ids, transactions
from millrace.registry import QUERIES
from millrace.session import table


def run(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)


def accuracy(df, label="label", prediction="prediction"):
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double"))).first()[0]


def test_text_models_beat_a_coin(spark):
    assert accuracy(run(spark, "/root/testdata/sf0.01", "ml_naive_bayes")) > 0.5


def test_every_document_is_classified(spark):
    """Fitted on the labelled documents, scored on all."""
    sf_dir = "/root/testdata/sf0.01"
    got = run(spark, sf_dir, "ml_text_classification")
    assert got.count() == table(spark, sf_dir, "documents").count()
    assert accuracy(got.join(table(spark, sf_dir, "labels"), "doc_id"), label="quality") > 0.5


def test_als_takes_ids_beyond_32_bits(spark):
    wide = spark.range(3).select((F.col("id") + (1 << 40)).alias("key"), F.lit(1.0).alias("rating"))
    assert sorted(r["user"] for r in dense_ids(wide, "key", "user").collect()) == [1, 2, 3]


@pytest.mark.parametrize("name", ["ml_decision_tree", "ml_random_forest", "ml_gbt"])
def test_tree_models_predict_known_names(spark, sf_dir, name):
    got = run(spark, sf_dir, name)
    known = {r[0] for r in got.select("name").distinct().collect()}
    assert {r[0] for r in got.select("predictedName").distinct().collect()} <= known | {f"c{i}" for i in range(10)}


SPOILT = [*model_checks.CLASSIFIERS, *model_checks.REGRESSORS, "ml_params", "ml_naive_bayes", "ml_text_classification", "ml_als", "ml_kmeans", "ml_pca"]


@pytest.mark.parametrize("name", SPOILT)
def test_properties_fail_on_spoilt_labels(spark, name):
    """The green rows of these models can be red: with labels dealt at random (or a spoilt model) a property fails."""
    row = QUERIES[f"{name}_holds"](spark, "/root/testdata/sf0.01", spoil=True).first()
    assert row["n"] > 0 and not all(row.asDict().values())


@pytest.mark.parametrize("name", ["ml_decision_tree_regressor", "ml_random_forest_regressor", "ml_gbt_regressor"])
def test_regressors_stay_near_the_spread(spark, sf_dir, name):
    row = run(spark, sf_dir, name).first()
    assert row["rmse"] < 1.2 * row["spread"]


def test_isotonic_is_monotone(spark, sf_dir):
    curve = [r["prediction"] for r in run(spark, sf_dir, "ml_isotonic").orderBy("features").collect()]
    assert curve == sorted(curve)


def test_pca_is_orthogonal(spark, sf_dir):
    scores = np.array([[r["pc1"], r["pc2"], r["pc3"]] for r in run(spark, sf_dir, "ml_pca").collect()])
    cov = np.cov(scores.T)
    assert abs(cov[0, 1]) < 1e-8 and abs(cov[0, 2]) < 1e-8 and cov[0, 0] >= cov[1, 1] >= cov[2, 2]


def test_als_error_falls(spark, sf_dir):
    errors = {r["rounds"]: r["rmse"] for r in run(spark, sf_dir, "it_als").collect()}
    assert errors[5] < errors[1]


def test_saved_model_predicts_the_same(spark, sf_dir):
    assert run(spark, sf_dir, "snk_model").filter("not same").count() == 0


def test_random_columns(spark, sf_dir):
    row = run(spark, sf_dir, "src_random").first()
    assert abs(row["mean"]) < 4 / math.sqrt(row["n"]) and abs(row["sd"] - 1) < 0.1


def test_samples_have_their_size(spark, sf_dir):
    lines = run(spark, sf_dir, "smp_bernoulli").count()
    assert 450 < lines < 750
    sizes = {r["how"]: r["count"] for r in run(spark, sf_dir, "smp_fixed_size").groupBy("how").count().collect()}
    assert sizes == {"with": 100, "without": 100}
    for r in run(spark, sf_dir, "smp_stratified").collect():
        assert r["after"] == pytest.approx(r["before"] * {"F": 0.1, "O": 0.2, "P": 0.3}[r["o_orderstatus"]], rel=0.4)


def test_kmeans_and_mixture(spark, sf_dir):
    clusters = run(spark, sf_dir, "ml_kmeans")
    assert clusters.select("prediction").distinct().count() == 4
    weights = {r["prediction"]: r["weight"] for r in run(spark, sf_dir, "ml_gmm").collect()}
    assert sum(weights.values()) <= 1 + 1e-9


def test_stop_word_list_is_sparks(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_params_are_overridden(spark):
    train = spark.createDataFrame(
        [(1.0, Vectors.dense(0.0, 1.1, 0.1)), (0.0, Vectors.dense(2.0, 1.0, -1.0)), (0.0, Vectors.dense(2.0, 1.3, 1.0)), (1.0, Vectors.dense(0.0, 1.2, -0.5))],
        ["label", "features"],
    )
    test = spark.createDataFrame(
        [(1.0, Vectors.dense(-1.0, 1.5, 1.3)), (0.0, Vectors.dense(3.0, 2.0, -0.1)), (1.0, Vectors.dense(0.0, 2.2, -1.5))], ["label", "features"]
    )
    lr = LogisticRegression(maxIter=10, regParam=0.01)
    assert "regParam" in lr.explainParams()
    model = lr.fit(train, {lr.maxIter: 30, lr.regParam: 0.1, lr.probabilityCol: "myProbability"})
    got = model.transform(test).select("label", "prediction", vector_to_array("myProbability").alias("p")).collect()
    assert all(r["label"] == r["prediction"] for r in got)


def test_transactions_of_a_task_are_bounded(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    sizes = transactions(lines, 100).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == lines.count() and max(r["count"] for r in sizes) <= 200
