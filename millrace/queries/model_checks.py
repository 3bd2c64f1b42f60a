"""What must hold of a fitted model, as a row that SQL can state: how many rows were scored, and properties that are true.

Labels here follow from the features, so that a model has something to learn; with ``spoil`` they are dealt at random and the properties fail.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import PCA, VectorAssembler, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml.factors import scored
from millrace.queries.aggregates import embedding_vectors
from millrace.queries.feature_queries import tokenized
from millrace.queries.model_queries import factor_model, labelled_documents, ml_aft_survival, ml_cross_validation, ratings, split, text_stages
from millrace.registry import QUERIES, query
from millrace.session import cut_lineage, table

#: A model must be right this much more often than the most frequent label, and its squared error this share of the mean's or less.
BETTER, SHARE = 0.05, 0.8


def _held_out(key: str) -> str:
    return f"('0x' || substr(md5({key}::varchar), 1, 8))::bigint / 4294967296.0::double >= 0.7::double"


VECTORS_SQL = f"select count(*) as n, true as better from embeddings where {_held_out('vec_id')}"
LINES_SQL = f"select count(*) as n, true as better from lineitem where {_held_out('l_orderkey')}"
LABELLED_SQL = f"select count(*) as n, true as better from labels join documents using (doc_id) where {_held_out('doc_id')}"


def noise(key: str, classes: int):
    return F.pmod(F.xxhash64(F.lit("spoilt"), F.col(key)), F.lit(classes)).cast("double")


def quadrants(spark, sf_dir, classes=4, spoil=False):
    """Vectors, labelled by the signs of their first two numbers (of the first one for two classes)."""
    rows = embedding_vectors(spark, sf_dir)
    sign = [(F.element_at(vector_to_array("features"), i) > 0).cast("double") for i in (1, 2)]
    label = noise("vec_id", classes) if spoil else sign[0] if classes == 2 else 2 * sign[0] + sign[1]
    return rows.withColumn("label", label).select("vec_id", "features", "label")


def charges(spark, sf_dir, spoil=False):
    """Lines with what is charged for them, by quantity, discount and tax."""
    lines = table(spark, sf_dir, "lineitem")
    charge = F.col("l_quantity") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    label = F.pmod(F.xxhash64(F.lit("spoilt"), "l_orderkey", "l_linenumber"), F.lit(50)).cast("double") if spoil else charge
    rows = lines.select("l_orderkey", "l_quantity", "l_discount", "l_tax", label.alias("label"))
    return VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(rows)


def classified(scored: DataFrame) -> DataFrame:
    """(n, better) of rows with label and prediction."""
    counts = scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == F.col("prediction")).cast("int")).alias("hits"))
    return counts.agg(F.sum("n").alias("n"), (F.sum("hits") / F.sum("n") > F.max("n") / F.sum("n") + BETTER).alias("better"))


def regressed(scored: DataFrame) -> DataFrame:
    error = F.avg(F.pow(F.col("label") - F.col("prediction"), 2))
    return scored.agg(F.count(F.lit(1)).alias("n"), (error <= SHARE * F.var_pop("label")).alias("better"))


def classifier(spark, sf_dir, estimator, classes=4, spoil=False):
    train, test = split(quadrants(spark, sf_dir, classes, spoil), ["vec_id"])
    return classified(estimator.fit(train).transform(test))


def regressor(spark, sf_dir, estimator, spoil=False):
    train, test = split(charges(spark, sf_dir, spoil), ["l_orderkey"])
    return regressed(estimator.fit(train).transform(test))


CLASSIFIERS = {
    "ml_decision_tree": lambda: (DecisionTreeClassifier(impurity="gini", maxDepth=5, maxBins=32), 4),
    "ml_random_forest": lambda: (RandomForestClassifier(numTrees=20, maxDepth=6, seed=42), 4),
    "ml_gbt": lambda: (GBTClassifier(maxIter=10, seed=42), 2),
    "ml_logistic_regression": lambda: (LogisticRegression(maxIter=50, regParam=0.01, elasticNetParam=0.8), 4),
    "ml_perceptron": lambda: (MultilayerPerceptronClassifier(maxIter=100, layers=[64, 8, 4], seed=1234), 4),
}
REGRESSORS = {
    "ml_decision_tree_regressor": lambda: DecisionTreeRegressor(impurity="variance", maxDepth=5, maxBins=32),
    "ml_random_forest_regressor": lambda: RandomForestRegressor(numTrees=3, maxDepth=4, seed=42, featureSubsetStrategy="all"),
    "ml_gbt_regressor": lambda: GBTRegressor(maxIter=10, seed=42),
    "ml_linear_regression_elastic_net": lambda: LinearRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8),
}


def _register_classifier(name):
    @query(f"{name}_holds", VECTORS_SQL)
    def run(spark, sf_dir, spoil=False):
        estimator, classes = CLASSIFIERS[name]()
        return classifier(spark, sf_dir, estimator, classes, spoil)


def _register_regressor(name):
    @query(f"{name}_holds", LINES_SQL)
    def run(spark, sf_dir, spoil=False):
        return regressor(spark, sf_dir, REGRESSORS[name](), spoil)


for _name in CLASSIFIERS:
    _register_classifier(_name)
for _name in REGRESSORS:
    _register_regressor(_name)


@query("ml_params_holds", f"select count(*) as n, true as better, true as by_thresholds from embeddings where {_held_out('vec_id')}")
def ml_params_holds(spark, sf_dir, spoil=False):
    # what is given at fit overrides the estimator: thresholds that lean to class 0, and the name of the probabilities
    train, test = split(quadrants(spark, sf_dir, 2, spoil), ["vec_id"])
    lr = LogisticRegression(maxIter=1, regParam=100.0)
    model = lr.fit(train, {lr.maxIter: 30, lr.regParam: 0.1, lr.thresholds: [0.3, 0.7], lr.probabilityCol: "myProbability"})
    scored = model.transform(test).withColumn("p", vector_to_array("myProbability"))
    rule = (F.col("p")[1] / 0.7 > F.col("p")[0] / 0.3).cast("double") == F.col("prediction")
    own = lambda label: F.avg(F.when(F.col("label") == label, F.col("p")[1]))
    better = own(1.0) - own(0.0) > 0.4 * F.stddev_pop(F.col("p")[1])
    return scored.agg(F.count(F.lit(1)).alias("n"), better.alias("better"), F.every(rule).alias("by_thresholds"))


def documents_model(spark, sf_dir, last, spoil=False):
    tokens, hashed, _ = text_stages()
    rows = labelled_documents(spark, sf_dir)
    train, test = split(rows.withColumn("label", noise("doc_id", 2)) if spoil else rows, ["doc_id"])
    return Pipeline(stages=[tokens, hashed, last]).fit(train), test


def ranked_well(scored: DataFrame, score) -> DataFrame:
    """(n, better): documents of label 1 have a higher mean score than those of label 0, by a margin of their spread."""
    own = lambda label: F.avg(F.when(F.col("label") == label, score))
    return scored.agg(F.count(F.lit(1)).alias("n"), (own(1.0) - own(0.0) > 0.4 * F.stddev_pop(score)).alias("better"))


@query("ml_naive_bayes_holds", LABELLED_SQL)
def ml_naive_bayes_holds(spark, sf_dir, spoil=False):
    model, test = documents_model(spark, sf_dir, NaiveBayes(smoothing=1.0), spoil)
    return ranked_well(model.transform(test), vector_to_array("probability")[1])


@query("ml_text_classification_holds", LABELLED_SQL)
def ml_text_classification_holds(spark, sf_dir, spoil=False):
    model, test = documents_model(spark, sf_dir, LogisticRegression(maxIter=10, regParam=0.001), spoil)
    return ranked_well(model.transform(test), vector_to_array("probability")[1])


@query("ml_cross_validation_holds", "select 6::bigint as n, true as better")
def ml_cross_validation_holds(spark, sf_dir):
    return ml_cross_validation(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), (F.max("area") > 0.6).alias("better"))


@query("ml_aft_survival_holds", "select count(*) as n, true as in_order from lineitem join orders on l_orderkey = o_orderkey")
def ml_aft_survival_holds(spark, sf_dir):
    found = ml_aft_survival(spark, sf_dir)
    return found.select("n", ((F.col("q30") < F.col("q60")) & (F.col("q30") > 0) & (F.col("q30") < F.col("mean_prediction"))).alias("in_order"))


RATINGS_SQL = "select count(*) as n, true as better from (select distinct o_custkey, l_partkey from lineitem join orders on l_orderkey = o_orderkey)"


@query("ml_als_holds", RATINGS_SQL)
def ml_als_holds(spark, sf_dir, spoil=False):
    known = cut_lineage(ratings(spark, sf_dir))
    asked = known.withColumn("rating", F.pmod(F.xxhash64("user", "item"), F.lit(50)).cast("double")) if spoil else known
    return regressed(scored(asked, factor_model(known)).withColumnRenamed("rating", "label"))


@query("it_als_holds", "select 5::bigint as n, true as falls")
def it_als_holds(spark, sf_dir):
    errors = QUERIES["it_als"](spark, sf_dir)
    both = errors.alias("a").join(errors.alias("b"), F.col("a.rounds") + 1 == F.col("b.rounds"), "left")
    falls = F.every(F.coalesce(F.col("b.rmse") < F.col("a.rmse"), F.lit(True))).alias("falls")
    return both.agg(F.count(F.lit(1)).alias("n"), falls)


@query("ml_kmeans_holds", "select count(*) as n, true as nearest, true as cost_adds_up, true as better from embeddings")
def ml_kmeans_holds(spark, sf_dir, spoil=False):
    points = embedding_vectors(spark, sf_dir)
    model = KMeans(k=4, seed=42, maxIter=20).fit(points)
    values = vector_to_array("features")
    square = lambda c: F.aggregate(F.zip_with(values, F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x)
    # a spoilt model has its last centre at the first one's place
    centres = model.clusterCenters()[:3] + [model.clusterCenters()[0]] if spoil else model.clusterCenters()
    distances = F.array(*[square(c) for c in centres])
    own = F.element_at("d", F.col("prediction") + 1)
    scored = model.transform(points).withColumn("d", distances)
    spread = points.select(values.alias("v")).select(F.posexplode("v")).groupBy("pos").agg((F.var_pop("col") * F.count(F.lit(1))).alias("s")).agg(F.sum("s")).first()[0]
    sums = scored.agg(F.count(F.lit(1)).alias("n"), F.every(own <= F.array_min("d") + 1e-6).alias("nearest"), F.sum(own).alias("cost"))
    cost = float(model.summary.trainingCost)
    return sums.select("n", "nearest", (F.abs(F.col("cost") - cost) < 1e-4 * cost).alias("cost_adds_up"), (F.col("cost") < spread).alias("better"))


@query("ml_gmm_holds", "select count(*) as n, true as weights_add_up, true as likeliest from embeddings")
def ml_gmm_holds(spark, sf_dir):
    points = embedding_vectors(spark, sf_dir)
    model = GaussianMixture(k=2, tol=0.001, maxIter=100, seed=42).fit(points)
    p = vector_to_array("probability")
    scored = model.transform(points).withColumn("p", p)
    one = F.abs(F.aggregate("p", F.lit(0.0), lambda t, x: t + x) - 1) < 1e-6
    likeliest = F.element_at("p", F.col("prediction") + 1) >= F.array_max("p") - 1e-12
    return scored.agg(F.count(F.lit(1)).alias("n"), F.lit(abs(sum(model.weights) - 1) < 1e-9).alias("weights_add_up"), F.every(one & likeliest).alias("likeliest"))


@query("ml_pca_holds", "select count(*) as n, true as uncorrelated, true as descending from embeddings")
def ml_pca_holds(spark, sf_dir, spoil=False):
    points = embedding_vectors(spark, sf_dir)
    p = vector_to_array("pca")
    scores = PCA(k=3, inputCol="features", outputCol="pca").fit(points).transform(points).select(*[p[i].alias(f"p{i}") for i in range(3)])
    if spoil:
        scores = scores.withColumn("p1", F.col("p1") + F.col("p0"))
    flat = [F.abs(F.corr(f"p{i}", f"p{j}")) < 1e-6 for i, j in ((0, 1), (0, 2), (1, 2))]
    down = (F.var_pop("p0") >= F.var_pop("p1")) & (F.var_pop("p1") >= F.var_pop("p2"))
    return scores.agg(F.count(F.lit(1)).alias("n"), (flat[0] & flat[1] & flat[2]).alias("uncorrelated"), down.alias("descending"))


@query("ml_word2vec_holds", "select count(*) as n, true as means_of_words from documents")
def ml_word2vec_holds(spark, sf_dir):
    # a document's vector is the mean of its words' vectors
    words = tokenized(spark, sf_dir)
    model = Word2Vec(vectorSize=3, minCount=0, seed=42, maxIter=1, numPartitions=4, inputCol="tokens", outputCol="v").fit(words)
    vectors = model.getVectors().select("word", vector_to_array("vector").alias("w"))
    each = words.select("doc_id", F.explode("tokens").alias("word")).join(vectors, "word")
    means = each.groupBy("doc_id").agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(3)])
    own = vector_to_array("v")
    met = model.transform(words).select("doc_id", own.alias("v")).join(means, "doc_id", "left")
    near = [F.abs(F.col("v")[i] - F.coalesce(F.col(f"m{i}"), F.lit(0.0))) < 1e-5 for i in range(3)]
    return met.agg(F.count(F.lit(1)).alias("n"), F.every(near[0] & near[1] & near[2]).alias("means_of_words"))


@query(
    "ml_tf_idf_hashed_holds",
    "select count(*) as n, true as not_negative, true as some_weight from documents",
)
def ml_tf_idf_hashed_holds(spark, sf_dir):
    weights = QUERIES["ml_tf_idf_hashed"](spark, sf_dir)
    columns = [F.col(c) for c in weights.columns if c != "doc_id"]
    total = sum(columns[1:], columns[0])
    return weights.agg(F.count(F.lit(1)).alias("n"), F.every(F.least(*columns) >= 0).alias("not_negative"), F.some(total > 0).alias("some_weight"))
