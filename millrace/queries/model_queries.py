"""Models on the tables: fit on the training part, score all rows or report the test error."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer, Tokenizer, VectorAssembler, VectorIndexer
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    AFTSurvivalRegression,
    DecisionTreeRegressor,
    GBTRegressor,
    IsotonicRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from millrace.ml.factors import LEAST_BLOCKS, fit, scored
from millrace.ml.metrics import (
    binary_curve_areas,
    class_metrics,
    multilabel_summary,
    overall_metrics,
    per_label_metrics,
    regression_metrics,
)
from millrace.operators.sampling import hash_split
from millrace.queries.aggregates import embedding_vectors
from millrace.operators.skew import number_rows
from millrace.registry import query
from millrace.session import cut_lineage, scratch_path, table

# ---------------------------------------------------------------- training data


def embeddings(spark, sf_dir, binary=False):
    rows = embedding_vectors(spark, sf_dir)
    label = (F.col("label") >= 5).cast("double") if binary else F.col("label").cast("double")
    return rows.withColumn("label", label)


def priced_lines(spark, sf_dir):
    """Regression rows: the price of a line from its quantity, discount and tax."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("label"), "l_quantity", "l_discount", "l_tax"
    )
    return VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(lines)


def split(df, keys):
    return hash_split(df, keys, [0.7, 0.3])


def one_row(spark, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


# ---------------------------------------------------------------- regression


@query(
    "ml_linear_regression",
    """select round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept
       from lineitem""",
)
def ml_linear_regression(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("label"), "l_quantity")
    points = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(lines)
    model = LinearRegression(regParam=0.0, solver="normal").fit(points)
    return one_row(spark, slope=round(float(model.coefficients[0]), 4), intercept=round(float(model.intercept), 3))


@query("ml_linear_regression_elastic_net")
def ml_linear_regression_elastic_net(spark, sf_dir):
    train, test = split(priced_lines(spark, sf_dir), ["l_orderkey"])
    model = LinearRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8).fit(train)
    return regression_metrics(model.transform(test))


def regressor_report(spark, sf_dir, regressor):
    rows = priced_lines(spark, sf_dir)
    indexer = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=4).fit(rows)
    train, test = split(indexer.transform(rows), ["l_orderkey"])
    predicted = regressor.setFeaturesCol("indexed").fit(train).transform(test)
    rmse = RegressionEvaluator(metricName="rmse").evaluate(predicted)
    plain = test.agg(F.stddev_pop("label").alias("spread"))
    return plain.select(F.lit(rmse).alias("rmse"), "spread")


def classifier_report(spark, sf_dir, classifier, binary=False):
    """Labels are indexed, the model predicts, predictions go back to the original labels."""
    rows = embeddings(spark, sf_dir, binary).withColumn("name", F.concat(F.lit("c"), F.col("label").cast("int").cast("string")))
    labels = StringIndexer(inputCol="name", outputCol="indexedLabel").fit(rows)
    features = VectorIndexer(inputCol="features", outputCol="indexedFeatures", maxCategories=4).fit(rows)
    back = IndexToString(inputCol="prediction", outputCol="predictedName", labels=labels.labels)
    classifier = classifier.setLabelCol("indexedLabel").setFeaturesCol("indexedFeatures")
    train, test = split(rows, ["vec_id"])
    model = Pipeline(stages=[labels, features, classifier, back]).fit(train)
    return model.transform(test).select("vec_id", "name", "predictedName")


@query("ml_decision_tree")
def ml_decision_tree(spark, sf_dir):
    return classifier_report(spark, sf_dir, DecisionTreeClassifier(impurity="gini", maxDepth=5, maxBins=32))


@query("ml_decision_tree_regressor")
def ml_decision_tree_regressor(spark, sf_dir):
    return regressor_report(spark, sf_dir, DecisionTreeRegressor(impurity="variance", maxDepth=5, maxBins=32))


@query("ml_random_forest")
def ml_random_forest(spark, sf_dir):
    return classifier_report(spark, sf_dir, RandomForestClassifier(numTrees=3, maxDepth=4, seed=42))


@query("ml_random_forest_regressor")
def ml_random_forest_regressor(spark, sf_dir):
    return regressor_report(spark, sf_dir, RandomForestRegressor(numTrees=3, maxDepth=4, seed=42))


@query("ml_gbt")
def ml_gbt(spark, sf_dir):
    return classifier_report(spark, sf_dir, GBTClassifier(maxIter=10, seed=42), binary=True)


@query("ml_gbt_regressor")
def ml_gbt_regressor(spark, sf_dir):
    return regressor_report(spark, sf_dir, GBTRegressor(maxIter=10, seed=42))


@query("ml_aft_survival")
def ml_aft_survival(spark, sf_dir):
    # days between order and shipping, the first day counted; lines of open orders are censored
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = (F.abs(F.datediff("l_shipdate", "o_orderdate")) + 1).cast("double")
    rows = lines.select(
        days.alias("label"), (F.col("l_linestatus") == "F").cast("double").alias("censor"), "l_quantity", "l_discount"
    )
    points = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features").transform(rows)
    model = AFTSurvivalRegression(quantileProbabilities=[0.3, 0.6], quantilesCol="quantiles").fit(points)
    q = vector_to_array("quantiles")
    return model.transform(points).agg(
        F.avg("prediction").alias("mean_prediction"), F.avg(q[0]).alias("q30"), F.avg(q[1]).alias("q60"), F.count(F.lit(1)).alias("n")
    )


@query(
    "ml_isotonic",
    """with l as (select l_quantity as x, l_extendedprice as y,
                 ('0x' || substr(md5(l_orderkey::varchar), 1, 8))::bigint / 4294967296.0::double < 0.7::double as train from lineitem),
        p as (select x, avg(y) as m, count(*) as w from l where train group by x),
        means as (select a.x as lo, b.x as hi, sum(c.m * c.w) / sum(c.w) as mean
                  from p a join p b on a.x <= b.x join p c on c.x between a.x and b.x group by 1, 2),
        least_from as (select lo, i.x, min(mean) as low from means join p i on i.x between lo and hi group by 1, 2),
        fitted as (select x, max(low) as prediction from least_from group by x)
        select x as features, round(prediction, 4) as prediction, round(avg((y - prediction) * (y - prediction)), 0) as mse
        from fitted join l using (x) where not train group by x, prediction""",
)
def ml_isotonic(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").alias("label"), F.col("l_quantity").alias("features")
    )
    train, test = split(points, ["l_orderkey"])
    # equal quantities are one weighted point: fifty rows reach the fit, whatever the table's size
    pooled = train.groupBy("features").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    model = IsotonicRegression(weightCol="weight").fit(pooled)
    curve = model.transform(test)
    return curve.groupBy("features").agg(
        F.round(F.max("prediction"), 4).alias("prediction"), F.round(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)), 0).alias("mse")
    )


# ---------------------------------------------------------------- classification


@query("ml_logistic_regression")
def ml_logistic_regression(spark, sf_dir):
    train, test = split(embeddings(spark, sf_dir), ["vec_id"])
    model = LogisticRegression(maxIter=20, regParam=0.01, elasticNetParam=0.8).fit(train)
    return model.transform(test).select("vec_id", "label", "prediction")


@query("ml_params")
def ml_params(spark, sf_dir):
    # parameters set on the estimator are overridden at fit; the probability column is renamed
    train, test = split(embeddings(spark, sf_dir, binary=True), ["vec_id"])
    lr = LogisticRegression(maxIter=10, regParam=0.01)
    override = {lr.maxIter: 30, lr.regParam: 0.1, lr.thresholds: [0.45, 0.55], lr.probabilityCol: "myProbability"}
    model = lr.fit(train, override)
    p = vector_to_array("myProbability")
    return model.transform(test).select("vec_id", "label", F.round(p[1], 6).alias("p"), "prediction")


def labelled_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return documents.join(labels, "doc_id")


def text_stages(features=1000):
    tokens = Tokenizer(inputCol="text", outputCol="words")
    hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=features)
    return tokens, hashed, LogisticRegression(maxIter=10, regParam=0.001)


@query("ml_text_classification")
def ml_text_classification(spark, sf_dir):
    # fitted on the labelled documents, scored on all
    model = Pipeline(stages=list(text_stages())).fit(labelled_documents(spark, sf_dir))
    return model.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "prediction")


@query("ml_cross_validation")
def ml_cross_validation(spark, sf_dir):
    rows = cut_lineage(labelled_documents(spark, sf_dir))
    tokens, hashed, lr = text_stages()
    grid = ParamGridBuilder().addGrid(hashed.numFeatures, [10, 100, 1000]).addGrid(lr.regParam, [0.1, 0.01]).build()
    chosen = CrossValidator(
        estimator=Pipeline(stages=[tokens, hashed, lr]),
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC"),
        numFolds=2,
        seed=42,
        parallelism=2,
    ).fit(rows)
    scores = [(int(g[hashed.numFeatures]), float(g[lr.regParam]), float(m)) for g, m in zip(grid, chosen.avgMetrics)]
    return spark.createDataFrame(scores, "features int, reg double, area double")


@query("ml_perceptron")
def ml_perceptron(spark, sf_dir):
    train, test = split(embeddings(spark, sf_dir), ["vec_id"])
    net = MultilayerPerceptronClassifier(maxIter=100, layers=[64, 16, 12, 10], blockSize=128, seed=1234)
    return net.fit(train).transform(test).select("vec_id", "label", "prediction")


@query("ml_naive_bayes")
def ml_naive_bayes(spark, sf_dir):
    tokens, hashed, _ = text_stages()
    train, test = split(labelled_documents(spark, sf_dir), ["doc_id"])
    model = Pipeline(stages=[tokens, hashed, NaiveBayes(smoothing=1.0)]).fit(train)
    return model.transform(test).select("doc_id", "label", "prediction")


# ---------------------------------------------------------------- clustering, recommendation, item sets


@query("ml_kmeans")
def ml_kmeans(spark, sf_dir):
    points = embedding_vectors(spark, sf_dir)
    model = KMeans(k=4, seed=42, maxIter=20).fit(points)
    cost = float(model.summary.trainingCost)
    return model.transform(points).select("vec_id", "prediction", F.lit(cost).alias("cost"))


@query("ml_kmeans_centres")
def ml_kmeans_centres(spark, sf_dir):
    # k rows
    model = KMeans(k=4, seed=42, maxIter=20).fit(embedding_vectors(spark, sf_dir))
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")


def mixture(points):
    return GaussianMixture(k=2, tol=0.001, maxIter=100, seed=42).fit(points)


@query("ml_gmm_components")
def ml_gmm_components(spark, sf_dir):
    # weight, mu and sigma (by columns) of each of the k components
    model = mixture(embedding_vectors(spark, sf_dir))
    rows = [
        (i, float(w), [float(x) for x in g.mean], [float(x) for x in g.cov.toArray().flatten(order="F")])
        for i, (w, g) in enumerate(zip(model.weights, model.gaussiansDF.collect()))
    ]
    return spark.createDataFrame(rows, "component int, weight double, mu array<double>, sigma array<double>")


@query("ml_gmm")
def ml_gmm(spark, sf_dir):
    points = embedding_vectors(spark, sf_dir)
    model = mixture(points)
    weights = F.array(*[F.lit(float(w)) for w in model.weights])
    return model.transform(points).select("vec_id", "prediction", F.element_at(weights, F.col("prediction") + 1).alias("weight"))


def key_numbers(df, column, name):
    """(column, name): the distinct keys numbered from 1, as the estimator takes 32-bit ids only."""
    return number_rows(df.select(column).distinct(), [F.col(column)], name).withColumn(name, F.col(name).cast("int"))


def dense_ids(df, column, name):
    """``column`` replaced by ``name``, numbered from 1."""
    return df.join(key_numbers(df, column, name), column).drop(column)


def ratings(spark, sf_dir):
    """(rating, user, item): the mean quantity of a part that a customer bought, both numbered."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # customers are numbered on the orders, four times fewer than lines; the lines pass the join with their order, and the one that also groups them by part
    sold = orders.join(lines.select("l_orderkey").distinct(), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    buyers = orders.join(key_numbers(sold, "o_custkey", "user"), "o_custkey")
    bought = cut_lineage(lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select("user", "l_partkey", "l_quantity"))
    numbered = bought.join(key_numbers(bought, "l_partkey", "item"), "l_partkey")
    return numbered.groupBy("user", "l_partkey", "item").agg(F.avg("l_quantity").alias("rating")).select("rating", "user", "item")


#: Blocks of items at least: each gets a copy of the factors of nearly every user in every round.
ITEM_BLOCKS = LEAST_BLOCKS


def factor_model(known):
    return fit(known, 10, rank=10, reg=0.01, seed=42)


@query("ml_als")
def ml_als(spark, sf_dir):
    known = cut_lineage(ratings(spark, sf_dir))
    return regression_metrics(scored(known, factor_model(known)), "rating")


#: Transactions of one task of the frequent item sets, about 200 bytes each while they are kept.
TRANSACTIONS_PER_TASK = 500_000


def transactions(lines, per_task=TRANSACTIONS_PER_TASK):
    def tag(name, value):
        return F.concat(F.lit(f"{name}="), value.cast("string"))

    # a transaction is one row's own attributes, so no group is collected; the fit keeps the transactions of a task as objects, hence parts of bounded length
    parts = max(lines.sparkSession.sparkContext.defaultParallelism, -(-lines.count() // per_task))
    taken = lines.select("l_returnflag", "l_linestatus", *[(F.col(c) > least).alias(c) for c, least in (("l_tax", 0), ("l_discount", 0), ("l_quantity", 25))])
    return taken.repartition(parts).select(
        F.array(
            tag("flag", F.col("l_returnflag")),
            tag("status", F.col("l_linestatus")),
            tag("taxed", F.col("l_tax")),
            tag("cut", F.col("l_discount")),
            tag("big", F.col("l_quantity")),
        ).alias("items")
    )


ITEM_SQL = """items as (
  select id, unnest(['flag=' || l_returnflag, 'status=' || l_linestatus, 'taxed=' || (l_tax > 0), 'cut=' || (l_discount > 0),
                     'big=' || (l_quantity > 25)]) as item
  from (select *, row_number() over () as id from lineitem))"""


@query(
    "ml_fpgrowth",
    f"""with {ITEM_SQL}, r as (select id, list(item order by item) as items from items group by id),
        subsets as (select array_to_string(list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1), '|') as items, bit_count(mask)::integer as size
                    from r, (select unnest(range(1, 32)) as mask))
        select items, size, count(*) as freq from subsets group by 1, 2 having count(*) >= (select count(*) * 0.2 from lineitem)""",
)
def ml_fpgrowth(spark, sf_dir):
    found = FPGrowth(minSupport=0.2, minConfidence=0.5, itemsCol="items").fit(transactions(table(spark, sf_dir, "lineitem"))).freqItemsets
    return found.select(F.array_join(F.array_sort("items"), "|").alias("items"), F.size("items").alias("size"), "freq")


@query(
    "snk_model",
    """select vec_id, true as same from embeddings
       where not ('0x' || substr(md5(vec_id::varchar), 1, 8))::bigint / 4294967296.0::double < 0.7::double""",
)
def snk_model(spark, sf_dir):
    train, test = split(embeddings(spark, sf_dir), ["vec_id"])
    fitted = Pipeline(stages=[DecisionTreeClassifier(maxDepth=4)]).fit(train)
    path = scratch_path(spark, "model")
    fitted.write().save(path)
    before = fitted.transform(test).select("vec_id", F.col("prediction").alias("before"))
    after = PipelineModel.load(path).transform(test).select("vec_id", F.col("prediction").alias("after"))
    return before.join(after, "vec_id").select("vec_id", (F.col("before") == F.col("after")).alias("same"))


# ---------------------------------------------------------------- quality measures


@query(
    "ml_metrics_binary",
    """with p as (select l_extendedprice as s, sum(case when l_returnflag = 'R' then 1 else 0 end) as pos,
                        sum(case when l_returnflag = 'R' then 0 else 1 end) as neg from lineitem group by 1),
       c as (select *, sum(pos) over w as tp, sum(neg) over w as fp from p window w as (order by s desc)),
       t as (select sum(pos) as ap, sum(neg) as an from p),
       d as (select c.*, t.*, tp - pos as tp0, fp - neg as fp0 from c, t)
       select round(sum(neg * (tp0 + tp) / 2.0::double) / (max(ap)::double * max(an)), 6) as area_roc,
              round(sum(pos / ap::double * (case when tp0 + fp0 = 0 then tp / (tp + fp)::double else tp0 / (tp0 + fp0)::double end
                        + tp / (tp + fp)::double) / 2), 6) as area_pr from d""",
)
def ml_metrics_binary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    areas = binary_curve_areas(rows, "l_extendedprice", "label")
    return areas.select(F.round("area_roc", 6).alias("area_roc"), F.round("area_pr", 6).alias("area_pr"))


def flags(spark, sf_dir):
    """The return flag, three classes, against a rule on quantity and tax."""
    lines = table(spark, sf_dir, "lineitem")
    guess = F.when(F.col("l_quantity") < 15, "A").when(F.col("l_tax") < 0.04, "N").otherwise("R")
    return lines.select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


CLASS_SQL = """
g as (select l_returnflag as y, case when l_quantity < 15 then 'A' when l_tax < 0.04 then 'N' else 'R' end as p from lineitem),
c as (select k as class, count(*) filter (where y = k) as actual, count(*) filter (where p = k) as predicted,
             count(*) filter (where y = k and p = k) as hit, count(*) as total
      from g, (values ('A'), ('N'), ('R')) v(k) group by k),
m as (select *, coalesce(hit / nullif(predicted, 0)::double, 0) as precision, coalesce(hit / nullif(actual, 0)::double, 0) as recall,
             (predicted - hit) / (total - actual)::double as fpr from c),
f as (select *, 2 * precision * recall / (precision + recall) as f1, 1.25::double * precision * recall / (0.25::double * precision + recall) as f05 from m)
"""


@query(
    "ml_metrics_multiclass",
    f"""with {CLASS_SQL} select class, actual, predicted, hit, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1,
        round(f05, 9) as f05, round(fpr, 9) as fpr from f""",
)
def ml_metrics_multiclass(spark, sf_dir):
    rows = class_metrics(flags(spark, sf_dir))
    return rows.select("class", "actual", "predicted", "hit", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "f05", "fpr")])


@query(
    "ml_metrics_multiclass_overall",
    f"""with {CLASS_SQL} select round(sum(hit) / sum(actual)::double, 9) as accuracy,
        round(sum(precision * actual) / sum(actual), 9) as weighted_precision, round(sum(recall * actual) / sum(actual), 9) as weighted_recall,
        round(sum(f1 * actual) / sum(actual), 9) as weighted_f1, round(sum(f05 * actual) / sum(actual), 9) as weighted_f05,
        round(sum(fpr * actual) / sum(actual), 9) as weighted_fpr from f""",
)
def ml_metrics_multiclass_overall(spark, sf_dir):
    rows = overall_metrics(class_metrics(flags(spark, sf_dir)))
    return rows.select(*[F.round(c, 9).alias(c) for c in rows.columns])


def label_sets(spark, sf_dir):
    """Two sets of labels per line, from its own columns; the first may be empty."""
    lines = table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber").cast("double")
    predicted = F.array_distinct(F.filter(F.array(number, F.floor(F.col("l_tax") * 100).cast("double")), lambda x: x > 2))
    actual = F.array_distinct(F.array(number, F.floor(F.col("l_quantity") / 10).cast("double")))
    return lines.select(predicted.alias("predictions"), actual.alias("labels"))


LABEL_SQL = """
s as (select list_distinct(list_filter([l_linenumber::double, floor(l_tax * 100)::double], lambda x: x > 2)) as p,
             list_distinct([l_linenumber::double, floor(l_quantity / 10)::double]) as y from lineitem),
z as (select p, y, len(p)::double as np, len(y)::double as ny, len(list_intersect(p, y))::double as b from s)
"""


@query(
    "ml_metrics_multilabel",
    f"""with {LABEL_SQL} select round(avg(b / ny), 9) as recall, round(avg(case when np = 0 then 0 else b / np end), 9) as precision,
        round(avg(2 * b / (np + ny)), 9) as f1, round(avg(b / (np + ny - b)), 9) as accuracy,
        round(avg(case when b = np and b = ny then 1.0::double else 0.0::double end), 9) as subset_accuracy,
        round(sum(b) / sum(np), 9) as micro_precision, round(sum(b) / sum(ny), 9) as micro_recall,
        round(2 * sum(b) / (sum(np) + sum(ny)), 9) as micro_f1,
        round(sum(np + ny - 2 * b) / (count(*) * (select count(distinct l) from (select unnest(y) as l from z))), 9) as hamming_loss from z""",
)
def ml_metrics_multilabel(spark, sf_dir):
    row = multilabel_summary(label_sets(spark, sf_dir))
    return row.select(*[F.round(c, 9).alias(c) for c in row.columns])


@query(
    "ml_metrics_multilabel_by_label",
    f"""with {LABEL_SQL},
        l as (select l, sum(h)::double as h, sum(a)::double as a, sum(p)::double as p from (
          select unnest(list_intersect(p, y)) as l, 1 as h, 0 as a, 0 as p from z
          union all select unnest(y), 0, 1, 0 from z union all select unnest(p), 0, 0, 1 from z) group by l)
        select l as label, round(case when p = 0 then 0 else h / p end, 9) as precision, round(case when a = 0 then 0 else h / a end, 9) as recall,
               round(case when h = 0 then 0 else 2 * h / (p + a) end, 9) as f1 from l""",
)
def ml_metrics_multilabel_by_label(spark, sf_dir):
    rows = per_label_metrics(label_sets(spark, sf_dir))
    return rows.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "ml_metrics_regression",
    """with p as (select l_extendedprice as y, 2000 * l_quantity + 500 as p from lineitem)
       select round(avg((y - p) * (y - p)), 2) as mse, round(sqrt(avg((y - p) * (y - p))), 4) as rmse,
              round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) as r2, round(avg(abs(y - p)), 4) as mae,
              round(avg((p - (select avg(y) from p)) * (p - (select avg(y) from p))), 1) as explained_variance from p""",
)
def ml_metrics_regression(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000 + 500).alias("prediction")
    )
    digits = {"mse": 2, "rmse": 4, "r2": 6, "mae": 4, "explained_variance": 1}
    return regression_metrics(rows).select(*[F.round(c, n).alias(c) for c, n in digits.items()])
