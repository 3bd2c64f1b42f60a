"""Term weights: frequent words by broadcast, the rest by join, against a plain count."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import millrace.queries  # noqa: F401  (fills the registry)
from millrace.ml.text import frequent_from, tf_idf
from millrace.registry import QUERIES

TEXTS = [(1, "a b a c"), (2, "a b d"), (2, "a d d e"), (3, "a f"), (None, "a g"), (None, "g h"), (4, ""), (5, None)]


def plain(tokens):
    tf = Counter(tokens)
    df = Counter(w for _, w in tf)
    return {(d, w): (n, n * math.log(10 / (df[w] + 1))) for (d, w), n in tf.items()}


@pytest.mark.parametrize("most", [0, 1, 3, 1000])
def test_weights_are_those_of_a_plain_count(spark, most):
    tokens = [(d, w) for d, text in TEXTS if text for w in text.split()]
    found = tf_idf(spark.createDataFrame(tokens, "doc_id long, word string"), 9, most=most).collect()
    want = plain(tokens)
    assert len(found) == len(want)
    assert {(r["doc_id"], r["word"]): (r["tf"], pytest.approx(r["weight"])) for r in found} == want


def test_frequent_words_are_bounded(spark):
    sizes = spark.createDataFrame([(x,) for x in [1] * 50 + [2] * 20 + [3] * 10 + [8] * 5 + [900]], "df long")
    for most, least in ((100, 1), (40, 2), (6, 8), (5, 512), (1, 512), (0, 1024)):
        assert frequent_from(sizes, most=most) == least
        assert sizes.filter(F.col("df") >= least).count() <= most
    assert frequent_from(sizes.limit(0)) == 1


def test_frequent_words_meet_their_frequency_by_broadcast(spark, tmp_path):
    """With no small-table broadcasts by Spark itself, the words that most rows have still meet their frequency where they are."""
    rows = [(i, " ".join(["the", "of", f"w{i % 7}", f"own{i}"])) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = QUERIES["ml_tf_idf"](spark, str(tmp_path))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "BroadcastHashJoin" in plan
        assert found.filter("terms = 4").count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
