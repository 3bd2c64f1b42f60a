"""The plans that matter at scale."""

import hashlib

import pytest
from pyspark.sql import functions as F

import millrace.queries  # noqa: F401
from millrace.ingest.run import pull
from millrace.queries.ingest_queries import ORDERS
from millrace.registry import QUERIES
from millrace.session import table

ROW_PYTHON = ("BatchEvalPython", "FlatMapGroups")
RELATIONAL = [n for n in QUERIES if n.split("_")[0] in {"sel", "flt", "join", "agg", "fn", "set", "top", "limit", "sort", "job"}]


@pytest.fixture(autouse=True)
def whole_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_nested_loops_and_no_row_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", *ROW_PYTHON):
        assert bad not in text, name


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["flt_compare"](spark, sf_dir))
    assert "GreaterThan(o_totalprice,250000.0)" in text and "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_watermark_is_pushed(spark, sf_dir):
    import datetime

    text = plan(pull(table(spark, sf_dir, "orders"), ORDERS, datetime.datetime(2000, 1, 1)))
    assert "GreaterThan(o_orderdate," in text


def test_top_k_is_cut_before_the_shuffle(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, sf_dir))
    text = plan(QUERIES["top_k_per_group"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert "WindowGroupLimit" in plan(QUERIES["job_score_summary"](spark, sf_dir))


def test_bucketed_join_has_no_exchange_below_it(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["snk_partition_bucket"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in below and "Bucketed: true" in below


def test_partition_folder_is_pruned(spark, sf_dir):
    for name, column, value in (("src_partition_discovery", "key", "2"), ("snk_partitioned", "o_orderstatus", "'P'")):
        text = plan(QUERIES[name](spark, sf_dir).filter(f"{column} = {value}"))
        assert f"PartitionFilters: [isnotnull({column}" in text


def test_small_table_is_broadcast_by_size(spark, sf_dir):
    df = QUERIES["join_broadcast_map"](spark, sf_dir)
    assert "BroadcastHashJoin" in plan(df) and "hint" not in optimized(df).lower()


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["agg_reduce_by_key"](spark, sf_dir))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_global_numbering_has_no_one_task_sort(spark, sf_dir):
    text = plan(QUERIES["sort_desc"](spark, sf_dir))
    # the only single-partition step is the window over the few partition sizes
    assert text.count("SinglePartition") == 1 and "Window [sum(__before" in text


def test_no_query_depends_on_the_broadcast_threshold(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("join_inner_on", "agg_filtered", "join_left_semi"):
            df = QUERIES[name](spark, sf_dir)
            assert "SortMergeJoin" in plan(df)
            assert df.agg(F.count(F.lit(1))).first()[0] > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_terms_are_tokenized_once(spark, sf_dir):
    """The weights read the written counts; neither texts nor tokens are touched again."""
    text = plan(QUERIES["ml_tf_idf"](spark, sf_dir))
    assert "documents.parquet" not in text and "UDF" not in text and text.count("terms-") >= 1


def test_whole_texts_come_to_python_row_by_row(spark, tmp_path):
    rows = [(1, "Crème brûlée"), (2, "plain"), (3, None), (4, ""), (5, "Zürich")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["udf_row_map"](spark, str(tmp_path))
    assert "ArrowEvalPython" not in plan(found)
    want = {1: "Creme brulee", 2: "plain", 3: None, 4: "", 5: "Zurich"}
    assert dict(found.collect()) == {k: None if v is None else hashlib.md5(v.encode()).hexdigest() for k, v in want.items()}
