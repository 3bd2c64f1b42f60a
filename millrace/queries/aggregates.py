"""Aggregations."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from millrace.registry import query
from millrace.session import table


def money(column: str):
    """Exact sums: two decimals instead of doubles."""
    return F.col(column).cast("decimal(18,2)")


def exact_avg(column: str):
    """Mean from an exact sum, equal on any number of executors."""
    return F.sum(money(column)).cast("double") / F.count(column)


@query("agg_count", "select count(*) as n from lineitem")
def agg_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_group_count",
    """select l.quality, count(*) as n from documents d left join labels l on d.doc_id = l.doc_id group by l.quality""",
)
def agg_group_count(spark, sf_dir):
    # documents without a label make the null group; labels are counted per document before they travel
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("rows"))
    joined = documents.join(labels, "doc_id", "left")
    return joined.groupBy("quality").agg(F.sum(F.coalesce("rows", F.lit(1))).alias("n"))


@query(
    "agg_avg_max_min",
    """select coalesce(sum(cast(o_totalprice as decimal(18,2)))::double / count(o_totalprice), 0) as avg_price,
              coalesce(max(o_totalprice), 0) as max_price, coalesce(min(o_totalprice), 0) as min_price,
              coalesce(max(case when o_orderstatus = 'X' then o_totalprice end), 0) as none_price from orders""",
)
def agg_avg_max_min(spark, sf_dir):
    price = F.col("o_totalprice")
    zero = F.lit(0.0)
    return table(spark, sf_dir, "orders").agg(
        F.coalesce(exact_avg("o_totalprice"), zero).alias("avg_price"),
        F.coalesce(F.max(price), zero).alias("max_price"),
        F.coalesce(F.min(price), zero).alias("min_price"),
        F.coalesce(F.max(F.when(F.col("o_orderstatus") == "X", price)), zero).alias("none_price"),
    )


@query(
    "agg_filtered",
    """select o_orderstatus, sum(cast(l_extendedprice as decimal(18,2)))::double / count(*) as avg_score,
              max(l_extendedprice) as max_score, min(l_extendedprice) as min_score
       from lineitem join orders on l_orderkey = o_orderkey group by o_orderstatus""",
)
def agg_filtered(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderstatus")
        .agg(
            exact_avg("l_extendedprice").alias("avg_score"),
            F.max("l_extendedprice").alias("max_score"),
            F.min("l_extendedprice").alias("min_score"),
        )
    )


@query(
    "agg_sum_group2",
    "select event_type, user_id, sum(cast(value as decimal(18,2)))::double as total from events group by 1, 2",
)
def agg_sum_group2(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.sum(money("value")).cast("double").alias("total"))


@query("agg_max_group", "select o_custkey, max(o_totalprice) as best from orders group by 1")
def agg_max_group(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"))


@query(
    "agg_reduce_by_key",
    "select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from documents) group by word",
)
def agg_reduce_by_key(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_reduce_global",
    """select sum(cast(l_quantity as decimal(18,2)))::double as quantity,
              sum(cast(l_extendedprice as decimal(18,2)))::double as price, sum(cast(l_tax as decimal(18,2)))::double as tax
       from lineitem""",
)
def agg_reduce_global(spark, sf_dir):
    total = lambda c: F.sum(money(c)).cast("double")
    return table(spark, sf_dir, "lineitem").agg(
        total("l_quantity").alias("quantity"), total("l_extendedprice").alias("price"), total("l_tax").alias("tax")
    )


@query(
    "agg_group_list",
    """select user_id, count(distinct event_type) as neighbours, string_agg(distinct event_type, ',' order by event_type) as list
       from events group by user_id""",
)
def agg_group_list(spark, sf_dir):
    # a list per key is kept only because its members come from a small fixed set of event types;
    # duplicates go before the shuffle
    kinds = F.array_sort(F.collect_set("event_type"))
    lists = table(spark, sf_dir, "events").groupBy("user_id").agg(kinds.alias("kinds"))
    return lists.select(
        "user_id", F.size("kinds").cast("bigint").alias("neighbours"), F.array_join("kinds", ",").alias("list")
    )


def embedding_vectors(spark, sf_dir):
    values = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector(values).alias("features"))


def positions(df, keys, column="mean"):
    """A mean vector as rows (pos, value)."""
    return df.select(*keys, F.posexplode(vector_to_array(column)).alias("pos", "x")).select(
        *keys, (F.col("pos") + 1).cast("bigint").alias("pos"), F.round("x", 6).alias("value")
    )


@query(
    "agg_pair_mean",
    """select label, pos, round(sum(x) / count(*), 6) as value from
       (select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings)
       group by label, pos""",
)
def agg_pair_mean(spark, sf_dir):
    means = embedding_vectors(spark, sf_dir).groupBy("label").agg(Summarizer.mean(F.col("features")).alias("mean"))
    return positions(means, ["label"])


@query(
    "agg_vector_stats",
    """select pos, round(avg(x), 6) as value from
       (select unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings) group by pos""",
)
def agg_vector_stats(spark, sf_dir):
    means = embedding_vectors(spark, sf_dir).agg(Summarizer.mean(F.col("features")).alias("mean"))
    return positions(means, [])


@query("agg_count_by_key", "select l_suppkey, count(*) as n from lineitem group by 1")
def agg_count_by_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_describe",
    """select count(l_quantity) as n, round(avg(l_quantity), 6) as mean, round(stddev_samp(l_quantity), 6) as sd,
              min(l_quantity) as lowest, max(l_quantity) as highest from lineitem""",
)
def agg_describe(spark, sf_dir):
    q = "l_quantity"
    return table(spark, sf_dir, "lineitem").agg(
        F.count(q).alias("n"),
        F.round(F.avg(q), 6).alias("mean"),
        F.round(F.stddev(q), 6).alias("sd"),
        F.min(q).alias("lowest"),
        F.max(q).alias("highest"),
    )


@query(
    "agg_corr",
    """select round(corr(l_extendedprice, l_quantity), 6) as with_quantity,
              round(corr(l_extendedprice, l_discount), 6) as with_discount, round(corr(l_extendedprice, l_tax), 6) as with_tax
       from lineitem""",
)
def agg_corr(spark, sf_dir):
    pairs = [F.round(F.corr("l_extendedprice", f"l_{x}"), 6).alias(f"with_{x}") for x in ("quantity", "discount", "tax")]
    return table(spark, sf_dir, "lineitem").agg(*pairs)


@query(
    "agg_mean_sq",
    """select round(avg(pow(l_extendedprice / 1000 - l_quantity, 2)), 4) as mean_sq,
              avg(case when l_returnflag <> l_linestatus then 1.0::double else 0.0::double end) as mismatch from lineitem""",
)
def agg_mean_sq(spark, sf_dir):
    difference = F.col("l_extendedprice") / 1000 - F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").agg(
        F.round(F.avg(F.pow(difference, 2)), 4).alias("mean_sq"),
        F.avg((F.col("l_returnflag") != F.col("l_linestatus")).cast("double")).alias("mismatch"),
    )


@query(
    "agg_truthy_count",
    """select l_orderkey, l_linenumber,
              case when l_quantity <> 0 then 1 else 0 end + case when l_discount <> 0 then 1 else 0 end
            + case when l_tax <> 0 then 1 else 0 end + case when nullif(l_suppkey, 3) <> 0 then 1 else 0 end
            + case when nullif(l_linenumber, 1) <> 0 then 1 else 0 end as flag from lineitem""",
)
def agg_truthy_count(spark, sf_dir):
    given = [
        F.col("l_quantity"),
        F.col("l_discount"),
        F.col("l_tax"),
        F.nullif(F.col("l_suppkey"), F.lit(3)),
        F.nullif(F.col("l_linenumber"), F.lit(1)),
    ]
    flags = [F.when(F.coalesce(x != 0, F.lit(False)), 1).otherwise(0) for x in given]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", sum(flags[1:], flags[0]).alias("flag"))
