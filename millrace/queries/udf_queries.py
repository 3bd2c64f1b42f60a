"""The user-function surface: built-ins where they do, Arrow batches where Python is the point."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from millrace.registry import query
from millrace.session import table

ACCENTS = re.compile(r"[\u0300-\u036f]")


@query("udf_row_map", "select doc_id, md5(strip_accents(text)) as digest from documents")
def udf_row_map(spark, sf_dir):
    # no built-in function takes letters apart from their accents; texts come row by row, as an Arrow batch would hold thousands of whole texts, several times over
    @F.udf("string", useArrow=False)
    def without_accents(text: str | None) -> str | None:
        return text if text is None or text.isascii() else ACCENTS.sub("", unicodedata.normalize("NFD", text))

    return table(spark, sf_dir, "documents").select("doc_id", F.md5(without_accents("text")).alias("digest"))


@query(
    "udf_partition_map",
    "select l_returnflag, sum(cast(l_quantity as bigint))::bigint as quantity, count(*) as n from lineitem group by 1",
)
def udf_partition_map(spark, sf_dir):
    # each partition hands back one small partial table; the merge is an ordinary aggregate
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = batch.groupby("l_returnflag", as_index=False).agg(q=("l_quantity", "sum"), c=("l_quantity", "size"))
            yield sums.astype({"q": "int64", "c": "int64"})

    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    parts = lines.mapInPandas(partial, "l_returnflag string, q bigint, c bigint")
    return parts.groupBy("l_returnflag").agg(F.sum("q").alias("quantity"), F.sum("c").alias("n"))


@query(
    "udf_flat_map",
    """select o_orderkey, kind, amount from (
         select o_orderkey, 'half' as kind, o_totalprice / 2 as amount from orders
         union all select o_orderkey, 'rest', o_totalprice - o_totalprice / 2 from orders)""",
)
def udf_flat_map(spark, sf_dir):
    half = F.col("o_totalprice") / 2
    pair = F.array(
        F.struct(F.lit("half").alias("kind"), half.alias("amount")),
        F.struct(F.lit("rest").alias("kind"), (F.col("o_totalprice") - half).alias("amount")),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(pair))


@query("udf_value_map", "select c_custkey as key, upper(c_mktsegment) || '!' as value from customer")
def udf_value_map(spark, sf_dir):
    pairs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"))
    return pairs.withColumn("value", F.concat(F.upper("value"), F.lit("!")))


@query(
    "udf_group_reduce",
    """select l_partkey, sum(l_quantity::bigint)::bigint as total, bit_or(l_linenumber) as numbers from lineitem group by 1""",
)
def udf_group_reduce(spark, sf_dir):
    # associative merges are aggregates: they run before the shuffle as well as after it
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"), F.bit_or("l_linenumber").alias("numbers")
    )
