"""Projection, filters, joins, sets, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.intervals import contained_in
from millrace.operators.ranking import keep_group_max, top_k, top_k_per_group
from millrace.operators.skew import number_rows, zip_rows
from millrace.operators.subsets import join_subsets, tag_sources
from millrace.queries import roles
from millrace.registry import query
from millrace.session import scratch_name, table


def view(spark, sf_dir, name):
    """A view of a table under a name of its own, so that two runs in one session do not meet."""
    own = scratch_name(f"v_{name}")
    table(spark, sf_dir, name).createOrReplaceTempView(own)
    return own

# ---------------------------------------------------------------- projection


@query("sel_columns", "select c_custkey, c_name as name from customer")
def sel_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))


@query(
    "sel_arith",
    """select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net, l_quantity + 1 as quantity_1,
              l_extendedprice - 2.5::double as less
       from lineitem""",
)
def sel_arith(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_quantity") + 1).alias("quantity_1"),
        (F.col("l_extendedprice") - 2.5).alias("less"),
    )


@query("sel_star", "select * from supplier")
def sel_star(spark, sf_dir):
    return spark.sql(f"SELECT A.* FROM (SELECT * FROM {view(spark, sf_dir, 'supplier')}) A")


@query("sel_rename", "select p_partkey as part_id, p_name, p_brand, p_type, p_size, p_retailprice from part")
def sel_rename(spark, sf_dir):
    return table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "part_id")


@query("sel_drop", "select p_partkey, p_name, p_brand, p_type, p_size from part")
def sel_drop(spark, sf_dir):
    return table(spark, sf_dir, "part").drop("p_retailprice")


@query("sel_distinct", "select distinct l_partkey, l_suppkey from lineitem")
def sel_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


# ---------------------------------------------------------------- filters


@query(
    "flt_compare",
    "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 250000",
)
def flt_compare(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").filter(F.col("o_totalprice") > 250000)
    return orders.select("o_orderkey", "o_totalprice")


@query(
    "flt_equal_text",
    """select doc_id, count(*) as n from (select doc_id, unnest(string_split(text, ' ')) as word from documents)
       where word = 'été' or word = 'où' or word = 'à' or word = 'très' or word = 'é' or word = 'è' or word = 'ê' group by doc_id""",
)
def flt_equal_text(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    wanted = (F.col("word") == "été") | F.col("word").isin("où", "à", "très", "é", "è", "ê")
    return words.filter(wanted).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("flt_range_and", "select p_partkey, p_size from part where p_size >= 13 and p_size <= 19")
def flt_range_and(spark, sf_dir):
    return spark.sql(f"SELECT p_partkey, p_size FROM {view(spark, sf_dir, 'part')} WHERE p_size >= 13 AND p_size <= 19")


@query("flt_between", "select p_partkey, p_name, p_size from part where p_size between 13 and 19")
def flt_between(spark, sf_dir):
    return spark.sql(f"SELECT p_partkey, p_name, p_size FROM {view(spark, sf_dir, 'part')} WHERE p_size BETWEEN 13 AND 19")


@query(
    "flt_string_expr",
    """select c.c_custkey, c.c_nationkey from customer c left join (select distinct user_id from events) e
       on c.c_custkey = e.user_id where e.user_id is null and c.c_nationkey >= 0""",
)
def flt_string_expr(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(users, F.col("c_custkey") == F.col("user_id"), "left")
    return joined.filter("user_id is null and c_nationkey >= 0").select("c_custkey", "c_nationkey")


@query(
    "flt_contains",
    """select count(*) filter (where contains(text, 'a')) as lines_with_a,
              count(*) filter (where contains(text, 'b')) as lines_with_b
       from (select unnest(string_split(text, chr(10))) as text from documents)""",
)
def flt_contains(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.agg(
        F.count_if(F.col("line").contains("a")).alias("lines_with_a"),
        F.count_if(F.col("line").contains("b")).alias("lines_with_b"),
    )


# ---------------------------------------------------------------- joins


@query(
    "join_inner_on",
    "select o.o_orderkey, c.c_name, c.c_mktsegment from orders o join customer c on o.o_custkey = c.c_custkey",
)
def join_inner_on(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "inner")
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "join_inner_where",
    """select l_returnflag, o_orderstatus, count(*) as n,
              sum(cast(l_extendedprice as decimal(18,2)))::double as total
       from lineitem, orders where l_orderkey = o_orderkey group by l_returnflag, o_orderstatus""",
)
def join_inner_where(spark, sf_dir):
    lines, orders = view(spark, sf_dir, "lineitem"), view(spark, sf_dir, "orders")
    return spark.sql(
        f"""SELECT l_returnflag, o_orderstatus, count(*) AS n,
                  cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total
           FROM {lines} l, {orders} o WHERE l.l_orderkey = o.o_orderkey
           GROUP BY l_returnflag, o_orderstatus"""
    )


@query(
    "join_inner_cond_list",
    """select count(*) as n from lineitem l join orders o
       on l.l_orderkey = o.o_orderkey and l.l_shipdate >= o.o_orderdate where o.o_orderstatus = 'F'""",
)
def join_inner_cond_list(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    joined = orders.join(lines, [lines.l_orderkey == orders.o_orderkey, lines.l_shipdate >= orders.o_orderdate])
    return joined.agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_using",
    """select custkey, orders_n, c_name from
       (select o_custkey as custkey, count(*) as orders_n from orders group by 1)
       join (select c_custkey as custkey, c_name from customer) using (custkey)""",
)
def join_using(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("orders_n"))
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return counts.join(names, "custkey")


@query(
    "join_different_names",
    """select e.user_id, c.c_custkey, e.n from (select user_id, count(*) as n from events group by user_id) e
       join customer c on e.user_id = c.c_custkey""",
)
def join_different_names(spark, sf_dir):
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    customers = table(spark, sf_dir, "customer")
    return users.join(customers, users["user_id"] == customers["c_custkey"]).select("user_id", "c_custkey", "n")


@query(
    "join_using_multi",
    """select o_custkey, o_orderkey, o_orderpriority from orders o join
       (select o_custkey, max(o_orderpriority) as o_orderpriority from orders group by 1) g
       using (o_custkey, o_orderpriority)""",
)
def join_using_multi(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    best = orders.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("o_orderpriority"))
    return orders.join(best, ["o_custkey", "o_orderpriority"]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    "join_left_semi",
    "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders)",
)
def join_left_semi(spark, sf_dir):
    # only the distinct keys of the right side travel: a customer with very many orders is one row
    customers, buyers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select("o_custkey").distinct()
    return customers.join(buyers, customers.c_custkey == buyers.o_custkey, "left_semi").select("c_custkey", "c_name")


@query(
    "join_interval_contain",
    f"with {roles.ROLE_SQL} select person, cast(score as double) as score from after_class",
)
def join_interval_contain(spark, sf_dir):
    attempts = roles.scores(spark, sf_dir).select("person", "starttime", "endtime", "score")
    granted = roles.windows(spark, sf_dir).filter(F.col("status") == 1).select("person", "start_dt", "end_dt")
    return contained_in(attempts, granted).select("person", F.col("score").cast("double").alias("score"))


@query(
    "join_pair_rdd",
    """select l.k, l.v as line_total, o.v as order_total from
       (select l_orderkey as k, sum(cast(l_extendedprice as decimal(18,2)))::double as v from lineitem group by 1) l
       join (select o_orderkey as k, o_totalprice as v from orders) o on l.k = o.k""",
)
def join_pair_rdd(spark, sf_dir):
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(total.alias("line_total"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("order_total"))
    return lines.join(orders, "k")


@query(
    "join_broadcast_map",
    """select n.n_name, r.r_name, count(*) as customers from customer c join nation n on c.c_nationkey = n.n_nationkey
       join region r on n.n_regionkey = r.r_regionkey group by 1, 2""",
)
def join_broadcast_map(spark, sf_dir):
    # reduced before the join; nation and region are below the size Spark broadcasts by itself
    per_nation = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_name", "r_name", "customers")
    )


@query(
    "join_positional",
    """select row_number() over (order by o_orderkey) as row_id, o_totalprice as label,
              o_totalprice * 0.5::double + 1000 as prediction from orders""",
)
def join_positional(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    labels = orders.select(F.col("o_orderkey").alias("a"), F.col("o_totalprice").alias("label"))
    predicted = orders.select(F.col("o_orderkey").alias("b"), (F.col("o_totalprice") * 0.5 + 1000).alias("prediction"))
    return zip_rows(labels, predicted, [F.col("a")], [F.col("b")]).select("row_id", "label", "prediction")


SUBSET_SQL = """
with t as (
  select o_custkey as person, 1 as bit, max(cast(o_totalprice as decimal(18,2))) as score from orders where o_orderstatus = 'F' group by 1
  union all
  select o_custkey, 2, max(cast(o_totalprice as decimal(18,2))) from orders where o_orderstatus = 'O' group by 1
  union all
  select o_custkey, 4, max(cast(o_totalprice as decimal(18,2))) from orders where o_orderstatus = 'P' group by 1
  union all
  select c_custkey, 8, cast(c_acctbal as decimal(18,2)) from customer),
exams as (select user_id as person, event_type as exam, sum(cast(value as decimal(18,2))) as score from events group by 1, 2),
p as (
  select person, bit_or(bit) as present,
         max(case when bit = 1 then score end) as s1, max(case when bit = 2 then score end) as s2,
         max(case when bit = 4 then score end) as s3, max(case when bit = 8 then score end) as s4
  from (select person, bit, score from t union all select distinct person, 16, cast(null as decimal(18,2)) from exams)
  group by person),
masks as (select m from range(0, 32) r(m) where bit_count(m::integer) >= 3),
kept as (select p.*, cast(m as integer) as mask from p, masks where (m::integer & present) = m)
select k.person, k.mask,
       case when mask & 1 <> 0 then s1::double end as s1, case when mask & 2 <> 0 then s2::double end as s2,
       case when mask & 4 <> 0 then s3::double end as s3, case when mask & 8 <> 0 then s4::double end as s4,
       e.exam, e.score::double as exam_score
from kept k left join exams e on e.person = k.person and k.mask & 16 <> 0
"""


@query("join_subsets", SUBSET_SQL)
def subsets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    price = F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("score")
    best = [
        orders.filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("person")).agg(price) for s in ("F", "O", "P")
    ]
    balance = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), F.col("c_acctbal").alias("score"))
    exams = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("person"), F.col("event_type").alias("exam"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("score"))
    )
    money = "decimal(18,2)"
    rows = join_subsets(tag_sources([*best, balance], money), exams, score_type=money)
    scores = ["s1", "s2", "s3", "s4", "exam_score"]
    return rows.withColumns({c: F.col(c).cast("double") for c in scores})


# ---------------------------------------------------------------- order, limits, sets


@query(
    "sort_desc",
    "select row_number() over (order by o_totalprice desc, o_orderkey) as row_id, o_orderkey, o_totalprice from orders",
)
def sort_desc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return number_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query(
    "sort_by_key_numeric",
    """select row_number() over (order by n) as row_id, n from
       (select cast(string_split(c_name, '#')[2] as integer) as n from customer)""",
)
def sort_by_key_numeric(spark, sf_dir):
    numbers = table(spark, sf_dir, "customer").select(F.split_part("c_name", F.lit("#"), F.lit(2)).try_cast("int").alias("n"))
    return number_rows(numbers, [F.col("n")])


@query(
    "top_k",
    "select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 5",
)
def top_five(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_k(orders, 5, F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query(
    "top_k_per_group",
    """select * from (
         select o_orderstatus, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) as "rank",
                o_orderkey, o_totalprice from orders) where "rank" <= 5""",
)
def top_five_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    top = top_k_per_group(orders, "o_orderstatus", 5, F.col("o_totalprice").desc(), F.col("o_orderkey"))
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("limit_take", "select event_id, event_type, value from events order by event_id limit 20")
def limit_take(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value").orderBy("event_id").limit(20)


@query(
    "set_union_distinct",
    "select c_nationkey as nationkey from customer union select s_nationkey from supplier",
)
def set_union_distinct(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return customers.union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query(
    "agg_group_argmax",
    """select event_type, event_id, value from events
       where (event_type, value) in (select event_type, max(value) from events group by 1)""",
)
def agg_group_argmax(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return keep_group_max(events, ["event_type"], "value").select("event_type", "event_id", "value")
