"""Graph and iterative algorithms, sampling, splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.ml.factors import errors_by_round
from millrace.operators.graph import page_rank, transitive_closure
from millrace.operators.iterative import kmeans, logistic_descent, nearest, squared_distance
from millrace.operators.sampling import (
    bernoulli,
    fixed_size,
    fixed_size_with_replacement,
    hash_split,
    key_shares,
    poisson_steps,
    random_order,
    stratified,
)
from millrace.queries.model_queries import ratings
from millrace.registry import query
from millrace.session import cut_lineage, table


def _round_sql(i: int) -> str:
    return (
        f"r{i} as (select e.dst as node, 0.15 + 0.85 * sum(r.rnk / d.degree) as rnk from r{i - 1} r "
        f"join deg d on d.src = r.node join e on e.src = r.node group by e.dst)"
    )


@query(
    "it_pagerank",
    f"""with e as (select distinct l_orderkey as src, l_partkey as dst from lineitem),
        deg as (select src, count(*) as degree from e group by src),
        r0 as (select src as node, 1.0::double as rnk from deg),
        {_round_sql(1)}, {_round_sql(2)}, {_round_sql(3)}
        select node, round(rnk, 6) as "rank" from r3""",
)
def it_pagerank(spark, sf_dir):
    # order and part numbers share one id space: some nodes have no in-links, some no out-links
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))
    return page_rank(edges, 3).select("node", F.round("rank", 6).alias("rank"))


@query(
    "it_transitive_closure",
    """with recursive e as (
         select 'O' || o_orderkey as src, 'C' || o_custkey as dst from orders
         union select 'C' || c_custkey, 'N' || c_nationkey from customer
         union select 'S' || s_suppkey, 'N' || s_nationkey from supplier
         union select 'N' || n_nationkey, 'R' || n_regionkey from nation),
       p as (select src, dst from e union select p.src, e.dst from p join e on p.dst = e.src)
       select src, dst from p""",
)
def it_transitive_closure(spark, sf_dir):
    # which place does everything belong to: order -> customer -> nation -> region
    def edge(name, a, x, b, y):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(a), F.col(x).cast("string")).alias("src"), F.concat(F.lit(b), F.col(y).cast("string")).alias("dst")
        )

    edges = (
        edge("orders", "O", "o_orderkey", "C", "o_custkey")
        .union(edge("customer", "C", "c_custkey", "N", "c_nationkey"))
        .union(edge("supplier", "S", "s_suppkey", "N", "s_nationkey"))
        .union(edge("nation", "N", "n_nationkey", "R", "n_regionkey"))
    )
    return transitive_closure(edges)


def embedding_points(spark, sf_dir):
    values = F.transform("embedding", lambda x: x.cast("double")).alias("v")
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", values)


_KMEANS_ROUND = """
c{i} as (select k, list(m order by pos) as c from (
    select a.k, pos, avg(v[pos]) as m from (
      select vec_id, v, arg_min(k, (dist, k)) as k from (
        select p.vec_id, p.v, c.k, list_sum(list_transform(list_zip(p.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as dist
        from p, c{j} c) group by vec_id, v) a, range(1, 65) t(pos) group by a.k, pos) group by k)
"""


#: Rounds of the SQL form; the points of the test tables stand still well before.
KMEANS_ROUNDS = 60


@query(
    "it_kmeans",
    f"""with p as (select vec_id, embedding::double[] as v from embeddings),
        c0 as (select row_number() over (order by md5(vec_id || '|1'), vec_id) - 1 as k, v as c from p
               qualify row_number() over (order by md5(vec_id || '|1'), vec_id) <= 4),
        {", ".join(_KMEANS_ROUND.format(i=i, j=i - 1) for i in range(1, KMEANS_ROUNDS + 1))}
        select vec_id, k::integer as cluster, round(dist, 5) as distance from (
          select p.vec_id, c.k, list_sum(list_transform(list_zip(p.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as dist,
                 row_number() over (partition by p.vec_id order by dist, c.k) as rn from p, c{KMEANS_ROUNDS} c) where rn = 1""",
)
def it_kmeans(spark, sf_dir):
    points = embedding_points(spark, sf_dir)
    # a seeded sample of four points, moved until they stand still
    start = [row["v"] for row in fixed_size(points, 4, ["vec_id"], 1).orderBy(*random_order(["vec_id"], 1)).collect()]
    centres = kmeans(points, "v", start, 1e-9)
    cluster = nearest(F.col("v"), centres)
    own = F.element_at(F.lit(centres), F.col("cluster") + 1)
    return points.withColumn("cluster", cluster).select(
        "vec_id", "cluster", F.round(squared_distance(F.col("v"), own), 5).alias("distance")
    )


_LOGIT = """(select case when l_returnflag = 'R' then 1.0::double else -1.0::double end as y, l_quantity / 50 as x1,
  l_extendedprice / 100000 as x2, l_discount * 10 as x3, l_tax * 10 as x4 from lineitem)"""


def _gradient_sql(i: int) -> str:
    margin = " + ".join(f"x{k} * w.w{k}" for k in range(1, 5))
    terms = ", ".join(
        f"max(w.w{k}) - 0.00001::double * sum((1 / (1 + exp(-y * ({margin}))) - 1) * y * x{k}) as w{k}" for k in range(1, 5)
    )
    return f"g{i} as (select {terms} from {_LOGIT} p, g{i - 1} w)"


@query(
    "it_logistic_gd",
    f"""with g0 as (select 0.0::double as w1, 0.0::double as w2, 0.0::double as w3, 0.0::double as w4), {_gradient_sql(1)}, {_gradient_sql(2)},
        agree as (select avg(case when (x1 * w1 + x2 * w2 + x3 * w3 + x4 * w4 > 0) = (y > 0) then 1.0::double else 0.0::double end) as hit
                  from {_LOGIT} p, g2)
        select round(w1, 8) as w1, round(w2, 8) as w2, round(w3, 8) as w3, round(w4, 8) as w4, round(hit, 6) as accuracy from g2, agree""",
)
def it_logistic_gd(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(-1.0).alias("y"),
        (F.col("l_quantity") / 50).alias("x1"),
        (F.col("l_extendedprice") / 100000).alias("x2"),
        (F.col("l_discount") * 10).alias("x3"),
        (F.col("l_tax") * 10).alias("x4"),
    )
    features = ["x1", "x2", "x3", "x4"]
    weights = logistic_descent(points, "y", features, 2, step=1e-5)
    margin = sum((F.col(f) * w for f, w in zip(features, weights)), F.lit(0.0))
    hit = F.avg(((margin > 0) == (F.col("y") > 0)).cast("double"))
    return points.agg(
        *[F.lit(round(w, 8)).alias(f"w{i}") for i, w in enumerate(weights, 1)], F.round(hit, 6).alias("accuracy")
    )


@query("it_als")
def it_als(spark, sf_dir):
    # the error after each of five rounds
    errors = errors_by_round(cut_lineage(ratings(spark, sf_dir)), 5, rank=10, reg=0.01, seed=42)
    return spark.createDataFrame(list(enumerate(errors, 1)), "rounds int, rmse double")


# ---------------------------------------------------------------- sampling


def _uniform_sql(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 15))::bigint / {float(1 << 60)!r}::double)"


def _copies_sql(u: str, mean: float) -> str:
    return " + ".join(f"({u} >= {step!r}::double)::integer" for step in poisson_steps(mean))


@query(
    "smp_bernoulli",
    f"""with l as (select l_orderkey, l_linenumber, {_uniform_sql("l_orderkey || '|' || l_linenumber || '|7'")} as u from lineitem)
        select l_orderkey, l_linenumber from (select l_orderkey, l_linenumber, {_copies_sql("u", 0.1)} as copies from l), range(20) r(i) where i < copies""",
)
def smp_bernoulli(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return bernoulli(lines, 0.1, 7, ["l_orderkey", "l_linenumber"], replacement=True)


@query(
    "smp_fixed_size",
    """with o as (select o_orderkey, o_totalprice, row_number() over (order by o_orderkey) as rn from orders)
       select * from (select o_orderkey, o_totalprice, 'without' as how from o order by md5(o_orderkey || '|1'), o_orderkey limit 100)
       union all
       select o_orderkey, o_totalprice, 'with' from range(100) d(id)
       join o on rn = ('0x' || substr(md5(id || '|1'), 1, 15))::bigint % (select count(*) from orders) + 1""",
)
def smp_fixed_size(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    without = fixed_size(orders, 100, ["o_orderkey"], 1).withColumn("how", F.lit("without"))
    again = fixed_size_with_replacement(orders, 100, ["o_orderkey"], 1).withColumn("how", F.lit("with"))
    return without.unionByName(again)


@query(
    "smp_stratified",
    f"""with o as (select o_orderkey, o_orderstatus, {_uniform_sql("o_orderkey || '|11'")} as u from orders),
        c as (select o_orderstatus, case o_orderstatus when 'F' then {_copies_sql("u", 0.1)} when 'O' then {_copies_sql("u", 0.2)}
              when 'P' then {_copies_sql("u", 0.3)} else 0 end as copies from o),
        k as (select o_orderstatus, count(*) as before, sum(copies)::bigint as after from c group by 1)
        select o_orderstatus, before, before / (select sum(before) from k) as share_before, nullif(after, 0) as after,
               case when after > 0 then after / (select sum(after) from k) end as share_after from k""",
)
def smp_stratified(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    fractions = {"F": 0.1, "O": 0.2, "P": 0.3}
    taken = stratified(orders, "o_orderstatus", fractions, 11, ["o_orderkey"], replacement=True)
    before = key_shares(orders, "o_orderstatus").select("o_orderstatus", F.col("n").alias("before"), F.col("share").alias("share_before"))
    after = key_shares(taken, "o_orderstatus").select("o_orderstatus", F.col("n").alias("after"), F.col("share").alias("share_after"))
    return before.join(after, "o_orderstatus", "left")


@query(
    "smp_split",
    """select o_orderkey, case when ('0x' || substr(md5(o_orderkey::varchar), 1, 8))::bigint / 4294967296.0::double < 0.7::double
       then 'train' else 'test' end as part from orders""",
)
def smp_split(spark, sf_dir):
    train, test = hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], [0.7, 0.3])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
