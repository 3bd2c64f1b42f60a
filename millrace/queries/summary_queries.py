"""Sketches, totals on several levels, aggregates and table functions of the caller's, multisets."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import sketches
from millrace.operators.aggregator import GeometricMean, aggregate, modes
from millrace.operators.tables import stretches
from millrace.registry import query
from millrace.session import cut_lineage, table


@query(
    "agg_sketches",
    """select event_type, true as people_within, true as value_within, true as merged_people, true as merged_value, count(*) as n from events group by event_type""",
)
def agg_sketches(spark, sf_dir):
    # a sketch for every day and kind is stored; later the days are put together, without the events
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    distinct, quantiles = {"people": F.col("user_id")}, {"mid": F.col("value")}
    stored = cut_lineage(sketches.sketch(events, ["event_type", "day"], distinct, quantiles), "sketches")
    merged = sketches.estimates(sketches.merge(stored, ["event_type"], ["people"], ["mid"]), ["event_type"], ["people"], {"mid": 0.5})
    once = sketches.sketch(events, ["event_type"], distinct, quantiles)
    once = sketches.estimates(once, ["event_type"], ["people"], {"mid": 0.5}).select("event_type", F.col("people").alias("people_once"), F.col("mid").alias("mid_once"))
    exact = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("people_exact"))

    # the share of values up to a quantile must be near one half
    both = merged.join(once, "event_type")
    below = lambda c: F.avg((F.col("value") <= F.col(c)).cast("double"))
    ranks = events.join(F.broadcast(both), "event_type").groupBy("event_type").agg(below("mid").alias("rank"), below("mid_once").alias("rank_once"))
    near, close = sketches.distinct_error(), sketches.rank_error()
    people, exactly = F.col("people"), F.col("people_exact")
    return (
        both.join(exact, "event_type")
        .join(ranks, "event_type")
        .select(
            "event_type",
            (F.abs(people - exactly) <= near * exactly).alias("people_within"),
            (F.abs(F.col("rank") - 0.5) <= close + 1 / F.col("n")).alias("value_within"),
            (F.abs(people - F.col("people_once")) <= near * exactly).alias("merged_people"),
            (F.abs(F.col("rank") - F.col("rank_once")) <= 2 * close + 1 / F.col("n")).alias("merged_value"),
            "n",
        )
    )


# Segments that are not known are null in the data; grouping_id tells them from totals.
PLACES_SQL = """with c as (select r_name as region, n_name as nation, nullif(c_mktsegment, 'MACHINERY') as segment, c_acctbal::decimal(18,2) as balance
                           from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""


def placed_customers(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("region"),
            F.col("n_name").alias("nation"),
            F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        )
    )


def totals():
    return F.count(F.lit(1)).alias("n"), F.sum("balance").cast("double").alias("balance")


def _levels(grouping: str) -> str:
    return (
        PLACES_SQL
        + f"""select region, nation, segment, grouping(region, nation, segment)::bigint as level, count(*) as n, sum(balance)::double as balance from c group by {grouping}"""
    )


@query("agg_grouping_sets", _levels("grouping sets ((region, nation), (region, segment), (segment), ())"))
def agg_grouping_sets(spark, sf_dir):
    customers = placed_customers(spark, sf_dir)
    region, nation, segment = (F.col(c) for c in ("region", "nation", "segment"))
    sets = [[region, nation], [region, segment], [segment], []]
    return customers.groupingSets(sets, region, nation, segment).agg(F.grouping_id().alias("level"), *totals()).select("region", "nation", "segment", "level", "n", "balance")


@query("agg_cube", _levels("cube (region, nation, segment)"))
def agg_cube(spark, sf_dir):
    return placed_customers(spark, sf_dir).cube("region", "nation", "segment").agg(F.grouping_id().alias("level"), *totals())


@query("agg_rollup", _levels("rollup (region, nation, segment)"))
def agg_rollup(spark, sf_dir):
    return placed_customers(spark, sf_dir).rollup("region", "nation", "segment").agg(F.grouping_id().alias("level"), *totals())


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@query(
    "agg_pivot",
    PLACES_SQL
    + "select region, "
    + ", ".join(f"nullif(count(*) filter (where segment = '{s}'), 0) as {s.lower()}_n, (sum(balance) filter (where segment = '{s}'))::double as {s.lower()}_balance" for s in SEGMENTS)
    + " from c group by region",
)
def agg_pivot(spark, sf_dir):
    # the values are given, so one pass finds them all
    found = placed_customers(spark, sf_dir).groupBy("region").pivot("segment", SEGMENTS).agg(*totals())
    return found.toDF(*[c.lower() for c in found.columns])


@query(
    "agg_user_defined",
    """select event_type, round(exp(avg(ln(value)) filter (where value > 0)), 6) * (count(*) filter (where value = 0) = 0)::integer as geometric_mean from events group by event_type""",
)
def agg_user_defined(spark, sf_dir):
    found = aggregate(table(spark, sf_dir, "events").select("event_type", "value"), ["event_type"], GeometricMean("value"))
    return found.withColumn("geometric_mean", F.round("geometric_mean", 6))


@query(
    "agg_mode",
    """with c as (select user_id, event_type, count(*) as n from events group by all)
       select user_id, max(n) as n, list(event_type order by event_type) filter (where n = high) as modes
       from (select *, max(n) over (partition by user_id) as high from c) group by user_id""",
)
def agg_mode(spark, sf_dir):
    return modes(table(spark, sf_dir, "events"), ["user_id"], "event_type")


@query(
    "udf_table_function",
    """with e as (select user_id, ts, event_type, row_number() over (partition by user_id order by ts) - row_number() over (partition by user_id, event_type order by ts) as run from events)
       select user_id, min(ts) as ts, event_type, count(*) as length from e group by user_id, event_type, run
       union all select user_id, null, null, -count(*) from events group by user_id""",
)
def udf_table_function(spark, sf_dir):
    return stretches(table(spark, sf_dir, "events").select("user_id", "ts", "event_type"), "user_id", "ts", "event_type")


def order_kinds(spark, sf_dir):
    """(status, priority) of orders before and after a date, with repeated rows and nulls."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderdate", "o_orderstatus", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    early = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    return rows.filter(early).drop("o_orderdate"), rows.filter(~early).drop("o_orderdate")


KINDS_SQL = """with k as (select o_orderdate < timestamp '2000-01-01' as early, o_orderstatus, nullif(o_orderpriority, '5-LOW') as priority from orders)
select o_orderstatus, priority from k where {} {} all select o_orderstatus, priority from k where {}"""


@query("set_intersect_all", KINDS_SQL.format("early", "intersect", "not early"))
def set_intersect_all(spark, sf_dir):
    # Spark counts each row on both sides in one exchange and repeats it as often as both have it
    early, late = order_kinds(spark, sf_dir)
    return early.intersectAll(late)


@query("set_except_all", KINDS_SQL.format("early", "except", "not early"))
def set_except_all(spark, sf_dir):
    early, late = order_kinds(spark, sf_dir)
    return early.exceptAll(late)
