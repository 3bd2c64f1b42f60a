"""Windows over large groups and as-of joins; a third to half of all rows have one key."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.ordered import LargeGroups, asof_join, ranked
from millrace.registry import query
from millrace.session import table


def half_hot(spark, sf_dir):
    """Events, every second one with the same key."""
    key = F.when(F.col("event_id") % 2 == 0, "all").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", key.alias("key"), "ts", F.col("value").cast("decimal(18,2)").alias("value"))


HALF_HOT_SQL = "with h as (select event_id, case when event_id % 2 = 0 then 'all' else event_type end as key, ts, value::decimal(18,2) as value from events) "


@query(
    "win_running",
    HALF_HOT_SQL
    + """select event_id, key, row_number() over w as nth, (sum(value) over w)::double as total from h
         window w as (partition by key order by ts, event_id rows unbounded preceding)""",
)
def win_running(spark, sf_dir):
    groups = LargeGroups(half_hot(spark, sf_dir), ["key"], [F.col("ts"), F.col("event_id")])
    return groups.running({"total": F.col("value")}, "nth").select("event_id", "key", "nth", F.col("total").cast("double").alias("total"))


@query(
    "win_frame",
    HALF_HOT_SQL
    + """select event_id, key, (lag(value, 2) over w)::double as two_before, (sum(value) over (w rows 4 preceding))::double as last_five,
                (max(value) over (w rows between 3 preceding and 1 preceding))::double as high from h window w as (partition by key order by ts, event_id)""",
)
def win_frame(spark, sf_dir):
    groups = LargeGroups(half_hot(spark, sf_dir), ["key"], [F.col("ts"), F.col("event_id")])

    def outputs(part: Window):
        return {
            "two_before": F.lag("value", 2).over(part).cast("double"),
            "last_five": F.sum("value").over(part.rowsBetween(-4, 0)).cast("double"),
            "high": F.max("value").over(part.rowsBetween(-3, -1)).cast("double"),
        }

    return groups.nearby(outputs, 4).select("event_id", "key", "two_before", "last_five", "high")


@query(
    "win_rank",
    HALF_HOT_SQL
    + """select event_id, key, row_number() over (partition by key order by round(value, 0) desc, event_id) as row_number,
                rank() over (partition by key order by round(value, 0) desc) as rank from h""",
)
def win_rank(spark, sf_dir):
    return ranked(half_hot(spark, sf_dir), ["key"], F.round("value", 0), [F.col("event_id")], descending=True).select("event_id", "key", "row_number", "rank")


# Orders and events of one person; every third row of both belongs to person 1. Orders are moved into the month of the events.
ASOF_SQL = """
with o as (select o_orderkey, case when o_orderkey % 3 = 0 then 1 else o_custkey end as person,
                  timestamp '2024-01-01' + to_days(((epoch(o_orderdate)::bigint // 86400) % 30)::integer) + to_seconds(o_orderkey % 86400) as ordered_at from orders),
e as (select event_id, case when event_id % 3 = 0 then 1 else user_id end as person, ts, event_type from events),
both_sides as (select person, ordered_at as t, 1 as side, null as event_id, null as ts, null as event_type, o_orderkey from o
               union all select person, ts, 0, event_id, ts, event_type, null from e),
filled as (select o_orderkey, person, t, last_value(event_id ignore nulls) over w as event_id, last_value(ts ignore nulls) over w as ts, last_value(event_type ignore nulls) over w as event_type
           from both_sides window w as (partition by person order by t, side, event_id, o_orderkey rows unbounded preceding))
"""


def asof_sides(spark, sf_dir):
    day = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) / 86400
    seconds = F.floor(day) % 30 * 86400 + F.col("o_orderkey") % 86400
    ordered = (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("timestamp_ntz")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).alias("person"), ordered.alias("ordered_at"))
    events = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id")).alias("person"), "ts", "event_type")
    return orders, events


@query("join_asof", ASOF_SQL + "select o_orderkey, person, t as ordered_at, event_id, ts, event_type from filled where o_orderkey is not null")
def join_asof(spark, sf_dir):
    orders, events = asof_sides(spark, sf_dir)
    return asof_join(orders, events, ["person"], "ordered_at", "ts", "event_id")


@query(
    "join_asof_tolerance",
    ASOF_SQL
    + """select o_orderkey, person, t as ordered_at, case when ts + interval 2 hour >= t then event_id end as event_id, case when ts + interval 2 hour >= t then ts end as ts,
                case when ts + interval 2 hour >= t then event_type end as event_type from filled where o_orderkey is not null""",
)
def join_asof_tolerance(spark, sf_dir):
    orders, events = asof_sides(spark, sf_dir)
    return asof_join(orders, events, ["person"], "ordered_at", "ts", "event_id", tolerance=F.expr("interval 2 hours"))
