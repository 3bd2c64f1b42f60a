"""The warehouse roles played by the test tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.jsondoc import to_json_text
from millrace.functions.times import epoch_seconds, from_epoch
from millrace.session import cut_lineage, table


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts: sheet, person, starttime, endtime, score; written once, as the warehouse has them in one table."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sheet"),
        F.col("l_shipdate").alias("starttime"),
        F.col("l_extendedprice").cast("decimal(18,3)").alias("score"),
    )
    people = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sheet"), F.col("o_custkey").alias("person"))
    # the end follows from the start, so it does not pass the join
    ended = (F.col("starttime") + F.expr("interval 1 day")).alias("endtime")
    return cut_lineage(lines.join(people, "sheet").select("sheet", "starttime", ended, "score", "person"), "scores")


def learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets with their training type."""
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", 0).when(status == "O", 1).when(status == "P", 2)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sheet"), kind.alias("type"))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Granted training windows; the source keeps their edges as epoch seconds."""
    start = epoch_seconds(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person"),
        (F.col("o_orderstatus") == "F").cast("int").alias("status"),
        from_epoch(start).alias("start_dt"),
        from_epoch(start + 90 * 86400).alias("end_dt"),
    )


def exam_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station scores of exams; low values count as zero."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("exam"),
        F.col("user_id").alias("person"),
        F.when(F.col("value") < 60, 0.0).otherwise(F.col("value")).cast("decimal(18,3)").alias("score"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exam reports as JSON: a ranking list of two and some stations."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    name = F.concat(F.col("event_type"), F.lit("-"), F.col("event_id").cast("string"))

    def entry(ranking: int, score, suffix: str):
        return F.struct(F.lit(ranking).alias("ranking"), score.alias("score"), F.concat(name, F.lit(suffix)).alias("name"))

    ranking = F.array(entry(1, F.col("value"), "a"), entry(2, F.col("value") / 8, "b"))
    stations = F.array_repeat(F.lit("station"), k % 4)
    body = F.struct(ranking.alias("rankinglist"), F.struct(stations.alias("stationarray")).alias("analysis"))
    return events.select("event_id", to_json_text(body).alias("report"))


ROLE_SQL = """
scores as (
  select l.l_orderkey as sheet, o.o_custkey as person, l.l_shipdate as starttime,
         l.l_shipdate + interval 1 day as endtime, cast(l.l_extendedprice as decimal(18,3)) as score
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey),
learn as (
  select o_orderkey as sheet, case o_orderstatus when 'F' then 0 when 'O' then 1 when 'P' then 2 end as type from orders),
windows as (
  select o_custkey as person, case when o_orderstatus = 'F' then 1 else 0 end as status,
         o_orderdate as start_dt, o_orderdate + interval 90 day as end_dt from orders),
exam_scores as (
  select event_type as exam, user_id as person,
         cast(case when value < 60 then 0 else value end as decimal(18,3)) as score from events),
rankings as (
  select value as score, event_type || '-' || event_id || 'a' as name from events
  union all
  select value / 8, event_type || '-' || event_id || 'b' from events),
after_class as (
  select s.person, s.score from scores s join windows w on s.person = w.person
  where w.status = 1 and s.starttime >= w.start_dt and s.endtime <= w.end_dt)
"""
