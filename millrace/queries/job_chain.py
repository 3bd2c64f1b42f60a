"""Two analytics jobs from end to end: load the warehouse, find the active tables, compute over the loaded text columns, replace the result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import epoch_seconds, from_epoch
from millrace.ingest.run import ingest
from millrace.ingest.specs import WAREHOUSE
from millrace.plans.progress_curve import progress_curve, progress_curve_stored
from millrace.plans.score_summary import score_summary, score_summary_json
from millrace.queries import roles
from millrace.queries.ingest_queries import LOADED_AT, target_table
from millrace.queries.jobs import comparable, job_progress_curve_stored, job_score_summary_stored
from millrace.registry import ORACLES, query
from millrace.session import scratch_name, scratch_path
from millrace.sinks.writers import create_table, truncate_load
from millrace.sources.catalog import active_table


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The operational tables in the layout of the warehouse's sources."""
    then = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    nothing = F.lit(None).cast("string")
    scores = roles.scores(spark, sf_dir).select(
        F.xxhash64("sheet", "starttime", "score").alias("id"), "starttime", "endtime", F.col("person").alias("operatorstudentid"),
        nothing.alias("graderstudentid"), F.col("sheet").alias("scoresheetcode"), F.col("score").alias("totalscore"), F.col("endtime").alias("updatetime"),
    )
    learn = roles.learn(spark, sf_dir).select(
        F.col("sheet").alias("id"), F.lit("training").alias("name"), F.lit(1).alias("status"), "type", F.col("sheet").alias("scoresheetcode"), then.alias("updated_at")
    )
    windows = roles.windows(spark, sf_dir).select(
        F.xxhash64("person", "start_dt").alias("id"), nothing.alias("place_id"), nothing.alias("learn_id"), F.col("person").alias("std_id"),
        epoch_seconds(F.col("start_dt")).alias("start_dt"), epoch_seconds(F.col("end_dt")).alias("end_dt"), "status", nothing.alias("type"), then.alias("updated_at"),
    )
    exams = roles.exam_scores(spark, sf_dir)
    given = {"examineeid": F.col("person"), "examid": F.col("exam"), "totalscore": F.col("score"), "id": F.xxhash64("exam", "person", "score"), "updatetime": then}
    spec = WAREHOUSE["ets_osce_score"]
    exams = exams.select(*[given.get(c, nothing).alias(c) for c in spec.hashed])
    reports = roles.reports(spark, sf_dir).select(F.col("event_id").alias("adminid"), nothing.alias("examid"), "report", then.alias("creattime"))
    return {"ets_score": scores, "ets_learn": learn, "ets_apply_student": windows, "ets_osce_score": exams, "ets_osce_das_admin_report": reports}


def loaded_tables(spark: SparkSession, sf_dir: str, targets: list[str]) -> DataFrame:
    """Load ``targets`` and return the control table that names the copy in use for each."""
    sources, routes = _sources(spark, sf_dir), []
    for target in targets:
        name = target_table(spark, WAREHOUSE[target])
        ingest(sources[target], name, WAREHOUSE[target], LOADED_AT)
        routes.append((target, name))
    return spark.createDataFrame(routes, "taskname string, which_for_cs string")


def typed(spark: SparkSession, control: DataFrame, target: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """The active copy of ``target`` with its text columns cast: new name -> (column, type)."""
    held = spark.table(active_table(control, target))
    return held.select(*[F.col(c).cast(kind).alias(name) for name, (c, kind) in columns.items()])


def warehouse_scores(spark: SparkSession, control: DataFrame) -> DataFrame:
    columns = {
        "sheet": ("scoresheetcode", "bigint"), "person": ("operatorstudentid", "bigint"), "starttime": ("starttime", "timestamp_ntz"),
        "endtime": ("endtime", "timestamp_ntz"), "score": ("totalscore", "decimal(18,3)"),
    }
    return typed(spark, control, "ets_score", columns)


def warehouse_learn(spark: SparkSession, control: DataFrame) -> DataFrame:
    return typed(spark, control, "ets_learn", {"sheet": ("scoresheetcode", "bigint"), "type": ("type", "int")})


def warehouse_windows(spark: SparkSession, control: DataFrame) -> DataFrame:
    columns = {"person": ("std_id", "bigint"), "status": ("status", "int"), "start_dt": ("start_dt", "bigint"), "end_dt": ("end_dt", "bigint")}
    held = typed(spark, control, "ets_apply_student", columns)
    return held.withColumns({c: from_epoch(F.col(c)) for c in ("start_dt", "end_dt")})


def result_table(spark: SparkSession, result: DataFrame, keep_if_empty: bool) -> DataFrame:
    """Replace the result table's content and return it."""
    name = scratch_name("cs_result")
    create_table(spark, name, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in result.schema), scratch_path(spark, "cs-result"))
    truncate_load(result, name, keep_if_empty)
    return spark.table(name)


@query("job_progress_curve_chain", ORACLES[job_progress_curve_stored.__name__])
def job_progress_curve_chain(spark, sf_dir):
    control = loaded_tables(spark, sf_dir, ["ets_score", "ets_learn", "ets_apply_student", "ets_osce_score"])
    exams = typed(
        spark, control, "ets_osce_score", {"exam": ("examid", "string"), "person": ("examineeid", "bigint"), "score": ("totalscore", "decimal(18,3)")}
    )
    curve = progress_curve(warehouse_scores(spark, control), warehouse_learn(spark, control), warehouse_windows(spark, control), exams)
    # the program leaves the old curves when there is nothing to write
    return result_table(spark, progress_curve_stored(curve, F.lit(LOADED_AT)), keep_if_empty=True)


@query("job_score_summary_chain", ORACLES[job_score_summary_stored.__name__])
def job_score_summary_chain(spark, sf_dir):
    control = loaded_tables(spark, sf_dir, ["ets_score", "ets_learn", "ets_apply_student", "ets_osce_das_admin_report"])
    reports = typed(spark, control, "ets_osce_das_admin_report", {"event_id": ("adminid", "bigint"), "report": ("report", "string")})
    summary = score_summary(warehouse_scores(spark, control), warehouse_learn(spark, control), warehouse_windows(spark, control), reports)
    return result_table(spark, score_summary_json(comparable(summary), F.lit(LOADED_AT)), keep_if_empty=False)
