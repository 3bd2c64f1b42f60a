"""Participation counts: how many students, teachers and reports each kind of training touched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsondoc import station_count, to_json_text

ONLINE, DEVICE = 0, 2


def base_counts(t: dict[str, DataFrame]) -> DataFrame:
    """(metric, n): every base count once; each later figure is arithmetic on these few rows.

    ``t`` holds score(sheet, grader), learn(sheet, type), schedule(id), schedule_std(schedule_id, std_id),
    schedule_teacher(schedule_id, teacher_id), tasks(schedule_id), question_send(sg_id, type), question_vote(id),
    student_report, admin_report(report) and examiner_report.
    """
    rows = F.count(F.lit(1))

    def spread(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
        return df.agg(*[c.cast("bigint").alias(m) for m, c in counts.items()]).unpivot([], list(counts), "metric", "n")

    # joins run on rows per key, so that a sheet or schedule with very many rows is one row by then
    per_sheet = t["score"].groupBy("sheet").agg(rows.alias("rows"))
    trained = per_sheet.join(t["learn"].filter(F.col("type").isin(ONLINE, DEVICE)), "sheet")
    of_type = lambda kind: F.coalesce(F.sum(F.when(F.col("type") == kind, F.col("rows"))), F.lit(0))
    task_set = t["tasks"].filter(F.col("schedule_id").isNotNull()).select("schedule_id").distinct()
    per_schedule = t["schedule_std"].groupBy("schedule_id").agg(rows.alias("rows"))
    parts = [
        spread(trained, {"online": of_type(ONLINE), "device": of_type(DEVICE)}),
        spread(t["score"], {"peer": F.count("grader")}),
        spread(task_set, {"task_schedules_set": rows}),
        spread(t["tasks"], {"task_null": F.coalesce(F.max(F.col("schedule_id").isNull().cast("int")), F.lit(0))}),
        spread(per_schedule.join(task_set, "schedule_id", "left_semi"), {"std_with_task": F.coalesce(F.sum("rows"), F.lit(0))}),
        spread(t["schedule_std"], {"std": rows}),
        spread(t["schedule_teacher"], {"teacher": rows}),
        spread(t["schedule"], {"schedule": rows}),
        spread(
            t["question_send"],
            {
                "send_all": F.count_if(F.col("sg_id").isNull() & (F.col("type") == 0)),
                "send_quick": F.count_if(F.col("type") == 1),
            },
        ),
        spread(t["question_vote"], {"vote": rows}),
        spread(t["student_report"], {"student_report": rows}),
        spread(t["admin_report"], {"admin_report": rows}),
        spread(t["examiner_report"], {"examiner_report": rows}),
        spread(station_count(t["admin_report"]), {"stations": F.max("stations")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def participation(t: dict[str, DataFrame]) -> DataFrame:
    """One row with the three structs ``student``, ``teacher`` and ``report``."""
    n = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("n")))
    base = base_counts(t).agg(
        *[
            n(m).alias(m)
            for m in (
                "online device peer task_schedules_set task_null std_with_task std teacher schedule send_all send_quick "
                "vote student_report admin_report examiner_report stations"
            ).split()
        ]
    )
    c = F.col
    # a null schedule is one more distinct value
    tasks = c("task_schedules_set") + c("task_null")
    # The JSON keys of the stored document, in their order.
    student = {
        "stu_bjkh": c("std") + c("send_all") + c("send_quick") + c("vote"),
        "stu_zxxl": c("online"),
        "stu_bjkqxl": c("std_with_task"),
        "stu_bjktxl": c("std"),
        "stu_tbhz": c("peer"),
        "stu_ksznsb": c("device"),
        "stu_osce_student": c("student_report"),
        "stu_osce_admin": c("student_report"),
        "stu_osce_examiner": c("student_report") * c("stations"),
    }
    teacher = {
        "teacher_zxxl": c("online"),
        "teacher_bjkqxl": tasks,
        "teacher_bjktxl": c("teacher"),
        "teacher_tbhz": c("peer"),
        "teacher_ksznsb": c("device"),
        "teacher_bjkh": c("teacher"),
        "teacher_osce_examiner": c("examiner_report"),
        "teacher_osce_admin": c("admin_report"),
        "teacher_osce_student": c("student_report"),
    }
    report = {
        "report_zxxl": c("online"),
        "report_bjkqxl": tasks,
        "report_bjktxl": c("schedule"),
        "report_tbhz": c("peer"),
        "report_ksznsb": c("device"),
        "report_bjkh": c("schedule"),
        "report_osce_examiner": c("examiner_report"),
        "report_osce_admin": c("admin_report"),
        "report_osce_student": c("student_report"),
    }

    def block(name: str, fields: dict[str, Column]) -> Column:
        total = reduce(Column.__add__, fields.values())
        return F.struct(*[v.alias(k) for k, v in fields.items()], total.alias(f"{name}_count")).alias(name)

    return base.select(block("student", student), block("teacher", teacher), block("report", report))


def participation_long(t: dict[str, DataFrame]) -> DataFrame:
    """(metric, n) rows of all thirty figures."""
    flat = participation(t).select("student.*", "teacher.*", "report.*")
    return flat.unpivot([], flat.columns, "metric", "n")


def participation_json(t: dict[str, DataFrame], load_time: Column) -> DataFrame:
    """The stored form: one row (id, counts, createts, updatets)."""
    return participation(t).select(
        F.lit(1).cast("bigint").alias("id"),
        to_json_text(F.struct("student", "teacher", "report")).alias("counts"),
        load_time.alias("createts"),
        load_time.alias("updatets"),
    )
