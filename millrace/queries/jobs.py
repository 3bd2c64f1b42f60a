"""The analytics jobs on the warehouse roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.skew import number_rows
from millrace.plans.participation import participation_json, participation_long
from millrace.plans.progress_curve import progress_curve, progress_curve_all5, progress_curve_stored
from millrace.plans.score_summary import EXAM, GROUPS, score_summary, score_summary_json
from millrace.queries import roles
from millrace.registry import query
from millrace.session import table

def _stamp():
    return F.lit("2024-05-06 07:08:09")


def comparable(summary):
    """The mean of the exam scores at six places: numbers are added up in another order by SQL."""
    of_exams = (F.col("grp") == EXAM) & (F.col("metric") == "avg")
    return summary.withColumn("value", F.when(of_exams, F.round("value", 6)).otherwise(F.col("value")))


def _summary(spark, sf_dir):
    found = score_summary(
        roles.scores(spark, sf_dir), roles.learn(spark, sf_dir), roles.windows(spark, sf_dir), roles.reports(spark, sf_dir)
    )
    return comparable(found)


SUMMARY_SQL = f"""
with {roles.ROLE_SQL},
g as (
  select case l.type when 0 then 'zxxl' when 1 then 'ksmxr' when 2 then 'znsb' end as grp, s.person as id,
         cast(null as varchar) as name, s.score, s.score::double as mark from scores s join learn l on s.sheet = l.sheet
  union all select 'khxl', person, null, score, score::double from after_class
  union all select 'osce', null, name, null, score from rankings),
m as (
  select grp, coalesce(max(mark), 0) as a, coalesce(min(mark), 0) as b,
         coalesce(case when grp = 'osce' then round(avg(mark), 6) else sum(score)::double / nullif(count(score), 0) end, 0) as c from g group by grp),
r as (
  select grp, id, name, mark as score,
         row_number() over (partition by grp order by mark desc nulls last, id nulls last, name nulls last) as rn from g)
"""


@query(
    "job_score_summary",
    f"""{SUMMARY_SQL}
select grp, 'max' as metric, a as value, cast(null as varchar) as who from m
union all select grp, 'min', b, null from m
union all select grp, 'avg', c, null from m
union all select grp, 'rank' || rn, score::double, coalesce(name, id::varchar) from r where rn <= 5
""",
)
def job_score_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def _stored_group_sql(grp: str) -> str:
    """One group's fields of the stored document, from the oracle's tables."""
    if grp == "osce":
        shown, average, who = "score::double", "c", "'name': name"
    else:
        shown, average, who = "score::decimal(25,3)::varchar", "c::decimal(25,7)::varchar", "'id': id"
    one = lambda x: f"(select {x} from m where grp = '{grp}')"
    top = f"(select list({{{who}, 'score': {shown}}} order by rn) from r where grp = '{grp}' and rn <= 5)"
    value = lambda x: one(x) if grp == "osce" else one(f"{x}::decimal(25,3)::varchar")
    return (
        f"'{grp}': {{'{grp}_maxscore': {value('a')}, '{grp}_minscore': {value('b')}, "
        f"'{grp}_avgscore': {one(average)}, '{grp}_rank5': {top}}}"
    )


@query(
    "job_score_summary_stored",
    f"""{SUMMARY_SQL} select 1::bigint as id, to_json({{{", ".join(_stored_group_sql(g) for g in GROUPS)}}})::varchar as scores,
        '2024-05-06 07:08:09' as createts, '2024-05-06 07:08:09' as updatets""",
)
def job_score_summary_stored(spark, sf_dir):
    return score_summary_json(_summary(spark, sf_dir), _stamp())


def participation_tables(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    orders, events = t("orders"), t("events")
    kind = F.col("event_type")
    return {
        "score": t("lineitem").select(
            F.col("l_orderkey").alias("sheet"), F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).alias("grader")
        ),
        "learn": roles.learn(spark, sf_dir),
        "schedule": t("part").select(F.col("p_partkey").alias("id")),
        "schedule_std": t("customer").select(F.col("c_custkey").alias("schedule_id"), F.col("c_custkey").alias("std_id")),
        "schedule_teacher": t("supplier").select(F.col("s_nationkey").alias("schedule_id"), F.col("s_suppkey").alias("teacher_id")),
        "tasks": orders.select(F.col("o_custkey").alias("schedule_id")),
        "question_send": events.select(
            F.when(kind != "view", F.col("user_id")).alias("sg_id"), F.when(kind == "click", 1).otherwise(0).alias("type")
        ),
        "question_vote": events.filter(kind == "purchase").select(F.col("event_id").alias("id")),
        "student_report": t("conversations").select("conv_id"),
        "admin_report": roles.reports(spark, sf_dir).select("report"),
        "examiner_report": t("pages").select("page_id"),
    }


COUNTS_SQL = """
with b as (select
  (select count(*) from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F') as online,
  (select count(*) from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'P') as device,
  (select count(*) from lineitem where l_returnflag = 'R') as peer,
  (select count(distinct o_custkey) from orders) as tasks,
  (select count(*) from customer where c_custkey in (select o_custkey from orders)) as std_task,
  (select count(*) from customer) as std, (select count(*) from supplier) as teacher, (select count(*) from part) as schedule,
  (select count(*) from events where event_type = 'view') as send_all,
  (select count(*) from events where event_type = 'click') as send_quick,
  (select count(*) from events where event_type = 'purchase') as vote,
  (select count(*) from conversations) as s_rep, (select count(*) from events) as a_rep, (select count(*) from pages) as e_rep,
  (select greatest(1, sum(cast(json_extract_string(props, '$.k') as integer) % 4))::bigint from events) as stations),
f as (
  select 'stu' as who, 'stu_bjkh' as metric, std + send_all + send_quick + vote as n from b
  union all select 'stu', 'stu_zxxl', online from b union all select 'stu', 'stu_bjkqxl', std_task from b
  union all select 'stu', 'stu_bjktxl', std from b union all select 'stu', 'stu_tbhz', peer from b
  union all select 'stu', 'stu_ksznsb', device from b union all select 'stu', 'stu_osce_student', s_rep from b
  union all select 'stu', 'stu_osce_admin', s_rep from b union all select 'stu', 'stu_osce_examiner', s_rep * stations from b
  union all select 'tea', 'teacher_zxxl', online from b union all select 'tea', 'teacher_bjkqxl', tasks from b
  union all select 'tea', 'teacher_bjktxl', teacher from b union all select 'tea', 'teacher_tbhz', peer from b
  union all select 'tea', 'teacher_ksznsb', device from b union all select 'tea', 'teacher_bjkh', teacher from b
  union all select 'tea', 'teacher_osce_examiner', e_rep from b union all select 'tea', 'teacher_osce_admin', a_rep from b
  union all select 'tea', 'teacher_osce_student', s_rep from b
  union all select 'rep', 'report_zxxl', online from b union all select 'rep', 'report_bjkqxl', tasks from b
  union all select 'rep', 'report_bjktxl', schedule from b union all select 'rep', 'report_tbhz', peer from b
  union all select 'rep', 'report_ksznsb', device from b union all select 'rep', 'report_bjkh', schedule from b
  union all select 'rep', 'report_osce_examiner', e_rep from b union all select 'rep', 'report_osce_admin', a_rep from b
  union all select 'rep', 'report_osce_student', s_rep from b)
"""


@query(
    "job_participation_counts",
    f"""{COUNTS_SQL}
select metric, n::bigint as n from f
union all
select case who when 'stu' then 'student_count' when 'tea' then 'teacher_count' else 'report_count' end, sum(n)::bigint from f group by who
""",
)
def job_participation_counts(spark, sf_dir):
    return participation_long(participation_tables(spark, sf_dir))


def _stored_block_sql(name: str, short: str, keys: str) -> str:
    """One block of the stored document, from the oracle's tables."""
    fields = [f"'{k}': (select n from f where metric = '{k}')" for k in keys.split()]
    total = f"'{name}_count': (select sum(n)::bigint from f where who = '{short}')"
    return f"'{name}': {{{', '.join([*fields, total])}}}"


_KINDS = "zxxl bjkqxl bjktxl tbhz ksznsb bjkh osce_examiner osce_admin osce_student"
STORED_COUNTS = [
    _stored_block_sql(
        "student",
        "stu",
        "stu_bjkh stu_zxxl stu_bjkqxl stu_bjktxl stu_tbhz stu_ksznsb stu_osce_student stu_osce_admin stu_osce_examiner",
    ),
    _stored_block_sql("teacher", "tea", " ".join(f"teacher_{k}" for k in _KINDS.split())),
    _stored_block_sql("report", "rep", " ".join(f"report_{k}" for k in _KINDS.split())),
]


@query(
    "job_participation_counts_stored",
    f"""{COUNTS_SQL} select 1::bigint as id, to_json({{{", ".join(STORED_COUNTS)}}})::varchar as counts,
        '2024-05-06 07:08:09' as createts, '2024-05-06 07:08:09' as updatets""",
)
def job_participation_counts_stored(spark, sf_dir):
    return participation_json(participation_tables(spark, sf_dir), _stamp())


CURVE_SQL = f"""
with {roles.ROLE_SQL},
t as (
  select s.person, case l.type when 0 then 1 when 2 then 2 when 1 then 4 end as bit, s.score
  from scores s join learn l on s.sheet = l.sheet
  union all select person, 8, score from after_class),
exams as (select person, exam, sum(score) as score from exam_scores group by 1, 2),
p as (
  select person, bit_or(bit) as present,
         max(case when bit = 1 then score end) as s1, max(case when bit = 2 then score end) as s2,
         max(case when bit = 4 then score end) as s3, max(case when bit = 8 then score end) as s4
  from (select person, bit, score from t union all select distinct person, 16, cast(null as decimal(18,3)) from exams) group by person),
masks as (select cast(m as integer) as mask from range(0, 32) r(m) where bit_count(m::integer) >= 3),
every as (
  select p.*, m.mask, e.exam, e.score as s5,
    case when mask & 1 <> 0 and coalesce(s1, 0) <> 0 then 1 else 0 end + case when mask & 2 <> 0 and coalesce(s2, 0) <> 0 then 1 else 0 end
  + case when mask & 4 <> 0 and coalesce(s3, 0) <> 0 then 1 else 0 end + case when mask & 8 <> 0 and coalesce(s4, 0) <> 0 then 1 else 0 end
  + case when mask & 16 <> 0 and coalesce(e.score, 0) <> 0 then 1 else 0 end as flag
  from p join masks m on (m.mask & present) = m.mask left join exams e on e.person = p.person and m.mask & 16 <> 0),
shown as (
  select *, max(flag) over (partition by person) as top,
    case when mask & 1 <> 0 then coalesce('"' || s1 || '"', 'null') else '""' end as j1,
    case when mask & 2 <> 0 then coalesce('"' || s2 || '"', 'null') else '""' end as j2,
    case when mask & 4 <> 0 then coalesce('"' || s3 || '"', 'null') else '""' end as j3,
    case when mask & 8 <> 0 then coalesce('"' || s4 || '"', 'null') else '""' end as j4,
    case when mask & 16 <> 0 then coalesce('"' || cast(s5 as decimal(18,3)) || '"', 'null') else '""' end as j5
  from every)
"""

CURVE_JSON = """'{"kqselftraining":' || j1 || ',"ksrobottraining":' || j2 || ',"ksmodeltraining":' || j3
              || ',"khselftraining":' || j4 || ',"osce":' || j5 || '}' as scores"""


def _curve(spark, sf_dir):
    return progress_curve(
        roles.scores(spark, sf_dir), roles.learn(spark, sf_dir), roles.windows(spark, sf_dir), roles.exam_scores(spark, sf_dir)
    )


@query("job_progress_curve", f"{CURVE_SQL} select person, mask, exam, {CURVE_JSON} from shown where flag = top")
def job_progress_curve(spark, sf_dir):
    return _curve(spark, sf_dir)


@query(
    "job_progress_curve_stored",
    f"""{CURVE_SQL} select row_number() over (order by person, mask, exam nulls first) as id, person as student_id,
        {CURVE_JSON}, '2024-05-06 07:08:09' as createts, '2024-05-06 07:08:09' as updatets from shown where flag = top""",
)
def job_progress_curve_stored(spark, sf_dir):
    return progress_curve_stored(_curve(spark, sf_dir), _stamp())


@query(
    "job_progress_curve_all5",
    f"""{CURVE_SQL} select row_number() over (order by person, exam) as id, person as student_id, exam,
        {CURVE_JSON} from shown where mask = 31""",
)
def job_progress_curve_all5(spark, sf_dir):
    return progress_curve_all5(
        roles.scores(spark, sf_dir), roles.learn(spark, sf_dir), roles.windows(spark, sf_dir), roles.exam_scores(spark, sf_dir)
    )


@query(
    "job_people_stats",
    """select row_number() over (order by c_acctbal desc, c_custkey) as row_id, c_custkey, c_acctbal,
              (select sum(cast(c_acctbal as decimal(18,2)))::double / count(*) from customer where c_mktsegment = 'BUILDING') as avg_balance
       from customer where c_mktsegment = 'BUILDING' and c_acctbal > 1750""",
)
def job_people_stats(spark, sf_dir):
    group = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_acctbal")
    average = group.agg((F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double") / F.count("c_acctbal")).alias("avg_balance"))
    tall = number_rows(group.filter(F.col("c_acctbal") > 1750), [F.col("c_acctbal").desc(), F.col("c_custkey")])
    # the average is one row
    return tall.select("row_id", "c_custkey", "c_acctbal", F.lit(average.first()["avg_balance"]).alias("avg_balance"))
