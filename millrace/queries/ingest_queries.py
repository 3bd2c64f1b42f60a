"""Incremental ingestion on the orders, events and customer tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fingerprint import row_md5
from millrace.ingest.run import ingest, pull, read_watermark, stamp, watermark
from millrace.ingest.specs import WAREHOUSE, IngestSpec, labelled
from millrace.ingest.stream import Feed, ingest_stream
from millrace.registry import query
from millrace.session import scratch_name, scratch_path, table
from millrace.sinks.writers import append_by_name, create_table
from millrace.streaming.counts import drain
from millrace.streaming.sources import parquet_files

CUT = "2000-01-01"
LOADED_AT = "2024-05-06 07:08:09"

ORDERS = IngestSpec(
    "ets_orders",
    ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "o_orderdate",
    labelled("Orders", 5),
    "o_orderkey",
)
EVENTS = IngestSpec(
    "ets_events",
    ["event_id", "user_id", "event_type", "props"],
    "ts",
    labelled("Events", 5),
    "event_id",
)
CUSTOMERS = IngestSpec(
    "ets_customer",
    ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    None,
    labelled("Customer", 4),
    "c_custkey",
)

ORDERS_SQL = """
  select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderstatus, o_orderpriority,
         '1' as cust_no, '1' as isvalid,
         md5('Orders.' || o_orderkey || '|Orders.' || o_custkey || '|Orders.' || o_orderstatus || '|Orders.' || o_orderpriority
             || '|Orders.' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) as src_fields_md5,
         '2024-05-06 07:08:09' as createts, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as updatets from orders
"""


def target_table(spark, spec):
    name = scratch_name(spec.target)
    create_table(spark, name, ", ".join(f"{c} string" for c in spec.layout), scratch_path(spark, spec.target))
    return name


def until_cut(orders):
    return orders.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))


def half_loaded(spark, sf_dir):
    """Orders, and a target that holds those before the cut date."""
    orders = table(spark, sf_dir, "orders")
    name = target_table(spark, ORDERS)
    ingest(until_cut(orders), name, ORDERS, LOADED_AT)
    return orders, name


@query("etl_watermark_max", "select max(o_orderdate) as max from orders where o_orderdate < timestamp '2000-01-01'")
def etl_watermark_max(spark, sf_dir):
    _, name = half_loaded(spark, sf_dir)
    return watermark(spark.table(name))


@query(
    "etl_incremental_pull",
    """select o_orderkey, o_orderdate from orders
       where o_orderdate > (select max(o_orderdate) from orders where o_orderdate < timestamp '2000-01-01')""",
)
def etl_incremental_pull(spark, sf_dir):
    orders, name = half_loaded(spark, sf_dir)
    return pull(orders, ORDERS, read_watermark(spark.table(name))).select("o_orderkey", "o_orderdate")


@query("etl_incremental_pull_inclusive", ORDERS_SQL)
def etl_incremental_pull_inclusive(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    name = target_table(spark, ORDERS)
    early = until_cut(orders)
    # one boundary row is held back: the strict form would lose it for ever
    edge = early.agg(F.max("o_orderdate").alias("d"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("k")).first()
    append_by_name(stamp(pull(early.filter(F.col("o_orderkey") != edge["k"]), ORDERS, None), ORDERS, LOADED_AT), name)
    ingest(orders, name, ORDERS, LOADED_AT, inclusive=True)
    # a repeat finds the boundary rows already loaded
    ingest(orders, name, ORDERS, LOADED_AT, inclusive=True)
    return spark.table(name)


@query(
    "etl_full_refresh",
    """select c_custkey::varchar as c_custkey, c_name, c_nationkey::varchar as c_nationkey, c_mktsegment, '1' as cust_no, '1' as isvalid,
              md5('Customer.' || c_custkey || '|Customer.' || c_name || '|Customer.' || c_nationkey || '|Customer.' || c_mktsegment)
              as src_fields_md5, '2024-05-06 07:08:09' as createts, '2024-05-06 07:08:09' as updatets from customer""",
)
def etl_full_refresh(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    name = target_table(spark, CUSTOMERS)
    ingest(customers.filter("c_acctbal > 0"), name, CUSTOMERS, "2024-01-01 00:00:00")
    ingest(customers, name, CUSTOMERS, LOADED_AT)
    return spark.table(name)


@query("etl_stamp_row", ORDERS_SQL)
def etl_stamp_row(spark, sf_dir):
    return stamp(pull(table(spark, sf_dir, "orders"), ORDERS, None), ORDERS, LOADED_AT)


@query(
    "etl_row_md5",
    """select event_id, md5('Events.' || event_id || '|Events.' || coalesce(nullif(event_type, 'view'), 'None') || '|Events.' ||
              strftime(ts, '%Y-%m-%d %H:%M:%S') || case when microsecond(ts) % 1000000 = 0 then '' else strftime(ts, '.%f') end) as digest
       from events""",
)
def etl_row_md5(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"), "ts"
    )
    digest = row_md5(labelled("Events", 3), ["event_id", "event_type", "ts"], events.schema)
    return events.select("event_id", digest.alias("digest"))


@query(
    "etl_row_count",
    """select count(*) filter (where o_orderdate < timestamp '2000-01-01') as first_load,
              count(*) filter (where o_orderdate >= timestamp '2000-01-01') as second_load from orders""",
)
def etl_row_count(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    name = target_table(spark, ORDERS)
    first = ingest(until_cut(orders), name, ORDERS, LOADED_AT)
    second = ingest(orders, name, ORDERS, LOADED_AT)
    return spark.range(1).select(F.lit(first).cast("bigint").alias("first_load"), F.lit(second).cast("bigint").alias("second_load"))


# What the test tables give to the warehouse tables: for each, the columns of its source after the key, in the order of the specification.
# Two tables change over time (one of them with fractions of a second), nulls are among the values.
FROM_ORDERS = ["o_custkey", "nullif(o_orderstatus, 'F')", "nullif(o_orderpriority, '5-LOW')", "o_orderdate"]
FROM_EVENTS = ["user_id", "nullif(event_type, 'view')", "props", "ts"]
ORDER_FED = [
    "ets_apply_student", "ets_gradeitem", "ets_osce_das_admin_report", "ets_osce_das_student_report", "ets_osce_exam_examinee", "ets_osce_station",
    "ets_questionvoterecord", "ets_schedule_std", "ets_score",
]

# The fingerprint of every table written out, ``{}`` for the text of a column.
FINGERPRINTS = {
    "ets_apply_student": "Apply_Student.{}|Apply_Student.{}|Apply_Student.{}|Apply_Student.{}Apply_Student.{}|Apply_Student.{}|Apply_Student.{}|Apply_Student.{}|Apply_Student.{}",
    "ets_gradeitem": "GradeItem.{}|GradeItem.{}|GradeItem.{}|GradeItem.{}",
    "ets_learn": "Learn.{}|Learn.{}|Learn.{}|Learn.{}|Learn.{}|Learn.{}",
    "ets_osce_das_admin_report": "osce_das_admin_report.{}|osce_das_admin_report.{}|osce_das_admin_report.{}|osce_das_admin_report.{}",
    "ets_osce_das_examiner_report": "osce_das_examiner_report.{}|osce_das_examiner_report.{}|osce_das_examiner_report.{}|osce_das_examiner_report.{}",
    "ets_osce_das_student_report": "osce_das_student_report.{}|osce_das_student_report.{}|osce_das_student_report.{}|osce_das_student_report.{}",
    "ets_osce_exam": "osce_exam.{}|osce_exam.{}|osce_exam.{}|osce_exam.{}|osce_exam.{}|osce_exam.{}",
    "ets_osce_exam_examinee": "GradeItem.{}|GradeItem.{}|GradeItem.{}",
    "ets_osce_score": "osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{}|osce_score.{} |osce_score.{}",
    "ets_osce_station": "osce_station.{}|osce_station.{}|osce_station.{}|osce_station.{}",
    "ets_questionsend": "QuestionSend.{}|QuestionSend.{}|QuestionSend.{}|QuestionSend.{}|QuestionSend.{}|QuestionSend.{}",
    "ets_questionvoterecord": "QuestionVoteRecord.{}|QuestionVoteRecord.{}|QuestionVoteRecord.{}|QuestionVoteRecord.{}",
    "ets_schedule": "Schedule.{}|Schedule.{}|Schedule.{}|Schedule.{}|Schedule.{}|Schedule.{}|Schedule.{}|Schedule.{}|Schedule.{}",
    "ets_schedule_std": "Schedule_Std.{}|Schedule_Std.{}|Schedule_Std.{}|Schedule_Std.{}",
    "ets_schedule_teacher": "Schedule_Teacher.{}|Schedule_Teacher.{}|Schedule_Teacher.{}|Schedule_Teacher.{}",
    "ets_score": "score.{}|Score.{}|Score.{}|Score.{}|Score.{}|Score.{}|Score.{}|Score.{}",
    "ets_tasks": "Tasks.{}|Tasks.{}|Tasks.{}",
}


def source_columns(target: str, columns: int) -> tuple[str, list[str], str]:
    """(test table, expressions of the key and the other columns, expression of the change time)."""
    if target in ORDER_FED:
        name, key, pool, changed = "orders", "o_orderkey", FROM_ORDERS, "o_orderdate"
    else:
        name, key, pool, changed = "events", "event_id", FROM_EVENTS, "ts"
    return name, [key, *(pool[i % len(pool)] for i in range(columns - 1))], changed


def _text_sql(expression: str) -> str:
    if expression in ("o_orderdate", "ts"):
        whole = f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"
        return f"({whole} || case when microsecond({expression}) % 1000000 = 0 then '' else strftime({expression}, '.%f') end)"
    return f"coalesce(({expression})::varchar, 'None')"


def _target_sql(target: str, columns: int, changes: bool) -> str:
    name, expressions, changed = source_columns(target, columns)
    texts = [_text_sql(e) for e in expressions + ([changed] if changes else [])]
    pieces = FINGERPRINTS[target].split("{}")
    assert len(pieces) == len(texts) + 1
    digest = " || ".join(f"'{piece}' || {text}" for piece, text in zip(pieces, texts))
    updated = _text_sql(changed) if changes else f"'{LOADED_AT}'"
    return f"select '{target}' as target, {expressions[0]}::varchar as key, md5({digest}) as src_fields_md5, {updated} as updatets from {name}"


SEVENTEEN_SQL = " union all ".join(_target_sql(t, len(s.columns), s.changed is not None) for t, s in WAREHOUSE.items())

#: Loads of different tables that run at the same time.
LOADS_AT_ONCE = 6


def shaped(target: str, spec: IngestSpec, source: DataFrame) -> DataFrame:
    """The columns of a warehouse table from the test table that feeds it."""
    _, expressions, changed = source_columns(target, len(spec.columns))
    picked = [F.expr(e).alias(c) for e, c in zip(expressions, spec.columns)]
    return source.select(*picked, *([F.col(changed).alias(spec.changed)] if spec.changed else []))


def change_times(source: DataFrame, changed: str, parts: int) -> list[Column]:
    """Times that cut the span of the changes into equal parts."""
    low, high = source.agg(F.unix_micros(F.min(changed).cast("timestamp")), F.unix_micros(F.max(changed).cast("timestamp"))).first()
    low, high = low or 0, high or 0
    return [F.timestamp_micros(F.lit(low + (high - low) * k // parts)).cast("timestamp_ntz") for k in range(1, parts)]


def all_targets(spark, tables: dict[str, str]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [spark.table(held).select(F.lit(t).alias("target"), F.col(WAREHOUSE[t].key).alias("key"), "src_fields_md5", "updatets") for t, held in tables.items()],
    )


@query("etl_seventeen_tables", SEVENTEEN_SQL)
def etl_seventeen_tables(spark, sf_dir):
    # one function loads every table of the warehouse from its specification: two batches by change time, or a full refresh
    sources = {name: table(spark, sf_dir, name) for name in ("orders", "events")}
    middle = {name: change_times(source, changed, 2)[0] for (name, source), changed in zip(sources.items(), ("o_orderdate", "ts"))}
    held = {target: target_table(spark, spec) for target, spec in WAREHOUSE.items()}

    def load(target):
        spec = WAREHOUSE[target]
        name = source_columns(target, len(spec.columns))[0]
        source = shaped(target, spec, sources[name])
        if spec.changed:
            ingest(source.filter(F.col(spec.changed) < middle[name]), held[target], spec, LOADED_AT)
        ingest(source, held[target], spec, LOADED_AT)

    with ThreadPoolExecutor(LOADS_AT_ONCE) as pool:
        list(pool.map(load, WAREHOUSE))
    return all_targets(spark, held)


class Stopped(Exception):
    """Ends a stream in the middle of a batch."""


def fed_in_waves(spark, source: DataFrame, changed: str, feeds: list[Feed], waves: int = 3) -> None:
    """The source arrives in waves; in the second, the stream fails with some tables written and is started again on the same checkpoint."""
    folder, checkpoint = scratch_path(spark, "wave"), scratch_path(spark, "wave-checkpoint")
    cuts = change_times(source, changed, waves)
    time = F.col(changed)
    wave_of = reduce(lambda found, cut: found + F.coalesce(time >= cut, F.lit(True)).cast("int"), cuts, F.lit(0))

    def stop(batch):
        raise Stopped

    for k in range(waves):
        source.filter(wave_of == k).write.mode("append").parquet(folder)
        stream = parquet_files(spark, folder, source.schema)
        if k == 1:
            try:
                drain(ingest_stream(stream, [*feeds[:3], Feed(feeds[3].target, feeds[3].spec, stop)], checkpoint, LOADED_AT))
            except StreamingQueryException:
                pass  # what the restart is for
        drain(ingest_stream(stream, feeds, checkpoint, LOADED_AT))


@query("etl_seventeen_tables_stream", SEVENTEEN_SQL)
def etl_seventeen_tables_stream(spark, sf_dir):
    held = {target: target_table(spark, spec) for target, spec in WAREHOUSE.items()}
    for name, changed in (("orders", "o_orderdate"), ("events", "ts")):
        fed = [t for t, spec in WAREHOUSE.items() if source_columns(t, len(spec.columns))[0] == name]
        feeds = [Feed(held[t], WAREHOUSE[t], partial(shaped, t, WAREHOUSE[t])) for t in fed]
        fed_in_waves(spark, table(spark, sf_dir, name), changed, feeds)
    return all_targets(spark, held)
