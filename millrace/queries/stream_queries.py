"""Streams over the tables: whatever is there is processed, then the run stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.registry import query
from millrace.session import scratch_name, scratch_path, table
from millrace.streaming.counts import (
    count_by,
    drain,
    latest,
    per_batch,
    printing,
    running,
    split_words,
    sql_per_batch,
)
from millrace.streaming.sources import line_files, parquet_files, table_stream
from millrace.streaming.visits import last_values, visits
from millrace.streaming.windows import closed_windows

CUT = "2000-01-01"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def folders(spark, label):
    return scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-checkpoint")


def running_words(spark, lines, label):
    out, checkpoint = folders(spark, label)
    drain(running(split_words(lines), ["word"], {"n": F.count(F.lit(1))}, out, checkpoint))
    return latest(spark.read.parquet(out), ["word"])


@query(
    "stm_files",
    """select word, count(*) as n from (select unnest(string_split(line, ' ')) as word from
       (select unnest(string_split(text, chr(10))) as line from documents)) group by word""",
)
def stm_files(spark, sf_dir):
    folder = scratch_path(spark, "lines-in")
    table(spark, sf_dir, "documents").select("text").write.text(folder)
    return running_words(spark, line_files(spark, folder), "files")


@query(
    "stm_socket",
    "select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from conversations) group by word",
)
def stm_socket(spark, sf_dir):
    # the socket program's counts behind another source: no port is opened
    lines = table_stream(spark, sf_dir, "conversations").select(F.col("text").alias("value"))
    return running_words(spark, lines, "lines")


def waves(spark, label, batches, schema, process):
    """Put one batch after the other into a folder; after each, a fresh query resumes from the same checkpoint."""
    folder = scratch_path(spark, f"{label}-in")
    out, checkpoint = folders(spark, label)
    for batch in batches:
        batch.write.mode("append").parquet(folder)
        drain(process(parquet_files(spark, folder, schema), out, checkpoint))
    return spark.read.parquet(out)


@query(
    "stm_queue",
    """select cast(substr(o_orderpriority, 1, 1) as integer) - 1 as batch_id, o_orderkey % 10 as key, count(*) as n
       from orders group by 1, 2""",
)
def stm_queue(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    priority = F.col("o_orderpriority")
    batches = [orders.filter(priority == p) for p in PRIORITIES]
    # the last wave takes whatever the others leave
    batches.append(orders.filter(~F.coalesce(priority.isin(PRIORITIES), F.lit(False))))

    def process(stream, out, checkpoint):
        return per_batch(stream, lambda b: count_by(b.select((F.col("o_orderkey") % 10).alias("key")), "key"), out, checkpoint)

    return waves(spark, "queue", batches, orders.schema, process)


@query(
    "stm_kafka",
    """select word, count(*) as n from (select unnest(string_split(event_type || ' ' || user_id, ' ')) as word from events) group by word""",
)
def stm_kafka(spark, sf_dir):
    # (key, value) messages; only the value is counted
    events = table_stream(spark, sf_dir, "events")
    pairs = events.select(
        F.col("event_id").cast("string").alias("key"),
        F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("value"),
    )
    return running_words(spark, pairs.select("value"), "pairs")


@query(
    "stm_broker_other",
    "select word, count(*) as n from (select unnest(string_split(role || ' ' || turn, ' ')) as word from conversations) group by word",
)
def stm_broker_other(spark, sf_dir):
    turns = table_stream(spark, sf_dir, "conversations")
    value = F.concat_ws(" ", "role", F.col("turn").cast("string")).alias("value")
    return running_words(spark, turns.select(value), "broker")


def two_halves(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    early = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    return [orders.filter(early), orders.filter(~early)], orders.schema


HALVES_SQL = """
select case when o_orderdate < timestamp '2000-01-01' then 0 else 1 end as batch_id, o_orderstatus, count(*) as n from orders group by 1, 2
"""


@query("stm_batch_count", HALVES_SQL)
def stm_batch_count(spark, sf_dir):
    batches, schema = two_halves(spark, sf_dir)

    def process(stream, out, checkpoint):
        return per_batch(stream, lambda b: count_by(b, "o_orderstatus"), out, checkpoint)

    return waves(spark, "batch-count", batches, schema, process)


@query("stm_running_count", "select o_orderstatus, count(*) as n from orders group by 1")
def stm_running_count(spark, sf_dir):
    batches, schema = two_halves(spark, sf_dir)

    def process(stream, out, checkpoint):
        return running(stream, ["o_orderstatus"], {"n": F.count(F.lit(1))}, out, checkpoint)

    return latest(waves(spark, "running", batches, schema, process), ["o_orderstatus"])


@query("stm_sql_per_batch", HALVES_SQL)
def stm_sql_per_batch(spark, sf_dir):
    batches, schema = two_halves(spark, sf_dir)
    view = scratch_name("v_batch")
    sql = f"SELECT o_orderstatus, count(*) AS n FROM {view} GROUP BY o_orderstatus"

    def process(stream, out, checkpoint):
        return sql_per_batch(stream, view, sql, out, checkpoint)

    return waves(spark, "sql-batch", batches, schema, process)


@query("stm_recoverable", "select event_type, count(*) as n from events group by 1")
def stm_recoverable(spark, sf_dir):
    # stopped after the first half; a new query on the same checkpoint reads only the second
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    low = F.col("value") < 60

    def process(stream, out, checkpoint):
        return per_batch(stream, lambda b: count_by(b, "event_type"), out, checkpoint)

    appended = waves(spark, "recoverable", [events.filter(low), events.filter(~low)], events.schema, process)
    return appended.groupBy("event_type").agg(F.sum("n").alias("n"))


@query("stm_sink_print", "select role, count(*) as n from conversations group by 1")
def stm_sink_print(spark, sf_dir):
    out, checkpoint = folders(spark, "print")
    drain(printing(table_stream(spark, sf_dir, "conversations"), lambda b: count_by(b, "role"), out, checkpoint))
    # each batch counts its own rows; their number depends on the size of the table
    return spark.read.parquet(out).groupBy("role").agg(F.sum("n").alias("n"))


@query(
    "udf_state_update",
    "select user_id, sum(cast(value as decimal(18,2)))::double as total, count(*) as n from events group by 1",
)
def udf_state_update(spark, sf_dir):
    # new value + old state is a sum: the state store's own aggregate, no Python per key
    events = table(spark, sf_dir, "events").select("user_id", "value")
    low = F.col("value") < 60
    totals = {"total": F.sum(F.col("value").cast("decimal(18,2)")), "n": F.count(F.lit(1))}

    def process(stream, out, checkpoint):
        return running(stream, ["user_id"], totals, out, checkpoint)

    state = latest(waves(spark, "state", [events.filter(low), events.filter(~low)], events.schema, process), ["user_id"])
    return state.withColumn("total", F.col("total").cast("double"))


# ---------------------------------------------------------------- event time

# The events come in waves by day of the month; every tenth comes a wave late, every twenty-fifth two waves. In the end a row of another decade closes
# what is open. The watermark of a wave is two days behind the latest time of the waves before, in whole milliseconds.
WAVES = 5
DELAY = "2 days"
WAVE_SQL = """
with recursive e as (select *, epoch_us(ts) as us, least((day(ts) - 1) // 10, 2) + case when event_id % 25 = 0 then 2 when event_id % 10 = 0 then 1 else 0 end as wave from events),
marks as (select w.wave, coalesce(max(epoch_ms(e.ts)) - 2 * 86400000, -1000000000000000) * 1000 as mark from range(6) w(wave) left join e on e.wave < w.wave group by w.wave),
"""


def fed_late(spark, sf_dir, label, columns, process):
    """The events, late and out of order, through ``process``; a fresh query resumes after each wave."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.when(F.col("event_id") % 25 == 0, 2).when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    wave = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) + late
    batches = [events.filter(wave == k).select(*columns) for k in range(WAVES)]
    ends = events.agg((F.max("ts") + F.expr("interval 10 years")).alias("ts"))
    kinds = dict(events.dtypes)
    batches.append(ends.select(*[F.col("ts") if c == "ts" else F.lit(None).cast(kinds[c]).alias(c) for c in columns]))
    return waves(spark, label, batches, batches[0].schema, process)


def windowed(spark, sf_dir, label, window, key):
    totals = {"n": F.count(F.lit(1)), "total": F.sum(F.col("value").cast("decimal(18,2)"))}

    def process(stream, out, checkpoint):
        return closed_windows(stream, "ts", DELAY, window, [key], totals, out, checkpoint)

    found = fed_late(spark, sf_dir, label, ["ts", key, "value"] if key == "event_type" else ["event_id", "ts", key, "value"], process)
    times = [F.col(c).cast("timestamp_ntz").alias(f"{c}_at") for c in ("start", "end")]
    return found.select(*times, key, "n", F.col("total").cast("double").alias("total"))


def _fixed_sql(starts: str, hours: int) -> str:
    """Rows count for the windows that end behind the watermark of their wave."""
    return f"""{WAVE_SQL} placed as (select event_type, value, wave, unnest({starts}) as start from e)
    select make_timestamp(start) as start_at, make_timestamp(start + {hours} * 3600000000) as end_at, event_type, count(*) as n, sum(value::decimal(18,2))::double as total
    from placed join marks using (wave) where start + {hours} * 3600000000 > mark group by start, event_type"""


@query("stm_window_watermark", _fixed_sql("[us // 21600000000 * 21600000000]", 6))
def stm_window_watermark(spark, sf_dir):
    return windowed(spark, sf_dir, "tumbling", F.window("ts", "6 hours"), "event_type")


@query("stm_window_sliding", _fixed_sql("[us // 43200000000 * 43200000000, us // 43200000000 * 43200000000 - 43200000000]", 24))
def stm_window_sliding(spark, sf_dir):
    return windowed(spark, sf_dir, "sliding", F.window("ts", "24 hours", "12 hours"), "event_type")


def _session_sql(gap: int) -> str:
    """Wave by wave: rows that are not too late meet the rows of sessions that are still open; what the watermark has passed is closed."""
    steps = ["open_0 as (select event_id, user_id, value, us, us as from_us, 0 as to_us from e where false)"]
    for w in range(WAVES):
        steps.append(
            f"""rows_{w} as (select event_id, user_id, value, us from open_{w}
                             union all select event_id, user_id, value, us from e, (select mark from marks where wave = {w}) where wave = {w} and us + {gap} > mark),
            cut_{w} as (select *, case when us - lag(us) over (partition by user_id order by us, event_id) <= {gap} then 0 else 1 end as first from rows_{w}),
            run_{w} as (select *, sum(first) over (partition by user_id order by us, event_id) as run from cut_{w}),
            span_{w} as (select event_id, user_id, value, us, min(us) over (partition by user_id, run) as from_us, max(us) over (partition by user_id, run) + {gap} as to_us from run_{w}),
            open_{w + 1} as (select s.* from span_{w} s, (select mark from marks where wave = {w + 1}) where to_us > mark)"""
        )
    closed = " union all ".join(
        [f"select s.* from span_{w} s, (select mark from marks where wave = {w + 1}) where to_us <= mark" for w in range(WAVES)] + [f"select * from open_{WAVES}"]
    )
    return f"""{WAVE_SQL} {', '.join(steps)}, closed as ({closed})
    select make_timestamp(from_us) as start_at, make_timestamp(to_us) as end_at, user_id, count(*) as n, sum(value::decimal(18,2))::double as total
    from closed group by from_us, to_us, user_id"""


@query("stm_window_session", _session_sql(8 * 3600 * 1_000_000))
def stm_window_session(spark, sf_dir):
    return windowed(spark, sf_dir, "session", F.session_window("ts", "8 hours"), "user_id")


VISIT_GAP = 12 * 3600
VISITS_SQL = f"""{WAVE_SQL} seen as (select e.* from e join marks using (wave) where us > mark),
steps as (select *, lag(us) over (partition by user_id order by us, event_id) as before, lag(event_type) over (partition by user_id order by us, event_id) as kind_before from seen),
runs as (select *, sum(case when us - before <= {VISIT_GAP * 1_000_000} and kind_before <> 'purchase' then 0 else 1 end) over (partition by user_id order by us, event_id) as run from steps)
select user_id, make_timestamp(min(us)) as started, make_timestamp(max(us)) as ended, count(*) as n, arg_max(event_type, (us, event_id)) as last_kind,
       case when arg_max(event_type, (us, event_id)) = 'purchase' then 'last' else 'gap' end as reason
from runs group by user_id, run"""


@query("udf_state_visits", VISITS_SQL)
def udf_state_visits(spark, sf_dir):
    def process(stream, out, checkpoint):
        named = stream.select(F.col("user_id").alias("key"), F.col("ts").alias("time"), F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
        return visits(named, DELAY, VISIT_GAP, "purchase", out, checkpoint)

    found = fed_late(spark, sf_dir, "visits", ["event_id", "ts", "user_id", "event_type"], process)
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("started", "ended")]
    return found.select(F.col("key").alias("user_id"), *times, "n", "last_kind", "reason")


@query(
    "udf_state_last_values",
    """select user_id, list(value order by ts, event_id) as last from
       (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as nth from events) where nth <= 3 group by user_id""",
)
def udf_state_last_values(spark, sf_dir):
    def process(stream, out, checkpoint):
        named = stream.select(F.col("user_id").alias("key"), F.col("ts").alias("time"), F.col("event_id").alias("id"), "value")
        return last_values(named.filter("id is not null"), 3, out, checkpoint)

    found = fed_late(spark, sf_dir, "last-values", ["event_id", "ts", "user_id", "value"], process)
    return latest(found, ["key"]).select(F.col("key").alias("user_id"), "last")
