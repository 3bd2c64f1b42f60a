"""Sinks and table definitions: write, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.skew import salted_sides
from millrace.registry import query
from millrace.session import scratch_name, scratch_path, table
from millrace.sinks.writers import append_by_name, bucket_count, create_table, insert_values, save_bucketed, to_cells, truncate_load, upsert
from millrace.sources import cells
from millrace.sources.connectors import read_connector, write_connector

CUT = "2000-01-01"
ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


def order_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def early_late(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    return orders.filter(early).select(*columns), orders.filter(~early).select(*columns)


def new_table(spark, label, schema=ORDER_SCHEMA):
    name = scratch_name(label)
    create_table(spark, name, schema, scratch_path(spark, label))
    return name


@query("snk_parquet", "select c_name, c_mktsegment from customer")
def snk_parquet(spark, sf_dir):
    path = scratch_path(spark, "names")
    table(spark, sf_dir, "customer").select("c_name", "c_mktsegment").write.save(path, format="parquet")
    return spark.read.parquet(path)


@query("snk_partitioned", "select o_orderkey, o_totalprice, o_orderstatus from orders")
def snk_partitioned(spark, sf_dir):
    path = scratch_path(spark, "by-status")
    order_rows(spark, sf_dir).write.partitionBy("o_orderstatus").format("parquet").save(path)
    return spark.read.schema("o_orderkey bigint, o_totalprice double, o_orderstatus string").parquet(path)


@query(
    "snk_partition_bucket",
    """select o_orderstatus, c_mktsegment, count(*) as n from orders join customer on o_custkey = c_custkey group by 1, 2""",
)
def snk_partition_bucket(spark, sf_dir):
    # both sides bucketed on the customer (and its salt): the join reads bucket by bucket, without a shuffle
    buckets = bucket_count(table(spark, sf_dir, "orders").count())
    left, right = salted_sides(order_rows(spark, sf_dir), table(spark, sf_dir, "customer"), ["o_custkey"], ["c_custkey"])
    right = right.withColumnRenamed("salt", "c_salt")
    orders = save_bucketed(
        left, scratch_name("orders_b"), scratch_path(spark, "orders-b"), buckets, ["o_custkey", "salt"], "o_orderstatus"
    )
    customers = save_bucketed(
        right, scratch_name("customer_b"), scratch_path(spark, "customer-b"), buckets, ["c_custkey", "c_salt"]
    )
    joined = orders.join(customers, [F.col("o_custkey") == F.col("c_custkey"), F.col("salt") == F.col("c_salt")])
    return joined.groupBy("o_orderstatus", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("snk_bucket_sorted", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def snk_bucket_sorted(spark, sf_dir):
    return save_bucketed(
        table(spark, sf_dir, "customer"),
        scratch_name("customer_s"),
        scratch_path(spark, "customer-s"),
        bucket_count(table(spark, sf_dir, "customer").count()),
        ["c_name"],
        sort_by="c_acctbal",
    )


@query("snk_drop", "select count(*) as n, 0 as still_there from orders")
def snk_drop(spark, sf_dir):
    name = new_table(spark, "dropped")
    append_by_name(order_rows(spark, sf_dir), name)
    n = spark.table(name).count()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    there = int(spark.catalog.tableExists(name))
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n"), F.lit(there).alias("still_there"))


@query("snk_insert_append", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def snk_insert_append(spark, sf_dir):
    name = new_table(spark, "appended")
    early, late = early_late(spark, sf_dir)
    append_by_name(early, name)
    # columns arrive in another order and are matched by name
    append_by_name(late.select("o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey"), name)
    return spark.table(name)


@query("snk_insert_select", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def snk_insert_select(spark, sf_dir):
    name, view = new_table(spark, "selected"), scratch_name("v_orders")
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {name} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {view}")
    return spark.table(name)


@query(
    "snk_insert_rows",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
       union all select -1 - n_nationkey, n_regionkey, 'X', n_nationkey::double / 4 from nation""",
)
def snk_insert_rows(spark, sf_dir):
    # a few rows known to the driver go in by one INSERT with a list of VALUES, in named columns of any order; a whole table by one distributed append
    name = new_table(spark, "rows")
    append_by_name(order_rows(spark, sf_dir), name)
    few = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").collect()
    insert_values(spark, name, ["o_orderstatus", "o_totalprice", "o_custkey", "o_orderkey"], [("X", r[0] / 4, r[1], -1 - r[0]) for r in few])
    return spark.table(name)


@query(
    "snk_truncate_load",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderdate >= timestamp '2000-01-01'",
)
def snk_truncate_load(spark, sf_dir):
    name = new_table(spark, "reloaded")
    early, late = early_late(spark, sf_dir)
    truncate_load(early, name)
    truncate_load(late, name)
    # an empty result leaves the table as it is
    truncate_load(late.filter("o_totalprice < 0"), name, keep_if_empty=True)
    return spark.table(name)


@query(
    "snk_keyed_update",
    """select o_orderkey, o_custkey, case when o_orderstatus = 'P' then 'F' else o_orderstatus end as o_orderstatus,
              case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end as o_totalprice from orders""",
)
def snk_keyed_update(spark, sf_dir):
    orders = order_rows(spark, sf_dir)
    early, late = early_late(spark, sf_dir)
    # changes: late orders are new, orders with status P are closed at a higher price
    closed = orders.filter("o_orderstatus = 'P'").select(
        "o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice")
    )
    changes = late.filter("o_orderstatus != 'P'").unionByName(closed)
    return upsert(early, changes, "o_orderkey", F.col("o_totalprice"))


@query(
    "snk_cell_put",
    """select c_custkey::varchar as row, 'f' as family, q as qualifier,
              case q when 'c_name' then c_name when 'c_nationkey' then c_nationkey::varchar else c_mktsegment end as value
       from customer, (values ('c_name'), ('c_nationkey'), ('c_mktsegment')) v(q)""",
)
def snk_cell_put(spark, sf_dir):
    path = scratch_path(spark, "cells")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    to_cells(customers, "c_custkey", "f").write.parquet(path)
    return spark.read.parquet(path)


CELLS_SQL = """
select c_custkey::varchar as row, case q when 'c_name' then 'who' else 'what' end as family, q as qualifier,
       case q when 'c_name' then c_name when 'c_nationkey' then c_nationkey::varchar else c_mktsegment end as value
from customer, (values ('c_name'), ('c_nationkey'), ('c_mktsegment')) v(q)"""


def stored_cells(spark, sf_dir):
    """Customers as cells of two families, in a store that commits what all tasks wrote."""
    cells.register(spark)
    path = scratch_path(spark, "cell-store")
    customers = table(spark, sf_dir, "customer")
    who = to_cells(customers.select("c_custkey", "c_name"), "c_custkey", "who")
    what = to_cells(customers.select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey", "what")
    for part in (who, what):
        write_connector(part, "cells", {"path": path})
    return path


@query("snk_foreach_row", CELLS_SQL)
def snk_foreach_row(spark, sf_dir):
    # rows go to an external store task by task; a task that fails leaves nothing there
    return read_connector(spark, "cells", {"path": stored_cells(spark, sf_dir)})


@query("src_cell_store", CELLS_SQL.replace("select c_custkey::varchar", "select * from (select c_custkey::varchar") + ") where family = 'what' and qualifier = 'c_nationkey' and row >= '5'")
def src_cell_store(spark, sf_dir):
    # family and row skip files, the qualifier skips rows inside them
    found = read_connector(spark, "cells", {"path": stored_cells(spark, sf_dir)})
    return found.filter("family = 'what' and qualifier = 'c_nationkey' and row >= '5'")


@query(
    "ddl_temp_view",
    "select n_regionkey, count(*) as n from nation join supplier on n_nationkey = s_nationkey group by 1",
)
def ddl_temp_view(spark, sf_dir):
    nations, suppliers = scratch_name("v_nation"), scratch_name("v_supplier")
    table(spark, sf_dir, "nation").createOrReplaceTempView(nations)
    table(spark, sf_dir, "supplier").createOrReplaceTempView(suppliers)
    return spark.sql(f"SELECT n_regionkey, count(*) AS n FROM {nations} JOIN {suppliers} ON n_nationkey = s_nationkey GROUP BY n_regionkey")


@query("ddl_global_view", "select c_mktsegment, count(*) as n from customer group by 1")
def ddl_global_view(spark, sf_dir):
    name = scratch_name("customers")
    table(spark, sf_dir, "customer").createOrReplaceGlobalTempView(name)
    # visible from another session of the application
    seen = spark.newSession().sql(f"SELECT c_mktsegment, count(*) AS n FROM global_temp.{name} GROUP BY c_mktsegment")
    return seen


@query("ddl_managed_table", "select o_orderkey as key, o_orderpriority as value from orders")
def ddl_managed_table(spark, sf_dir):
    # no LOCATION: the files are in the warehouse folder and go when the table is dropped
    name = scratch_name("src")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key BIGINT, value STRING) USING parquet")
    append_by_name(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("value")), name)
    # a second definition of the same name changes nothing
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key BIGINT, value STRING) USING parquet")
    return spark.table(name)


@query(
    "ddl_show_schema",
    """select * from (values ('event_id', 'bigint'), ('ts', 'timestamp_ntz'), ('user_id', 'bigint'), ('event_type', 'string'),
       ('value', 'double'), ('props', 'string')) v(col_name, data_type), (select count(*) as n from events)""",
)
def ddl_show_schema(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    n = events.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    fields = spark.createDataFrame(events.dtypes, "col_name string, data_type string")
    return fields.withColumn("n", F.lit(n).cast("bigint"))
