"""Sources. Where a format is not the tables' own, Spark first writes the table in that format."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions.jsondoc import to_json_text
from millrace.operators.sampling import uniform
from millrace.registry import query
from millrace.session import scratch_path, table
from millrace.sources.catalog import active_table, catalog_map
from millrace.sources.connectors import read_connector
from millrace.sources.files import indexed_lines, labelled_lines, rating_lines, read_ctrl_a, read_delimited, vector_lines


def written(df, fmt, label, **options):
    """Write ``df`` below the shared scratch folder and return the path."""
    path = scratch_path(df.sparkSession, label)
    df.write.format(fmt).options(**options).save(path)
    return path


def as_lines(df, line, label):
    return written(df.select(line.alias("value")), "text", label)


@query("src_json", "select event_id, user_id, event_type, value, props, ts from events")
def src_json(spark, sf_dir):
    path = written(table(spark, sf_dir, "events"), "json", "events-json", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    # the types come from the files; times are text there
    read = spark.read.json(path)
    return read.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select("event_id", "user_id", "event_type", "value", "props", "ts")


@query(
    "src_json_generic_load",
    "select event_type, count(*) as n, max(user_id) as top_user from events group by 1",
)
def src_json_generic_load(spark, sf_dir):
    path = written(table(spark, sf_dir, "events").select("event_type", "user_id"), "json", "events-load")
    # no schema: the types come from the files
    loaded = spark.read.load(path, format="json")
    return loaded.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("user_id").alias("top_user"))


@query(
    "src_json_strings",
    "select c_custkey, c_name as name, n_name as city, c_nationkey as code from customer join nation on c_nationkey = n_nationkey",
)
def src_json_strings(spark, sf_dir):
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    address = F.struct(F.col("n_name").alias("city"), F.col("c_nationkey").alias("code"))
    documents = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        to_json_text(F.struct("c_custkey", F.col("c_name").alias("name"), address.alias("address"))).alias("doc")
    )
    parsed = documents.select(
        F.from_json("doc", "c_custkey bigint, name string, address struct<city:string,code:int>").alias("d")
    )
    return parsed.select("d.c_custkey", "d.name", "d.address.city", "d.address.code")


@query("src_parquet", "select p_partkey, p_brand, p_retailprice from part")
def src_parquet(spark, sf_dir):
    return spark.read.load(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_retailprice")


@query(
    "src_parquet_nested",
    """select label, round(sum(x), 4) as total, count(*) as n from
       (select label, unnest(embedding)::double as x from embeddings) group by label""",
)
def src_parquet_nested(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("x"))
    return rows.groupBy("label").agg(F.round(F.sum(F.col("x").cast("double")), 4).alias("total"), F.count(F.lit(1)).alias("n"))


def merged_parts(spark, sf_dir):
    """Two folders of one data set whose files know different columns."""
    path = scratch_path(spark, "merge-schema")
    lines = table(spark, sf_dir, "lineitem")
    common = ["l_orderkey", "l_linenumber"]
    for key, flags, extra in ((1, ["A", "N"], "l_tax"), (2, ["R"], "l_discount")):
        lines.filter(F.col("l_returnflag").isin(flags)).select(*common, extra).write.parquet(f"{path}/key={key}")
    return path


@query(
    "src_merge_schema",
    """select l_orderkey, l_linenumber, case when l_returnflag <> 'R' then l_tax end as l_tax,
              case when l_returnflag = 'R' then l_discount end as l_discount,
              case when l_returnflag = 'R' then 2 else 1 end as key from lineitem""",
)
def src_merge_schema(spark, sf_dir):
    return spark.read.option("mergeSchema", "true").parquet(merged_parts(spark, sf_dir))


@query(
    "src_partition_discovery",
    "select l_orderkey, l_linenumber, case when l_returnflag = 'R' then 2 else 1 end as key from lineitem",
)
def src_partition_discovery(spark, sf_dir):
    # the key comes from the folders' names
    return spark.read.parquet(merged_parts(spark, sf_dir)).select("l_orderkey", "l_linenumber", "key")


@query("src_sql_on_file", "select * from nation")
def src_sql_on_file(spark, sf_dir):
    return spark.sql(f"SELECT * FROM parquet.`{sf_dir}/nation.parquet`")


@query(
    "src_text_lines",
    "select value, count(*) as n from (select unnest(string_split(text, chr(10))) as value from documents) group by value",
)
def src_text_lines(spark, sf_dir):
    path = as_lines(table(spark, sf_dir, "documents"), F.col("text"), "lines")
    lines = spark.read.text(path)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("src_text_delimited", "select c_custkey, c_name, c_nationkey from customer")
def src_text_delimited(spark, sf_dir):
    line = F.concat_ws(", ", F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"))
    path = as_lines(table(spark, sf_dir, "customer"), line, "delimited")
    return read_delimited(spark, path, "c_custkey bigint, c_name string, c_nationkey int")


@query("src_ctrl_a_text", "select o_orderkey as key, 'val_' || o_orderkey as value from orders")
def src_ctrl_a_text(spark, sf_dir):
    line = F.concat_ws("\x01", F.col("o_orderkey").cast("string"), F.concat(F.lit("val_"), F.col("o_orderkey").cast("string")))
    path = as_lines(table(spark, sf_dir, "orders"), line, "ctrl-a")
    return read_ctrl_a(spark, path, "key bigint, value string")


@query(
    "src_space_vectors",
    """select vec_id, len(embedding) as dims, round(list_sum(list_transform(embedding, lambda x: x::double)), 4) as total from embeddings""",
)
def src_space_vectors(spark, sf_dir):
    # the first number of a line is the id
    texts = F.transform("embedding", lambda x: x.cast("double").cast("string"))
    line = F.concat(F.col("vec_id").cast("string"), F.lit(" "), F.array_join(texts, " "))
    path = as_lines(table(spark, sf_dir, "embeddings"), line, "vectors")
    parts = spark.read.text(path).select(F.split_part("value", F.lit(" "), F.lit(1)).cast("bigint").alias("vec_id"), "value")
    rest = parts.withColumn("value", F.regexp_replace("value", r"^\S+ ", ""))
    values = vector_to_array("features")
    return vector_lines(rest).select(
        "vec_id",
        F.size(values).cast("bigint").alias("dims"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    )


@query(
    "src_labeled_lines",
    """select label, count(*) as n, sum(cast(f1 as decimal(18,2)))::double as f1, sum(cast(f2 as decimal(18,2)))::double as f2 from
       (select case when l_returnflag = 'R' then 1.0::double else 0.0::double end as label, l_quantity as f1, l_extendedprice as f2
        from lineitem) group by label""",
)
def src_labeled_lines(spark, sf_dir):
    label = F.when(F.col("l_returnflag") == "R", "1").otherwise("-1")
    line = F.concat_ws(" ", label, F.col("l_quantity").cast("string"), F.col("l_extendedprice").cast("string"))
    path = as_lines(table(spark, sf_dir, "lineitem"), line, "labelled")
    points = labelled_lines(spark.read.text(path))
    total = lambda i: F.sum(F.element_at("values", i).cast("decimal(18,2)")).cast("double").alias(f"f{i}")
    return points.groupBy("label").agg(F.count(F.lit(1)).alias("n"), total(1), total(2))


LABELLED_SQL = """
select label, count(*) as n, sum(cast(f1 as decimal(18,2)))::double as f1, sum(cast(f2 as decimal(18,2)))::double as f2 from
  (select case when l_returnflag = 'R' then 1.0::double else {other}::double end as label, l_quantity as f1, l_extendedprice as f2 from lineitem) group by label"""


def labelled_text(spark, sf_dir, first, sep, indexed=False):
    """Lines of a label, a sign, and two numbers (with their places, if ``indexed``)."""
    values = [F.col(c).cast("string") for c in ("l_quantity", "l_extendedprice")]
    if indexed:
        values = [F.concat(F.lit(f"{i}:"), v) for i, v in zip((1, 7), values)]
    label = F.when(F.col("l_returnflag") == "R", "1").otherwise(first)
    return as_lines(table(spark, sf_dir, "lineitem"), F.concat(label, F.lit(sep), F.concat_ws(" ", *values)), "labelled")


@query("src_labeled_lines_comma", LABELLED_SQL.format(other="0.0"))
def src_labeled_lines_comma(spark, sf_dir):
    # label,f1 f2
    points = labelled_lines(spark.read.text(labelled_text(spark, sf_dir, "0", ",")))
    total = lambda i: F.sum(F.element_at("values", i).cast("decimal(18,2)")).cast("double").alias(f"f{i}")
    return points.groupBy("label").agg(F.count(F.lit(1)).alias("n"), total(1), total(2))


@query("src_labeled_lines_indexed", LABELLED_SQL.format(other="-1.0"))
def src_labeled_lines_indexed(spark, sf_dir):
    # label idx:val idx:val; places without a value are not stored
    points = indexed_lines(spark.read.text(labelled_text(spark, sf_dir, "-1", " ", indexed=True)))
    total = lambda i, name: F.sum(F.element_at("values", F.lit(i)).cast("decimal(18,2)")).cast("double").alias(name)
    return points.groupBy("label").agg(F.count(F.lit(1)).alias("n"), total(1, "f1"), total(7, "f2"))


@query(
    "src_ratings",
    'select o_custkey as "user", l_partkey as item, l_quantity - 2.5::double as rating from lineitem join orders on l_orderkey = o_orderkey',
)
def src_ratings(spark, sf_dir):
    bought = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    line = F.concat_ws("::", F.col("o_custkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_quantity").cast("string"))
    path = as_lines(bought, line, "ratings")
    return rating_lines(spark.read.text(path), "::", 2.5)


@query(
    "src_libsvm",
    """select label, count(*) as n, sum(cast(q as decimal(18,2)))::double as quantity, sum(cast(d as decimal(18,2)))::double as discount from
       (select case when l_returnflag = 'R' then 1.0::double else 0.0::double end as label, l_quantity as q, l_discount as d from lineitem)
       group by label""",
)
def src_libsvm(spark, sf_dir):
    # zeros are left out, as the sparse format has it
    label = F.when(F.col("l_returnflag") == "R", "1").otherwise("0")
    discount = F.when(F.col("l_discount") != 0, F.concat(F.lit("3:"), F.col("l_discount").cast("string")))
    line = F.concat_ws(" ", label, F.concat(F.lit("1:"), F.col("l_quantity").cast("string")), discount)
    path = as_lines(table(spark, sf_dir, "lineitem"), line, "libsvm")
    loaded = spark.read.format("libsvm").option("numFeatures", "3").load(path)
    values = loaded.select("label", vector_to_array("features").alias("x"))
    total = lambda i: F.sum(F.element_at("x", i).cast("decimal(18,2)")).cast("double")
    return values.groupBy("label").agg(F.count(F.lit(1)).alias("n"), total(1).alias("quantity"), total(3).alias("discount"))


@query("src_avro", "select c_custkey, c_mktsegment from customer")
def src_avro(spark, sf_dir):
    # the reader schema keeps two of the record's fields; "avro" needs its package, Parquet projects the same way
    return read_connector(
        spark, "parquet", {"path": f"{sf_dir}/customer.parquet"}, "c_custkey bigint, c_mktsegment string"
    )


@query("src_wide_store", "select s_suppkey as user_id, s_name as fname, s_nationkey as lname from supplier")
def src_wide_store(spark, sf_dir):
    # the wrapper that a column-store package plugs into, on a built-in format
    path = written(table(spark, sf_dir, "supplier"), "orc", "wide-store")
    rows = read_connector(spark, "orc", {"path": path})
    return rows.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("fname"), F.col("s_nationkey").alias("lname"))


@query(
    "src_cells_explode",
    """select event_id as row, 'event_type' as qualifier, event_type as value from events
       union all select event_id, 'user_id', user_id::varchar from events""",
)
def src_cells_explode(spark, sf_dir):
    def cell(qualifier, value):
        fields = F.struct(F.lit("f").alias("columnFamily"), F.lit(qualifier).alias("qualifier"), value.alias("value"))
        return to_json_text(fields)

    events = table(spark, sf_dir, "events")
    stored = events.select(
        F.col("event_id").alias("row"),
        F.concat_ws("\n", cell("event_type", F.col("event_type")), cell("user_id", F.col("user_id").cast("string"))).alias("cells"),
    )
    cells = stored.select("row", F.explode(F.split("cells", "\n")).alias("cell"))
    parsed = cells.select("row", F.from_json("cell", "columnFamily string, qualifier string, value string").alias("c"))
    return parsed.select("row", "c.qualifier", "c.value")


@query(
    "src_rows_in_memory",
    """select o.o_orderkey, v.grade from orders o join
       (values ('F', 'done', 1), ('O', 'open', 2), ('P', 'part', 3)) v(status, grade, rnk) on o.o_orderstatus = v.status""",
)
def src_rows_in_memory(spark, sf_dir):
    names = spark.createDataFrame([("F", "done", 1), ("O", "open", 2), ("P", "part", 3)], "status string, grade string, rnk int")
    orders = table(spark, sf_dir, "orders")
    return orders.join(names, orders.o_orderstatus == names.status).select("o_orderkey", "grade")


@query(
    "src_range",
    """select n, n * n as square, n * n * n as cube from range(0, (select max(c_custkey) + 1 from customer)) r(n)
       where n not in (select user_id from events)""",
)
def src_range(spark, sf_dir):
    # every id of the table's range that has no event, with its square and cube
    last = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    ids = spark.range(0, last + 1).withColumnRenamed("id", "n")
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    unused = ids.join(users, F.col("n") == F.col("user_id"), "left_anti")
    return unused.select("n", (F.col("n") * F.col("n")).alias("square"), (F.col("n") * F.col("n") * F.col("n")).alias("cube"))


def normal(seed: int):
    """A standard normal value from the order's key (Box and Muller), the same on every run and any number of executors."""
    u, v = uniform(["o_orderkey"], seed), uniform(["o_orderkey"], seed + 100)
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)


def _normal_sql(seed: int) -> str:
    u, v = (f"(('0x' || substr(md5(o_orderkey || '|{s}'), 1, 15))::bigint / {float(1 << 60)!r}::double)" for s in (seed, seed + 100))
    return f"sqrt(-2::double * ln(1::double - {u})) * cos({2 * math.pi!r}::double * {v})"


@query(
    "src_random",
    f"""with d as (select {_normal_sql(1)} as x, {_normal_sql(2)} as a, {_normal_sql(3)} as b from orders)
        select count(*) as n, round(avg(x), 8) as mean, round(stddev(x), 8) as sd, round(avg(a), 8) as mean_1, round(corr(a, b), 8) as corr from d""",
)
def src_random(spark, sf_dir):
    # a standard normal value and a normal vector of length 2 per order; the moments are the result
    drawn = table(spark, sf_dir, "orders").select(normal(1).alias("x"), F.array(normal(2), normal(3)).alias("v"))
    return drawn.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("x"), 8).alias("mean"),
        F.round(F.stddev("x"), 8).alias("sd"),
        F.round(F.avg(F.element_at("v", 1)), 8).alias("mean_1"),
        F.round(F.corr(F.element_at("v", 1), F.element_at("v", 2)), 8).alias("corr"),
    )


@query(
    "src_table_routing",
    "select s_suppkey, s_name from supplier",
)
def src_table_routing(spark, sf_dir):
    control = spark.createDataFrame(
        [("task_people", "supplier"), ("task_places", "nation")], "taskname string, which_for_cs string"
    )
    return table(spark, sf_dir, active_table(control, "task_people")).select("s_suppkey", "s_name")


@query(
    "src_catalog_map",
    """select 'ets_' || lower(source) as target, source, n from
       (select 'Customer' as source, count(*) as n from customer union all select 'ORDERS', count(*) from orders
        union all select 'Part', count(*) from part)""",
)
def src_catalog_map(spark, sf_dir):
    counted = None
    for name in ("Customer", "ORDERS", "Part"):
        one = table(spark, sf_dir, name.lower()).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "n")
        counted = one if counted is None else counted.unionByName(one)
    return catalog_map(counted).join(counted, "source").select("target", "source", "n")
