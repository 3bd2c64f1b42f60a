"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.fingerprint import python_text
from millrace.functions.jsondoc import ranking_rows, station_count, to_json_text
from millrace.functions.text import capitalize, jdbc_parts, mask_secret, title_words
from millrace.functions.times import epoch_seconds, epoch_text, text_epoch
from millrace.queries import roles
from millrace.registry import query
from millrace.session import table


@query(
    "fn_split",
    """select doc_id, len(string_split(text, ' ')) as tokens, len(string_split(text, chr(10))) as lines,
              len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) as words from documents""",
)
def fn_split(spark, sf_dir):
    count = lambda pattern: F.size(F.split("text", pattern)).cast("bigint")
    words = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    return table(spark, sf_dir, "documents").select(
        "doc_id", count(" ").alias("tokens"), count("\n").alias("lines"), F.size(words).cast("bigint").alias("words")
    )


@query(
    "fn_trim_cast",
    """select c_custkey, try_cast(trim('  ' || c_nationkey || ' ') as integer) as nation, try_cast(c_mktsegment as integer) as bad,
              cast(c_acctbal as decimal(18,2))::varchar as balance from customer""",
)
def fn_trim_cast(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("c_nationkey").cast("string"), F.lit(" "))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.trim(padded).try_cast("int").alias("nation"),
        F.col("c_mktsegment").try_cast("int").alias("bad"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("balance"),
    )


@query(
    "fn_concat_format",
    """select 'Name: ' || c_name as greeting, printf('Key: %d, Value: %s', c_custkey, c_mktsegment) as pair,
              'val_' || c_custkey as value from customer""",
)
def fn_concat_format(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Name: "), F.col("c_name")).alias("greeting"),
        F.format_string("Key: %d, Value: %s", "c_custkey", "c_mktsegment").alias("pair"),
        F.concat(F.lit("val_"), F.col("c_custkey").cast("string")).alias("value"),
    )


@query(
    "fn_case",
    """select p_partkey, upper(p_name) as up, lower(p_type) as low,
              upper(p_type[1]) || lower(p_type[2:]) as capital,
              array_to_string(list_transform(string_split(replace(p_name, ' ', '_'), '_'),
                lambda x: upper(x[1]) || lower(x[2:])), '_') as title from part""",
)
def fn_case(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.upper("p_name").alias("up"),
        F.lower("p_type").alias("low"),
        capitalize(F.col("p_type")).alias("capital"),
        title_words(F.replace("p_name", F.lit(" "), F.lit("_")), "_").alias("title"),
    )


@query("fn_md5", "select doc_id, md5(text) as digest from documents")
def fn_md5(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))


@query(
    "fn_from_unixtime",
    """select event_id, floor(epoch(ts))::bigint as seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') as text from events""",
)
def fn_from_unixtime(spark, sf_dir):
    seconds = epoch_seconds(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"), epoch_text(seconds).alias("text"))


@query(
    "fn_unix_timestamp",
    "select event_id, floor(epoch(ts))::bigint as seconds from events",
)
def fn_unix_timestamp(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select("event_id", text_epoch(text).alias("seconds"))


@query(
    "fn_now",
    """select o_orderkey, '2024-05-06 07:08:09' as load_time, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as changed from orders""",
)
def fn_now(spark, sf_dir):
    # a run passes its load time in, so that a repeated run writes the same rows
    orders = table(spark, sf_dir, "orders")
    changed = python_text(F.col("o_orderdate"), orders.schema["o_orderdate"].dataType)
    return orders.select("o_orderkey", F.lit("2024-05-06 07:08:09").alias("load_time"), changed.alias("changed"))


@query(
    "fn_json_get",
    """select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events""",
)
def fn_json_get(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    "fn_json_explode",
    """select 1 as ranking, value as score, event_type || '-' || event_id || 'a' as name from events
       union all select 2, value / 8, event_type || '-' || event_id || 'b' from events""",
)
def fn_json_explode(spark, sf_dir):
    return ranking_rows(roles.reports(spark, sf_dir))


@query(
    "fn_json_array_size",
    "select greatest(1, sum(cast(json_extract_string(props, '$.k') as integer) % 4))::bigint as stations from events",
)
def fn_json_array_size(spark, sf_dir):
    return station_count(roles.reports(spark, sf_dir))


@query(
    "fn_to_json",
    """select o_orderkey, '{"key":' || o_orderkey || ',"price":"' || cast(o_totalprice as decimal(18,3)) || '","text":"é ' ||
              o_orderpriority || '","nothing":null}' as doc from orders""",
)
def fn_to_json(spark, sf_dir):
    doc = F.struct(
        F.col("o_orderkey").alias("key"),
        F.col("o_totalprice").cast("decimal(18,3)").cast("string").alias("price"),
        F.concat(F.lit("é "), F.col("o_orderpriority")).alias("text"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", to_json_text(doc).alias("doc"))


@query(
    "fn_coalesce_zero",
    """select c_custkey, coalesce(n, 0) as n from customer left join
       (select o_custkey, count(*) as n from orders group by 1) on c_custkey = o_custkey""",
)
def fn_coalesce_zero(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(counts, customers.c_custkey == counts.o_custkey, "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "fn_parse_url",
    r"""select page_id, regexp_extract(url, '://([^/:?#]+)', 1) as host,
              nullif(regexp_extract(url, '://[^/?#]+(/[^?#]*)', 1), '') as path,
              nullif(regexp_extract(url, '\?([^#]*)', 1), '') as "query",
              regexp_extract(url, '://([^/:?#]+)', 1) as jdbc_host, '3306' as jdbc_port, 'db_' || page_id as jdbc_db,
              'reader' as jdbc_user,
              'jdbc:mysql://' || regexp_extract(url, '://([^/:?#]+)', 1) || ':3306/db_' || page_id ||
              '?user=reader&password=***&useUnicode=true' as masked
       from pages""",
)
def fn_parse_url(spark, sf_dir):
    url = F.col("url")
    host = F.try_parse_url(url, F.lit("HOST"))
    path = F.nullif(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    jdbc = F.concat(
        F.lit("jdbc:mysql://"),
        host,
        F.lit(":3306/db_"),
        F.col("page_id").cast("string"),
        F.lit("?user=reader&password=pw"),
        F.col("page_id").cast("string"),
        F.lit("&useUnicode=true"),
    )
    pages = table(spark, sf_dir, "pages").select(
        "page_id", host.alias("host"), path.alias("path"), F.try_parse_url(url, F.lit("QUERY")).alias("query"), jdbc.alias("jdbc")
    )
    parts = [part.alias(f"jdbc_{name}") for name, part in jdbc_parts(F.col("jdbc")).items()]
    return pages.select("page_id", "host", "path", "query", *parts, mask_secret(F.col("jdbc")).alias("masked"))


@query(
    "fn_math",
    """select l_orderkey, l_linenumber, pow(l_quantity, 2) as square, pow(l_quantity, 3) as cube,
              round(1 / (1 + exp(-(l_discount * 10 - l_tax))), 9) as sigmoid,
              round(pow(l_discount - l_tax, 2) + pow(l_quantity - 25, 2), 6) as distance from lineitem""",
)
def fn_math(spark, sf_dir):
    squared = F.aggregate(
        F.zip_with(
            F.array("l_discount", "l_quantity"), F.array(F.col("l_tax"), F.lit(25.0)), lambda a, b: F.pow(a - b, 2)
        ),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.pow("l_quantity", 2).alias("square"),
        F.pow("l_quantity", 3).alias("cube"),
        F.round(1 / (1 + F.exp(-(F.col("l_discount") * 10 - F.col("l_tax")))), 9).alias("sigmoid"),
        F.round(squared, 6).alias("distance"),
    )


@query(
    "fn_array",
    """select doc_id, len(string_split(text, ' ')) as n, string_split(text, ' ')[1] as first_word,
              list_contains(string_split(text, ' '), 'the') as has_the, md5(array_to_string(list_sort(string_split(text, ' ')), '|')) as sorted_md5
       from documents""",
)
def fn_array(spark, sf_dir):
    words = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(words).cast("bigint").alias("n"),
        F.element_at(words, 1).alias("first_word"),
        F.array_contains(words, "the").alias("has_the"),
        F.md5(F.array_join(F.array_sort(words), "|")).alias("sorted_md5"),
    )
