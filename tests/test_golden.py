"""Small fixtures with documented results."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.fingerprint import row_md5
from millrace.functions.jsondoc import parse_report, ranking_rows, rejects, station_count
from millrace.functions.text import capitalize, jdbc_parts, mask_secret, title_words
from millrace.functions.times import epoch_text, text_epoch
from millrace.ingest.specs import WAREHOUSE
from millrace.ml.metrics import class_metrics, multilabel_summary, overall_metrics, per_label_metrics
from millrace.sources.catalog import MissingRoute, active_table, catalog_map, strip_shard
from millrace.sources.connectors import avro_options, jdbc_max, jdbc_options, jdbc_writer, read_connector
from millrace.sources.files import indexed_lines, labelled_lines, rating_lines, read_ctrl_a, read_delimited


@pytest.fixture()
def people(spark, tmp_path):
    path = tmp_path / "people.json"
    path.write_text('{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    return spark.read.json(str(path))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_people_json(people):
    assert dict(people.dtypes) == {"age": "bigint", "name": "string"}
    assert rows(people.select("name", (F.col("age") + 1).alias("a"))) == [("Andy", 31), ("Justin", 20), ("Michael", None)]
    assert rows(people.filter(people["age"] > 21)) == [(30, "Andy")]
    assert rows(people.groupBy("age").count()) == [(19, 1), (30, 1), (None, 1)]
    assert rows(people.filter("age BETWEEN 13 AND 19").select("name")) == [("Justin",)]


def test_people_text(spark, tmp_path):
    path = tmp_path / "people.txt"
    path.write_text("Michael, 29\nAndy, 30\nJustin, 19\n")
    people = read_delimited(spark, str(path), "name string, age int")
    teens = people.filter("age >= 13 AND age <= 19").select(F.concat(F.lit("Name: "), "name"))
    assert rows(teens) == [("Name: Justin",)]


def test_ctrl_a(spark, tmp_path):
    path = tmp_path / "kv.txt"
    path.write_text("".join(f"{k}\x01val_{k}\n" for k in (238, 86, 0, 0, 2)))
    table = read_ctrl_a(spark, str(path), "key int, value string")
    assert rows(table.filter("key < 10").orderBy("key")) == [(0, "val_0"), (0, "val_0"), (2, "val_2")]


def test_nested_json(spark):
    text = '{"name":"Yin","address":{"city":"Columbus","state":"Ohio"}}'
    df = spark.range(1).select(F.from_json(F.lit(text), "name string, address struct<city:string,state:string>").alias("j"))
    assert rows(df.select("j.name", "j.address.city", "j.address.state")) == [("Yin", "Columbus", "Ohio")]


def test_schema_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1, 6).select(F.col("id").alias("single"), (F.col("id") * F.col("id")).alias("double")).write.parquet(f"{path}/key=1")
    spark.range(6, 11).select(F.col("id").alias("single"), F.pow("id", 3).cast("bigint").alias("triple")).write.parquet(f"{path}/key=2")
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    assert dict(merged.dtypes) == {"single": "bigint", "double": "bigint", "triple": "bigint", "key": "int"}
    assert (6, None, 216, 2) in rows(merged.select("single", "double", "triple", "key"))


def test_reader_schema(spark, tmp_path):
    path = str(tmp_path / "users")
    spark.createDataFrame(
        [("Alyssa", None, [3, 9, 15, 20]), ("Ben", "red", [])], "name string, favorite_color string, favorite_numbers array<int>"
    ).write.parquet(path)
    narrow = read_connector(spark, "parquet", {"path": path}, "name string, favorite_color string")
    assert rows(narrow) == [("Alyssa", None), ("Ben", "red")]
    assert avro_options("p", "{}") == {"path": "p", "avroSchema": "{}"}


def test_line_formats(spark):
    lines = lambda *texts: spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows(labelled_lines(lines("-1 2.0 x", "1,3 4"))) == [(0.0, [2.0, None]), (1.0, [3.0, 4.0])]
    assert rows(indexed_lines(lines("1 1:0.5 4:2"))) == [(1.0, {1: 0.5, 4: 2.0})]
    assert rows(rating_lines(lines("7::9::4.0"), "::", 2.5)) == [(7, 9, 1.5)]


def test_times(spark):
    df = spark.range(1).select(text_epoch(F.lit("2017-07-09 14:55:21")).alias("s"), epoch_text(F.lit(1486667450)).alias("t"))
    assert rows(df) == [(1499612121, "2017-02-09 19:10:50")]


def test_text(spark):
    df = spark.range(1).select(
        capitalize(F.lit("hELLO wORLD")), title_words(F.lit("ets_score_std"), "_"), mask_secret(F.lit("jdbc:x://h?user=a&password=b&c=d"))
    )
    assert rows(df) == [("Hello world", "Ets_Score_Std", "jdbc:x://h?user=a&password=***&c=d")]
    parts = jdbc_parts(F.lit("jdbc:mysql://10.0.0.7:3307/ware?user=me&password=pw&useUnicode=true"))
    got = spark.range(1).select(*[v.alias(k) for k, v in parts.items()]).first().asDict()
    assert got == {"host": "10.0.0.7", "port": "3307", "db": "ware", "user": "me"}


def test_row_md5_is_the_python_text(spark):
    df = spark.sql(
        "select 7 as id, cast(null as string) as name, cast(86.5 as decimal(10,3)) as score, "
        "timestamp_ntz'2017-07-09 14:55:04.5' as a, timestamp_ntz'2017-07-09 14:55:04' as b"
    )
    columns = ["id", "name", "score", "a", "b"]
    text = "T.7|T.None|T.86.500|T.2017-07-09 14:55:04.500000|T.2017-07-09 14:55:04"
    template = "|".join(["T.%s"] * 5)
    assert df.select(row_md5(template, columns, df.schema)).first()[0] == hashlib.md5(text.encode()).hexdigest()


def test_warehouse_specs():
    assert len(WAREHOUSE) == 17
    for spec in WAREHOUSE.values():
        assert spec.template.count("%s") == len(spec.hashed), spec.target
    assert "%sApply_Student" in WAREHOUSE["ets_apply_student"].template
    assert WAREHOUSE["ets_score"].template.startswith("score.%s|Score.%s")
    assert WAREHOUSE["ets_osce_score"].template.endswith("osce_score.%s |osce_score.%s")
    assert WAREHOUSE["ets_osce_exam_examinee"].template.startswith("GradeItem.")
    assert sorted(t for t, s in WAREHOUSE.items() if s.changed is None) == ["ets_gradeitem", "ets_osce_exam_examinee"]


def test_reports(spark):
    docs = [
        {"rankinglist": [{"ranking": 1, "score": 9.5, "name": "a"}], "analysis": {"stationarray": ["x", "y"]}},
        {"rankinglist": []},
        {"analysis": {}},
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("no json",), (None,)], "report string")
    assert rows(ranking_rows(df)) == [(1, 9.5, "a")]
    assert rows(station_count(df)) == [(2,)]
    assert rows(station_count(df.filter("report like '%ranking%' and report not like '%station%'"))) == [(1,)]
    assert rows(rejects(df)) == [("no json",)]
    assert df.select(parse_report().alias("r")).count() == 5


def test_routing(spark):
    control = spark.createDataFrame([("task_ets_score", "ets_score_1")], "taskname string, which_for_cs string")
    assert active_table(control, "task_ets_score") == "ets_score_1"
    with pytest.raises(MissingRoute):
        active_table(control, "task_other")
    names = spark.createDataFrame([("Score",), ("Apply_Student",)], "source string")
    assert rows(catalog_map(names)) == [("ets_apply_student", "Apply_Student"), ("ets_score", "Score")]
    assert strip_shard("ets_score_0") == "ets_score"


def test_jdbc_options(spark):
    options = jdbc_options("jdbc:x", "t", partition_column="id", bounds=("0", "100"), partitions=8)
    assert options["numPartitions"] == "8" and options["pushDownPredicate"] == "true"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")
    assert jdbc_max("jdbc:x", "t", "updatets")["dbtable"].startswith("(select max(updatets)")
    assert jdbc_writer(spark.range(1), "jdbc:x", "t", column_types="id CHAR(4)", truncate=True, connections=1) is not None


MULTILABEL = [
    ([0.0, 1.0], [0.0, 2.0]),
    ([0.0, 2.0], [0.0, 1.0]),
    ([], [0.0]),
    ([2.0], [2.0]),
    ([2.0, 0.0], [2.0, 0.0]),
    ([0.0, 1.0, 2.0], [0.0, 1.0]),
    ([1.0], [1.0, 2.0]),
]


def test_multilabel_fixture(spark):
    df = spark.createDataFrame(MULTILABEL, "predictions array<double>, labels array<double>")
    got = multilabel_summary(df).first().asDict()
    n = len(MULTILABEL)
    inter = [len(set(p) & set(y)) for p, y in MULTILABEL]
    assert got["recall"] == pytest.approx(sum(b / len(y) for b, (p, y) in zip(inter, MULTILABEL)) / n)
    assert got["precision"] == pytest.approx(sum(b / len(p) if p else 0 for b, (p, y) in zip(inter, MULTILABEL)) / n)
    assert got["accuracy"] == pytest.approx(sum(b / len(set(p) | set(y)) for b, (p, y) in zip(inter, MULTILABEL)) / n)
    assert got["subset_accuracy"] == pytest.approx(2 / 7)
    wrong = sum(len(set(p) ^ set(y)) for p, y in MULTILABEL)
    assert got["hamming_loss"] == pytest.approx(wrong / (n * 3))
    assert got["micro_f1"] == pytest.approx(2 * sum(inter) / sum(len(p) + len(y) for p, y in MULTILABEL))
    by_label = {r["label"]: r for r in per_label_metrics(df).collect()}
    assert by_label[0.0]["precision"] == 1.0 and by_label[0.0]["recall"] == pytest.approx(4 / 5)


def test_class_metrics(spark):
    pairs = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0)]
    per_class = class_metrics(spark.createDataFrame(pairs, "label double, prediction double"))
    got = {r["class"]: r for r in per_class.collect()}
    assert got[1.0]["precision"] == pytest.approx(2 / 3) and got[1.0]["recall"] == 1.0
    assert got[2.0]["precision"] == 0.0 and got[0.0]["fpr"] == pytest.approx(1 / 3)
    assert overall_metrics(per_class).first()["accuracy"] == pytest.approx(3 / 5)
