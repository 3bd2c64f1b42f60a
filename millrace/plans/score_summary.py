"""Score summary: maximum, minimum, average and a leaderboard of five for five training groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsondoc import ranking_rows, to_json_text
from millrace.operators.intervals import contained_in
from millrace.operators.ranking import top_k, top_k_per_group
from millrace.session import cut_lineage

# Learn types and the JSON keys of the five groups.
GROUP_OF_TYPE = {0: "zxxl", 1: "ksmxr", 2: "znsb"}
AFTER_CLASS = "khxl"
EXAM = "osce"
GROUPS = ["zxxl", "znsb", "ksmxr", "khxl", "osce"]

SCORE = "decimal(18,3)"


def group_scores(scores: DataFrame, learn: DataFrame, windows: DataFrame, reports: DataFrame) -> DataFrame:
    """(grp, id, name, score, mark) of all five groups.

    ``scores``: sheet, person, starttime, endtime, score. ``learn``: sheet, type.
    ``windows``: person, status, start_dt, end_dt. ``reports``: report (JSON). ``mark`` is every score as a number; ``score`` is the decimal of a
    training score. Exam scores are numbers of a JSON report and stay as they are.
    """
    score = [F.col("score").cast(SCORE).alias("score"), F.col("score").cast("double").alias("mark")]
    no_name = F.lit(None).cast("string").alias("name")
    label = F.create_map(*[F.lit(x) for pair in GROUP_OF_TYPE.items() for x in pair])
    trained = (
        scores.join(learn.filter(F.col("type").isin(*GROUP_OF_TYPE)), "sheet")
        .select(label[F.col("type")].alias("grp"), F.col("person").alias("id"), no_name, *score)
    )
    after_class = contained_in(
        scores.select("person", "starttime", "endtime", "score"),
        windows.filter(F.col("status") == 1).select("person", "start_dt", "end_dt"),
    ).select(F.lit(AFTER_CLASS).alias("grp"), F.col("person").alias("id"), no_name, *score)
    exams = ranking_rows(reports).select(F.lit(EXAM).alias("grp"), F.lit(None).cast("bigint").alias("id"), "name", F.lit(None).cast(SCORE).alias("score"), F.col("score").alias("mark"))
    return trained.unionByName(after_class).unionByName(exams)


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def score_metrics(rows: DataFrame) -> DataFrame:
    """(grp, max, min, avg) as doubles; a group without scores shows zeros."""
    # decimals add up exactly; exam scores are averaged as the numbers they are
    total, n = F.sum("score"), F.count("score")
    mean = F.coalesce(F.try_divide(total.cast("double"), n.cast("double")), F.avg("mark"))
    return rows.groupBy("grp").agg(_or_zero(F.max("mark")).alias("max"), _or_zero(F.min("mark")).alias("min"), _or_zero(mean).alias("avg"))


def leaderboard(rows: DataFrame, k: int = 5) -> DataFrame:
    """Best ``k`` attempts per group (a person may appear twice); ties fall to the smaller id, then name."""
    order = [F.col("mark").desc_nulls_last(), F.col("id").asc_nulls_last(), F.col("name").asc_nulls_last()]
    # five known groups: a bounded heap per task and group, where a window would sort all rows
    best = [top_k(rows.filter(F.col("grp") == grp), k, *order) for grp in GROUPS]
    return top_k_per_group(reduce(DataFrame.unionByName, best), "grp", k, *order)


def score_summary(scores: DataFrame, learn: DataFrame, windows: DataFrame, reports: DataFrame) -> DataFrame:
    """Long form: (grp, metric, value, who)."""
    # written once: the metrics and the leaderboard each read the columns they need instead of joining again
    rows = cut_lineage(group_scores(scores, learn, windows, reports), "group-scores")
    nobody = F.lit(None).cast("string").alias("who")
    metrics = score_metrics(rows).unpivot("grp", ["max", "min", "avg"], "metric", "value").select("grp", "metric", "value", nobody)
    ranks = leaderboard(rows).select(
        "grp",
        F.concat(F.lit("rank"), F.col("rank").cast("string")).alias("metric"),
        F.col("mark").alias("value"),
        F.coalesce(F.col("name"), F.col("id").cast("string")).alias("who"),
    )
    return metrics.unionByName(ranks)


def score_summary_json(summary: DataFrame, load_time: Column) -> DataFrame:
    """The stored form: one row (id, scores, createts, updatets) from the long form (at most 40 rows).

    Training scores are decimals and so quoted, with three places (seven for the average); exam scores come out
    of a JSON report and stay numbers.
    """
    fields = []
    for grp in GROUPS:
        here = F.col("grp") == grp

        def shown(value: Column, places: int = 3) -> Column:
            return value if grp == EXAM else value.cast(f"decimal(25,{places})").cast("string")

        def pick(metric: str, places: int = 3) -> Column:
            return shown(_or_zero(F.max(F.when(here & (F.col("metric") == metric), F.col("value")))), places)

        is_rank = here & F.col("metric").startswith("rank")
        who = F.col("who").alias("name") if grp == EXAM else F.col("who").cast("bigint").alias("id")
        entry = F.struct(F.col("metric"), F.struct(who, shown(F.col("value")).alias("score")).alias("entry"))
        ranked = F.transform(F.array_sort(F.collect_list(F.when(is_rank, entry))), lambda e: e["entry"])
        fields.append(
            F.struct(
                pick("max").alias(f"{grp}_maxscore"),
                pick("min").alias(f"{grp}_minscore"),
                pick("avg", 7).alias(f"{grp}_avgscore"),
                ranked.alias(f"{grp}_rank5"),
            ).alias(grp)
        )
    return summary.agg(to_json_text(F.struct(*fields)).alias("scores")).select(
        F.lit(1).cast("bigint").alias("id"), "scores", load_time.alias("createts"), load_time.alias("updatets")
    )
