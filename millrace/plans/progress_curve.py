"""Progress curve: each person's best training scores and exam totals, for people with enough of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsondoc import to_json_text
from millrace.operators.intervals import contained_in
from millrace.operators.skew import number_rows, salted_join
from millrace.operators.subsets import EXAM_BIT, join_subsets, people_and_exams
from millrace.session import cut_lineage

SCORE = "decimal(18,3)"
AFTER_CLASS_BIT = 8

# The source bit of each learn type (online 0, device 2, model 1).
BIT_OF_TYPE = {0: 1, 2: 2, 1: 4}

# JSON keys in the order online, device, model, after-class, exam.
KEYS = ["kqselftraining", "ksrobottraining", "ksmodeltraining", "khselftraining", "osce"]


def curve_inputs(
    scores: DataFrame, learn: DataFrame, windows: DataFrame, exam_scores: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Training attempts as (person, bit, score) and exam totals as (person, exam, score).

    Attempts come as the best of a sheet and person, or unreduced: the one grouped pass in ``people_and_exams`` takes each source's best.
    """
    bit = F.create_map(*[F.lit(x) for pair in BIT_OF_TYPE.items() for x in pair])
    # the attempts of a sheet lie together, so most meet before they are dealt out
    best = scores.groupBy("sheet", "person").agg(F.max("score").alias("score"))
    trained = best.join(learn.filter(F.col("type").isin(*BIT_OF_TYPE)), "sheet").select(
        "person", bit[F.col("type")].alias("bit"), "score"
    )
    after_class = contained_in(
        scores.select("person", "starttime", "endtime", "score"),
        windows.filter(F.col("status") == 1).select("person", "start_dt", "end_dt"),
        once=True,
    ).select("person", F.lit(AFTER_CLASS_BIT).alias("bit"), "score")
    exam_rows = exam_scores.filter(F.col("person").isNotNull())
    # written once: people and exam rows each read it
    exams = cut_lineage(exam_rows.groupBy("exam", "person").agg(F.sum(F.col("score").cast(SCORE)).alias("score")), "exams")
    return trained.unionByName(after_class), exams


def progress_curve(scores: DataFrame, learn: DataFrame, windows: DataFrame, exam_scores: DataFrame) -> DataFrame:
    """(person, exam, scores): people with three or more sources, rows with most non-zero scores.

    A missing source is the empty text, a null score is JSON null, numbers are quoted with three decimals.
    """
    attempts, exams = curve_inputs(scores, learn, windows, exam_scores)
    rows = join_subsets(attempts, exams, most_complete=True, score_type=SCORE)

    def shown(bit: int, score: str) -> Column:
        return F.when(F.col("mask").bitwiseAND(bit) != 0, F.col(score).cast("string")).otherwise(F.lit(""))

    columns = [shown(1 << i, f"s{i + 1}") for i in range(4)] + [shown(EXAM_BIT, "exam_score")]
    document = to_json_text(F.struct(*[c.alias(k) for c, k in zip(columns, KEYS)]))
    return rows.select("person", "mask", "exam", document.alias("scores"))


def progress_curve_stored(curve: DataFrame, load_time: Column) -> DataFrame:
    """The stored form (id, student_id, scores, createts, updatets); written by name."""
    numbered = number_rows(curve, [F.col("person"), F.col("mask"), F.col("exam")], "id")
    return numbered.select(
        "id", F.col("person").alias("student_id"), "scores", load_time.alias("createts"), load_time.alias("updatets")
    )


def progress_curve_all5(scores: DataFrame, learn: DataFrame, windows: DataFrame, exam_scores: DataFrame) -> DataFrame:
    """(id, student_id, exam, scores): only people with all five sources; a null score is the text ``None``."""
    attempts, exams = curve_inputs(scores, learn, windows, exam_scores)
    people = people_and_exams(attempts, exams, SCORE).filter(F.col("present") == 31)
    every = people.select("person", "s1", "s2", "s3", "s4")
    exam_rows = exams.select("person", "exam", F.col("score").cast(SCORE).alias("s5"))
    joined = salted_join(exam_rows, every, "person")
    text = [F.coalesce(F.col(f"s{i}").cast("string"), F.lit("None")).alias(k) for i, k in enumerate(KEYS, 1)]
    rows = joined.select("person", "exam", to_json_text(F.struct(*text)).alias("scores"))
    return number_rows(rows, [F.col("person"), F.col("exam")], "id").select("id", F.col("person").alias("student_id"), "exam", "scores")
