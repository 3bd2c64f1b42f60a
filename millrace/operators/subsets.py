"""Inner joins of every subset (three or more) of five keyed score tables, in one pass."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import salted_join

SOURCES = 5
EXAM_BIT = 16


def subset_masks(sources: int = SOURCES, smallest: int = 3) -> list[int]:
    """Bit masks of all subsets with at least ``smallest`` members."""
    return [
        sum(1 << i for i in picked) for size in range(smallest, sources + 1) for picked in combinations(range(sources), size)
    ]


def truthy(score: Column) -> Column:
    """Neither null nor zero."""
    return F.coalesce(score != 0, F.lit(False))


def tag_sources(tables: list[DataFrame], score_type: str = "double") -> DataFrame:
    """Stack (person, score) tables as (person, bit, score); table i gets bit ``1 << i``."""
    tagged = [
        one.select("person", F.lit(1 << i).alias("bit"), F.col("score").cast(score_type).alias("score"))
        for i, one in enumerate(tables)
    ]
    return reduce(DataFrame.unionByName, tagged)


def people_and_exams(tagged: DataFrame, exams: DataFrame, score_type: str = "double") -> DataFrame:
    """One row per person: the best score of each source, the sources present, those with a non-zero best.

    ``tagged`` is (person, bit, score) over the four training sources, any number of rows; ``exams`` is
    (person, exam, score). One grouped pass over the stacked rows replaces a chain of full joins, and partial
    aggregation keeps a person with very many rows cheap.
    """
    score = F.col("score").cast(score_type)
    exam_best = exams.groupBy("person").agg(
        F.lit(EXAM_BIT).alias("bit"),
        # any non-zero total makes the exam source non-zero
        F.max(F.when(truthy(F.col("score")), F.lit(1)).otherwise(0)).cast(score_type).alias("score"),
    )
    stacked = tagged.select("person", "bit", score.alias("score")).unionByName(exam_best)
    best = [F.max(F.when(F.col("bit") == (1 << i), F.col("score"))).alias(f"s{i + 1}") for i in range(SOURCES)]
    nonzero = sum(
        (F.when(truthy(F.col(f"s{i + 1}")), F.lit(1 << i)).otherwise(0) for i in range(SOURCES)),
        F.lit(0),
    )
    grouped = (
        stacked.filter(F.col("person").isNotNull())
        .groupBy("person")
        .agg(*best, F.bit_or("bit").alias("present"))
    )
    return grouped.withColumn("nonzero", nonzero)


def join_subsets(tagged: DataFrame, exams: DataFrame, most_complete: bool = False, score_type: str = "double") -> DataFrame:
    """Rows (person, mask, s1..s4, exam, exam_score): the union of all subset joins.

    A row carries the scores of the members of ``mask`` and nulls elsewhere. Subsets without the exam table
    come once per person, subsets with it once per exam of the person.

    With ``most_complete`` only rows with a person's highest number of non-zero scores are kept. Those are the subsets that
    contain every source with a non-zero score (and, if any exam total is non-zero, such an exam), so no ranking of the
    exploded rows is needed.
    """
    people = people_and_exams(tagged, exams, score_type)
    masks = F.array(*[F.lit(m) for m in subset_masks()])
    required = F.col("nonzero") if most_complete else F.lit(0)
    allowed = F.filter(
        masks,
        lambda m: (m.bitwiseAND(F.col("present")) == m) & (m.bitwiseAND(required) == required),
    )
    kept = people.withColumn("mask", F.explode(allowed))
    member = lambda i: F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col(f"s{i + 1}")).alias(f"s{i + 1}")
    members = [member(i) for i in range(SOURCES - 1)]
    with_exam = F.col("mask").bitwiseAND(EXAM_BIT) != 0

    plain = kept.filter(~with_exam).select(
        "person",
        "mask",
        *members,
        F.lit(None).cast(exams.schema["exam"].dataType).alias("exam"),
        F.lit(None).cast(score_type).alias("exam_score"),
    )
    # masks travel as one array per person, so that each exam row meets one partner
    wanted = (
        people.withColumn("masks", F.filter(allowed, lambda m: m.bitwiseAND(EXAM_BIT) != 0))
        .filter(F.size("masks") > 0)
        .withColumn("exam_nonzero", F.col("nonzero").bitwiseAND(EXAM_BIT) != 0)
    )
    exam_rows = exams.select("person", "exam", F.col("score").cast(score_type).alias("exam_score"))
    matched = salted_join(exam_rows, wanted, "person")
    if most_complete:
        matched = matched.filter(truthy(F.col("exam_score")) | ~F.col("exam_nonzero"))
    matched = matched.withColumn("mask", F.explode("masks")).select("person", "mask", *members, "exam", "exam_score")
    return plain.unionByName(matched)
