"""Connected components and the dealing of pair work, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that can be reached.

    Large-star and small-star rounds: each node hangs its larger neighbours, then itself and its smaller ones, under the smallest
    neighbour. Only minima and joins, no neighbour lists; every round is written to the shared folder. The rounds grow with
    the logarithm of the longest path.
    """
    edges = cut_lineage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = cut_lineage(small.select("e.*").filter("a <> b").distinct(), "edges")


def deal_pairs(rows: DataFrame, cell: list[str], key: str, rows_per_task: int) -> DataFrame:
    """Rows with ``chunk``, ``one``, ``two``: every two rows of a cell meet in exactly one task (cell, one, two).

    A cell of up to ``rows_per_task`` rows is one task. A larger one is cut into chunks by the hash of ``key`` and each two
    chunks are a task, so no task holds more than about twice that many rows. In a task of two chunks only pairs across them count.
    """
    parts = F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("parts")
    dealt = rows.join(rows.groupBy(*cell).agg(parts), cell).withColumn("chunk", F.pmod(F.xxhash64(F.col(key)), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.withColumns({"one": F.least("chunk", "other"), "two": F.greatest("chunk", "other")}).drop("parts", "other")
