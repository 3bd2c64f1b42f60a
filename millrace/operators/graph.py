"""Page rank and transitive closure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import ROWS_PER_SPLIT
from millrace.session import cut_lineage


def page_rank(edges: DataFrame, rounds: int, rows_per_split: int = ROWS_PER_SPLIT, cut_every: int = 3) -> DataFrame:
    """(node, rank) after ``rounds`` of ``0.15 + 0.85 * sum(rank / outdegree)`` over distinct (src, dst).

    Nodes with out-links start at 1. A node without in-links leaves after the first round; a node without
    out-links receives but never gives. A source with very many links is split: its links
    are spread over parts, and its share of rank is copied once per part.
    """
    links = edges.select("src", "dst").distinct()
    degree = links.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    degree = cut_lineage(degree.withColumn("parts", F.ceil(F.col("degree") / rows_per_split).cast("int")))
    hot = degree.filter(F.col("parts") > 1).select("src", "parts")
    # at most edges / rows_per_split sources are hot
    spread = F.pmod(F.hash("dst"), F.coalesce(F.col("parts"), F.lit(1)))
    links = cut_lineage(links.join(F.broadcast(hot), "src", "left").select("src", "dst", spread.alias("part")))

    ranks = degree.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    for i in range(1, rounds + 1):
        shares = (
            ranks.join(degree, F.col("node") == F.col("src"))
            .select("src", (F.col("rank") / F.col("degree")).alias("share"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        )
        received = links.join(shares, ["src", "part"]).groupBy("dst").agg(F.sum("share").alias("sum"))
        ranks = received.select(F.col("dst").alias("node"), (F.col("sum") * 0.85 + 0.15).alias("rank"))
        if i % cut_every == 0 and i < rounds:
            ranks = cut_lineage(ranks)
    return ranks


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All pairs (src, dst) joined by a path of one or more edges.

    Semi-naive: each round extends only the pairs found in the round before, and stops when none is
    new. Every round is written to the checkpoint folder, so a lost executor costs one round. The join
    reads checkpointed data on both sides, which is what lets Spark split a hot middle node.
    """
    edges = cut_lineage(edges.select("src", "dst").distinct())
    steps = edges.select(F.col("src").alias("mid"), F.col("dst").alias("end"))
    known = edges
    fresh = edges
    while True:
        longer = fresh.join(steps, F.col("dst") == F.col("mid")).select("src", F.col("end").alias("dst")).distinct()
        fresh = cut_lineage(longer.join(known, ["src", "dst"], "left_anti"))
        if fresh.isEmpty():
            return known
        known = known.unionByName(fresh)
