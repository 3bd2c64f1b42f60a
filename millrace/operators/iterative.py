"""Iterative estimates whose state between rounds is a few numbers."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Points that are compared with the centres at once.
POINTS = 1 << 12


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)


def nearest(values: Column, centres: list[list[float]]) -> Column:
    """Index of the nearest centre, the lowest one on a tie."""
    distances = [
        F.struct(squared_distance(values, F.lit(c)).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)
    ]
    return F.array_min(F.array(*distances))["i"]


def _packed(points: DataFrame, values: str, dims: int) -> DataFrame:
    """(plain, points): the vectors of a batch as one block of doubles, dealt evenly; not plain is a batch with a vector that is null, of another length or not finite."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            flat = column.flatten()
            plain = not column.null_count and not flat.null_count and bool((np.diff(column.offsets.to_numpy()) == dims).all())
            block = flat.to_numpy().tobytes() if plain and np.isfinite(flat.to_numpy()).all() else None
            yield pa.RecordBatch.from_pydict({"plain": [block is not None], "points": pa.array([block], pa.binary())})

    vectors = points.select(F.col(values).cast("array<double>"))
    return vectors.mapInArrow(task, "plain boolean, points binary").repartition(points.sparkSession.sparkContext.defaultParallelism)


def _sums(packed: DataFrame, centres: list[list[float]]) -> list[tuple[int, list[float]]]:
    """(cluster, mean) of the points nearest to each centre; a task sends one sum a centre."""
    held = np.array(centres)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros_like(held), np.zeros(len(held), np.int64)
        for batch in batches:
            for block in batch.column(0):
                rows = np.frombuffer(block.as_buffer(), np.float64).reshape(-1, held.shape[1])
                for lo in range(0, len(rows), POINTS):
                    own = rows[lo : lo + POINTS]
                    apart = [own - c for c in held]
                    cluster = np.stack([np.einsum("ij,ij->i", d, d) for d in apart]).argmin(axis=0)
                    member = cluster == np.arange(len(held))[:, None]
                    sums += member.astype(np.float64) @ own
                    sizes += member.sum(axis=1)
        some = np.flatnonzero(sizes)
        if len(some):
            yield pa.RecordBatch.from_pydict({"cluster": some, "n": sizes[some], "total": pa.array(sums[some].tolist(), pa.list_(pa.float64()))})

    totals, sizes = np.zeros_like(held), np.zeros(len(held))
    for cluster, n, total in packed.mapInArrow(task, "cluster bigint, n bigint, total array<double>").collect():
        totals[cluster] += total
        sizes[cluster] += n
    return [(int(i), (totals[i] / sizes[i]).tolist()) for i in np.flatnonzero(sizes)]


def kmeans(points: DataFrame, values: str, centres: list[list[float]], limit: float, max_rounds: int | None = None) -> list[list[float]]:
    """Move the k centres to the mean of their points until they move less than ``limit`` in total.

    The points are packed once and kept, in memory where there is room; a round sends one sum a centre and task to the driver. A centre without points stays
    where it is. Tables with vectors that are null, of another length than the centres or not finite are read as they are in every round.
    """
    centres = [list(c) for c in centres]
    packed = _packed(points, values, len(centres[0]) if centres else 0).persist()
    try:
        plain = bool(centres and centres[0]) and len({len(c) for c in centres}) == 1 and packed.agg(F.min("plain")).first()[0]
        for _ in count() if max_rounds is None else range(max_rounds):
            if plain:
                means = _sums(packed.select("points"), centres)
            else:
                grouped = points.select(nearest(F.col(values), centres).alias("cluster"), array_to_vector(values).alias("v"))
                means = grouped.groupBy("cluster").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("mean")).collect()
            moved = 0.0
            for cluster, mean in means:
                moved += sum((a - b) ** 2 for a, b in zip(centres[cluster], mean))
                centres[cluster] = list(mean)
            if moved <= limit:
                break
    finally:
        packed.unpersist()
    return centres


def logistic_descent(
    points: DataFrame, label: str, features: list[str], rounds: int, start: list[float] | None = None, step: float = 1.0
) -> list[float]:
    """Weights after ``rounds`` of full gradient descent; labels are -1 and 1.

    The gradient is one aggregate per round; only the weights pass through the driver.
    """
    weights = list(start) if start is not None else [0.0] * len(features)
    y = F.col(label)
    for _ in range(rounds):
        margin = sum((F.col(f) * w for f, w in zip(features, weights)), F.lit(0.0))
        scale = (1.0 / (1.0 + F.exp(-y * margin)) - 1.0) * y
        gradient = points.agg(*[F.sum(scale * F.col(f)).alias(f) for f in features]).first()
        weights = [w - step * (gradient[f] or 0.0) for w, f in zip(weights, features)]
    return weights
