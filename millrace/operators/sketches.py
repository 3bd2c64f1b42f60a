"""Distinct counts and quantiles from sketches that are stored per slice (a day, say) and put together later."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^k registers of a distinct sketch (relative error about 1.04 / sqrt(2^k)) and the k of a quantile sketch (rank error about 2.3 / k^0.9).
DISTINCT_BITS, QUANTILE_K = 14, 400


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Three standard errors of a distinct count, as a share of it."""
    return 3 * 1.04 / math.sqrt(1 << bits)


def rank_error(k: int = QUANTILE_K) -> float:
    """The error of a quantile's rank that 99 of 100 sketches keep to, as a share of all rows."""
    return 2.296 / k**0.9021


def sketch(df: DataFrame, slices: list[str], distinct: dict[str, Column], quantiles: dict[str, Column], bits: int = DISTINCT_BITS, k: int = QUANTILE_K) -> DataFrame:
    """One row per slice with the sketches of its rows; rows are folded into them before the shuffle, so a hot slice travels as one sketch a task."""
    return df.groupBy(*slices).agg(
        *[F.hll_sketch_agg(c, F.lit(bits)).alias(n) for n, c in distinct.items()],
        *[F.kll_sketch_agg_double(c.cast("double"), k).alias(n) for n, c in quantiles.items()],
    )


def merge(sketches: DataFrame, keys: list[str], distinct: list[str], quantiles: list[str]) -> DataFrame:
    """Stored sketches put together per key; no row is read again."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(n).alias(n) for n in distinct], *[F.kll_merge_agg_double(n).alias(n) for n in quantiles])


def estimates(sketches: DataFrame, keys: list[str], distinct: list[str], quantiles: dict[str, float]) -> DataFrame:
    """Distinct counts, and the quantile asked of each quantile sketch; null where a slice had only nulls."""
    return sketches.select(
        *keys,
        *[F.hll_sketch_estimate(n).alias(n) for n in distinct],
        *[F.when(F.kll_sketch_get_n_double(n) > 0, F.kll_sketch_get_quantile_double(n, F.lit(float(q)))).alias(n) for n, q in quantiles.items()],
    )
