"""Samples and splits that come out the same on every run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import number_rows
from millrace.session import cut_lineage


def random_order(keys: list[str], seed: int) -> list[Column]:
    """A repeatable shuffle of unique keys."""
    return [F.md5(F.concat_ws("|", *keys, F.lit(str(seed)))), *[F.col(k) for k in keys]]


def md5_number(text: Column) -> Column:
    """The first 15 hex digits of the text's md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def fixed_size(df: DataFrame, n: int, keys: list[str], seed: int) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows when there are fewer)."""
    return df.orderBy(*random_order(keys, seed)).limit(n)


def fixed_size_with_replacement(df: DataFrame, n: int, keys: list[str], seed: int) -> DataFrame:
    """Exactly ``n`` draws; a row can come out several times.

    Row numbers are drawn at random and joined to the numbered rows.
    """
    numbered = number_rows(df, [F.col(k) for k in keys], "__row")
    size = numbered.agg(F.max("__row")).first()[0]
    if not size:
        return df.limit(0)
    draw = md5_number(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)))) % F.lit(size) + 1
    draws = df.sparkSession.range(n).select(draw.alias("__row"))
    return draws.join(numbered, "__row").drop("__row")


def uniform(keys: list[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the row's keys only, so that it is the same on any number of executors."""
    return md5_number(F.concat_ws("|", *keys, F.lit(str(seed)))) / F.lit(float(1 << 60))


def poisson_steps(mean: float) -> list[float]:
    """The values of the Poisson distribution function below one."""
    steps, term = [], math.exp(-mean)
    while not steps or steps[-1] < 1.0 and term > 1e-17:
        steps.append((steps[-1] if steps else 0.0) + term)
        term *= mean / len(steps)
    return steps


def _copied(df: DataFrame, copies: Column) -> DataFrame:
    drawn = df.withColumn("__copies", copies).filter("__copies > 0")
    return drawn.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).drop("__copies", "__copy")


def bernoulli(df: DataFrame, fraction: float, seed: int, keys: list[str], replacement: bool = False) -> DataFrame:
    """Each row with probability ``fraction``, or with replacement a Poisson number of times; one pass, repeatable."""
    u = uniform(keys, seed)
    if not replacement:
        return df.filter(u < fraction)
    return _copied(df, sum(((u >= step).cast("int") for step in poisson_steps(fraction)), F.lit(0)))


def stratified(df: DataFrame, key: str, fractions: dict, seed: int, keys: list[str], replacement: bool = False) -> DataFrame:
    """A fraction per value of ``key``; values without a fraction are left out. One pass, whatever the number of values.

    The fractions are the caller's and as small as they came, hence the broadcast.
    """
    kind = df.schema[key].dataType.simpleString()
    steps = [(value, poisson_steps(f) if replacement else [1.0 - f]) for value, f in fractions.items()]
    table = F.broadcast(df.sparkSession.createDataFrame(steps, f"__value {kind}, __steps array<double>"))
    joined = df.join(table, F.col(key) == F.col("__value"))
    u = uniform(keys, seed)
    return _copied(joined, F.size(F.filter("__steps", lambda step: u >= step))).drop("__value", "__steps")


def key_shares(df: DataFrame, key: str) -> DataFrame:
    """(key, n, share); the total is the sum of the counts, the table is read once."""
    counts = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "shares")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.withColumn("share", F.col("n") / F.lit(max(total, 1)))


def hash_split(df: DataFrame, keys: list[str], weights: list[float]) -> list[DataFrame]:
    """Disjoint parts that cover all rows; a row's part depends only on its key."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", *keys)), 1, 8), 16, 10).cast("bigint") / F.lit(2**32)
    total = sum(weights)
    parts, low = [], 0.0
    for i, weight in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + weight / total
        parts.append(df.filter((bucket >= low) & (bucket < high)))
        low = high
    return parts
