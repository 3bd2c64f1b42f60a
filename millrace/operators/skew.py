"""Joins and numbering that hold when one key has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.session import cut_lineage

#: Rows of one key that a single task is asked to hold before the key is split.
ROWS_PER_SPLIT = 2_000_000


def row_salt(df: DataFrame, splits: Column) -> Column:
    """Split number in ``[0, splits)`` from the row's content and its input partition.

    It does not depend on the order of rows inside the partition, so a task that is
    run again after an executor was lost puts each row where it was before. The partition
    number spreads exact copies of one row.
    """
    return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), splits).cast("int")


def salted_sides(
    big: DataFrame,
    small: DataFrame,
    big_keys: list[str],
    small_keys: list[str],
    counts: DataFrame | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
    salt: str = "salt",
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``salt`` column, ready for an equi-join on keys and salt.

    Keys of ``big`` with more than ``rows_per_split`` rows are split into
    ``ceil(rows / rows_per_split)`` parts, and the matching rows of ``small`` are copied
    once per part. All other keys keep part 0. ``counts`` (big_keys, n) saves counting the rows per key when
    they are known already.
    """
    if counts is None:
        counts = big.groupBy(*big_keys).agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / rows_per_split).cast("int")
    hot_names = [f"__hot_{k}" for k in big_keys]
    hot = counts.filter(F.col("n") > rows_per_split).select(
        *[F.col(k).alias(h) for k, h in zip(big_keys, hot_names)], parts.alias("__parts")
    )
    # at most rows(big) / rows_per_split entries, hence a safe broadcast
    hot = F.broadcast(hot)
    splits = F.coalesce(F.col("__parts"), F.lit(1))

    def with_parts(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.join(hot, [F.col(c) == F.col(h) for c, h in zip(columns, hot_names)], "left").drop(*hot_names)

    left = with_parts(big, big_keys).withColumn(salt, row_salt(big, splits)).drop("__parts")
    copies = F.explode(F.sequence(F.lit(0), splits - 1))
    right = with_parts(small, small_keys).withColumn(salt, copies).drop("__parts")
    return left, right


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: str | list[str],
    condition: Column | None = None,
    how: str = "inner",
    counts: DataFrame | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Inner or left-semi equi-join on ``keys`` (kept once) where ``big`` may be dominated by a few keys.

    Adaptive skew handling steps aside when the join output is grouped by the same key, or when one side is an
    aggregate; this join does not depend on it. See :func:`salted_sides`.
    """
    keys = [keys] if isinstance(keys, str) else keys
    renamed = [f"__key_{k}" for k in keys]
    small = small.withColumnsRenamed(dict(zip(keys, renamed)))
    left, right = salted_sides(big, small, keys, renamed, counts, rows_per_split, "__salt")
    right = right.withColumnRenamed("__salt", "__part")
    on = F.col("__salt") == F.col("__part")
    for k, r in zip(keys, renamed):
        on = on & (F.col(k) == F.col(r))
    if condition is not None:
        on = on & condition
    return left.join(right, on, how).drop("__salt", "__part", *renamed)


def _ordered(df: DataFrame, order: list[Column]) -> DataFrame:
    """The sorted rows, written once with the number of their range (``__range``) and their place in it (``__place``)."""
    placed = df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
    placed = cut_lineage(placed, "ordered")
    # the id holds the partition from bit 33 up and the position in it below
    return placed.select(
        *df.columns, F.shiftright("__id", 33).alias("__range"), F.col("__id").bitwiseAND((1 << 33) - 1).alias("__place")
    )


def _before(ordered: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per range, the totals of all ranges before it; the window sees one small row per range."""
    sums = ordered.groupBy("__range").agg(*[c.alias(name) for name, c in totals.items()])
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("__range", *[F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(name) for name in totals])


def number_rows(df: DataFrame, order: list[Column], name: str = "row_id") -> DataFrame:
    """Number the rows 1..n in the given total order without a one-task window."""
    ordered = _ordered(df, order)
    before = _before(ordered, {"__before": F.count(F.lit(1))})
    row_id = (F.col("__before") + F.col("__place") + 1).cast("bigint").alias(name)
    return ordered.join(F.broadcast(before), "__range").select(*df.columns, row_id)


def running_totals(df: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """``<c>_to``: sum of ``c`` over all rows up to and including this one, without a one-task window."""
    ordered = _ordered(df, order)
    before = _before(ordered, {f"__{c}": F.sum(c) for c in columns})
    inside = Window.partitionBy("__range").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    joined = ordered.join(F.broadcast(before), "__range")
    return joined.select(*df.columns, *[(F.sum(c).over(inside) + F.col(f"__{c}")).alias(f"{c}_to") for c in columns])


def zip_rows(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """Pair the i-th row of one side with the i-th row of the other; both orders must be total."""
    a = number_rows(left, left_order, "row_id")
    b = number_rows(right, right_order, "row_id")
    return a.join(b, "row_id")
