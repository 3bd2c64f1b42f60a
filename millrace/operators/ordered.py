"""Windows and as-of joins over groups larger than a task: sorted ranges that may cut a group, and what is carried from range to range."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import _ordered


class LargeGroups:
    """The rows of ``df`` sorted by keys and a total order, in ranges of about equal size, written once.

    A range is a group's part or some whole groups, so no task holds more than a range of a group. At most one group of a range goes on from an earlier
    one: what is carried has one row a range at most, and that is all that is broadcast. Null keys are a group like any other.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[Column]) -> None:
        self.columns, self.keys = df.columns, keys
        self.rows = _ordered(df, [*[F.col(k) for k in keys], *order])
        firsts, lasts = (pick(F.struct(*keys), F.col("__place")) for pick in (F.min_by, F.max_by))
        self.edges = self.rows.groupBy("__range").agg(firsts.alias("__first"), lasts.alias("__last"))
        #: rows of one group in one range
        self.part = Window.partitionBy("__range", *keys).orderBy("__place")

    def _same(self, left: DataFrame, right: DataFrame, names: list[str]) -> Column:
        return reduce(Column.__and__, [left[n].eqNullSafe(right[n]) for n in names])

    def _cut(self) -> DataFrame:
        """The rows of groups that another range may share: those of the first and of the last key of every range."""
        own = F.struct(*self.keys)
        edges = F.broadcast(self.edges.withColumnRenamed("__range", "__edge"))
        at = self.rows.join(edges, F.col("__range") == F.col("__edge"))
        return at.filter(own.eqNullSafe(F.col("__first")) | own.eqNullSafe(F.col("__last"))).drop("__edge", "__first", "__last")

    def carried(self, parts: dict[str, tuple[Column, Callable[[Column], Column]]]) -> DataFrame:
        """For every group that goes on from earlier ranges, one row with what they carry into this one.

        Each part is an aggregate of a group's rows in a range, and the function that puts those of the earlier ranges together.
        """
        sums = self._cut().groupBy("__range", *self.keys).agg(*[c.alias(n) for n, (c, _) in parts.items()])
        earlier = Window.partitionBy(*self.keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        before = sums.select("__range", *self.keys, F.count(F.lit(1)).over(earlier).alias("__n"), *[f(F.col(n)).over(earlier).alias(n) for n, (_, f) in parts.items()])
        return before.filter("__n > 0").drop("__n")

    def joined(self, carried: DataFrame) -> DataFrame:
        names = ["__range", *self.keys]
        renamed = {n: f"__of_{n}" for n in names}
        carried = F.broadcast(carried.withColumnsRenamed(renamed))
        on = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(r)) for n, r in renamed.items()])
        return self.rows.join(carried, on, "left").drop(*renamed.values())

    def running(self, sums: dict[str, Column], number: str | None = None) -> DataFrame:
        """The rows with running sums of their group and, if wanted, the number of each row in it (from 1)."""
        wanted = dict(sums) | ({number: F.lit(1).cast("bigint")} if number else {})
        carried = self.carried({f"__{n}": (F.sum(c), F.sum) for n, c in wanted.items()})
        inside = self.part.rowsBetween(Window.unboundedPreceding, 0)
        totals = [(F.sum(c).over(inside) + F.coalesce(F.col(f"__{n}"), F.lit(0))).alias(n) for n, c in wanted.items()]
        return self.joined(carried).select(*self.columns, *totals)

    def last_known(self, values: dict[str, Column]) -> DataFrame:
        """The rows with the last value that is not null, of this row or an earlier one of its group."""
        carried = self.carried({f"__{n}": (F.max_by(c, F.when(c.isNotNull(), F.col("__place"))), lambda x: F.last(x, ignorenulls=True)) for n, c in values.items()})
        inside = self.part.rowsBetween(Window.unboundedPreceding, 0)
        found = [F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__{n}")).alias(n) for n, c in values.items()]
        return self.joined(carried).select(*self.columns, *found)

    def nearby(self, outputs: Callable[[Window], dict[str, Column]], before: int) -> DataFrame:
        """The rows with window functions that look at most ``before`` rows back: lags and sums over a frame of rows.

        A part of a group sees copies of the ``before`` rows ahead of it, which are dropped again.
        """
        if before < 1:
            raise ValueError("look back at one row or more")
        row = F.struct(F.col("__range").alias("r"), F.col("__place").alias("p"), *[F.col(c).alias(c) for c in self.columns])
        back = F.row_number().over(Window.partitionBy("__range", *self.keys).orderBy(F.col("__place").desc()))
        tails = self._cut().withColumn("__back", back).filter(F.col("__back") <= before)
        ends = tails.groupBy("__range", *self.keys).agg(F.array_sort(F.collect_list(row)).alias("__tail"))
        # rows of one group lie in neighbouring ranges, so the last rows of the last few of them are enough
        earlier = Window.partitionBy(*self.keys).orderBy("__range").rowsBetween(-before, -1)
        seen = ends.select("__range", F.flatten(F.collect_list("__tail").over(earlier)).alias("__seen"))
        last = F.slice("__seen", F.greatest(F.size("__seen") - before + 1, F.lit(1)), before)
        kept = seen.filter(F.size("__seen") > 0).select("__range", F.posexplode(last).alias("__pos", "x"))
        # before every row of the range, in their order
        ahead = kept.select(*[F.col(f"x.{c}").alias(c) for c in self.columns], "__range", (F.col("__pos") - before - 1).cast("bigint").alias("__place"), F.lit(True).alias("__copy"))
        both = self.rows.withColumn("__copy", F.lit(False)).unionByName(ahead)
        found = both.select(*self.columns, "__copy", *[c.alias(n) for n, c in outputs(self.part).items()])
        return found.filter(~F.col("__copy")).drop("__copy")


def ranked(df: DataFrame, keys: list[str], value: Column, tie: list[Column], descending: bool = False) -> DataFrame:
    """``row_number`` and ``rank`` (equal values share the first number of theirs) of every row in its group, by ``value`` and then ``tie``."""
    by = [value.desc() if descending else value.asc(), *tie]
    numbered = LargeGroups(df.withColumn("__value", F.struct(value.alias("v"))), keys, by).running({}, "row_number")
    # the number of the first row of each run of equal values, brought forward over ranges
    again = LargeGroups(numbered, keys, [F.col("row_number")])
    starts = again.nearby(lambda w: {"__start": ~F.coalesce(F.lag("__value").over(w).eqNullSafe(F.col("__value")), F.lit(False))}, 1)
    first = F.when(F.col("__start"), F.col("row_number"))
    return LargeGroups(starts, keys, [F.col("row_number")]).last_known({"rank": first}).drop("__value", "__start")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    tie: str,
    tolerance: Column | None = None,
    exact: bool = True,
) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` that has its keys and is not later (with ``exact=False``: earlier).

    Equal times of the right side fall to the larger ``tie``. Columns of the right side are null where there is no such row or it is more than ``tolerance``
    (an interval) away; rows without a time or with a null key meet nothing. Both sides are sorted once as one table, whose ranges may cut a key: the last row
    of the right side is carried from range to range. Names of the two sides must differ but for the keys.
    """
    values = [c for c in right.columns if c not in keys]
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"rename {sorted(clash)} on one side")
    as_left, as_right = (1, 0) if exact else (0, 1)
    own = F.struct(*[F.col(c).alias(c) for c in left.columns])
    other = F.struct(*[F.col(c).alias(c) for c in values])
    usable = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    none = lambda df, part: F.lit(None).cast(df.select(part).schema[0].dataType)
    marks = left.select(*keys, F.col(left_time).alias("__time"), F.lit(as_left).alias("__side"), F.lit(None).cast(right.schema[tie].dataType).alias("__tie"), own.alias("__own"), none(right, other).alias("__other"))
    rows = right.filter(usable & F.col(right_time).isNotNull()).select(
        *keys, F.col(right_time).alias("__time"), F.lit(as_right).alias("__side"), F.col(tie).alias("__tie"), none(left, own).alias("__own"), other.alias("__other")
    )
    order = [F.col("__time").asc_nulls_first(), F.col("__side"), F.col("__tie")]
    found = LargeGroups(marks.unionByName(rows), keys, order).last_known({"__last": F.col("__other")}).filter(F.col("__own").isNotNull())
    if tolerance is not None:
        found = found.withColumn("__last", F.when(F.col(f"__last.{right_time}") + tolerance >= F.col("__time"), F.col("__last")))
    return found.select("__own.*", "__last.*")
