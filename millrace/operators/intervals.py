"""Attempts that fall inside a window opened for the same person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import epoch_seconds
from millrace.operators.skew import ROWS_PER_SPLIT, salted_join
from millrace.session import cut_lineage


def contained_in(
    attempts: DataFrame,
    windows: DataFrame,
    key: str = "person",
    once: bool = False,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """``attempts`` (key, starttime, endtime, ...) inside ``windows`` (key, start_dt, end_dt).

    An attempt inside two windows appears twice. With ``once`` it is enough that some window holds it (at most
    one row per length class), which is what a maximum needs.

    A plain join on the key would try every attempt of a person with every window. Windows are sorted into classes by
    length (powers of two); a window covers at most two time slots of its class, and an attempt meets
    only the windows that touch the slot of its start. Attempts of people without a window, and those that begin before the first window of their
    person or end behind the last, go no further; the others are repeated once per class among their own person's windows. Busy slots are split further by the salted join.
    """
    usable = windows.filter(F.col("end_dt") >= F.col("start_dt")).withColumns(
        {"__from": epoch_seconds(F.col("start_dt")), "__to": epoch_seconds(F.col("end_dt"))}
    )
    length = F.greatest(F.col("__to") - F.col("__from"), F.lit(1)).cast("double")
    usable = usable.withColumn("__class", F.ceil(F.log2(length)).cast("int"))
    # slots of a class are 2 ** class seconds wide
    first, last = (F.call_function("shiftright", F.col(c), F.col("__class")) for c in ("__from", "__to"))
    opened = usable.withColumn("__slot", F.explode(F.sequence(first, last))).drop("__from", "__to")
    # at most rows / rows_per_split people, counted once for both joins
    busy = cut_lineage(attempts.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_per_split), "busy")
    # a few dozen classes at most
    classes = usable.groupBy(key).agg(F.collect_set("__class").alias("__classes"), F.min("start_dt").alias("__first"), F.max("end_dt").alias("__last"))
    start = epoch_seconds(F.col("starttime"))
    place = F.transform("__classes", lambda c: F.struct(c.alias("__class"), F.call_function("shiftright", start, c).alias("__slot")))
    own = salted_join(attempts, classes, key, counts=busy, rows_per_split=rows_per_split)
    own = own.filter((F.col("starttime") >= F.col("__first")) & (F.col("endtime") <= F.col("__last")))
    placed = own.select(*attempts.columns, F.inline(place))
    # only the slots of busy people are counted one by one
    slots = [key, "__class", "__slot"]
    counts = placed.join(F.broadcast(busy.select(key)), key, "left_semi").groupBy(*slots).agg(F.count(F.lit(1)).alias("n"))
    inside = (F.col("starttime") >= F.col("start_dt")) & (F.col("endtime") <= F.col("end_dt"))
    joined = salted_join(
        placed, opened, slots, inside, "left_semi" if once else "inner", counts=counts, rows_per_split=rows_per_split
    )
    return joined.drop("__class", "__slot")
