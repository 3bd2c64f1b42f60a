"""Mixing sources to target weights by entropy balancing. DataFrame operations only.

Each document gets a rate, the expected number of its copies. Among all rates between 0 and CAP that give every source its
target of words, those nearest to one copy each in the sense of bounded entropy solve

    minimise  sum  r ln r + (CAP - r) ln((CAP - r) / (CAP - 1))    with  sum size * r = target  for each source.

The dual has one multiplier per source and is convex; its solution tilts the odds of a document exponentially by its size:
r = CAP / (1 + (CAP - 1) exp(-multiplier * size / scale)). Newton steps, kept inside a shrinking bracket, run as one aggregation
over the cells (source, size, number of documents) each; the cells hold all that the rates depend on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import number_rows, salted_join
from millrace.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
#: Newton ends when every source is this near to its target.
TOLERANCE = 1e-7
#: Multipliers are sought between these bounds, where the rates of all sizes are 0 or CAP.
FARTHEST = 1e9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(cells: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_no, documents, source_size, scale, target, full) from cells (source, size, n).

    Sources in code point order, null last, take the weights in turn and share all words by weight; a source stops at ``cap`` times its size and what
    is left over goes to the others by weight. ``full`` marks the sources that stop.
    """
    sums = cells.groupBy("source").agg(
        F.sum("n").alias("documents"),
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.col("size").cast("double") * F.col("size") * F.col("n")).alias("squares"),
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    known = cut_lineage(number_rows(sums, [F.col("source").asc_nulls_last()], "source_no").withColumn("weight", weight), "sources")
    total = known.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, -1.0
    full = F.lit(False)
    while level != before:
        before = level
        full = F.col("weight") * F.lit(level) >= F.col("source_size") * cap
        if level == 0.0:
            full = F.col("source_size") == 0
        row = known.agg(F.sum(F.when(full, F.col("source_size") * cap).otherwise(0)), F.sum(F.when(~full, F.col("weight")))).first()
        # the level only rises, as every source that stops takes less than its share
        level = max(level, (total - (row[0] or 0)) / row[1]) if row[1] else level
    share = F.when(full, (F.col("source_size") * cap).cast("double")).otherwise(F.col("weight") * F.lit(level))
    return known.select(
        "source", "source_no", "documents", "source_size",
        F.when(F.col("source_size") > 0, F.col("squares") / F.greatest("source_size", F.lit(1))).otherwise(F.lit(1.0)).alias("scale"),
        share.alias("target"), full.alias("full"),
    )


def rate(multiplier: Column, size: Column, scale: Column, cap: int = CAP) -> Column:
    return cap / (1 + (cap - 1) * F.exp(-multiplier * size / scale))


def balance(cells: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """(source_no, multiplier) that bring every source that is not full to its target."""
    state = sources.filter(~F.col("full")).select(
        "source_no", "scale", "target", F.lit(0.0).alias("multiplier"), F.lit(-FARTHEST).alias("low"), F.lit(FARTHEST).alias("high")
    )
    state = cut_lineage(state, "multipliers")
    r = F.col("r")
    while True:
        joined = cells.join(state, "source_no").withColumn("r", rate(F.col("multiplier"), F.col("size"), F.col("scale"), cap))
        words = F.col("n") * F.col("size")
        got = joined.groupBy("source_no").agg(
            *[F.first(c).alias(c) for c in ("scale", "target", "multiplier", "low", "high")],
            F.sum(words * r).alias("words"),
            F.sum(words * F.col("size") / F.col("scale") * r * (1 - r / cap)).alias("slope"),
        )
        gap = F.col("target") - F.col("words")
        got = got.withColumns({
            "low": F.when(gap > 0, F.greatest("low", "multiplier")).otherwise(F.col("low")),
            "high": F.when(gap < 0, F.least("high", "multiplier")).otherwise(F.col("high")),
            "newton": F.col("multiplier") + F.try_divide(gap, F.col("slope")),
            "error": F.abs(gap) / F.col("target"),
        })
        middle = F.sinh((F.asinh("low") + F.asinh("high")) / 2)
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        done = F.col("error") <= TOLERANCE
        step = F.when(done, F.col("multiplier")).when(inside, F.col("newton")).otherwise(middle)
        state = cut_lineage(got.select("source_no", "scale", "target", step.alias("multiplier"), "low", "high", "error"), "multipliers")
        worst = state.agg(F.max("error"), F.max((F.col("high") - F.col("low")) / (F.abs("low") + F.abs("high") + 1))).first()
        if worst[0] is None or worst[0] <= TOLERANCE or worst[1] < 1e-15:
            return state.select("source_no", "multiplier")


def size_class(size: Column) -> Column:
    """The size with all but its seven leading bits zero: 64 classes for each doubling, whatever the data."""
    low = F.greatest(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))) - 6, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", size, low), low)


def allot(cells: DataFrame, solved: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, class, members, copies): the copies that the documents of a source and size class share.

    From the longest class down, each takes the whole number of copies nearest to its own words plus what is still owed; so what
    a source owes in the end is about half of one of its shortest documents. A source has at most 64 classes for each doubling of size.
    """
    tilted = F.when(F.col("full"), F.lit(float(cap))).otherwise(rate(F.col("multiplier"), F.col("size"), F.col("scale"), cap))
    classes = (
        cells.filter("size > 0")
        .join(solved, "source_no")
        .withColumns({"rate": tilted, "class": size_class(F.col("size"))})
        .groupBy("source_no", "class")
        .agg(
            F.sum("n").alias("members"),
            F.sum(F.col("n") * F.col("size")).alias("words"),
            F.sum(F.col("n") * F.col("size") * F.col("rate")).alias("wanted"),
        )
    )
    lists = classes.groupBy("source_no").agg(
        F.sort_array(F.collect_list(F.struct("class", "members", (F.col("words") / F.col("members")).alias("mean"), "wanted")), asc=False).alias("classes")
    )
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<struct<class:bigint,members:bigint,copies:bigint>>").alias("out"))

    def take(state: Column, c: Column) -> Column:
        due = state["owed"] + c["wanted"]
        copies = F.least(c["members"] * cap, F.greatest(F.lit(0), F.round(due / c["mean"]).cast("bigint"))).cast("bigint")
        one = F.struct(c["class"].alias("class"), c["members"].alias("members"), copies.alias("copies"))
        return F.struct((due - copies * c["mean"]).alias("owed"), F.concat(state["out"], F.array(one)).alias("out"))

    taken = lists.select("source_no", F.explode(F.aggregate("classes", start, take)["out"]).alias("c"))
    return taken.select("source_no", "c.class", "c.members", "c.copies")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """One row per input row: id, ``text_hash``, ``size`` (words), ``source_size``, ``target`` of its source, ``copies`` and ``taken`` (size times copies).

    Rates become copies class by class (:func:`allot`); the documents of a class, in order of size and hash, share its copies evenly, so
    each gets the whole number below or above its share and none more than ``cap``. Repeated rows are rounded one by one, a null id is an id
    like any other, a null text has size 0, and documents of size 0 get one copy, which adds no words. A null source is a source of its
    own, the last. An empty table gives no row; other columns are not read.
    """
    text = F.col(text_col)
    # a key that tells a null source from every name
    key = F.struct(F.col(source_col).isNull().alias("none"), F.coalesce(F.col(source_col), F.lit("")).alias("name"))
    sized = docs.select(F.col(id_col).alias("id"), key.alias("key"), word_count(text).alias("size"), F.xxhash64(text).alias("text_hash"))
    sized = cut_lineage(sized, "sized")
    cells = cut_lineage(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    named = cells.withColumn("source", F.when(~F.col("key.none"), F.col("key.name")))
    sources = cut_lineage(targets(named, weights, cap).withColumn("key", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))), "targets")
    cells = cut_lineage(cells.join(sources.select("key", "source_no"), "key").select("source_no", "size", "n"), "cells")
    solved = sources.join(balance(cells.filter("size > 0"), sources, cap), "source_no", "left")
    shares = allot(cells, solved.select("source_no", "scale", "full", "multiplier"), cap)

    spread = F.xxhash64("id", "text_hash")
    order = [F.col("key"), F.col("class"), F.col("size"), spread, F.col("id").asc_nulls_first(), F.col("text_hash").asc_nulls_first()]
    placed = number_rows(sized.withColumn("class", size_class(F.col("size"))), order, "place")
    placed = cut_lineage(placed, "placed")
    firsts = placed.groupBy("key", "class").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    given = firsts.join(sources.select("key", "source_no", "source_size", "target"), "key").join(shares, ["source_no", "class"], "left")
    given = cut_lineage(given, "shares")
    out = salted_join(placed, given.drop("n", "source_no"), ["key", "class"], counts=given.select("key", "class", "n"))
    wide = lambda c: c.cast("decimal(38,0)")
    until = lambda i: F.call_function("div", wide(i) * wide(F.col("copies")), wide(F.col("members")))
    at = F.col("place") - F.col("first")
    copies = F.when(F.col("size") > 0, until(at + 1) - until(at)).otherwise(1).cast("bigint")
    return out.select(
        F.col("id").alias(id_col), "text_hash", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )
