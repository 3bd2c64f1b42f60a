"""Term weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Words whose document frequencies are sent to every task, the most frequent first.
FREQUENT_WORDS = 400_000


def frequent_from(frequency: DataFrame, df: str = "df", most: int = FREQUENT_WORDS) -> int:
    """The smallest power of two that at most ``most`` rows reach with ``df``."""
    sizes = frequency.groupBy(F.floor(F.log2(F.col(df))).cast("int").alias("power")).count().collect()
    reached, power = 0, 1 + max((r["power"] for r in sizes), default=-1)
    for r in sorted(sizes, key=lambda r: -r["power"]):
        reached += r["count"]
        if reached > most:
            break
        power = r["power"]
    return 1 << power


def tf_idf(tokens: DataFrame, documents: int, doc: str = "doc_id", word: str = "word", most: int = FREQUENT_WORDS) -> DataFrame:
    """(doc, word, tf, weight) with weight ``tf * ln((N + 1) / (df + 1))`` on exact terms, N = ``documents``.

    The most frequent words have nearly all rows: their document frequencies meet the counts by broadcast, so that neither these rows are shuffled
    nor a word in nearly every document makes a hot key. The rest is joined by word.
    """
    # written once: the counts per document and the document frequencies come from the same tokens
    tf = cut_lineage(tokens.groupBy(doc, word).agg(F.count(F.lit(1)).alias("tf")), "terms")
    frequency = cut_lineage(tf.groupBy(word).agg(F.count(F.lit(1)).alias("df")), "frequencies")
    least = frequent_from(frequency, most=most)
    frequent = F.broadcast(frequency.filter(F.col("df") >= least))
    met = tf.join(frequent, word)
    rest = tf.join(frequent.select(word), word, "left_anti").join(frequency.filter(F.col("df") < least), word)
    weight = F.col("tf") * F.log(F.lit(float(documents + 1)) / (F.col("df") + 1))
    return met.unionByName(rest).select(doc, word, "tf", weight.alias("weight"))
