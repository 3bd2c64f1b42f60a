"""Repeated word windows, found through super-k-mers.

A window is WINDOW consecutive words of one document. Its minimiser is the run of MINIMISER words in it with the lowest hash, the leftmost of equals;
consecutive windows with the same minimiser make one super-k-mer, the words they cover. Equal windows have equal minimisers at equal places,
so a window is looked for only among the super-k-mers of its minimiser, at its own distance from it.

1. Every document is cut into super-k-mers. What travels first is not their words but, for each, the hash of the minimiser, an independent hash
   of the words (128 bits together), and the place. Of super-k-mers that are equal within a batch only the earliest travels to its bucket.
2. Sorted by both hashes, later copies of a super-k-mer are marked whole. A super-k-mer whose minimiser no other one has holds no repeated window.
3. For the rest the first copy of each super-k-mer travels as one packed string to the bucket of its minimiser, where the windows at each distance
   from the minimiser are sorted and equal ones found; all but the earliest are marked. A minimiser with more than CROWD different super-k-mers
   (a common phrase in ever new surroundings) is spread: its windows travel one by one to the bucket of their own words.
4. Marks go back to their documents, and words under a mark are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrays import byte_codes, passes, range_hashes, runs, whole_groups, word_ranges
from millrace.session import cut_lineage

WINDOW = 20
MINIMISER = 5
#: Different super-k-mers of one minimiser that one task compares.
CROWD = 20_000

_FIRST, _SECOND = byte_codes(1), byte_codes(2)

# A place is one long: first word of the super-k-mer, its number of windows (16 bits), words from its start to the minimiser (14 bits), two flags.
_CROWDED, _COPY = 1, 2


def cut(data: np.ndarray, bounds: np.ndarray, window: int = WINDOW, width: int = MINIMISER) -> tuple[np.ndarray, ...]:
    """The super-k-mers of a pass: text number, first word, number of windows, words to the minimiser, hash of the minimiser, hash of all words."""
    starts, ends, words = word_ranges(data, bounds)
    n = len(starts)
    places = np.arange(n)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(words))
    whole = places + window <= words[1:][text]
    if not whole.any():
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    codes = range_hashes(_FIRST[data], starts, ends)
    # runs that cross from one text to the next belong to no whole window
    grams = range_hashes(codes, places[: n - width + 1], places[: n - width + 1] + width)
    count = n - window + 1
    low, at = grams[:count].copy(), places[:count].copy()
    for step in range(1, window - width + 1):
        other = grams[step : step + count]
        less = other < low
        np.copyto(low, other, where=less)
        np.copyto(at, places[step : step + count], where=less)
    first = np.flatnonzero(whole[:count])
    cuts = runs([at[first], text[first]])
    begin, length = first[cuts[:-1]], np.diff(cuts)
    prints = range_hashes(range_hashes(_SECOND[data], starts, ends), begin, begin + length + window - 1)
    own = text[begin]
    return own, begin - words[own], length, at[begin] - begin, grams[at[begin]].view(np.int64), prints.view(np.int64)


def id_ranks(ids: pa.Array, hashes: np.ndarray) -> np.ndarray:
    """The place of each row in the order of (id, text hash); null ids last, equal rows share a place."""
    keys = [(v is None, 0 if v is None else v, h) for v, h in zip(ids.to_pylist(), hashes.tolist())]
    places = {k: i for i, k in enumerate(sorted(set(keys)))}
    return np.fromiter((places[k] for k in keys), np.int64, len(keys))


def super_kmers(docs: DataFrame, window: int, width: int) -> DataFrame:
    """(key, print, id, text_hash, place) for each super-k-mer of ``docs``; one with an earlier copy in its batch is a copy, spread over small keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in passes(batch.column(2)):
                ids, hashes = batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo).to_numpy()
                text, start, length, mid, key, print_ = cut(data, bounds, window, width)
                rank = id_ranks(ids, hashes)[text]
                order = np.lexsort((start, rank, print_, key))
                text, start, length, mid, key, print_, rank = (x[order] for x in (text, start, length, mid, key, print_, rank))
                cuts = runs([key, print_])
                head = np.repeat(cuts[:-1], np.diff(cuts))
                # a row that is given twice stands at the same place and is no copy of itself
                copy = (rank != rank[head]) | (start != start[head])
                spread = np.arange(len(text)) & 0xFFFF
                place = start << 32 | length << 16 | mid << 2 | np.where(copy, _COPY, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(copy, spread, key)), pa.array(np.where(copy, 0, print_)), ids.take(pa.array(text)), pa.array(hashes[text]), pa.array(place)],
                    names=["key", "print", "id", "text_hash", "place"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text_hash", "text").mapInArrow(task, f"key bigint, print bigint, id {kind}, text_hash int, place bigint")


def compared(places: DataFrame, crowd: int) -> DataFrame:
    """The copies, and the first copies (``first``) of super-k-mers that share a minimiser with another one; the rest holds no repeated window.

    One exchange and one sort serve all windows here.
    """
    copy = F.col("place").bitwiseAND(_COPY) != 0
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", F.shiftright("place", 32).alias("start"))
    minimiser = Window.partitionBy("key")
    equal = Window.partitionBy("key", "print").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    # by minimiser only, which serves the finer windows too
    judged = places.repartition("key").withColumn("rank", rank).withColumn("first", ~copy & (F.first("rank").over(equal) == F.col("rank")))
    judged = judged.withColumns({
        "shared": F.min("print").over(minimiser) != F.max("print").over(minimiser),
        "crowd": F.sum(F.col("first").cast("int")).over(minimiser),
    })
    kept = judged.filter(~F.col("first") | F.col("shared"))
    flag = F.when(F.col("first") & (F.col("crowd") > crowd), F.lit(_CROWDED)).otherwise(0)
    return kept.select("key", "id", "text_hash", F.col("place").bitwiseOR(flag.cast("bigint")).alias("place"), "first")


def packed(texts: DataFrame, window: int) -> DataFrame:
    """(bucket, id, text_hash, place, words): the packed words of the places (key, place) listed with each text; crowded ones window by window."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            owner: list[int] = []
            for i, (text, listed) in enumerate(zip(batch.column(2).cast(pa.binary()), batch.column(3))):
                words = (text.as_py() or b"").split()
                for item in listed.as_py():
                    place = item["place"]
                    start, length, mid = place >> 32, place >> 16 & 0xFFFF, place >> 2 & 0x3FFF
                    if place & _CROWDED:
                        for k in range(length):
                            own = b" ".join(words[start + k : start + k + window])
                            bucket = xxhash.xxh64_intdigest(own) - (1 << 63)
                            rows.append((bucket, start + k << 32 | 1 << 16 | mid - k << 2 | _CROWDED, own))
                    else:
                        rows.append((item["key"], place, b" ".join(words[start : start + length + window - 1])))
                    owner += [i] * (len(rows) - len(owner))
                if len(rows) > 20_000:
                    yield out(batch, rows, owner)
                    rows, owner = [], []
            yield out(batch, rows, owner)

    def out(batch: pa.RecordBatch, rows: list[tuple], owner: list[int]) -> pa.RecordBatch:
        at = pa.array(owner, pa.int64())
        bucket, place, words = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket, pa.int64()), batch.column(0).take(at), batch.column(1).take(at), pa.array(place, pa.int64()),
                pa.array(words, pa.binary()),
            ],
            names=["bucket", "id", "text_hash", "place", "words"],
        )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(task, f"bucket bigint, id {kind}, text_hash int, place bigint, words binary")


def repeated_windows(strings: DataFrame, window: int) -> DataFrame:
    """(id, text_hash, place) of the windows in packed strings that also start earlier."""
    kind = strings.schema["id"].dataType.simpleString()
    fields = f"id {kind}, text_hash int, place bigint"

    def sorted_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket"], 1 << 12):
            windows = []
            for bucket, id_, text_hash, place, packed_words in zip(*(c.to_pylist() for c in table.columns)):
                words, start, mid = packed_words.split(), place >> 32, place >> 2 & 0x3FFF
                for k in range(place >> 16 & 0xFFFF):
                    windows.append((bucket, mid - k, b" ".join(words[k : k + window]), id_ is None, id_ or 0, text_hash, start + k))
            windows.sort()
            marks = []
            head = (None,) * 7
            for w in windows:
                if w[:3] != head[:3]:
                    head = w
                elif w[3:] != head[3:]:
                    marks.append((None if w[3] else w[4], w[5], w[6] << 32 | 1 << 16))
            yield marked(marks, table.schema.field("id").type)

    def sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            marks = []
            for _, id_, text_hash, place, words in zip(*(c.to_pylist() for c in batch.columns)):
                if head is None or words != head[0]:
                    head = (words, id_, text_hash, place >> 32)
                elif (id_, text_hash, place >> 32) != head[1:]:
                    marks.append((id_, text_hash, place))
            yield marked(marks, batch.schema.field("id").type)

    def marked(marks: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = zip(*marks) if marks else ((), (), ())
        arrays = [pa.array(c, t) for c, t in zip(columns, (id_type, pa.int32(), pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "text_hash", "place"])

    crowded = F.col("place").bitwiseAND(_CROWDED) != 0
    order = [F.col("bucket"), F.col("words"), F.col("id").asc_nulls_last(), F.col("text_hash"), F.col("place")]
    few = strings.filter(~crowded).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sorted_bucket, fields)
    many = strings.filter(crowded).repartition("bucket").sortWithinPartitions(*order).mapInArrow(sorted_windows, fields)
    return few.unionByName(many)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, width: int = MINIMISER, crowd: int = CROWD
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept`` (the words that stay, joined by one blank) and its SHA-256.

    A word is removed when it lies in a window whose words also start earlier: in a document with a smaller id, or earlier in the same one.
    Windows are judged on the input. A null text and a text of fewer words than a window lose nothing. Null ids come after all others. Rows with
    the same id are told apart and ordered by the hash of their text; a row that is given twice counts as one document, and each of
    its copies gets the same result. An empty table gives no row; other columns are not read.
    """
    if not 1 <= width <= window < 1 << 14:
        raise ValueError("the minimiser must fit the window, and the window 16383 words")
    texts = docs.select(F.col(id_col).alias("id"), F.hash(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    found = cut_lineage(compared(super_kmers(texts, window, width), crowd), "places")
    wanted = found.filter("first").groupBy("id", "text_hash").agg(F.collect_set(F.struct("key", "place")).alias("places"))
    strings = packed(matched(texts, wanted, "inner"), window)
    marks = found.filter("not first").select("id", "text_hash", "place").unionByName(repeated_windows(strings, window))
    # word ranges; a document has at most as many as words
    ranges = marks.groupBy("id", "text_hash").agg(F.collect_set(F.shiftright("place", 16)).alias("places"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept, digests = [], [], [], []
            for text, listed in zip(batch.column(2).cast(pa.binary()), batch.column(3)):
                words = (text.as_py() or b"").split()
                total.append(len(words))
                if listed.is_valid:
                    at = listed.values.to_numpy()
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, at >> 16, 1)
                    np.add.at(change, (at >> 16) + (at & 0xFFFF) + window - 1, -1)
                    words = list(compress(words, np.cumsum(change[:-1]) == 0))
                gone.append(total[-1] - len(words))
                joined = b" ".join(words)
                kept.append(joined)
                digests.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string(), safe=False), pa.array(digests, pa.string())],
                names=["id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    out = matched(texts, ranges, "left").mapInArrow(task, f"id {kind}, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def matched(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """``texts`` with the list of their row in ``lists``."""
    lists = lists.select(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"), "places")
    on = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
    return texts.join(lists, on, how).select("id", "text_hash", "text", "places")
