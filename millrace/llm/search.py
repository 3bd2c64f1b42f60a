"""Ranked lexical search turned round: the items' terms are the index, and every document streams through it once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Hits that are listed for each item.
TOP = 10
#: Pairs of a term and an item that are broadcast at once (about 100 bytes each); more items are searched block by block.
BLOCK_POSTINGS = 1_000_000
#: Bytes of a text that are cut into terms at once, rows of term counts that go out together, and cells of one matrix of scores.
PART_BYTES, ROWS, CELLS = 1 << 20, 500, 1 << 21
#: Groups of tasks whose heaps meet first.
MERGE_PARTS = 256

_SMALL = bytes(range(ord("a"), ord("z") + 1))
#: ASCII letters and digits and every byte of a longer character belong to terms; A-Z become small, all else a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or c in _SMALL or 48 <= c <= 57 else 32 for c in range(256))
_LAST = np.iinfo(np.int64).max


def terms(text: bytes) -> Iterator[list[bytes]]:
    """All terms of a text in order, a part at a time; a part ends between two terms."""
    folded = text.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + PART_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term) once each, from (item, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                found = set().union(*terms(text.as_py() or b""))
                same = pa.array([row] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(same), pa.array(list(found), pa.binary())], names=["item", "term"])

    kind = items.schema["item"].dataType.simpleString()
    return items.mapInArrow(task, f"item {kind}, term binary").distinct()


def term_counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """One row per document with a term: id, ``n`` terms in all, and those of the vocabulary by number with how often each occurs."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def flushed(ids: list, sizes: list, found: list, times: list) -> pa.RecordBatch:
        longs = pa.list_(pa.int64())
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), longs)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((ids, sizes, found, times), kinds)], names=["id", "n", "terms", "times"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: k for k, term in enumerate(held.value)}
        rows: tuple[list, ...] = ([], [], [], [])
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                n, hits = 0, Counter()
                for words in terms(text.as_py() or b""):
                    n += len(words)
                    counts = Counter(words)
                    for term in counts.keys() & number.keys():
                        hits[number[term]] += counts[term]
                if n:
                    for column, value in zip(rows, (key, n, list(hits.keys()), list(hits.values()))):
                        column.append(value)
                if len(rows[0]) >= ROWS:
                    yield flushed(*rows)
                    rows = ([], [], [], [])
        yield flushed(*rows)

    return docs.mapInArrow(task, "id bigint, n bigint, terms array<int>, times array<bigint>")


def weight(n_docs: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * with_term + 1)))


class Heaps:
    """The ``k`` best (score, document) of every item, equal scores by smaller id."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.held: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
        # what a full heap would give up; a heap with room takes every score above 0
        self.floor, self.last = np.ones(n_items, np.int64), np.full(n_items, _LAST)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores by document (row) and item (column)."""
        better = (scores > self.floor) | ((scores == self.floor) & (ids[:, None] <= self.last))
        for row, item in np.argwhere(better).tolist():
            heap, entry = self.held[item], (int(scores[row, item]), -int(ids[row]))
            if len(heap) < self.k:
                heappush(heap, entry)
            else:
                heappushpop(heap, entry)
            if len(heap) == self.k:
                self.floor[item], self.last[item] = heap[0][0], -heap[0][1]


def best_of_tasks(counts: DataFrame, item_ids: pa.Array, kind: str, index: tuple[np.ndarray, np.ndarray, np.ndarray], totals: tuple[int, int], k: int) -> DataFrame:
    """(item, id, score): every task's heaps after all its documents went through the index.

    ``index`` is, by term number, where its items begin in the second array, and the weights.
    """
    n_docs, n_terms = totals
    held = counts.sparkSession.sparkContext.broadcast((item_ids, *index))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, starts, owners, worth = held.value
        heaps, step = Heaps(len(own_ids), k), k
        for batch in batches:
            ids = batch.column(0).fill_null(_LAST).to_numpy()
            m = np.array([10 + 90 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
            bounds = batch.column(2).offsets.to_numpy()
            found, times = (batch.column(c).values.to_numpy() for c in (2, 3))
            reach = np.concatenate(([0], np.cumsum(starts[found + 1] - starts[found])))
            lo = 0
            while lo < len(ids):
                # documents whose scores and whose hits fit the matrix, one at least
                hi = int(np.searchsorted(reach[bounds], reach[bounds[lo]] + CELLS, "right")) - 1
                hi = min(len(ids), max(lo + 1, min(hi, lo + CELLS // len(own_ids), lo + step)))
                step *= 2  # the first few documents raise the floors
                a, b = bounds[lo], bounds[hi]
                t, tf = found[a:b], times[a:b]
                row = np.repeat(np.arange(hi - lo), np.diff(bounds[lo : hi + 1]))
                gain = worth[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[lo + row]))
                width = starts[t + 1] - starts[t]
                ends = np.cumsum(width)
                at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[t] - ends + width, width)
                scores = np.zeros((hi - lo, len(own_ids)), np.int64)
                np.add.at(scores, (np.repeat(row, width), owners[at]), np.repeat(gain, width))
                heaps.offer(ids[lo:hi], scores)
                lo = hi
        item, found_ids, score = [], [], []
        for k_item, heap in enumerate(heaps.held):
            for value, key in heap:
                item.append(k_item)
                found_ids.append(None if -key == _LAST else -key)
                score.append(value)
        yield pa.RecordBatch.from_arrays([own_ids.take(pa.array(item, pa.int64())), pa.array(found_ids, pa.int64()), pa.array(score, pa.int64())], names=["item", "id", "score"])

    return counts.mapInArrow(task, f"item {kind}, id bigint, score bigint")


def searched(texts: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """(item, rank, id, score) for one block of items; two runs over term counts that are written once."""
    kind = pairs.schema["item"].dataType.simpleString()
    listed = pairs.toArrow().combine_chunks()  # at most a block of postings
    if not listed.num_rows:
        return texts.sparkSession.createDataFrame([], f"item {kind}, rank int, id bigint, score bigint")
    term = listed["term"].combine_chunks().dictionary_encode()
    item = listed["item"].combine_chunks().dictionary_encode(null_encoding="encode")
    words, numbers = term.dictionary.to_pylist(), term.indices.to_numpy()
    order = np.argsort(numbers, kind="stable")
    starts = np.searchsorted(numbers[order], np.arange(len(words) + 1))
    owners = item.indices.to_numpy()[order].astype(np.int64)

    counts = cut_lineage(term_counts(texts, words), "term-counts")
    totals = counts.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = int(totals["docs"]), int(totals["terms"])
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("docs")).toArrow()
    weights = np.zeros(len(words), np.int64)
    weights[held["term"].to_numpy()] = [weight(n_docs, df) for df in held["docs"].to_pylist()]

    best = best_of_tasks(counts, item.dictionary, kind, (starts, owners, weights), (n_docs, n_terms), top)
    order_by = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    # heaps meet in two steps, as there are as many of them as tasks
    part = best.withColumn("part", F.spark_partition_id() % MERGE_PARTS)
    part = part.withColumn("nth", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order_by))).filter(F.col("nth") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order_by))).filter(F.col("rank") <= top)
    return ranked.select("item", "rank", "id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """The ``top`` documents of every item by score: item, ``rank`` (from 1), id, ``score`` (above 0), equal scores by smaller id.

    Ids of documents are integers; a null id comes after all others. Every row of ``docs`` is a document, so repeated rows have ranks of their own. Rows
    of ``items`` with one id (null is one) are one item with the terms of all of them. A null or empty text has no term: such a document counts
    nowhere, such an item gets no row; nor does any item if either table is empty. Other columns are not read. A very long text is cut into
    terms by the megabyte: it costs three times its bytes beside them. Items beyond ``block_postings`` are searched in blocks, each in
    one run over all documents; an item alone is never split.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    pairs = cut_lineage(item_terms(items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))), "item-terms")
    blocks = max(1, math.ceil(pairs.count() / block_postings))
    hits = searched(texts, pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == 0), top)
    for b in range(1, blocks):
        hits = hits.unionByName(searched(texts, pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), top))
    return hits.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
