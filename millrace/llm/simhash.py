"""SimHash near-duplicates through Gray-ordered hierarchical indexes.

A fingerprint is 64 bits wide and a link allows three differing bits, so of its four quarters one agrees exactly. Four
indexes, one per rotation by a quarter, hold all distinct fingerprints in the order of their Gray rank. The first level of an index are the
groups that share the leading quarter; a search begins at its own group with no difference spent. Below, neighbours in Gray order
form nodes of eight; a node stores the bits on which all its members agree. A search adds up, level by level, the differences
on the bits that a node fixes beyond its parent, and leaves a whole node when they pass the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import forest_labels, group_ids, runs, whole_groups
from millrace.llm.components import components, deal_pairs
from millrace.operators.skew import salted_join
from millrace.session import cut_lineage

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Bytes of a text that are shingled at once.
PIECE_BYTES = 1 << 20
#: Distinct fingerprints with the same leading quarter that one task compares.
ROWS_PER_TASK = 1 << 15
FAN = 8
#: Searches that walk the index together.
SEARCHES = 1 << 13


def pieces(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, by pieces of about ``size`` bytes cut between words."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes, width: int = SHINGLE_WORDS, size: int = PIECE_BYTES) -> int:
    """Majority of the XXH64 bits of all word shingles; half is not a majority. No word: zero."""
    ones, total, held = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_digest
    for words in pieces(text.lower(), size):
        words = held + words
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
            hashes = [digest(joined[s:e], 42) for s, e in zip(starts, ends[width - 1 :].tolist())]
            bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int32)
            total += len(hashes)
            words = words[len(words) - width + 1 :] if width > 1 else []
        held = words
    if not total:
        return int.from_bytes(digest(b" ".join(held), 42), "big") if held else 0
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fingerprint long) for every row; a null text is empty, its fingerprint zero."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"", width) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "print"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return given.mapInArrow(task, f"id {given.schema['id'].dataType.simpleString()}, print bigint")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code word in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> np.uint64(shift))
    return codes


def index_levels(prints: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level from the leaves up: (fixed bits, their values, first child of each node and the end); the top has one node per group."""
    levels = []
    fixed, values, cells = np.full(len(prints), ~np.uint64(0)), prints, bounds
    while not levels or len(cells) - 1 < len(fixed):
        group = group_ids(cells)
        within = np.arange(len(fixed)) - cells[:-1][group]
        first = np.flatnonzero(within % FAN == 0)
        agree_ones = np.bitwise_and.reduceat(values, first)
        agree_any = np.bitwise_or.reduceat(values | ~fixed, first)
        # a bit is fixed above when every child fixes it at the same value
        fixed_up = np.bitwise_and.reduceat(fixed, first) & ~(agree_ones ^ agree_any)
        levels.append((fixed_up, agree_ones & fixed_up, np.append(first, len(fixed))))
        cells = np.searchsorted(first, cells)
        fixed, values = levels[-1][:2]
    return levels


def near_pairs(prints: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of one group with at most ``limit`` differing bits; groups are Gray-ordered ranges of ``prints``."""
    if not len(prints):
        return
    levels = index_levels(prints, bounds)
    tops = group_ids(bounds)
    for lo in range(0, len(prints), SEARCHES):
        asked = np.arange(lo, min(lo + SEARCHES, len(prints)))
        node = tops[asked]
        fixed, values, _ = levels[-1]
        spent = np.bitwise_count((prints[asked] ^ values[node]) & fixed[node]).astype(np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            stay = spent <= limit
            asked, node, spent = asked[stay], node[stay], spent[stay]
            first = levels[depth][2]
            sizes = first[node + 1] - first[node]
            at = np.repeat(np.cumsum(sizes) - sizes, sizes)
            child = np.arange(len(at)) - at + np.repeat(first[node], sizes)
            asked, spent, parent = np.repeat(asked, sizes), np.repeat(spent, sizes), np.repeat(node, sizes)
            own = ~levels[depth][0][parent]
            if depth:
                own &= levels[depth - 1][0][child]
                differ = (prints[asked] ^ levels[depth - 1][1][child]) & own
            else:
                differ = (prints[asked] ^ prints[child]) & own
            spent = spent + np.bitwise_count(differ)
            node = child
        stay = (spent <= limit) & (node > asked)
        yield asked[stay], node[stay]


def links(prints: DataFrame, limit: int = MAX_BITS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``print``) that join what lies within ``limit`` bits.

    Each task hands on a spanning forest of its links, never all pairs. ``limit`` may be at most three: beyond it no quarter need agree.
    """
    if not 0 <= limit <= 3:
        raise ValueError("four rotations find at most three differing bits")
    turns = F.explode(F.array(*[F.lit(r) for r in range(4)])).alias("turn")
    turned = prints.select("print", turns).select(
        "turn", "print", F.expr("(print << (16 * turn)) | shiftrightunsigned(print, (64 - 16 * turn) % 64) * int(turn > 0)").alias("turned")
    )
    turned = turned.withColumn("lead", F.shiftrightunsigned("turned", 48).cast("int"))
    dealt = deal_pairs(turned, ["turn", "lead"], "print", rows_per_task)
    cells = ["turn", "lead", "one", "two"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, cells):
            codes = table.column("turned").to_numpy().view(np.uint64)
            keys = [table.column(c).to_numpy() for c in cells]
            order = np.lexsort([gray_rank(codes), *reversed(keys)])
            codes, keys = codes[order], [k[order] for k in keys]
            own, chunk = table.column("print").to_numpy()[order], table.column("chunk").to_numpy()[order]
            crossing = keys[2] != keys[3]
            labels = np.arange(len(codes))
            for a, b in near_pairs(codes, runs(keys), limit):
                meet = ~crossing[a] | (chunk[a] != chunk[b])
                labels = forest_labels(labels, a[meet], b[meet])
            tied = np.flatnonzero(labels != np.arange(len(labels)))
            yield pa.RecordBatch.from_arrays([pa.array(own[tied]), pa.array(own[labels[tied]])], names=["a", "b"])

    placed = dealt.select(*cells, "chunk", "print", "turned").repartition(*cells).sortWithinPartitions(*cells)
    return placed.mapInArrow(task, "a bigint, b bigint")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, limit: int = MAX_BITS
) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that links reach.

    Null texts and texts without a word have fingerprint zero and link like any other. Repeated rows stay, each with its group. A null id
    counts as larger than any other: a group of null ids alone has a null ``component_id``. An empty table gives no row; other columns are not read.
    """
    printed = cut_lineage(fingerprints(docs, id_col, text_col, width), "prints")
    distinct = cut_lineage(printed.groupBy("print").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(links(distinct.select("print"), limit))
    grouped = distinct.join(roots, distinct.print == roots.node, "left").select("print", "low", F.coalesce("root", "print").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    named = cut_lineage(grouped.join(lowest, "root").select("print", "component_id"), "named")
    out = salted_join(printed, named, "print", counts=distinct.select("print", "n"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
