"""Document quality by a generalised additive model with pairwise interactions over measures of the text.

Cyclic boosting of shallow trees over binned measures adds up to one lookup table for each measure and one for each chosen pair; a score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import SEPARATOR, byte_codes, group_ids, passes, range_hasher, word_ranges

#: The model is fitted on about this many labelled documents of each label, chosen by the hash of their id.
DOCS_PER_LABEL = 10_000
#: Bins of a measure, and of each of the two measures of a pair.
BINS, PAIR_BINS = 32, 8
#: Measures that may interact in a pair, rounds over all tables, leaves of a tree, its least weight of second derivatives, and the step.
PAIRS, ROUNDS, LEAVES, LEAST, STEP = 10, 200, 3, 2.0, 0.1
THRESHOLD = 0.5
#: Bytes of text that are measured at once; a longer text is measured part by part.
PART_BYTES = 1 << 20

_LETTER, _UPPER, _DIGIT, _STOP, _SYMBOL = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0x80:] = True
_DIGIT[48:58] = True
_STOP[[ord(c) for c in ".,;:?!"]] = True
_SYMBOL[33:127] = ~(_LETTER | _DIGIT | _STOP)[33:127]
_WIDE = np.zeros(256, bool)
_WIDE[0xC0:] = True
_CODES = byte_codes(11)

#: Sums over a text, of which measures are made.
SUMS = ("chars", "letters", "upper", "digits", "stops", "symbols", "lines", "wide", "words", "word_bytes", "square", "bare", "shouted", "capital", "long", "short", "marked", "stopped", "different", "same", "different_two", "most")
MEASURES = (
    "log_words", "word_length", "length_spread", "letters", "upper", "digits", "stops", "symbols", "wide", "lines", "bare", "shouted", "capital", "long", "short",
    "marked", "stopped", "different", "same", "different_two", "most",
)


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Cut one long text behind a separator into parts of about PART_BYTES; a word is never cut."""
    at = 0
    while at < len(data):
        end = at + PART_BYTES
        while end < len(data) and not SEPARATOR[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def _add(sums: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add what can be added up over parts; returns the hashes of the words and where each text's words begin."""
    starts, ends, cuts = word_ranges(data, bounds)

    def counted(mask: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))

    runs = {name: counted(table[data]) for name, table in (("letters", _LETTER), ("upper", _UPPER), ("digits", _DIGIT), ("stops", _STOP), ("symbols", _SYMBOL), ("wide", _WIDE))}
    for name, run in (*runs.items(), ("chars", counted((data & 0xC0) != 0x80)), ("lines", counted(data == 10))):
        sums[:, SUMS.index(name)] += np.diff(run[bounds])
    # bytes of longer characters count as letters one by one; upper case is known for ASCII only
    size = ends - starts
    inside = {name: runs[name][ends] - runs[name][starts] for name in ("letters", "upper", "symbols")}
    by_word = {
        "words": np.ones(len(size), np.int64),
        "word_bytes": size,
        "square": size * size,
        "bare": inside["letters"] == 0,
        "shouted": (inside["letters"] > 1) & (inside["upper"] == inside["letters"]),
        "capital": _UPPER[data[starts]],
        "long": size >= 16,
        "short": size <= 2,
        "marked": inside["symbols"] > 0,
        "stopped": _STOP[data[ends - 1]],
    }
    for name, value in by_word.items():
        sums[:, SUMS.index(name)] += np.diff(counted(value)[cuts])
    hashes = range_hasher(_CODES[data])(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return hashes, cuts


def _repeats(sums: np.ndarray, hashes: np.ndarray, cuts: np.ndarray) -> None:
    """Different words and neighbours, words like the one before, and the most frequent word of each text."""
    owner = group_ids(cuts).astype(np.uint64)
    inner = owner[1:] == owner[:-1]
    twos = (hashes[:-1] * np.uint64(3) + hashes[1:] * np.uint64(0x9E3779B97F4A7C15))[inner]
    same = (hashes[1:] == hashes[:-1]) & inner
    n = len(cuts) - 1
    sums[:, SUMS.index("same")] = np.bincount(owner[1:][same].astype(np.int64), minlength=n)
    for name, values, texts in (("different", hashes, owner), ("different_two", twos, owner[1:][inner])):
        # the text in the upper bits, 42 bits of the hash below
        keys = np.sort(texts << np.uint64(42) | values >> np.uint64(22))
        firsts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        of = (keys[firsts] >> np.uint64(42)).astype(np.int64)
        sums[:, SUMS.index(name)] = np.bincount(of, minlength=n)
        if name == "different" and len(keys):
            np.maximum.at(sums[:, SUMS.index("most")], of, np.diff(np.concatenate((firsts, [len(keys)]))))


def text_sums(texts: pa.Array) -> np.ndarray:
    """One row of SUMS for each text; null is empty."""
    out = np.zeros((len(texts), len(SUMS)), np.int64)
    for lo, hi, data, bounds in passes(texts, PART_BYTES):
        rows = out[lo:hi]
        if len(data) <= PART_BYTES:
            hashes, cuts = _add(rows, data, bounds)
        else:
            listed = [_add(rows, part, np.array([0, len(part)]))[0] for part in _parts(data)]
            hashes = np.concatenate(listed)
            cuts = np.array([0, len(hashes)])
        _repeats(rows, hashes, cuts)
    return out


def measures(texts: pa.Array) -> np.ndarray:
    """One row of MEASURES for each text; shares of nothing are 0."""
    s = dict(zip(SUMS, text_sums(texts).T.astype(float)))

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)

    length = share(s["word_bytes"], s["words"])
    spread = np.sqrt(np.maximum(share(s["square"], s["words"]) - length**2, 0))
    of_chars = [share(s[c], s["chars"]) for c in ("letters", "upper", "digits", "stops", "symbols", "wide")]
    of_words = [share(s[c], s["words"]) for c in ("lines", "bare", "shouted", "capital", "long", "short", "marked", "stopped", "different", "same", "different_two", "most")]
    return np.column_stack([np.log1p(s["words"]), length, spread, *of_chars, *of_words])


class Model(NamedTuple):
    """``edges`` of the bins by measure, ``tables`` by measure, ``pairs`` of measures with their own ``pair_edges`` and ``pair_tables``."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges of at most ``bins`` bins of nearly equal weight."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, v) for e, v in zip(edges, values.T)])


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place (bins before it) of the best cut of ordered bins by sums of first and second derivatives."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    fits = (left_h >= LEAST) & (right_h >= LEAST)
    if not fits.any():
        return 0.0, 0
    gain = np.where(fits, left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - g.sum() ** 2 / (h.sum() + 1), 0)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """One Newton step as a function of the bin, constant on each of at most ``leaves`` boxes; ``g`` and ``h`` have one or two axes."""
    boxes = [tuple(slice(0, n) for n in g.shape)]
    while len(boxes) < leaves:
        found = []
        for k, box in enumerate(boxes):
            for axis in range(g.ndim):
                other = tuple(a for a in range(g.ndim) if a != axis)
                gain, at = _best_cut(g[box].sum(axis=other), h[box].sum(axis=other))
                found.append((gain, -k, -axis, at))
        gain, k, axis, at = max(found)
        if gain <= 1e-9:
            break
        box, axis = boxes.pop(-k), -axis
        middle = box[axis].start + at
        for part in (slice(box[axis].start, middle), slice(middle, box[axis].stop)):
            boxes.append((*box[:axis], part, *box[axis + 1 :]))
    step = np.zeros(g.shape)
    for box in boxes:
        step[box] = -g[box].sum() / (h[box].sum() + 1)
    return step


def _derivatives(total: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-total))
    return weight * (p - label), weight * p * (1 - p)


def _cycle(total: np.ndarray, label: np.ndarray, weight: np.ndarray, cells: list[np.ndarray], shapes: list[tuple[int, ...]], rounds: int) -> list[np.ndarray]:
    """Boost the tables in turn, ``rounds`` times over; ``total`` is brought up to date."""
    tables = [np.zeros(shape) for shape in shapes]
    for _ in range(rounds):
        for cell, table in zip(cells, tables):
            g, h = _derivatives(total, label, weight)
            sums = (np.bincount(cell, x, table.size).reshape(table.shape) for x in (g, h))
            step = STEP * shallow_tree(*sums)
            table += step
            total += step.ravel()[cell]
    return tables


def train(values: np.ndarray, label: np.ndarray, weight: np.ndarray, pairs: int = PAIRS, rounds: int = ROUNDS) -> Model:
    """Tables of single measures first, then those of the pairs whose grid of four boxes explains most of what is left."""
    edges, pair_edges = ([bin_edges(v, n) for v in values.T] for n in (BINS, PAIR_BINS))
    share = np.clip((weight * label).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    total = np.full(len(label), base)
    bins, coarse = binned(values, edges), binned(values, pair_edges)
    tables = _cycle(total, label, weight, list(bins.T), [(len(e) + 1,) for e in edges], rounds)

    g, h = _derivatives(total, label, weight)
    cells, shapes, gains = {}, {}, []
    for i, j in combinations(range(values.shape[1]), 2):
        shapes[i, j] = len(pair_edges[i]) + 1, len(pair_edges[j]) + 1
        cells[i, j] = coarse[:, i] * shapes[i, j][1] + coarse[:, j]
        sums = [np.bincount(cells[i, j], x, shapes[i, j][0] * shapes[i, j][1]).reshape(shapes[i, j]) for x in (g, h)]
        step = shallow_tree(*sums, leaves=4)
        gains.append((float(-(sums[0] * step).sum()), i, j))
    chosen = sorted((i, j) for gain, i, j in sorted(gains, key=lambda x: (-x[0], x[1:]))[:pairs] if gain > 1e-9)
    pair_tables = _cycle(total, label, weight, [cells[p] for p in chosen], [shapes[p] for p in chosen], rounds // 2)
    return Model(base, edges, tables, chosen, pair_edges, pair_tables)


def probability(model: Model, values: np.ndarray) -> np.ndarray:
    """Sums of table entries, as probabilities of label 1."""
    bins, coarse = binned(values, model.edges), binned(values, model.pair_edges)
    total = np.full(len(values), model.base)
    for k, table in enumerate(model.tables):
        total += table[bins[:, k]]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        total += table[coarse[:, i], coarse[:, j]]
    return 1 / (1 + np.exp(-total))


def learnable(id_col: str) -> Column:
    """Labels that the model may learn from; a null id is never one of them."""
    return ~held_out(id_col) & F.col(id_col).isNotNull()


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def _measured(texts: DataFrame) -> DataFrame:
    """(label, spot, measures) of (label, spot, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.FixedSizeListArray.from_arrays(pa.array(measures(batch.column(2)).ravel()), len(MEASURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["label", "spot", "measures"])

    return texts.mapInArrow(task, "label int, spot bigint, measures array<double>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_label: int = DOCS_PER_LABEL,
    pairs: int = PAIRS,
    rounds: int = ROUNDS,
) -> Model:
    """Learn from about ``per_label`` labelled documents of each label, weighted as all labelled ones.

    Labels other than 0 and 1, labels of unknown documents and null ids are passed over; a document with several labels counts once with each. Without both labels every text
    has the one probability that is known (0.5 without any).
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label in (0, 1)").distinct()
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        share = next(iter(counts), 0.5)
        return Model(float(np.log((share + 1e-6) / (1 - share + 1e-6))), [np.zeros(0)] * len(MEASURES), [np.zeros(1)] * len(MEASURES), [], [np.zeros(0)] * len(MEASURES), [])
    shares = {label: min(1.0, per_label / n) for label, n in counts.items()}
    share = F.when(F.col("label") == 1, shares[1]).otherwise(shares[0])
    spot = F.xxhash64(F.lit("quality"), F.col("id").cast("string"))
    chosen = known.withColumn("spot", spot).filter(F.pmod("spot", F.lit(1_000_003)) / 1_000_003 < share)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("label", "spot", "text")
    rows = _measured(texts).orderBy("spot", "label", "measures").toArrow()  # at most the sample
    if len(set(rows["label"].to_pylist())) < 2:
        return fit(docs, labels.limit(0), id_col, text_col, label_col)
    label = rows["label"].to_numpy().astype(float)
    values = np.array(rows["measures"].to_pylist())
    weight = np.where(label == 1, 1 / shares[1], 1 / shares[0])
    return train(values, label, weight / weight.mean(), pairs, rounds)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``threshold`` on).

    Only the text counts. A null text is empty, and an empty text has the score of measures that are all 0. Repeated rows and null ids stay as they are; an
    empty table gives no row; other columns are not read. A very long text is measured by the megabyte; beside it, a task holds eight bytes for each of
    its words, four times over while they are counted.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for batch in batches:
            value = probability(own, measures(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), pa.array((value >= threshold).astype(np.int32))], names=["id", "score", "predicted"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(task, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
