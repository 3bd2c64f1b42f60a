"""Toxicity by a linear-chain conditional random field over the words of a text.

Labels come for whole documents. Words and word beginnings that stand in toxic documents in too many different surroundings for chance
become features, and where they stand in a toxic document the word is labelled toxic, in a clean one not. On these labelled
tokens the field learns weights for the features of a word, for featured neighbours, and for the steps between the two states. Scoring runs
forward and backward over whole texts; the marginals of offending words give the score of the document and the offsets of its spans.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import byte_codes, group_ids, mix, passes, range_hasher, word_ranges
from millrace.session import cut_lineage

#: The model is fitted on about so many documents of each label, chosen by the hash of their id; their texts enter whole.
DOCS_PER_LABEL = 2000
#: One document in so many of the sample serves the calibration alone.
CALIBRATION = 5
#: Words of the rest, for each label, that the field itself is trained on, and rounds of training.
WORDS_PER_LABEL, ROUNDS = 300_000, 120
#: Most features, the strongest first; a bound on the size of the model.
MAX_FEATURES = 4096
#: Bytes of the word beginnings that can be features.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Occurrences that must lie in toxic documents for a feature, and the marginal from which a word counts towards the score and from which it is a span.
PURITY, COUNTED, OFFENDING = 0.9, 0.1, 0.5
#: From this score on a document is predicted toxic.
THRESHOLD = 0.3

_CODES = byte_codes(3)
_SOLID = np.ones(256, bool)
_SOLID[[c for c in range(128) if not chr(c).isalnum()]] = False


class Field(NamedTuple):
    """A trained model; every part is a number or an array of at most MAX_FEATURES numbers."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    beside: float
    steps: tuple[float, float, float]
    slope: float
    shift: float


def word_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Byte starts and ends of all words, text bounds in them, and the features as (word numbers, hashes): the word, then its beginnings.

    Words are stripped of ASCII punctuation at both ends; one without any letter or digit has no feature.
    """
    starts, ends, cuts = word_ranges(data, bounds)
    solid = np.flatnonzero(_SOLID[data])
    if not len(solid) or not len(starts):
        none = np.zeros(0, np.int64)
        return starts, ends, cuts, [(none, none.view(np.uint64))]
    a = np.searchsorted(solid, starts)
    b = np.searchsorted(solid, ends) - 1
    full = np.flatnonzero(b >= a)
    first, last = solid[a[full]], solid[b[full]] + 1
    hashed = range_hasher(_CODES[data])
    out = [(full, hashed(first, last))]
    for size in BEGINNINGS:
        long = last - first >= size
        out.append((full[long], ~hashed(first[long], first[long] + size)))
    return starts, ends, cuts, out


def feature_hits(features: list[tuple[np.ndarray, np.ndarray]], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature number) wherever a word has one of the model's features."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sieve = np.zeros(1 << 16, bool)
    sieve[hashes & np.uint64(0xFFFF)] = True
    words, found = [], []
    for at, own in features:
        maybe = np.flatnonzero(sieve[own & np.uint64(0xFFFF)])
        spot = np.minimum(np.searchsorted(hashes, own[maybe]), len(hashes) - 1)
        hit = hashes[spot] == own[maybe]
        words.append(at[maybe[hit]])
        found.append(spot[hit])
    return np.concatenate(words), np.concatenate(found)


def recursion(w: np.ndarray, first: np.ndarray, t01: float, t10: float, t11: float) -> np.ndarray:
    """r[i] = w[i] * (t01 + t11 r[i-1]) / (1 + t10 r[i-1]), and w[i] where a chain begins.

    The chains are cut into lanes that run side by side. A lane begins early enough for what stands before it to have no weight left: the
    recursion forgets its start at a rate that the step weights bound (Birkhoff's contraction).
    """
    rate = math.tanh(abs(math.log(t11 / (t01 * t10))) / 4)
    warm = min(4096, max(8, math.ceil(math.log(1e-12) / math.log(max(rate, 1e-9)))))
    n, lane = len(w), 512
    lanes = -(-n // lane)
    spare = lanes * lane - n
    padded = np.concatenate((np.ones(warm), w, np.ones(spare)))
    begins = np.concatenate((np.ones(warm, bool), first, np.ones(spare, bool)))
    view = lambda x: np.lib.stride_tricks.sliding_window_view(x, lane + warm)[::lane][:lanes].T.copy()
    weights, resets = view(padded), view(begins)
    out = np.empty((lane, lanes))
    r = np.ones(lanes)
    for j in range(lane + warm):
        r = (t01 + t11 * r) / (1 + t10 * r)
        r[resets[j]] = 1
        r = r * weights[j]
        if j >= warm:
            out[j - warm] = r
    return out.T.reshape(-1)[:n]


def chain(odds: np.ndarray, cuts: np.ndarray, steps: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward ratios, backward ratios and marginals of the toxic state; ``odds`` are the words' own log odds."""
    w = np.exp(np.clip(odds, -40, 40))
    t01, t10, t11 = np.exp(steps)
    first, last = np.zeros(len(w), bool), np.zeros(len(w), bool)
    full = np.diff(cuts) > 0
    first[cuts[:-1][full]] = True
    last[cuts[1:][full] - 1] = True
    ahead = recursion(w, first, t01, t10, t11)
    back = recursion(w[::-1], last[::-1], t10, t01, t11)[::-1] / w
    both = ahead * back
    return ahead, back, both / (1 + both)


def log_odds(field: Field, words: np.ndarray, found: np.ndarray, n: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' own log odds, and how many of their neighbours in the same text have a feature."""
    odds = np.full(n, field.bias)
    np.add.at(odds, words, field.weights[found])
    marked = np.zeros(n, bool)
    marked[words] = True
    text = group_ids(cuts)
    near = np.zeros(n)
    same = text[1:] == text[:-1]
    near[1:] += marked[:-1] & same
    near[:-1] += marked[1:] & same
    return odds + field.beside * near, near


def train(hashes: np.ndarray, words: np.ndarray, found: np.ndarray, cuts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Maximum conditional likelihood with a Gaussian prior, by Adam steps on the whole sample."""
    n, k = int(cuts[-1]), len(hashes)
    text = group_ids(cuts)
    truth = np.zeros(n)
    truth[words] = labels[text[words]]
    pair = np.flatnonzero(text[1:] == text[:-1])
    y0, y1 = truth[pair], truth[pair + 1]
    seen = np.array([((1 - y0) * y1).sum(), (y0 * (1 - y1)).sum(), (y0 * y1).sum()])
    scale = max(truth.sum(), 1.0)
    point = np.concatenate((np.zeros(k), [-4.0, 0.0], np.zeros(3)))
    mean, square = np.zeros(k + 5), np.zeros(k + 5)
    for i in range(1, rounds + 1):
        field = Field(hashes, point[:k], point[k], point[k + 1], tuple(point[k + 2 :]), 1.0, 0.0)
        odds, near = log_odds(field, words, found, n, cuts)
        ahead, back, p = chain(odds, cuts, field.steps)
        t01, t10, t11 = np.exp(field.steps)
        r, v = ahead[pair], back[pair + 1] * np.exp(np.clip(odds[pair + 1], -40, 40))
        total = 1 + t01 * v + r * t10 + r * t11 * v
        expected = np.array([(t01 * v / total).sum(), (r * t10 / total).sum(), (r * t11 * v / total).sum()])
        miss = truth - p
        slope = np.concatenate((np.bincount(found, miss[words], k), [miss.sum(), (miss * near).sum()], seen - expected)) / scale - 1e-3 * point
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        point = point + 0.2 * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
        # bounded steps between states keep the recursion's memory short
        point[k + 2 :] = np.clip(point[k + 2 :], -4, 4)
    return Field(hashes, point[:k], float(point[k]), float(point[k + 1]), tuple(float(x) for x in point[k + 2 :]), 1.0, 0.0)


def offence(p: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Per text, the logarithm of the expected number of offending words, words of small marginal left out."""
    counted = np.bincount(group_ids(cuts), np.where(p >= COUNTED, p, 0.0), len(cuts) - 1)
    return np.log(0.05 + counted)


def calibrate(x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic regression, by Newton steps with a small ridge."""
    features = np.stack((x, np.ones(len(x))), axis=1)
    point = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ point, -30, 30)))
        slope = features.T @ (weights * (labels - p)) - 0.1 * point
        bend = (features * (weights * p * (1 - p))[:, None]).T @ features + 0.1 * np.eye(2)
        point = point + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return max(0.0, float(point[0])), float(point[1])


def within(sizes: np.ndarray, labels: np.ndarray, bound: int) -> np.ndarray:
    """Which texts to train on: of each label, in order, all whose words fit what is left of its ``bound``; one text at least, the shortest if none fits."""
    use = np.zeros(len(sizes), bool)
    for label in set(labels.tolist()):
        own, left = np.flatnonzero(labels == label), bound
        for k in own:
            if sizes[k] <= left:
                use[k] = True
                left -= int(sizes[k])
        if not use[own].any():
            use[own[sizes[own].argmin()]] = True
    return use


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_label: int = DOCS_PER_LABEL,
    words_per_label: int = WORDS_PER_LABEL,
    max_features: int = MAX_FEATURES,
) -> Field:
    """Learn from the documents that ``labels`` (id, 0 or 1) marks; pass only labels that may be learned from.

    Features are sought in a sample of about ``per_label`` documents of each label, the strongest ``max_features`` are kept. Of the sample, documents of each label
    with at most ``words_per_label`` words together train the field; one that is longer than what is left is passed over, so no long text takes the place of the others.
    A document with several labels is toxic if one says so; labels other than 0 and 1 and null ids count for nothing. With labels of one kind only, or without
    features that pass the test, the field has no feature and every score is the share of toxic labels.
    """
    if not 0 < max_features <= 1 << 16:
        raise ValueError("a feature's number has 16 bits")
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter("id is not null and toxic in (0, 1)")
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {t: min(1.0, per_label / counts[t]) for t in counts}
    base = counts.get(1, 0) / max(1, sum(counts.values()))
    empty = Field(np.zeros(0, np.uint64), np.zeros(0), -4.0, 0.0, (0.0, 0.0, 0.0), 0.0, math.log((base + 1e-6) / (1 - base + 1e-6)))
    if len(counts) < 2:
        return empty
    spot = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("id").cast("string")), F.lit(1_000_003)) / 1_000_003
    # about 2 x per_label ids, whatever the input
    ids = F.broadcast(marks.filter(spot < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    spare = F.pmod(F.xxhash64(F.lit("calibration"), F.col("id").cast("string")), F.lit(CALIBRATION)) == 0
    sample = cut_lineage(texts.join(ids, "id").select("id", "toxic", "text", spare.alias("spare")), "toxic-sample")

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for lo, hi, data, bounds in passes(pc.utf8_lower(batch.column(2))):
                starts, _, cuts, features = word_features(data, bounds)
                n = len(starts)
                own = np.zeros(n + 2, np.uint64)
                own[features[0][0] + 1] = features[0][1]
                around = mix(own[:-2] * np.uint64(3) + mix(own[2:]))
                text = group_ids(cuts)
                for at, hashes in features:
                    # a text counts once for a feature, with the surroundings of the first place
                    _, once = np.unique(mix(hashes + text[at].astype(np.uint64)), return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[once].view(np.int64)), pa.array(around[at[once]].view(np.int64)), pa.array(toxic[lo:hi][text[at[once]]])],
                        names=["feature", "around", "toxic"],
                    )

    # copies of a text repeat its surroundings and count once
    different = sample.filter("not spare").select("id", "toxic", "text").mapInArrow(surroundings, "feature bigint, around bigint, toxic int").distinct()
    tallies = different.groupBy("feature").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).filter("n >= 3")
    tallies = cut_lineage(tallies, "tallies")
    # how many features have n different surroundings; as few rows as there are numbers n
    sizes = [(r["n"], r["features"], r["t"]) for r in tallies.groupBy("n").agg(F.count(F.lit(1)).alias("features"), F.sum("t").alias("t")).orderBy(F.desc("n")).collect()]
    toxic, total = sum(r[2] for r in sizes), sum(r[0] * r[1] for r in sizes)
    if not 0 < toxic < total:
        return empty
    # only features frequent enough to pass at all are tests, and only tests raise the bar (Tarone)
    bar, tests = math.inf, 0
    for n, features, _ in sizes:
        if n * math.log(total / toxic) < math.log(10 * (tests + features)):
            break
        tests += features
        bar = math.log(10 * tests)
    # the likelihood bound for so many occurrences in toxic documents, against the number of features looked at
    p, f = toxic / total, F.col("t") / F.col("n")
    bits = F.col("n") * (f * F.log(f / p) + F.when(f < 1, (1 - f) * F.log((1 - f) / (1 - p))).otherwise(0.0))
    strong = tallies.filter("t > 0").withColumn("bits", bits).filter((f >= PURITY) & (f > p) & (F.col("bits") >= F.lit(bar)))
    chosen = [r["feature"] for r in strong.orderBy(F.desc("bits"), "feature").limit(max_features).collect()]
    hashes = np.sort(np.array(chosen, np.int64).view(np.uint64))
    if not len(hashes):
        return empty

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in passes(pc.utf8_lower(batch.column(2))):
                starts, _, cuts, features = word_features(data, bounds)
                words, found = feature_hits(features, hashes)
                order = np.argsort(words, kind="stable")
                words, found = words[order], found[order]
                ends = np.searchsorted(words, cuts)
                hits = [((words[a:b] - c) << 16 | found[a:b]).tolist() for a, b, c in zip(ends[:-1], ends[1:], cuts[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in (0, 1, 3)), pa.array(np.diff(cuts)), pa.array(hits, pa.list_(pa.int64()))],
                    names=["id", "toxic", "spare", "n", "hits"],
                )

    kind = sample.schema["id"].dataType.simpleString()
    lines = sample.mapInArrow(tokens, f"id {kind}, toxic int, spare boolean, n bigint, hits array<bigint>")
    rows = lines.orderBy("spare", F.xxhash64(F.col("id").cast("string")), "toxic", "n").collect()
    sizes, marked, kept = (np.array([r[c] for r in rows]) for c in ("n", "toxic", "spare"))
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    hits = np.array([h + (int(cuts[i]) << 16) for i, r in enumerate(rows) for h in r["hits"]], np.int64)
    words, found = hits >> 16, hits & 0xFFFF
    learned = np.flatnonzero(~kept)
    learned = learned[within(sizes[learned], marked[learned], words_per_label)]
    # the words of these texts, numbered anew one text after the other
    own = np.full(len(sizes), -1)
    own[learned] = np.arange(len(learned))
    text = np.searchsorted(cuts, words, "right") - 1
    use = own[text] >= 0
    own_cuts = np.concatenate(([0], np.cumsum(sizes[learned])))
    field = train(hashes, own_cuts[own[text[use]]] + words[use] - cuts[text[use]], found[use], own_cuts, marked[learned])
    odds, _ = log_odds(field, words, found, int(cuts[-1]), cuts)
    p = chain(odds, cuts, field.steps)[2] if len(odds) else odds
    # each label weighs as in the whole table
    weights = np.array([1 / share[int(t)] for t in marked])
    judged = kept if len(set(marked[kept])) == 2 else np.ones(len(kept), bool)
    slope, shift = calibrate(offence(p, cuts)[judged], marked[judged], (weights / weights.mean())[judged])
    return field._replace(slope=slope, shift=shift)


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on) and ``spans``.

    ``spans`` are the runs of words with a marginal of at least OFFENDING: start and end as code points of the text, and the highest marginal.
    A null text is empty; an empty text or one without features has the score of no offending word. Repeated rows and null ids stay as they are; an
    empty table gives no row.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(tuple(field))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*held.value)
        for batch in batches:
            for lo, hi, data, bounds in passes(pc.utf8_lower(batch.column(1))):
                starts, ends, cuts, features = word_features(data, bounds)
                words, found = feature_hits(features, own.hashes)
                odds, _ = log_odds(own, words, found, len(starts), cuts) if len(starts) else (np.zeros(0), None)
                p = chain(odds, cuts, own.steps)[2] if len(odds) else odds
                value = 1 / (1 + np.exp(-(own.slope * offence(p, cuts) + own.shift)))
                bad = np.flatnonzero(p >= OFFENDING)
                spans: list[list[dict]] = [[] for _ in range(hi - lo)]
                if len(bad):
                    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                    text = np.searchsorted(cuts, bad, "right") - 1
                    breaks = np.flatnonzero((np.diff(bad) != 1) | (np.diff(text) != 0)) + 1
                    for run in np.split(np.arange(len(bad)), breaks):
                        i, a, b = int(text[run[0]]), starts[bad[run[0]]], ends[bad[run[-1]]]
                        zero = lead[bounds[i]]
                        spans[i].append({"start": int(lead[a] - zero), "end": int(lead[b] - zero), "marginal": float(p[bad[run]].max())})
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(value), pa.array((value >= threshold).astype(np.int32)), pa.array(spans, kind)],
                    names=["id", "score", "predicted", "spans"],
                )

    kind = texts.schema["id"].dataType.simpleString()
    out = texts.mapInArrow(task, f"id {kind}, score double, predicted int, spans array<struct<start: bigint, end: bigint, marginal: double>>")
    return out.withColumnRenamed("id", id_col)
