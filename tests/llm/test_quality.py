"""Quality model: measures against plain loops, tables against sums by hand, held-out labels, odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from millrace.llm import quality
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def by_hand(text):
    data = (text or "").encode()
    words = WORD.findall(data)
    n, chars = len(words), len(text or "")
    letter = lambda c: chr(c).isascii() and chr(c).isalpha() or c >= 0x80
    upper = lambda c: 65 <= c <= 90
    symbol = lambda c: 33 <= c < 127 and not chr(c).isalnum() and chr(c) not in ".,;:?!"
    per = lambda count, total: count / total if total else 0.0
    sizes = [len(w) for w in words]
    length = per(sum(sizes), n)
    spread = math.sqrt(max(0, per(sum(s * s for s in sizes), n) - length**2))
    counts = Counter(words)
    return [
        math.log1p(n), length, spread,
        per(sum(map(letter, data)), chars), per(sum(map(upper, data)), chars), per(sum(48 <= c <= 57 for c in data), chars),
        per(sum(chr(c) in ".,;:?!" for c in data), chars), per(sum(map(symbol, data)), chars), per(sum(c >= 0xC0 for c in data), chars),
        per(data.count(b"\n"), n), per(sum(not any(map(letter, w)) for w in words), n),
        per(sum(sum(map(letter, w)) > 1 and all(upper(c) for c in w if letter(c)) for w in words), n),
        per(sum(upper(w[0]) for w in words), n), per(sum(s >= 16 for s in sizes), n), per(sum(s <= 2 for s in sizes), n),
        per(sum(any(map(symbol, w)) for w in words), n), per(sum(chr(w[-1]) in ".,;:?!" for w in words), n),
        per(len(counts), n), per(sum(a == b for a, b in zip(words, words[1:])), n), per(len(set(zip(words, words[1:]))), n),
        per(max(counts.values(), default=0), n),
    ]


TEXTS = [None, "", " \n", "a", "One two two THREE!! <x> été 12 3,4 x|y", "日本語 \U0001f600 ÉTÉ Ok", "line one\nline two\nline one", "AB " * 50 + "averyveryverylongword", "z"]


def test_measures_by_hand():
    np.testing.assert_allclose(quality.measures(pa.array(TEXTS, pa.string())), [by_hand(t) for t in TEXTS], atol=1e-12)


def test_long_text_part_by_part(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["ab", "cd", "EF", "g-h", "été", "x" * 30]) for _ in range(n)) for n in (500, 3, 40, 0, 200)]
    whole = quality.measures(pa.array(texts))
    monkeypatch.setattr(quality, "PART_BYTES", 64)
    np.testing.assert_allclose(quality.measures(pa.array(texts)), whole)
    np.testing.assert_allclose(whole, [by_hand(t) for t in texts])


def test_tree_is_a_newton_step_on_its_best_boxes():
    g, h = np.array([3.0, 3.0, -3.0, -3.0, 0.0]), np.full(5, 4.0)
    step = quality.shallow_tree(g, h, leaves=2)
    # brute force over both sides of every cut
    gain = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1)
    cut = max(range(1, 5), key=lambda c: gain(slice(0, c)) + gain(slice(c, 5)))
    wanted = [-g[s].sum() / (h[s].sum() + 1) for s in (slice(0, cut), slice(cut, 5))]
    np.testing.assert_allclose(step, [wanted[0]] * cut + [wanted[1]] * (5 - cut))


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(4)
    values = rng.random((4000, 4))
    label = ((values[:, 0] > 0.5) ^ (values[:, 2] > 0.5)).astype(float)
    alone = quality.train(values, label, np.ones(4000), pairs=0, rounds=50)
    both = quality.train(values, label, np.ones(4000), pairs=1, rounds=50)
    right = [((quality.probability(m, values) >= 0.5) == label).mean() for m in (alone, both)]
    assert both.pairs == [(0, 2)] and right[0] < 0.62 and right[1] > 0.95


def test_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(5)
    values = rng.random((500, 3))
    model = quality.train(values, (values[:, 0] + values[:, 1] > 1).astype(float), np.ones(500), pairs=2, rounds=10)
    for row in rng.random((20, 3)):
        total = model.base
        for v, edges, table in zip(row, model.edges, model.tables):
            total += table[sum(e < v for e in edges)]
        for (i, j), table in zip(model.pairs, model.pair_tables):
            total += table[sum(e < row[i] for e in model.pair_edges[i]), sum(e < row[j] for e in model.pair_edges[j])]
        assert quality.probability(model, row[None])[0] == pytest.approx(1 / (1 + math.exp(-total)))


def area(rows):
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.filter(quality.learnable("doc_id")), rounds=40)
    rows = quality.score(docs, model).join(labels, "doc_id").filter(quality.held_out("doc_id")).collect()
    assert area(rows) > 0.97 and sum((r["score"] >= 0.5) == r["quality"] for r in rows) > 0.95 * len(rows)
    # labels dealt at random teach nothing
    spoilt = labels.withColumn("quality", (F.xxhash64("doc_id") % 2 == 0).cast("int"))
    blind = quality.fit(docs, spoilt.filter(quality.learnable("doc_id")), rounds=40)
    rows = quality.score(docs, blind).join(labels, "doc_id").filter(quality.held_out("doc_id")).collect()
    assert 0.2 < area(rows) < 0.8


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    rows = [("a", "good text here, and more of it.", 1), ("b", "bad!! bad!! bad!!", 2), (None, None, 3), ("b", "", 4), ("a", "good text here, and more of it.", 1)]
    docs = spark.createDataFrame(rows, "name string, body string, score int").withColumn("measures", F.lit(1)).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([("a", 1), ("b", 0), (None, 0), ("zz", 1), ("a", None), ("b", 7)], "name string, good int")
    model = quality.fit(docs, labels, "name", "body", "good", rounds=5)
    out = quality.score(docs, model, "name", "body")
    assert out.columns == ["name", "score", "predicted"]
    got = out.collect()
    assert sorted(str(r["name"]) for r in got) == ["None", "a", "a", "b", "b"]
    assert len({r["score"] for r in got if r["name"] == "a"}) == 1 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score(docs.limit(0), model, "name", "body").count() == 0
    for part, low, high in ((labels.limit(0), 0.49, 0.51), (labels.filter("good = 0"), 0, 0.01), (labels.filter("good = 1"), 0.99, 1)):
        one = quality.fit(docs, part, "name", "body", "good")
        (found,) = {r["score"] for r in quality.score(docs, one, "name", "body").collect()}
        assert low <= found <= high


def test_sample_is_bounded_by_its_parameter(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    kept = []
    original = quality.train
    try:
        quality.train = lambda values, label, *more: kept.append(label) or original(values, label, *more)
        quality.fit(docs, labels, per_label=100, rounds=1)
    finally:
        quality.train = original
    assert 60 < sum(kept[0] == 0) < 150 and 60 < sum(kept[0] == 1) < 150
