"""Ranked search against a plain loop over all pairs of an item and a document."""

import math
import random
import re
from collections import Counter

from millrace.llm import search
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def brute(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    rows = []
    for item, of_item in wanted.items():
        scores = []
        for i, c in counts:
            m, score = 10 + (90 * sum(c.values()) * n_docs) // n_terms, 0
            for term in of_item & set(c):
                df = sum(1 for _, x in counts if term in x)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        rows += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scores)[:top])]
    return Counter(rows)


def searched(spark, docs, items, top=10, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return Counter(tuple(r) for r in search.search(d, i, top=top, **more).collect())


def corpus(n):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(60)] + ["Été", "日本", "ÀB", "x_y", "a-b", "İz"]
    return [(k, " ".join(rng.choices(words, [1 + 200 / (k + 1) for k in range(66)], k=rng.randint(0, 60)))) for k in range(n)], rng, words


def test_same_as_all_pairs(spark):
    docs, rng, words = corpus(300)
    items = [(k, ", ".join(rng.choices(words, k=8)).upper()) for k in range(12)]
    assert searched(spark, docs, items) == brute(docs, items, 10)
    assert searched(spark, docs, items, top=3) == brute(docs, items, 3)


def test_items_in_blocks(spark):
    docs, rng, words = corpus(80)
    items = [(k, " ".join(rng.choices(words, k=8))) for k in range(9)]
    assert searched(spark, docs, items, block_postings=20) == brute(docs, items, 10)


def test_copies_of_a_third_tie_by_id(spark):
    docs, rng, words = corpus(100)
    docs += [(1000 + k, "W0 w1 w65") for k in range(50)]
    rng.shuffle(docs)
    items = [(1, "w0 w1 w65"), (2, "w2")]
    got = searched(spark, docs, items)
    assert got == brute(docs, items, 10)


def test_nulls_empty_texts_repeated_rows(spark):
    docs = [(None, "cat dog"), (1, None), (2, ""), (3, "--- !!"), (4, "cat"), (4, "cat"), (5, "cat"), (None, "cat")] + [(k, "bird") for k in range(10, 20)]
    items = [(None, "cat"), (7, None), (8, ""), (9, "cat"), (9, "dog dog"), (10, "unknown")]
    assert searched(spark, docs, items) == brute(docs, items, 10)


def test_empty_tables(spark):
    assert not searched(spark, [], [(1, "cat")])
    assert not searched(spark, [(1, "cat")], [])
    assert not searched(spark, [(1, None)], [(1, "cat")])


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "cat", 5, 6, 7), (2, "dog", 5, 6, 7), (3, "cow", 5, 6, 7)], "doc_id bigint, text string, score int, item int, n int")
    items = spark.createDataFrame([("a", "cat", 1)], "name string, body string, rank int")
    rows = search.search(docs, items, item_col="name", item_text_col="body").collect()
    assert [(r["name"], r["rank"], r["doc_id"]) for r in rows] == [("a", 1, 1)]


def test_long_text_in_parts(monkeypatch):
    text = ("Foo bar-baz " * 1000 + "q" * 3000 + " end").encode()
    whole = [w for part in search.terms(text) for w in part]
    monkeypatch.setattr(search, "PART_BYTES", 100)
    assert [w for part in search.terms(text) for w in part] == whole
    assert max(len(part) for part in search.terms(text)) < 40


def test_long_document(spark):
    docs = [(1, "cat " * 400_000 + "dog"), (2, "dog"), (3, "bird"), (4, "fish")]
    items = [(1, "dog cat")]
    assert searched(spark, docs, items) == brute(docs, items, 10)


def test_heaps_merge_over_tasks(spark):
    docs, _, _ = corpus(200)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(37)
    items = spark.createDataFrame([(1, "w0 w1")], "item_id bigint, text string")
    got = Counter(tuple(r) for r in search.search(d, items).withColumn("score", F.col("score")).collect())
    assert got == brute(docs, [(1, "w0 w1")], 10)
