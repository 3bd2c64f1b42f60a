"""SimHash, vectors and repeated windows against brute force, with nulls, ties, repeated rows and hot groups."""

import random

import brute
import numpy as np
import pytest
from millrace.llm import arrays, simhash, substrings, vectors
from millrace.llm.components import components

DOCS = "doc_id long, text string, print string, node int, id string"


def docs(spark, rows):
    """Rows with columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS)


def sample_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["ab", "cd", "EF", "ég", "日本", "x,"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(n)]
    rows += [(n + i, rows[rng.randrange(n)][1] + rng.choice(["", " tail", "\ttail\n end"])) for i in range(n // 2)]
    return rows + [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one"), (1004, "ONE"), (1005, "two words")]


def test_simhash_same_as_brute_force(spark):
    rows = sample_texts(1, 60)
    got = simhash.simhash_components(docs(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.simhash(rows))


def test_simhash_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "q r s t u v"), (None, None), (7, "")]
    got = simhash.simhash_components(docs(spark, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.simhash(rows)))


def test_simhash_empty_table(spark):
    assert simhash.simhash_components(docs(spark, [])).collect() == []


@pytest.mark.parametrize("rows_per_task", [5, 1 << 15])
def test_gray_index_finds_every_link(spark, rows_per_task):
    rng = np.random.default_rng(3)
    heart = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = [sum((1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)), 0) for _ in range(400)]
    prints = np.unique(np.array([int(heart[k % 6]) ^ f for k, f in enumerate(flips)], np.uint64).view(np.int64))
    edges = simhash.links(spark.createDataFrame([(int(p),) for p in prints], "print long"), 3, rows_per_task)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    codes = prints.view(np.uint64)
    linked = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3
    want = brute.smallest_reachable([int(p) for p in prints], linked)
    assert [got.get(int(p), int(p)) for p in prints] == want


def test_gray_rank_inverts_the_code():
    x = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


def test_fingerprint_in_pieces():
    text = " ".join(random.Random(2).choices(["aa", "b", "ccc"], k=500)).encode()
    assert simhash.fingerprint(text, 3, 16) == simhash.fingerprint(text, 3) == brute.fingerprint(text.decode())


def test_components_of_a_long_path(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 500: 500, 501: 500}


@pytest.mark.parametrize(("window", "width", "crowd"), [(5, 2, 20_000), (5, 2, 1), (1, 1, 20_000), (7, 7, 3)])
def test_repeats_same_as_brute_force(spark, window, width, crowd):
    rows = sample_texts(4, 40) + [(2000, "a " * 50), (2001, "a " * 9 + "b"), (-5, "ab cd EF ab cd EF ab cd EF")]
    got = substrings.remove_repeats(docs(spark, rows), window=window, width=width, crowd=crowd).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute.repeats(rows, window)


def test_repeats_null_ids_same_ids_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text), (3, text), (None, text), (9, None), (9, "other " + text)]
    got = substrings.remove_repeats(docs(spark, rows)).collect()
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in got)
    assert found == [("3", 30, 0), ("3", 30, 0), ("9", 0, 0), ("9", 31, 30), ("None", 30, 30)]
    assert substrings.remove_repeats(docs(spark, [])).collect() == []


def test_hashes_depend_on_content_only():
    data = np.frombuffer(b"abcabcxabc", np.uint8)
    codes = arrays.byte_codes(9)[data]
    got = arrays.range_hashes(codes, np.array([0, 3, 7, 1]), np.array([3, 6, 10, 4]))
    assert got[0] == got[1] == got[2] != got[3]


def vector_rows(seed):
    rng = np.random.default_rng(seed)
    hearts = rng.standard_normal((4, 6))
    rows = [(i, [float(np.float32(x)) for x in hearts[i % 4] * rng.uniform(0.1, 9) + rng.standard_normal(6) * 0.15]) for i in range(90)]
    rows += [(200 + i, [1.0] * 6) for i in range(12)] + [(300, [2.0] * 6), (301, [-1.0] * 6), (302, [1.0, 1.0])]
    return rows + [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (404, [float("nan")] * 6), (405, [float("inf")] + [0.0] * 5)]


@pytest.mark.parametrize(("kind", "rows_per_task", "threshold"), [("float", 4096, 0.95), ("double", 10, 0.95), ("float", 4096, 0.5)])
def test_vectors_same_as_brute_force(spark, kind, rows_per_task, threshold):
    rows = vector_rows(5)
    df = spark.createDataFrame([(i, v, 1, "z") for i, v in rows], f"vec_id long, embedding array<{kind}>, node int, cell string")
    got = vectors.near_vectors(df, threshold=threshold, rows_per_task=rows_per_task).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute.near(rows, threshold))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_vectors_null_ids_and_empty_table(spark):
    kind = "vec_id long, embedding array<float>"
    got = vectors.near_vectors(spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, None)], kind)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True)]))
    assert vectors.near_vectors(spark.createDataFrame([], kind)).collect() == []


def test_vectors_are_sent_once_to_each_chunk(spark, tmp_path, monkeypatch):
    """A vector goes to as many tasks as there are chunks, and every two chunks are one task."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(32).astype("f4").tolist()) for i in range(300)]
    rows += [(1000 + i, [x * 2 + 1e-3 for x in rows[i][1]]) for i in range(0, 300, 7)]
    whole_groups = vectors.whole_groups

    def counted(batches, keys, *more):
        for table in whole_groups(batches, keys, *more):
            with open(tmp_path / "met", "a") as f:
                f.write(f"{table.num_rows} {len(arrays.runs([table.column(k).to_numpy() for k in keys])) - 1}\n")
            yield table

    monkeypatch.setattr(vectors, "whole_groups", counted)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vectors.near_vectors(df, rows_per_task=100).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute.near(rows, 0.95))
    met = [[int(x) for x in line.split()] for line in open(tmp_path / "met")]
    assert [sum(x) for x in zip(*met)] == [4 * len(rows), 10]


def test_every_near_pair_meets_in_a_block():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((200, 64))
    y = x + rng.standard_normal((200, 64)) * rng.uniform(0.05, 0.4, (200, 1))
    both = np.concatenate((x, y))
    near = np.einsum("ij,ij->i", vectors.unit(x), vectors.unit(y)) >= 0.95
    found = []
    for block in range(vectors.BLOCKS):
        for a, b in vectors.linked(both, len(both), None, block, 0.95, vectors.BLOCKS):
            found += list(zip(a.tolist(), b.tolist()))
    assert near.any() and len(found) == len(set(found))
    assert {(i, i + 200) for i in np.flatnonzero(near).tolist()} <= set(found)
