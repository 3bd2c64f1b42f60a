"""Operators against brute force on small random inputs, hot keys included."""

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.ingest.run import ingest, pull, read_watermark, stamp
from millrace.ingest.specs import WAREHOUSE, IngestSpec, labelled
from millrace.ml.metrics import binary_curve_areas
from millrace.operators import iterative, skew
from millrace.operators.graph import page_rank, transitive_closure
from millrace.operators.intervals import contained_in
from millrace.operators.iterative import kmeans, logistic_descent
from millrace.operators.ranking import keep_group_max, top_k_per_group
from millrace.operators.sampling import fixed_size, fixed_size_with_replacement, hash_split, stratified
from millrace.operators.skew import number_rows, running_totals, salted_join, salted_sides, zip_rows
from millrace.operators.subsets import join_subsets, subset_masks, tag_sources
from millrace.plans.progress_curve import progress_curve, progress_curve_all5
from millrace.plans.score_summary import score_summary, score_summary_json
from millrace.session import scratch_name, scratch_path
from millrace.sinks.writers import append_by_name, create_table, truncate_load, upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---------------------------------------------------------------- skew


@pytest.mark.parametrize("split", [3, 1000])
def test_salted_join_is_a_join(spark, split):
    rng = random.Random(1)
    # key 0 has a third of the rows, half of them exact copies
    big = [(0, 5)] * 50 + [(0, i) for i in range(50)] + [(rng.randrange(20), i) for i in range(200)] + [(None, 1)]
    small = [(0, "a"), (0, "b"), (1, "c"), (2, None), (99, "d"), (None, "n")]
    left = spark.createDataFrame(big, "k int, v int").repartition(4)
    right = spark.createDataFrame(small, "k int, w string")
    got = rows(salted_join(left, right, "k", rows_per_split=split).select("k", "v", "w"))
    assert got == sorted(((k, v, w) for k, v in big for q, w in small if k is not None and k == q), key=str)
    semi = rows(salted_join(left, right, "k", how="left_semi", rows_per_split=split).select("k", "v"))
    assert semi == sorted(((k, v) for k, v in big if k in (0, 1, 2)), key=str)


def test_hot_key_is_spread(spark):
    left = spark.range(1000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(7, "x")], "k int, w string")
    salted, copies = salted_sides(left, right, ["k"], ["k"], rows_per_split=100)
    parts = [r["n"] for r in salted.groupBy("salt").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(parts) == 10 and max(parts) < 200
    assert copies.count() == 10


def test_copies_of_one_row_are_spread(spark):
    left = spark.range(0, 1000, 1, 8).select(F.lit(7).alias("k"))
    salted, _ = salted_sides(left, spark.createDataFrame([(7,)], "k int"), ["k"], ["k"], rows_per_split=100)
    assert salted.select("salt").distinct().count() > 3


def test_number_rows(spark):
    values = [random.Random(2).randrange(1000) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(number_rows(df, [F.col("v").desc(), F.col("id")]).select("row_id", "id"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(range(500), key=lambda i: (-values[i], i))
    assert sorted(got) == [(n, i) for n, i in enumerate(want, 1)]


def test_zip_rows(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "i int, x string")
    b = spark.createDataFrame([(30, 0.3), (10, 0.1), (20, 0.2)], "j int, y double")
    assert rows(zip_rows(a, b, [F.col("i")], [F.col("j")]).select("x", "y")) == [("a", 0.1), ("b", 0.2), ("c", 0.3)]


def test_running_totals(spark):
    # ranges stay apart although they are small
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(i, i * i) for i in range(1, 41)], "i int, v int")
        got = rows(running_totals(df, [F.col("i").asc()], ["v"]).select("i", "v_to"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == [(i, sum(j * j for j in range(1, i + 1))) for i in range(1, 41)]


@pytest.mark.parametrize("split", [4, 1000])
def test_contained_in(spark, split):
    rng = random.Random(3)
    hour = 3600
    attempts, windows = [], []
    for i in range(300):
        start = rng.randrange(0, 2000) * hour
        # person 0 has a third of everything
        attempts.append((rng.choice([0, 0, 1, 2, 3]), i, start, start + rng.randrange(1, 50) * hour))
    for i in range(60):
        start = rng.randrange(0, 2000) * hour
        # lengths from nothing to a year, one of them negative
        windows.append((rng.choice([0, 0, 1, 2]), start, start + rng.choice([-hour, 0, hour, 20 * hour, 400 * hour, 8760 * hour])))
    at = lambda c: F.timestamp_add("SECOND", F.col(c), F.lit("2020-01-01").cast("timestamp_ntz")).alias(c)
    a = spark.createDataFrame(attempts, "person int, id int, starttime bigint, endtime bigint").select(
        "person", "id", at("starttime"), at("endtime")
    )
    w = spark.createDataFrame(windows, "person int, start_dt bigint, end_dt bigint").select("person", at("start_dt"), at("end_dt"))
    want = sorted((p, i) for p, i, s, e in attempts for q, x, y in windows if p == q and s >= x and e <= y)
    assert want
    assert sorted(rows(contained_in(a, w, rows_per_split=split).select("person", "id"))) == want
    once = sorted(rows(contained_in(a, w, once=True, rows_per_split=split).select("person", "id").distinct()))
    assert once == sorted(set(want))
    assert contained_in(a, w.limit(0)).count() == 0


# ---------------------------------------------------------------- subsets and the curve


def brute_subsets(tables, exams):
    """Every subset of at least three sources, joined on the person."""
    out = []
    people = {p for t in tables for p in t} | set(exams)
    for person in people:
        for size in (3, 4, 5):
            for picked in itertools.combinations(range(5), size):
                if any(person not in tables[i] for i in picked if i < 4) or (4 in picked and person not in exams):
                    continue
                mask = sum(1 << i for i in picked)
                scores = [tables[i][person] if i in picked else None for i in range(4)]
                for exam, total in exams[person].items() if 4 in picked else [(None, None)]:
                    values = [tables[i][person] for i in picked if i < 4] + ([total] if 4 in picked else [])
                    out.append((person, mask, *scores, exam, total, sum(1 for v in values if v)))
    return out


def random_people(seed, n):
    rng = random.Random(seed)
    score = lambda: rng.choice([None, 0.0, float(rng.randrange(1, 9))])
    tables = [{p: score() for p in range(n) if rng.random() < 0.7} for _ in range(4)]
    exams = {p: {f"e{k}": score() for k in range(rng.randrange(1, 4))} for p in range(n) if rng.random() < 0.7}
    return tables, exams


@pytest.mark.parametrize("seed", [1, 2])
def test_join_subsets_is_the_enumeration(spark, seed):
    tables, exams = random_people(seed, 120)
    frames = [spark.createDataFrame(list(t.items()), "person int, score double") for t in tables]
    flat = [(p, e, s) for p, es in exams.items() for e, s in es.items()]
    exam_frame = spark.createDataFrame(flat, "person int, exam string, score double")
    want = brute_subsets(tables, exams)
    tagged = tag_sources(frames)
    columns = ["person", "mask", "s1", "s2", "s3", "s4", "exam", "exam_score"]
    assert rows(join_subsets(tagged, exam_frame).select(*columns)) == sorted((w[:-1] for w in want), key=str)
    top = defaultdict(int)
    for w in want:
        top[w[0]] = max(top[w[0]], w[-1])
    kept = sorted((w[:-1] for w in want if w[-1] == top[w[0]]), key=str)
    assert rows(join_subsets(tagged, exam_frame, most_complete=True).select(*columns)) == kept


def test_masks():
    assert len(subset_masks()) == 16 and len(set(subset_masks())) == 16


def curve_tables(spark):
    ts = "timestamp_ntz'2020-01-02 00:00:00'"
    scores = spark.sql(
        f"""select sheet, person, {ts} as starttime, {ts} + interval 1 hour as endtime, cast(score as decimal(18,3)) as score
        from values ('on', 1, 86.5), ('dev', 1, 56.5), ('mod', 1, 32), ('on', 2, 10), ('dev', 2, 0), ('mod', 2, 5),
                    ('on', 3, 1), ('dev', 3, 1), ('on', 4, 1), ('dev', 4, 1), ('on', null, 9), ('dev', null, 9), ('mod', null, 9),
                    ('on', 1, 12), ('other', 3, 77) t(sheet, person, score)"""
    )
    learn = spark.createDataFrame([("on", 0), ("mod", 1), ("dev", 2), ("other", 3)], "sheet string, type int")
    windows = spark.sql(
        "select 1 as person, 1 as status, timestamp_ntz'2020-01-01' as start_dt, timestamp_ntz'2020-02-01' as end_dt "
        "union all select 2, 0, timestamp_ntz'2020-01-01', timestamp_ntz'2020-02-01'"
    )
    exams = spark.createDataFrame([(1, 1, 60.0), (1, 1, 40.0), (2, 3, 9.0)], "exam int, person int, score double")
    return scores, learn, windows, exams


def test_progress_curve_cases(spark):
    got = rows(progress_curve(*curve_tables(spark)).select("person", "mask", "exam", "scores"))
    full = (
        '{"kqselftraining":"86.500","ksrobottraining":"56.500","ksmodeltraining":"32.000",'
        '"khselftraining":"86.500","osce":"100.000"}'
    )
    # person 2: the device score is 0, so the subset without it ties with nothing above two non-zero scores
    zero = '{"kqselftraining":"10.000","ksrobottraining":"0.000","ksmodeltraining":"5.000","khselftraining":"","osce":""}'
    three = '{"kqselftraining":"1.000","ksrobottraining":"1.000","ksmodeltraining":"","khselftraining":"","osce":"9.000"}'
    # person 4 has two sources only, and a row without a person falls out
    assert got == [(1, 31, 1, full), (2, 7, None, zero), (3, 19, 2, three)]
    assert rows(progress_curve_all5(*curve_tables(spark))) == [(1, 1, 1, full)]


def test_score_summary_empty_group_is_zero(spark):
    scores, learn, windows, _ = curve_tables(spark)
    reports = spark.createDataFrame([('{"rankinglist":[]}',)], "report string")
    long = score_summary(scores, learn, windows, reports)
    document = score_summary_json(long, F.lit("t")).first()["scores"]
    assert '"osce":{"osce_maxscore":0.0,"osce_minscore":0.0,"osce_avgscore":0.0,"osce_rank5":[]}' in document
    best = '"znsb_rank5":[{"name":null,'
    devices = '"znsb_rank5":[{"id":1,"score":"56.500"},{"id":null,"score":"9.000"},{"id":3,"score":"1.000"},{"id":4,"score":"1.000"},{"id":2,"score":"0.000"}]'
    assert devices in document and best not in document
    # every attempt counts, so a person can appear twice
    ranks = [r["who"] for r in long.filter("grp = 'zxxl' and metric like 'rank%'").collect()]
    assert Counter(ranks)["1"] == 2


# ---------------------------------------------------------------- ranking


def test_group_max_and_top_k(spark):
    rng = random.Random(5)
    data = [(rng.choice("aab"), i, rng.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(data, "g string, id int, v int")
    best = {g: max(v for q, _, v in data if q == g) for g in "ab"}
    assert rows(keep_group_max(df, ["g"], "v").select("g", "id", "v")) == sorted((r for r in data if r[2] == best[r[0]]), key=str)
    top = rows(top_k_per_group(df, "g", 3, F.col("v").desc(), F.col("id")).select("g", "id"))
    want = [(g, r[1]) for g in "ab" for r in sorted((r for r in data if r[0] == g), key=lambda r: (-r[2], r[1]))[:3]]
    assert top == sorted(want, key=str)


# ---------------------------------------------------------------- graph and iteration


def brute_rank(edges, rounds):
    links = defaultdict(set)
    for s, d in edges:
        links[s].add(d)
    ranks = {s: 1.0 for s in links}
    for _ in range(rounds):
        received = defaultdict(float)
        for s, r in ranks.items():
            for d in links.get(s, ()):
                received[d] += r / len(links[s])
        ranks = {n: 0.15 + 0.85 * x for n, x in received.items()}
    return ranks


@pytest.mark.parametrize("split", [2, 1000])
def test_page_rank(spark, split):
    rng = random.Random(6)
    edges = [(rng.randrange(30), rng.randrange(35)) for _ in range(120)] + [(0, d) for d in range(20)] + [(0, 1)] * 3
    df = spark.createDataFrame(edges, "src int, dst int")
    got = {r["node"]: r["rank"] for r in page_rank(df, 4, rows_per_split=split, cut_every=2).collect()}
    want = brute_rank(edges, 4)
    assert got.keys() == want.keys()
    assert all(got[n] == pytest.approx(want[n]) for n in want)


def test_transitive_closure_with_cycles(spark):
    rng = random.Random(42)
    edges = set()
    while len(edges) < 60:
        a, b = rng.randrange(50), rng.randrange(50)
        if a != b:
            edges.add((a, b))
    known = set(edges)
    while True:
        more = {(a, d) for a, b in known for c, d in edges if b == c} - known
        if not more:
            break
        known |= more
    df = spark.createDataFrame(list(edges), "src int, dst int")
    closed = transitive_closure(df)
    assert set(rows(closed)) == known
    # closing a closed set adds nothing
    assert transitive_closure(closed).count() == len(known)


def test_kmeans_keeps_an_empty_centre(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([0.0, 2.0],), ([10.0, 0.0],)], "v array<double>")
    centres = kmeans(df, "v", [[0.0, 0.0], [9.0, 0.0], [500.0, 500.0]], 0.0, 10)
    assert centres == [[0.0, 1.0], [10.0, 0.0], [500.0, 500.0]]


def test_kmeans_rounds_read_packed_points(spark, monkeypatch):
    """A round interprets no expression per point; ties go to the lower centre, and tables with odd vectors give what they gave."""
    draw = random.Random(4)
    rows = [([draw.gauss(9 * (i % 3), 2.0), draw.gauss(0, 2.0)],) for i in range(300)] + [([4.5, 0.0],)] * 5
    start = [[0.0, 0.0], [9.0, 0.0], [18.0, 0.0], [18.0, 0.0]]
    df = spark.createDataFrame(rows, "v array<double>").repartition(3)
    distance = lambda p, c: sum((x - y) ** 2 for x, y in zip(p, c))
    want = [list(c) for c in start]
    for _ in range(3):
        own = [min(range(4), key=lambda i: distance(v, want[i])) for (v,) in rows]
        for i in range(4):
            if i in own:
                members = [v for (v,), k in zip(rows, own) if k == i]
                want[i] = [sum(x) / len(members) for x in zip(*members)]
    odd = df.union(spark.createDataFrame([([1.0, float("inf")],)], df.schema))
    slow = kmeans(odd, "v", start, 0.0, 1)
    assert not abs(slow[0][1]) < float("inf") and slow[3] == [18.0, 0.0]
    monkeypatch.setattr(iterative, "nearest", lambda *_: pytest.fail("a round went over single points"))
    found = kmeans(df, "v", start, 0.0, 3)
    assert [x for c in found for x in c] == pytest.approx([x for c in want for x in c], rel=1e-12)
    assert kmeans(df, "v", start, 0.0, 1)[3] == [18.0, 0.0]


def test_logistic_descent(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-1.0, -1.0)], "y double, x double")
    # from zero, sigma is 1/2: the gradient is the sum of -y*x/2
    assert logistic_descent(df, "y", ["x"], 1) == [pytest.approx(1.5)]


def test_curve_areas_of_a_perfect_score(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)], "s double, y int")
    got = binary_curve_areas(df, "s", "y").first()
    assert got["area_roc"] == pytest.approx(1.0) and got["area_pr"] == pytest.approx(1.0)


# ---------------------------------------------------------------- sampling


def test_samples(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 300, "a").otherwise("b"))
    assert fixed_size(df, 50, ["id"], 1).count() == 50
    assert rows(fixed_size(df, 50, ["id"], 1)) == rows(fixed_size(df.repartition(5), 50, ["id"], 1))
    assert fixed_size(df, 5000, ["id"], 1).count() == 1000
    drawn = fixed_size_with_replacement(df, 3000, ["id"], 1)
    assert drawn.count() == 3000 and drawn.distinct().count() < 1000
    train, test = hash_split(df, ["id"], [0.7, 0.3])
    assert train.count() + test.count() == 1000 and train.join(test, "id").count() == 0
    for replacement in (False, True):
        taken = {r["k"]: r["count"] for r in stratified(df, "k", {"a": 0.5, "b": 0.1}, 3, ["id"], replacement).groupBy("k").count().collect()}
        assert 100 < taken["a"] < 200 and 40 < taken["b"] < 105


# ---------------------------------------------------------------- ingestion and sinks

SPEC = IngestSpec("t", ["id", "name"], "updated_at", labelled("T", 3))


def source(spark, *changes):
    return spark.createDataFrame(list(changes), "id int, name string, updated_at string").withColumn(
        "updated_at", F.col("updated_at").cast("timestamp_ntz")
    )


def target(spark, spec):
    name = scratch_name("target")
    create_table(spark, name, ", ".join(f"{c} string" for c in spec.layout), scratch_path(spark, "target"))
    return name


def test_incremental_loads(spark):
    name = target(spark, SPEC)
    assert read_watermark(spark.table(name)) is None
    first = [(1, "a", "2020-01-01 00:00:00"), (2, "b", "2020-01-02 00:00:00"), (3, "c", None)]
    assert ingest(source(spark, *first), name, SPEC, "L1") == 3
    # a null change time is stored as text and does not disturb the watermark
    assert str(read_watermark(spark.table(name))) == "2020-01-02 00:00:00"
    late = [*first[:2], (4, "late", "2020-01-02 00:00:00"), (5, "new", "2020-01-03 00:00:00.5")]
    # the strict form misses row 4, which came late with the boundary time
    assert pull(source(spark, *late), SPEC, read_watermark(spark.table(name))).count() == 1
    # the inclusive form finds it and does not repeat row 2
    assert ingest(source(spark, *late), name, SPEC, "L2", inclusive=True) == 2
    assert ingest(source(spark, *late), name, SPEC, "L3", inclusive=True) == 0
    got = {(r["id"], r["updatets"], r["createts"]) for r in spark.table(name).collect()}
    assert got == {
        ("1", "2020-01-01 00:00:00", "L1"),
        ("2", "2020-01-02 00:00:00", "L1"),
        ("3", "None", "L1"),
        ("4", "2020-01-02 00:00:00", "L2"),
        ("5", "2020-01-03 00:00:00.500000", "L2"),
    }


def test_every_warehouse_spec_stamps(spark):
    for spec in WAREHOUSE.values():
        df = spark.range(2).select(*[F.col("id").alias(c) for c in spec.hashed])
        stamped = stamp(pull(df, spec, None), spec, "now")
        assert stamped.columns == spec.layout
        assert {t for _, t in stamped.dtypes} == {"string"}
        assert stamped.first()["updatets"] == ("now" if spec.changed is None else "0")


def test_full_refresh_empties_with_its_source(spark):
    spec = IngestSpec("f", ["id", "name"], None, labelled("F", 2))
    name = target(spark, spec)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert ingest(df, name, spec, "L1") == 2
    assert ingest(df.filter("id = 2"), name, spec, "L2") == 1
    assert ingest(df.limit(0), name, spec, "L3") == 0
    assert spark.table(name).count() == 0
    assert truncate_load(stamp(pull(df, spec, None), spec, "L4"), name) == 2
    assert truncate_load(stamp(pull(df.limit(0), spec, None), spec, "L5"), name, keep_if_empty=True) == 0
    assert {r["createts"] for r in spark.table(name).collect()} == {"L4"}


def test_load_reads_no_target(spark, monkeypatch):
    """The second load takes its watermark from the table's property and its rows from the batch."""
    import millrace.ingest.run as run

    name = target(spark, SPEC)
    assert ingest(source(spark, (1, "a", "2020-01-01 00:00:00")), name, SPEC, "L1") == 1
    frames = []
    monkeypatch.setattr(run, "read_watermark", lambda df: frames.append(df.inputFiles()) or read_watermark(df))
    assert ingest(source(spark, (1, "a", "2020-01-01 00:00:00"), (2, "b", "2020-01-03 00:00:00")), name, SPEC, "L2") == 1
    assert len(frames) == 1 and all("/batch-" in f for f in frames[0])
    assert str(run.loaded_until(spark, name)) == "2020-01-03 00:00:00" and spark.table(name).count() == 2


def test_append_matches_names(spark):
    name = scratch_name("named")
    create_table(spark, name, "a int, b string", scratch_path(spark, "named"))
    append_by_name(spark.createDataFrame([("x", 1)], "b string, a int"), name)
    assert rows(spark.table(name)) == [(1, "x")]
    with pytest.raises(ValueError):
        append_by_name(spark.createDataFrame([("x", 1)], "b string, c int"), name)
    assert truncate_load(spark.createDataFrame([("y", 2)], "b string, a int"), name) == 1
    assert rows(spark.table(name)) == [(2, "y")]


def test_upsert(spark):
    current = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, t int")
    changes = spark.createDataFrame([(2, "B", 1), (2, "BB", 2), (3, "c", 1)], "id int, v string, t int")
    assert rows(upsert(current, changes, "id", F.col("t"))) == [(1, "a", 1), (2, "BB", 2), (3, "c", 1)]


def test_split_constant_is_used():
    assert skew.ROWS_PER_SPLIT == 2_000_000


def test_scratch_scope_removes_its_folders(spark):
    import os

    from millrace.session import cut_lineage, scratch_scope

    kept = scratch_path(spark, "kept")
    with scratch_scope(spark):
        inner = cut_lineage(spark.range(5))
        files = inner.inputFiles()
        inner.write.parquet(kept)
    assert spark.read.parquet(kept).count() == 5
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
