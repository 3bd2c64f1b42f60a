"""Token alignment against loops over whole texts, and the fragments as a monoid."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from millrace.llm import align
from millrace.llm.queries import TOKENIZERS
from tokenizers import Tokenizer

A_FILE, B_FILE = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
LETTER = {}
for b in range(256):
    LETTER[chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b else chr(256 + len([c for c in range(b) if not (33 <= c <= 126 or 161 <= c <= 172 or 174 <= c)]))] = b


@pytest.fixture(scope="module")
def whole():
    """(A tokens, B tokens) of a whole text as (id, start, end), or nothing."""
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)

    def spans(ids, data):
        out, at = [], 0
        for i, piece in zip(ids, data):
            out.append((i, at, at + len(piece)))
            at += len(piece)
        return out

    def tokens(text):
        if not text:
            return [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(LETTER[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return [], []
        return spans(ids_a, bytes_a), spans(ids_b, bytes_b)

    return tokens


def groups_of(a, b):
    both = sorted({e for _, _, e in a} & {e for _, _, e in b})
    out, low = [], 0
    for high in both:
        out.append(([i for i, _, e in a if low < e <= high], [i for i, _, e in b if low < e <= high]))
        low = high
    return out


def brute(texts, whole):
    streams = [whole(t) for t in texts]
    pairs = [Counter((i, j) for i, s, e in a for j, t, f in b if s < f and t < e) for a, b in streams]
    held = Counter(p for c in pairs for p in c)
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    rows = []
    for (a, b), c in zip(streams, pairs):
        groups = groups_of(a, b)
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in c.items() if held[p] == most[p[0]])
        digest = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        rows.append((len(a), len(b), len(groups), sum(c.values()), best, sum(n * held[p] for p, n in c.items()), digest))
    return rows


def aligned(spark, texts, ids=None, **more):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")
    rows = align.align(docs, A_FILE, B_FILE, **more).collect()
    return Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows)


def expected(texts, whole, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return Counter((i, *row) for i, row in zip(ids, brute(texts, whole)))


TEXTS = [
    "hello  world, it's <|endoftext|> </s> <0x0A> 12345",
    None,
    "",
    " ",
    "  a b \n\n\t c\r\n",
    "x▁y comes back as a blank",
    "日本語のテキスト und \U0001f600\U0001f600 é  　 x",
    "nul \x00 byte",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "hello world hello world",
    "hello world hello world",
    "Здравствуй, мир",
]


def test_same_as_whole_texts(spark, whole):
    assert aligned(spark, TEXTS) == expected(TEXTS, whole)


def test_given_documents(spark, sf_dir, whole):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars < 2000").select("doc_id", "text").collect()
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    assert aligned(spark, texts, ids) == expected(texts, whole, ids)


@pytest.mark.parametrize("chunk", [1, 7, 40])
def test_byte_ranges_give_the_whole(spark, whole, chunk):
    texts = TEXTS + ["the quick brown fox " * 12 + "!!! ??? " * 9 + "jumps over the lazy dog " * 5]
    assert aligned(spark, texts, chunk=chunk, fan=3) == expected(texts, whole)


def test_counts_joined_beyond_the_broadcast(spark, whole):
    assert aligned(spark, TEXTS, broadcast_pairs=3) == expected(TEXTS, whole)
    assert aligned(spark, TEXTS, broadcast_pairs=3, chunk=20) == expected(TEXTS, whole)


def test_repeated_rows_null_ids_and_empty_tables(spark, whole):
    texts, ids = ["one two"] * 4 + [None] * 2, [None, None, 5, 5, 6, None]
    assert aligned(spark, texts, ids) == expected(texts, whole, ids)
    assert aligned(spark, texts, ids, chunk=3) == expected(texts, whole, ids)
    assert not aligned(spark, [])
    assert aligned(spark, [None]) == expected([None], whole)


def test_clashing_columns(spark, whole):
    docs = spark.createDataFrame([("a", "one two", 1, 2, 3)], "name string, body string, key int, n_a int, pairs int")
    (row,) = align.align(docs, A_FILE, B_FILE, id_col="name", text_col="body", chunk=4).collect()
    assert (row["name"], *(row[c] for c in COLUMNS)) == ("a", *brute(["one two"], whole)[0])


def test_no_piece_reaches_over_a_blank():
    model = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    assert not [p for p in pieces if "▁" in p.lstrip("▁")]


def test_ranges_cover_a_text_once_and_stay_small():
    rng = random.Random(3)
    text = "".join(rng.choice(["ab", "c", " ", " ", "é", "!", "\n"]) for _ in range(5000)).encode()
    for chunk in (16, 100, 1000):
        found = list(align.ranges(text, chunk))
        assert [low for _, low, _, _ in found] == [0] + [high for _, _, high, _ in found[:-1]]
        assert found[-1][2] == len(text) + 1
        assert all(start <= low and high <= start + 1 + len(words) for start, low, high, words in found)
    solid = b"x" * 5000
    assert sum(len(words) for *_, words in align.ranges(solid, 10)) <= 2 * len(solid)


def random_tokens(rng):
    ends = [sorted(rng.sample(range(1, 120), rng.randint(3, 50))) + [120] for _ in range(2)]
    ids = [[rng.randint(0, 99) for _ in e] for e in ends]
    return align.Tokens(*(np.array(x, np.int64) for x in (ids[0], ends[0], ids[1], ends[1])))


def test_fragments_compose_in_any_order():
    rng = random.Random(11)

    def plain(tokens):
        return tuple(map(tuple, (x.tolist() for x in tokens)))

    def folded(parts):
        """Compose neighbours in random order; (open ends, all closed runs cut into groups)."""
        parts, groups = list(parts), []
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            one, closed = align.compose(parts[k], parts[k + 1])
            groups += [closed] if closed else []
            parts[k : k + 2] = [one]
        return parts[0], groups

    def single(runs):
        out = set()
        for start, tokens in runs:
            for end in tokens.a_ends[align.common_ends(tokens)[0]].tolist():
                out.add((start, plain(tokens.between(start, end))))
                start = end
        return out

    for _ in range(200):
        tokens = random_tokens(rng)
        edges = [0, *sorted(rng.sample(range(1, 120), rng.randint(0, 12))), 120]
        found = [align.fragment(tokens.between(a, b), k == 0) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:]))]
        runs = [closed for _, closed in found if closed]
        whole_open, whole_closed = align.fragment(tokens, True)
        for _ in range(3):
            open_ends, between = folded([f for f, _ in found])
            assert single(runs + between) == single([whole_closed] if whole_closed else [])
            assert not len(open_ends.head.a) and not len(open_ends.tail.a) and not len(whole_open.tail.a)
        first = found[0][0]
        for x, y in ((align.IDENTITY, first), (first, align.IDENTITY)):
            both, closed = align.compose(x, y)
            assert closed is None and plain(both.head) == plain(first.head) and plain(both.tail) == plain(first.tail) and both.cut == first.cut


def test_links_are_all_overlaps():
    rng = random.Random(5)
    for _ in range(100):
        t = random_tokens(rng)
        starts = [np.concatenate(([0], e[:-1])) for e in (t.a_ends, t.b_ends)]
        wanted = {(i, j) for i in range(len(t.a)) for j in range(len(t.b)) if starts[0][i] < t.b_ends[j] and starts[1][j] < t.a_ends[i]}
        at_a, at_b = align.links(t, 0)
        assert len(at_a) == len(wanted) and set(zip(at_a.tolist(), at_b.tolist())) == wanted


def test_long_document(spark, whole):
    text = "The reed and the stone. " * 40_000
    (row,) = aligned(spark, [text])
    assert row[1] > 200_000 and row[3] <= row[1] and len(row[7]) == 64
    # a third of it, by itself, has the same groups at the same places
    short = "The reed and the stone. " * 100
    assert aligned(spark, [short], chunk=64) == aligned(spark, [short])
