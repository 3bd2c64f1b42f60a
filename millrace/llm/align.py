"""Alignment of two tokenizers: byte offsets where tokens of both end cut a text into groups.

Texts are handled in byte ranges. A range yields a fragment: the tokens up to its first common end (open, as the group may have begun before), closed groups, and the
tokens behind its last common end (open). Fragments form a monoid, so those of a very long text are composed by a tree over Spark tasks.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import salted_join
from millrace.session import cut_lineage

#: Bytes of a byte range; a longer text is cut, and its ranges go to tasks of their own.
CHUNK = 1 << 16
#: Neighbouring fragments that one group composes.
FAN = 16
#: Different pairs of ids (24 bytes each) up to which their counts are broadcast; beyond, they are joined.
BROADCAST_PAIRS = 4_000_000
#: Bytes of text that are encoded together.
PASS_BYTES = 1 << 20
#: Ids of units of text that a task keeps encoded, and units that are encoded in one run.
KNOWN_IDS, RUN_UNITS = 1 << 22, 2000
#: A pair of ids is one number: the first tokenizer's id above these bits, the second's in them.
ID_BITS = 20

#: A blank that no token crosses to its left: white space and what the second tokenizer writes for a blank stand on neither side.
_BLANK = re.compile("(?<=[^\\s\u2581\u180e]) (?=[^\\s\u2581\u180e])")
_ODD_END = re.compile("[\\s\u2581\u180e]")

_LISTS = ("head_a", "head_a_ends", "head_b", "head_b_ends", "tail_a", "tail_a_ends", "tail_b", "tail_b_ends")
_PIECE = pa.schema(
    [(n, pa.int64()) for n in ("key", "chunk", "n_a", "n_b")]
    + [("valid", pa.bool_()), ("cut", pa.bool_()), ("start", pa.int64())]
    + [(n, pa.list_(pa.int64())) for n in _LISTS]
    + [("position", pa.int64()), ("groups", pa.string()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)
_PIECE_SQL = (
    "key bigint, chunk bigint, n_a bigint, n_b bigint, valid boolean, cut boolean, start bigint, "
    + ", ".join(f"{n} array<bigint>" for n in _LISTS)
    + ", position bigint, groups string, n_groups bigint, n_links bigint, pairs array<bigint>, times array<bigint>"
)


class Tokens(NamedTuple):
    """Ids and byte ends of neighbouring tokens of both tokenizers."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def joined(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(pair) for pair in zip(self, other)))

    def between(self, low: int, high: int) -> Tokens:
        """Those that end behind ``low`` and not behind ``high``."""
        i, j = np.searchsorted(self.a_ends, (low, high), "right")
        k, m = np.searchsorted(self.b_ends, (low, high), "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])


NONE = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


class Fragment(NamedTuple):
    """What is open in a byte range: ``head`` ends with its first common end, ``tail`` begins at its last one (``start``); without any, all is head."""

    cut: bool
    start: int
    head: Tokens
    tail: Tokens


IDENTITY = Fragment(False, 0, NONE, NONE)


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, tuple[int, Tokens] | None]:
    """The fragment of two neighbouring ranges and the group (start, tokens) that closes between them, if any."""
    if not y.cut:
        return (x._replace(tail=x.tail.joined(y.head)) if x.cut else x._replace(head=x.head.joined(y.head))), None
    if not x.cut:
        return Fragment(True, y.start, x.head.joined(y.head), y.tail), None
    group = x.tail.joined(y.head)
    return Fragment(True, y.start, x.head, y.tail), (x.start, group) if len(group.a) else None


def fragment(tokens: Tokens, opens: bool) -> tuple[Fragment, tuple[int, Tokens] | None]:
    """The fragment of a range's tokens and its closed groups as one run; ``opens``: the text begins here, at a common end."""
    common = tokens.a_ends[common_ends(tokens)[0]]
    if opens:
        common = np.concatenate(([0], common))
    if not len(common):
        return Fragment(False, 0, tokens, NONE), None
    first, last = int(common[0]), int(common[-1])
    closed = tokens.between(first, last)
    open_ends = Fragment(True, last, tokens.between(-1, first), tokens.between(last, np.iinfo(np.int64).max))
    return open_ends, (first, closed) if len(closed.a) else None


def common_ends(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of each end where one of the other ends."""
    masks = []
    for own, other in ((tokens.a_ends, tokens.b_ends), (tokens.b_ends, tokens.a_ends)):
        at = np.searchsorted(other, own)
        at[at == len(other)] = 0
        masks.append(other[at] == own if len(other) else np.zeros(len(own), bool))
    return masks[0], masks[1]


def links(tokens: Tokens, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and the B token of every pair whose byte ranges overlap; the tokens are those of whole groups from ``start`` on."""
    begins = np.concatenate(([start], tokens.a_ends[:-1]))
    first = np.searchsorted(tokens.b_ends, begins, "right")
    width = np.searchsorted(tokens.b_ends, tokens.a_ends) - first + 1
    ends = np.cumsum(width)
    return np.repeat(np.arange(len(width)), width), np.arange(int(ends[-1])) + np.repeat(first - ends + width, width)


class Codecs:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, byte_json: bytes, piece_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_json.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        # printable bytes stand for themselves, the others for the characters from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        n_a, n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        if max(n_a, n_b) > 1 << ID_BITS:
            raise ValueError(f"ids must be below {1 << ID_BITS}")
        entries = [self.a.id_to_token(i) or "" for i in range(n_a)]
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        self.bytes_a = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.n_a, self.n_b = n_a, n_b
        self._forget()
        marks = [*(f"{i}," for i in range(n_a)), *(f"{i}|" for i in range(n_a)), *(f"{i}," for i in range(n_b)), *(f"{i};" for i in range(n_b))]
        self.marks = np.array(marks, object)

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.same = np.zeros(0, bool)
        self.ids, self.bounds = [np.zeros(0, np.int32)] * 2, [np.zeros(1, np.int64)] * 2

    def _learn(self, units: list[str]) -> None:
        """Encode units that are not known yet, many in one run with blanks between them; those with an odd end one by one."""
        odd = [u for u in units if not u or _ODD_END.match(u[0]) or _ODD_END.match(u[-1])]
        rest = list(set(units).difference(odd)) if odd else units
        runs = [rest[k : k + RUN_UNITS] for k in range(0, len(rest), RUN_UNITS)] + [[u] for u in odd]
        joined = [" ".join(run) for run in runs]
        found_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in joined], add_special_tokens=False)]
        for run, *sides in zip(runs, found_a, self.b.encode(joined, num_threads=1)):
            data = [b" " + u.encode() for u in run]
            ends = np.cumsum([len(x) for x in data])
            same = all(b"".join([t[i] for i in ids]) == b"".join(data) for t, ids in zip((self.bytes_a, self.bytes_b), sides))
            if not same and len(run) > 1:
                for unit in run:
                    self._learn([unit])
                continue
            self.number.update(zip(run, range(len(self.same), len(self.same) + len(run))))
            self.same = np.concatenate((self.same, np.full(len(run), same)))
            for side, (ids, table) in enumerate(zip(sides, (self.sizes_a, self.sizes_b))):
                ids = np.array(ids, np.int32)
                cuts = np.searchsorted(np.cumsum(table[ids]), ends, "right") if same else [len(ids)]
                self.bounds[side] = np.concatenate((self.bounds[side], self.bounds[side][-1] + cuts))
                self.ids[side] = np.concatenate((self.ids[side], ids))

    def encode(self, texts: list[str]) -> list[list[np.ndarray] | None]:
        """Ids of both for a blank and each text; None where their bytes are not these.

        A text is cut at blanks between two other characters: no token reaches over one to its left, so units are encoded once and looked up later.
        """
        if len(self.ids[0]) > KNOWN_IDS:
            self._forget()
        listed = [_BLANK.split(t) for t in texts]
        units = list(chain.from_iterable(listed))
        new = list(set(units) - self.number.keys())
        if new:
            self._learn(new)
        at = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        edges = np.concatenate(([0], np.cumsum([len(x) for x in listed])))
        good = np.logical_and.reduceat(self.same[at], edges[:-1])
        sides = []
        for ids, bounds in zip(self.ids, self.bounds):
            width = bounds[at + 1] - bounds[at]
            ends = np.concatenate(([0], np.cumsum(width)))
            line = ids[np.arange(ends[-1]) + np.repeat(bounds[at] - ends[:-1], width)].astype(np.int64)
            sides.append(np.split(line, ends[edges[1:-1]]))
        return [pair if ok else None for ok, *pair in zip(good.tolist(), *sides)]

    def placed(self, a: np.ndarray, b: np.ndarray, start: int) -> Tokens:
        return Tokens(a, start + np.cumsum(self.sizes_a[a]), b, start + np.cumsum(self.sizes_b[b]))

    def written(self, tokens: Tokens) -> np.ndarray:
        """Every token of whole groups with the sign behind it, in the order in which groups are written."""
        cut_a, cut_b = common_ends(tokens)
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        codes = np.empty(len(tokens.a) + len(tokens.b), np.int64)
        codes[np.arange(len(tokens.a)) + np.concatenate(([0], np.flatnonzero(cut_b) + 1))[group_a]] = tokens.a + cut_a * self.n_a
        codes[np.arange(len(tokens.b)) + (np.flatnonzero(cut_a) + 1)[group_b]] = 2 * self.n_a + tokens.b + cut_b * self.n_b
        return self.marks[codes]

    def segment(self, start: int, tokens: Tokens) -> dict:
        """A run of whole groups of one text: what is written for it and the pairs that it links."""
        at_a, at_b = links(tokens, start)
        pairs, times = np.unique(tokens.a[at_a] << ID_BITS | tokens.b[at_b], return_counts=True)
        return {
            "position": start,
            "groups": "".join(self.written(tokens))[:-1],
            "n_groups": int(common_ends(tokens)[0].sum()),
            "n_links": len(at_a),
            "pairs": pairs,
            "times": times,
        }


def _stands_alone(data: bytes, at: int) -> bool:
    """Whether the blank at ``at`` stands between two letters or digits: no token of either tokenizer reaches over its left side."""
    before, after = data[max(0, at - 4) : at].decode("utf-8", "ignore"), data[at + 1 : at + 5].decode("utf-8", "ignore")
    return before[-1:].isalnum() and after[:1].isalnum()


def ranges(text: bytes, chunk: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(start of the words, low, high, words) for the byte ranges of a blank and the text.

    A range owns the tokens that end in (low, high]. Its words reach from a blank that stands alone to the next one, so that encoding
    them gives the tokens that the whole text has there. A long stretch without such blanks is one range.
    """
    data = b" " + text
    high = 0
    while high < len(data):
        low, high = high, min(high + chunk, len(data))
        start = data.rfind(b" ", 0, low + 1) if low else 0
        while start > 0 and not _stands_alone(data, start):
            start = data.rfind(b" ", 0, start)
        end = data.find(b" ", high) if high < len(data) else -1
        while end >= 0 and not _stands_alone(data, end):
            end = data.find(b" ", end + 1)
        start, end = max(start, 0), end if end >= 0 else len(data)
        if end - start > 3 * chunk:
            high = end
        yield start, low, high, data[start + 1 : end]


def loader(held: Broadcast) -> Callable[[], Codecs]:
    """The tokenizers, loaded once by each task that asks for them."""
    kept: list[Codecs] = []

    def codecs() -> Codecs:
        if not kept:
            kept.append(Codecs(*held.value))
        return kept[0]

    return codecs


def short_rows(docs: DataFrame, held: Broadcast) -> DataFrame:
    """One row per text of one byte range: its numbers, the digest of its groups, its pairs of ids and how often each is linked."""
    kind, codecs = docs.schema["id"].dataType.simpleString(), loader(held)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy().astype(np.int64)
            steps = np.cumsum(sizes) // PASS_BYTES
            edges = np.flatnonzero(np.diff(steps)) + 1
            for lo, hi in zip((0, *edges), (*edges, batch.num_rows)):
                yield rows(batch.slice(lo, hi - lo), codecs())

    def rows(part: pa.RecordBatch, codecs: Codecs) -> pa.RecordBatch:
        texts = [t or "" for t in part.column(2).to_pylist()]
        found = codecs.encode(texts)
        good = [k for k, (t, ids) in enumerate(zip(texts, found)) if t and ids is not None]
        n = np.zeros((5, part.num_rows), np.int64)
        digests, pairs, times, bounds = [""] * part.num_rows, NONE.a, NONE.a, np.zeros(part.num_rows + 1, np.int64)
        if good:
            sides = [[found[k][side] for k in good] for side in (0, 1)]
            tokens = codecs.placed(*(np.concatenate(s) for s in sides), 0)
            first, second = (np.concatenate(([0], np.cumsum([len(x) for x in s]))) for s in sides)
            n[0, good], n[1, good] = np.diff(first), np.diff(second)
            cut = np.concatenate(([0], np.cumsum(common_ends(tokens)[0])))
            n[2, good] = np.diff(cut[first])
            written, edges = codecs.written(tokens), first + second
            for k, a, b in zip(good, edges[:-1], edges[1:]):
                digests[k] = hashlib.sha256("".join(written[a:b])[:-1].encode()).hexdigest()
            at_a, at_b = links(tokens, 0)
            owner = np.repeat(np.array(good), np.diff(first))[at_a]
            n[3] = np.bincount(owner, minlength=part.num_rows)
            keys, times = np.unique(owner << 2 * ID_BITS | tokens.a[at_a] << ID_BITS | tokens.b[at_b], return_counts=True)
            pairs, bounds = keys & (1 << 2 * ID_BITS) - 1, np.searchsorted(keys >> 2 * ID_BITS, np.arange(part.num_rows + 1))
        offsets = pa.array(bounds.astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (pairs, times)]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), *(pa.array(x) for x in n[:4]), pa.array(digests, pa.string()), *lists],
            names=["key", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
        )

    return docs.mapInArrow(task, f"key bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>")


def long_chunks(docs: DataFrame, chunk: int) -> DataFrame:
    """The byte ranges of texts, written once: keys that a task would give anew after a failure stay as they are."""
    kind = docs.schema["id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows: list[tuple] = []
                for k, found in enumerate(ranges(batch.column(2)[at].as_py().encode(), chunk)):
                    rows.append((k, *found))
                    if sum(len(r[-1]) for r in rows) > PASS_BYTES:
                        yield out(batch, at, rows)
                        rows = []
                if rows:
                    yield out(batch, at, rows)

    def out(batch: pa.RecordBatch, at: int, rows: list[tuple]) -> pa.RecordBatch:
        same = pa.array([at] * len(rows), pa.int64())
        arrays = [batch.column(0).take(same), batch.column(1).take(same), *(pa.array(c) for c in zip(*rows))]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "id", "chunk", "start", "low", "high", "words"])

    return cut_lineage(docs.mapInArrow(task, f"key bigint, id {kind}, chunk bigint, start bigint, low bigint, high bigint, words binary"), "chunks")


def _open_row(key: int, chunk: int, open_ends: Fragment) -> dict:
    lists = dict(zip(_LISTS, (*open_ends.head, *open_ends.tail)))
    return {"key": key, "chunk": chunk, "cut": open_ends.cut, "start": open_ends.start, **lists}


def _open_ends(row: dict) -> Fragment:
    lists = [np.array(row[name], np.int64) for name in _LISTS]
    return Fragment(row["cut"], row["start"], Tokens(*lists[:4]), Tokens(*lists[4:]))


def encoded_chunks(chunks: DataFrame, held: Broadcast) -> DataFrame:
    """For every byte range the row of its open ends and, if any, the row of its closed groups (``cut`` is null there)."""

    codecs = loader(held)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, chunk, start, low, high, words = (c[row].as_py() for c in batch.columns)
                ids = codecs().encode([words.decode()])[0]
                if ids is None:
                    yield pa.RecordBatch.from_pylist([_open_row(key, chunk, IDENTITY) | {"valid": False}], _PIECE)
                    continue
                tokens = codecs().placed(*ids, start).between(low, high)
                open_ends, closed = fragment(tokens, chunk == 0)
                rows = [_open_row(key, chunk, open_ends) | {"valid": True, "n_a": len(tokens.a), "n_b": len(tokens.b)}]
                if closed:
                    rows.append({"key": key} | codecs().segment(*closed))
                yield pa.RecordBatch.from_pylist(rows, _PIECE)

    dealt = chunks.select("key", "chunk", "start", "low", "high", "words").repartition("key", "chunk")
    return cut_lineage(dealt.mapInArrow(task, _PIECE_SQL), "fragments")


def composed(fragments: DataFrame, held: Broadcast, fan: int) -> DataFrame:
    """One level of the tree: neighbouring fragments become one, and the groups that close between them become rows of their own."""

    codecs = loader(held)

    def task(group: pa.Table) -> pa.Table:
        out, whole = [], IDENTITY
        listed = sorted(group.to_pylist(), key=lambda row: row["chunk"])
        for row in listed:
            whole, closed = compose(whole, _open_ends(row))
            if closed:
                out.append({"key": row["key"]} | codecs().segment(*closed))
        out.append(_open_row(listed[0]["key"], listed[0]["chunk"] // fan, whole))
        return pa.Table.from_pylist(out, _PIECE)

    node = F.floor(F.col("chunk") / fan)
    return cut_lineage(fragments.withColumn("node", node).groupBy("key", "node").applyInArrow(task, _PIECE_SQL), "level")


def segment_digests(segments: DataFrame) -> DataFrame:
    """(key, digest of all groups) from runs of groups in the order of their places; a task holds one batch of runs and a hash."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest = None, None
        for batch in batches:
            for key, groups in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest is not None and key != own:
                    yield pa.RecordBatch.from_pydict({"key": [own], "groups_sha256": [digest.hexdigest()]})
                    digest = None
                if digest is None:
                    own, digest = key, hashlib.sha256()
                else:
                    digest.update(b";")
                digest.update(groups.as_py().encode())
        if digest is not None:
            yield pa.RecordBatch.from_pydict({"key": [own], "groups_sha256": [digest.hexdigest()]})

    ordered = segments.repartition("key").sortWithinPartitions("key", "position").select("key", "groups")
    return ordered.mapInArrow(task, "key bigint, groups_sha256 string")


def segments_of(chunks: DataFrame, held: Broadcast, fan: int) -> tuple[DataFrame, DataFrame] | None:
    """Of texts in byte ranges: the fragment rows of the first level, and all runs of groups of texts that come back from both tokenizers."""
    last = chunks.agg(F.max("chunk")).first()[0]
    if last is None:
        return None
    rows = encoded_chunks(chunks, held)
    spoilt = rows.filter("not valid").select("key").distinct()
    kept = rows.join(spoilt, "key", "left_anti")
    segments, level = kept.filter("cut is null"), kept.filter("cut is not null")
    while last > 0:
        done = composed(level, held, fan)
        segments, level, last = segments.unionByName(done.filter("cut is null")), done.filter("cut is not null"), last // fan
    return rows.filter("cut is not null"), segments


def weighed(rows: DataFrame, counts: DataFrame, n_pairs: int, broadcast_pairs: int) -> DataFrame:
    """(key, n_best, count_sum) from rows (key, pairs, times): sums over all links of a document."""
    if n_pairs > broadcast_pairs:
        each = rows.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
        each = each.select("key", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
        met = salted_join(each, counts, "pair")
        sums = met.select("key", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("docs")).alias("count_sum"))
        return sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    table = counts.orderBy("pair").toArrow()
    held = rows.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "docs", "best")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = held.value
        for batch in batches:
            bounds, pairs, times = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy(), batch.column(2).values.to_numpy()
            at = np.searchsorted(known, pairs[bounds[0] : bounds[-1]])
            times = times[bounds[0] : bounds[-1]]
            sums = (np.concatenate(([0], np.cumsum(x)))[bounds - bounds[0]] for x in (times * best[at], times * docs[at]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.diff(s).astype(np.int64)) for s in sums)], names=["key", "n_best", "count_sum"])

    # a document's pairs come in one row, or in a few that each hold whole pairs
    return rows.select("key", "pairs", "times").mapInArrow(task, "key bigint, n_best bigint, count_sum bigint")


def align(
    docs: DataFrame,
    byte_bpe: str,
    piece_bpe: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    fan: int = FAN,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per input row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    A is the byte-level tokenizer in the file ``byte_bpe`` (tokenizers), B the one in ``piece_bpe`` (sentencepiece); the driver reads both files and sends them
    along. A blank and the text are encoded without special tokens. Byte ends common to A and B cut both into groups, written
    ``a1,a2|b1;a3|b2,b3``. A and B tokens that overlap are linked; the count of a pair of ids is the number of rows that link it, and
    ``n_best`` counts links whose pair has the highest count of its A id (ties included).

    A null or empty text, and one whose tokens do not give back its bytes, has no tokens: zeros and an empty digest. Rows are kept one for one: repeated
    rows count each, a null id stays null, an empty table gives no row; other columns are not read. A text longer than ``chunk`` bytes is
    cut into byte ranges that tasks encode apart, at three times its bytes on the task that cuts it; a stretch without any blank between letters or
    digits is encoded as a whole.
    """
    if chunk < 1 or fan < 2:
        raise ValueError("a byte range has one byte or more, and a group composes two fragments or more")
    with open(byte_bpe, "rb") as a, open(piece_bpe, "rb") as b:
        held = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    texts = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= chunk, F.lit(False))
    short = cut_lineage(short_rows(texts.filter(~is_long), held), "aligned")
    # keys below zero, as the rows of two scans are not numbered alike
    chunks = long_chunks(texts.filter(is_long).withColumn("key", -1 - F.col("key")), chunk)
    found = segments_of(chunks, held, fan)
    listed = short.select("key", "pairs", "times")
    if found:
        firsts, segments = found
        each = segments.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("key", "link.pairs", "link.times")
        each = each.groupBy("key", F.col("pairs").alias("pair")).agg(F.sum("times").alias("times"))
        part = F.pmod(F.xxhash64("pair"), F.lit(64)).alias("part")
        packed = each.groupBy("key", part).agg(F.collect_list(F.struct("pair", "times")).alias("links"))
        long_listed = cut_lineage(packed.select("key", F.col("links.pair").alias("pairs"), F.col("links.times").alias("times")), "long-pairs")
        listed = listed.unionByName(long_listed)

    held_by = listed.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    held_by = cut_lineage(held_by, "pairs")
    most = held_by.groupBy(F.shiftright("pair", ID_BITS).alias("a")).agg(F.max("docs").alias("most"))
    counts = held_by.join(most, F.shiftright("pair", ID_BITS) == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    sums = weighed(listed, counts, held_by.count(), broadcast_pairs).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))

    columns = ["key", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = short.select(*columns)
    if found:
        totals = firsts.groupBy("key").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.min("valid").alias("whole"))
        within = segments.groupBy("key").agg(F.sum("n_groups").alias("n_groups"), F.sum("n_links").alias("n_links"))
        numbers = totals.join(within, "key", "left").join(segment_digests(segments), "key", "left")
        ids = chunks.filter("chunk = 0").select("key", "id").join(numbers, "key")
        n = [F.when(F.col("whole"), F.col(c)).otherwise(0).alias(c) for c in columns[2:6]]
        rows = rows.unionByName(ids.select("key", "id", *n, F.when(F.col("whole"), F.col("groups_sha256")).otherwise("").alias("groups_sha256")))
    out = rows.join(sums, "key", "left").fillna(0, ["n_best", "count_sum"])
    return out.select(F.col("id").alias(id_col), *columns[2:6], "n_best", "count_sum", "groups_sha256")
