"""Language identification: multinomial naive Bayes over hashed character bigrams and trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import group_ids, mix, passes

BUCKETS = 1 << 15
#: The model is fitted on about this many documents of each language, chosen by the hash of their id.
DOCS_PER_LANGUAGE = 20_000
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Bytes of text whose n-grams are held at once (over a hundred bytes each), of long texts piece by piece, and rows that go out together.
PASS_BYTES, ROWS = 1 << 17, 1000

#: Code points below 0xC0 that are letters; from there on only the blocks below are not.
_LOW_LETTERS = np.zeros(0xC0, bool)
_LOW_LETTERS[[*range(65, 91), *range(97, 123), 0xAA, 0xB5, 0xBA]] = True


def code_points(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and the bounds of the texts in them."""
    lead = (data & 0xC0) != 0x80
    lead[bounds[:-1][bounds[:-1] < len(data)]] = True
    at = np.flatnonzero(lead)
    codes = data[at].astype(np.uint32)
    wide = np.flatnonzero(codes >= 0xC0)
    if len(wide):
        padded = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint32)
        p, first = at[wide], codes[wide]
        a, b, c = (padded[p + k] & 0x3F for k in (1, 2, 3))
        codes[wide] = np.select(
            [first < 0xE0, first < 0xF0],
            [(first & 0x1F) << 6 | a, (first & 0x0F) << 12 | a << 6 | b],
            (first & 0x07) << 18 | a << 12 | b << 6 | c,
        )
    return codes, np.searchsorted(at, bounds)


def letters(codes: np.ndarray) -> np.ndarray:
    """Which code points count as letters in an n-gram; marks and symbols of the large blocks for them do not."""
    high = codes >= 0xC0
    out = np.zeros(len(codes), bool)
    out[~high] = _LOW_LETTERS[codes[~high]]
    x = codes[high]
    out[high] = (x != 0xD7) & (x != 0xF7) & ~((x >= 0x2000) & (x < 0x2C00)) & ~((x >= 0x3000) & (x < 0x3040)) & (x < 0x1F000)
    return out


def hashed_pairs(line: np.ndarray) -> np.ndarray:
    return mix(line[:-1] << np.uint64(21) | line[1:]) % np.uint64(BUCKETS)


def hashed_triples(line: np.ndarray) -> np.ndarray:
    return mix(line[:-2] << np.uint64(42) | line[1:-1] << np.uint64(21) | line[2:] | np.uint64(1 << 63)) % np.uint64(BUCKETS)


def long_ngrams(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """The buckets of one text, by pieces of about ``limit`` bytes; what a piece needs of the one before is carried over."""
    blank = (np.zeros(1, np.uint64), np.zeros(1, bool))
    # code points not yet decided on, whether a letter stood before them, and the last two that were kept
    (open_line, open_solid), before = blank, False
    line, solid = np.zeros(0, np.uint64), np.zeros(0, bool)
    lo = 0
    while lo < len(data):
        hi = min(lo + limit, len(data))
        while hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi += 1
        codes, _ = code_points(data[lo:hi], np.array([0, hi - lo]))
        letter = letters(codes)
        new = [(open_line, open_solid), (np.where(letter, codes, 0).astype(np.uint64), letter)] + ([blank] if hi == len(data) else [])
        raw, sure = (np.concatenate(part) for part in zip(*new, strict=True))
        # the last one waits for what stands behind it
        done = len(raw) if hi == len(data) else len(raw) - 1
        led = np.concatenate(([before], sure[:-1]))
        follows = np.concatenate((sure[1:], [False]))
        kept = np.flatnonzero((sure | led | follows)[:done])
        before = bool(sure[done - 1]) if done else before
        open_line, open_solid = raw[done:], sure[done:]
        carried = len(line)
        line, solid = np.concatenate((line, raw[kept])), np.concatenate((solid, sure[kept]))
        two = hashed_pairs(line)[max(carried - 1, 0) :][(solid[:-1] | solid[1:])[max(carried - 1, 0) :]]
        three = np.zeros(0, np.uint64)
        if len(line) > 2:
            three = hashed_triples(line)[max(carried - 2, 0) :][(solid[:-2] | solid[1:-1] | solid[2:])[max(carried - 2, 0) :]]
        yield np.concatenate((two, three)).astype(np.int64)
        line, solid = line[-2:], solid[-2:]
        lo = hi


def ngrams(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, buckets, bounds of the texts in them), by passes over the lower-cased texts.

    What is no letter parts words; a word is seen between two blanks, and every n-gram holds a letter. The bucket lists with
    their bounds are the sparse count matrix of the pass. A text longer than a pass comes in several, one for each piece.
    """
    for lo, hi, data, bounds in passes(pc.utf8_lower(texts.cast(pa.large_string())), PASS_BYTES):
        if len(data) > PASS_BYTES and hi == lo + 1:
            yield from ((lo, hi, grams, np.array([0, len(grams)])) for grams in long_ngrams(data, PASS_BYTES))
            continue
        codes, cuts = code_points(data, bounds)
        docs = group_ids(cuts)
        letter = letters(codes)
        # each text stands between two blanks
        place = np.arange(len(codes)) + 2 * docs + 1
        total = len(codes) + 2 * (hi - lo)
        line, solid, owner = np.zeros(total, np.uint64), np.zeros(total, bool), np.zeros(total, np.int64)
        line[place], solid[place] = np.where(letter, codes, 0), letter
        owner = group_ids(cuts + 2 * np.arange(hi - lo + 1))
        keep = solid.copy()
        keep[1:] |= solid[:-1]
        keep[:-1] |= solid[1:] & ~solid[:-1] & ~np.concatenate(([False], solid[:-2]))
        line, solid, owner = line[keep], solid[keep], owner[keep]
        if len(line) < 2:
            yield lo, hi, np.zeros(0, np.int64), np.zeros(hi - lo + 1, np.int64)
            continue
        same = owner[1:] == owner[:-1]
        two, three = hashed_pairs(line), hashed_triples(line)
        ok_two = same & (solid[:-1] | solid[1:])
        ok_three = same[:-1] & same[1:] & (solid[:-2] | solid[1:-1] | solid[2:])
        grams = np.concatenate((two[ok_two], three[ok_three])).astype(np.int64)
        owners = np.concatenate((owner[:-1][ok_two], owner[:-2][ok_three]))
        order = np.argsort(owners, kind="stable")
        yield lo, hi, grams[order], np.searchsorted(owners[order], np.arange(hi - lo + 1))


def learnable(id_col: str) -> Column:
    """Rows that a model may learn from; a null id is never one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) != 2, F.lit(False))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def posterior(priors: np.ndarray, matrix: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Most probable language of each text (by number, ties to the first) and its posterior probability."""
    sums = np.tile(priors, (len(texts), 1))
    for lo, _, grams, bounds in ngrams(texts):
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            sums[lo + full] += np.add.reduceat(matrix[grams], bounds[full], axis=0)
    sums -= sums.max(axis=1, keepdims=True)
    weights = np.exp(sums)
    return weights.argmax(axis=1), 1 / weights.sum(axis=1)


class LanguageModel:
    """Languages in code point order, their log priors and the matrix of log probabilities (buckets x languages).

    The matrix has BUCKETS rows and one column a language (a closed set of labels), so 256 KB a language; that is all that is broadcast.
    """

    def __init__(self, languages: list[str], priors: np.ndarray, matrix: np.ndarray) -> None:
        self.languages, self.priors, self.matrix = languages, priors, matrix

    @classmethod
    def fit(
        cls, docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", per_language: int = DOCS_PER_LANGUAGE
    ) -> LanguageModel:
        """Learn from all rows given that have a text and a label: priors from all, n-grams from about ``per_language`` rows of each label.

        Without such a row the model knows no language.
        """
        rows = docs.select(F.col(text_col).alias("text"), F.col(label_col).alias("label"), F.col(id_col).cast("string").alias("id"))
        rows = rows.filter("text is not null and label is not null")
        counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
        languages = sorted(counts)
        if not languages:
            return cls([], np.zeros(0), np.zeros((BUCKETS, 0)))
        # the share that each language keeps, as a threshold on the hash of the id
        share = F.create_map(*[F.lit(x) for label in languages for x in (label, min(1.0, per_language / counts[label]))])
        spot = F.pmod(F.xxhash64(F.lit("languages"), "id"), F.lit(1_000_003)) / 1_000_003
        chosen = rows.filter(spot < share[F.col("label")]).select("label", "text")

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[str, np.ndarray] = {}
            for batch in batches:
                labels = np.array(batch.column(0).to_pylist(), object)
                for lo, hi, grams, bounds in ngrams(batch.column(1)):
                    owner = labels[lo:hi][group_ids(bounds)]
                    for label in set(labels[lo:hi]):
                        sums[label] = sums.get(label, 0) + np.bincount(grams[owner == label], minlength=BUCKETS)
            for label, row in sums.items():
                at = np.flatnonzero(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at].astype(np.int64))],
                    names=["label", "bucket", "n"],
                )

        found = chosen.mapInArrow(task, "label string, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
        matrix = np.full((BUCKETS, len(languages)), SMOOTHING)
        column = {label: k for k, label in enumerate(languages)}
        columns = np.array([column[x] for x in found.column("label").to_pylist()], np.int64)
        np.add.at(matrix, (found.column("bucket").to_numpy(), columns), found.column("n").to_numpy())
        n = np.array([counts[x] for x in languages], float)
        return cls(languages, np.log(n / n.sum()), np.log(matrix / matrix.sum(axis=0)))

    def predict(self, docs: DataFrame, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
        """``docs`` with ``pred_col`` and ``score_col`` (0 to 1) in place of columns of these names.

        A null text, a text without a letter and every text of a model without languages is ``und`` with score 0. Rows are kept one for one.
        A very long text costs its own bytes and a lower-cased copy; its n-grams are counted piece by piece.
        """
        docs = docs.drop(pred_col, score_col)
        names, model = docs.columns, docs.sparkSession.sparkContext.broadcast((self.languages, self.priors, self.matrix))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            languages, priors, matrix = model.value
            for batch in batches:
                for lo in range(0, batch.num_rows, ROWS):
                    yield told(batch.slice(lo, ROWS), languages, priors, matrix)

        def told(part: pa.RecordBatch, languages: list[str], priors: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
            texts = part.column(names.index(text_col))
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)
            if languages:
                best, sure = posterior(priors, matrix, texts)
                called = pc.if_else(lettered, pa.array(languages, pa.string()).take(pa.array(best)), UNDETERMINED)
                sure = pc.if_else(lettered, pa.array(sure), 0.0)
            else:
                called, sure = pa.array([UNDETERMINED] * part.num_rows, pa.string()), pa.array(np.zeros(part.num_rows))
            return pa.RecordBatch.from_arrays([*part.columns, called, sure], names=[*names, pred_col, score_col])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return docs.mapInArrow(task, f"{fields}, `{pred_col}` string, `{score_col}` double")
