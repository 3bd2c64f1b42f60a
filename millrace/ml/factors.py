"""Factor models in blocks: ratings are dealt out once, and a factor goes once to every block that asks for it instead of once to every rating."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Ratings of a block (16 bytes each in the task that sorts them; 12 where they train a model), of a chunk that is solved or scored at once, of a packed row, and the
#: fewest blocks: each gets a copy of nearly every factor in every round. A block is sorted in parts, one after the other.
RATINGS_PER_BLOCK, FITTED_PER_BLOCK, RATINGS_PER_CHUNK, PACKED_ROWS, LEAST_BLOCKS, PARTS = 30_000_000, 40_000_000, 500_000, 500, 6, 8


def blocks_of(known: DataFrame, per_block: int = RATINGS_PER_BLOCK) -> int:
    return max(LEAST_BLOCKS, -(-known.count() // per_block))


def _dealt(df: DataFrame, blocks: int, width: int = 0) -> RDD:
    """(block, (part, columns)): the rows by first column mod ``blocks`` in packed columns; with ``width`` the second one holds lists of that length.

    The rows of one id lie in one part of a block. The partition after the last block is left for results.
    """

    def packed(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        columns = [c.combine_chunks() for c in rows.columns]
        columns = [c.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False) for c in columns]
        place = columns[0] % (blocks * PARTS)
        order = np.argsort(place, kind="stable")
        columns, place = [c[order] for c in columns], place[order]
        cuts = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part, block = divmod(int(place[lo]), blocks)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "part": pa.array([part], pa.int32()), "columns": pa.array([[c[lo:hi].tobytes() for c in columns]], pa.list_(pa.binary()))})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting, n = [*waiting, batch], n + batch.num_rows
            if n >= RATINGS_PER_CHUNK:
                yield from packed(waiting)
                waiting, n = [], 0
        if n:
            yield from packed(waiting)

    return df.mapInArrow(task, "block int, part int, columns array<binary>").rdd.map(lambda r: (r["block"], (r["part"], r["columns"]))).partitionBy(blocks + 1, int)


def _side(known: DataFrame, key: str, other: str, blocks: int, rating: str = "double") -> RDD:
    """Per block of ``key``: first its ids and the ids it wants of the other side, then its ratings in chunks: part by part, sorted by id."""
    kind = {"double": "f8", "float": "f4"}[rating]

    def task(records):
        parts: dict[int, list] = {}
        for b, (part, columns) in records:
            block = b
            parts.setdefault(part, []).append(columns)
        if not parts:
            return
        column = lambda part, i, t: np.frombuffer(b"".join(columns[i] for columns in parts[part]), t)
        ids, wanted = [], np.empty(0, "i4")
        for part in sorted(parts):
            ids.append(np.unique(column(part, 0, "i4")))
            wanted = np.union1d(wanted, column(part, 1, "i4"))
        yield block, ("side", np.concatenate(ids), wanted)
        for part in sorted(parts):
            own, met, given = (column(part, i, t) for i, t in enumerate(("i4", "i4", kind)))
            del parts[part]
            order = np.argsort(own, kind="stable")
            own, met, given = own[order], met[order], given[order]
            for at in range(0, len(own), RATINGS_PER_CHUNK):
                piece = slice(at, at + RATINGS_PER_CHUNK)
                starts = np.flatnonzero(np.diff(own[piece], prepend=-1))
                yield block, ("chunk", own[piece][starts], starts, np.searchsorted(wanted, met[piece]).astype("i4"), given[piece])

    columns = known.select(F.col(key).cast("int"), F.col(other).cast("int"), F.col("rating").cast(rating))
    return _dealt(columns, blocks).mapPartitions(task, preservesPartitioning=True)


def _asked(side: RDD, blocks: int) -> RDD:
    """To every block of the other side the ids that each block of this one wants."""

    def task(records):
        for block, (tag, *columns) in records:
            if tag == "side":
                for b in range(blocks):
                    yield b, ("ask", block, columns[1][columns[1] % blocks == b])

    return side.mapPartitions(task).partitionBy(blocks + 1, int)


def _factors(factors: DataFrame, rank: int, blocks: int) -> RDD:
    def task(records):
        parts = [(np.frombuffer(ids, "i4"), np.frombuffer(values, "f4").reshape(-1, rank)) for _, (_, (ids, values)) in records]
        if parts:
            ids, values = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(ids)
            yield int(ids[0] % blocks), ("own", ids[order], values[order])

    return _dealt(factors.select("id", "features"), blocks, rank).mapPartitions(task, preservesPartitioning=True)


def _found(ids: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The rows of ``values`` for the wanted ids, NaN where there is none; ``ids`` are sorted."""
    if not len(ids):
        return np.full((len(wanted), values.shape[1]), np.nan, "f4")
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return np.where((ids[at] == wanted)[:, None], values[at], np.float32(np.nan))


def _answers(block: int, ids: np.ndarray, values: np.ndarray, asked: list):
    for b, wanted in asked:
        yield b, ("factors", block, _found(ids, values, wanted))


def _sent(factors: RDD, asked: RDD, blocks: int) -> RDD:
    """Given factors, sent to the blocks that ask for them."""

    def task(records):
        waiting = []
        for block, (tag, *columns) in records:
            if tag == "ask":
                waiting.append(columns)
            elif tag == "own":
                yield from _answers(block, *columns, waiting)

    return asked.union(factors).mapPartitions(task).partitionBy(blocks + 1, int)


def _table(wanted: np.ndarray, got: list, rank: int, blocks: int) -> np.ndarray:
    """The factors of the wanted ids, in their order; every block sends its own ones sorted by id."""
    table = np.empty((len(wanted), rank), "f4")
    table[~np.isin(wanted % blocks, [block for block, _ in got])] = np.nan
    while got:
        block, values = got.pop()
        table[wanted % blocks == block] = values
    return table


def _solved(received: RDD, asked: RDD, side: RDD, rank: int, reg: float, blocks: int, keep: bool = False) -> RDD:
    """The factors of one side from those of the other, sent on to the blocks that ask for them; the squared errors go to the last partition.

    With ``keep`` the factors stay in their blocks instead.

    An id's ratings may lie in several chunks: its sums are carried on until the next id begins.
    """
    a, b = np.triu_indices(rank)

    def answer(sums):
        n, square, right = sums[:, -1], sums[:, -2], sums[:, len(a) : len(a) + rank]
        left = np.empty((len(sums), rank, rank))
        left[:, a, b] = left[:, b, a] = sums[:, : len(a)]
        found = np.linalg.solve(left + reg * n[:, None, None] * np.eye(rank), right[:, :, None])[:, :, 0].astype("f4")
        exact = found.astype("f8")
        error = square.sum() - 2 * (exact * right).sum() + np.einsum("ni,nij,nj->", exact, left, exact, optimize=True)
        return found, error

    def task(records):
        got, waiting, found, error, n, carried, table = [], [], [], 0.0, 0, None, None
        for block, (tag, *columns) in records:
            if tag == "factors":
                got.append(columns)
            elif tag == "ask":
                waiting.append(columns)
            elif tag == "side":
                ids, table = columns[0], _table(columns[1], got, rank, blocks)
            elif tag == "chunk":
                own, starts, index, rating = columns
                rating = rating.astype("f8", copy=False)
                x = np.ascontiguousarray(table[index].T, "f8")
                parts = [np.add.reduceat(x[i] * x[j], starts) for i, j in zip(a, b)]
                parts += [np.add.reduceat(x[i] * rating, starts) for i in range(rank)]
                sums = np.stack([*parts, np.add.reduceat(rating * rating, starts), np.diff(starts, append=len(index))], axis=1)
                if carried is not None and carried[0] == own[0]:
                    sums[0] += carried[1]
                elif carried is not None:
                    sums = np.concatenate([carried[1][None], sums])
                carried, sums, n = (own[-1], sums[-1]), sums[:-1], n + len(index)
                if len(sums):
                    values, more = answer(sums)
                    found, error = [*found, values], error + more
        if carried is not None:
            values, more = answer(carried[1][None])
            order, table = np.argsort(ids), None
            ids, values = ids[order], np.concatenate([*found, values])[order]
            if keep:
                yield ids, values
                return
            yield from _answers(block, ids, values, waiting)
            yield blocks, ("error", error + more, n)

    solved = received.union(asked).union(side).mapPartitions(task)
    return solved if keep else solved.partitionBy(blocks + 1, int)


class _Training:
    """Ratings ``known`` (user, item, rating) in blocks of either side, and the factors as they are sent: at first those of the users from which ``ALS`` starts with this seed."""

    def __init__(self, known: DataFrame, rank: int, reg: float, seed: int, per_block: int, rating: str) -> None:
        blocks = blocks_of(known, per_block)
        # the start is drawn from the users' numbers, so one row of each does; a rating that is missing is refused as by the whole fit
        one = known.groupBy("user").agg(F.min("item").alias("item"), F.avg(F.coalesce("rating", F.lit(float("nan")))).alias("rating"))
        start = ALS(rank=rank, maxIter=0, regParam=reg, userCol="user", itemCol="item", ratingCol="rating", seed=seed).fit(one)
        self.users, self.items = (_side(known, *keys, blocks, rating).persist(StorageLevel.DISK_ONLY) for keys in (("user", "item"), ("item", "user")))
        self.of_users, self.of_items = (_asked(side, blocks).persist(StorageLevel.DISK_ONLY) for side in (self.items, self.users))
        self.rest, self.blocks = (rank, reg, blocks), blocks
        self.sent = _sent(_factors(start.userFactors, rank, blocks), self.of_users, blocks)

    def solve_items(self, keep: bool = False) -> RDD:
        return _solved(self.sent, self.of_items, self.items, *self.rest, keep)

    def solve_users(self, sent: RDD, keep: bool = False) -> RDD:
        return _solved(sent, self.of_users, self.users, *self.rest, keep)

    def unpersist(self) -> None:
        for kept in (self.users, self.items, self.of_users, self.of_items):
            kept.unpersist()


def errors_by_round(known: DataFrame, rounds: int, rank: int, reg: float, seed: int, per_block: int = RATINGS_PER_BLOCK) -> list[float]:
    """The root mean squared error on the ratings ``known`` (user, item, rating) after each round of alternating least squares.

    The start is that of ``ALS`` with this seed. A round solves the items from the users and then the users from the items; the error comes out of the same
    sums, so that every round is trained once and no rating is moved again.
    """
    training, errors = _Training(known, rank, reg, seed, per_block, "double"), []
    for _ in range(rounds):
        training.sent = training.solve_users(training.solve_items())
        found = [r for _, (tag, *r) in known.sparkSession.sparkContext.runJob(training.sent, list, [training.blocks]) if tag == "error"]
        errors.append(float(np.sqrt(max(0.0, sum(e for e, _ in found)) / sum(n for _, n in found))))
    training.unpersist()
    return errors


@dataclass(frozen=True)
class FactorModel:
    """What ``scored`` reads of a model: the factors of users and items as (id, features)."""

    rank: int
    userFactors: DataFrame  # noqa: N815
    itemFactors: DataFrame  # noqa: N815


def _unpacked(spark, factors: RDD, rank: int) -> DataFrame:
    def rows(records):
        for ids, values in records:
            for at in range(0, len(ids), PACKED_ROWS):
                yield ids[at : at + PACKED_ROWS].astype("i4").tobytes(), values[at : at + PACKED_ROWS].tobytes()

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = (np.frombuffer(b"".join(batch.column(i).to_pylist()), t) for i, t in enumerate(("i4", "f4")))
            features = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype="i4") * rank), pa.array(values))
            yield pa.RecordBatch.from_arrays([pa.array(ids), features], ["id", "features"])

    packed = spark.createDataFrame(factors.mapPartitions(rows), "ids binary, factors binary", verifySchema=False)
    return cut_lineage(packed.mapInArrow(unpacked, "id int, features array<float>"), "factors")


def fit(known: DataFrame, rounds: int, rank: int, reg: float, seed: int, per_block: int = FITTED_PER_BLOCK) -> FactorModel:
    """The model of ``ALS`` with these parameters, of ratings ``known`` (user, item, rating), trained in blocks of bounded size.

    The estimator holds a block's ratings several times over as it builds it, whatever their number; here a block is sorted part by part.
    """
    spark, training = known.sparkSession, _Training(known, rank, reg, seed, per_block, "float")
    for _ in range(rounds - 1):
        training.sent = training.solve_users(training.solve_items())
    users = _unpacked(spark, training.solve_users(training.solve_items(), keep=True), rank)
    items = _unpacked(spark, training.solve_items(keep=True), rank)
    training.unpersist()
    return FactorModel(rank, users, items)


def scored(known: DataFrame, model: ALSModel | FactorModel, per_block: int = RATINGS_PER_BLOCK) -> DataFrame:
    """(rating, prediction) of every row of ``known``, as ``model.transform`` finds them: NaN for a user or an item that the model does not know.

    There each rating carries its user's factors to its item; here a block of users gets each item's factors once.
    """
    blocks, rank = blocks_of(known, per_block), model.rank
    users = _side(known, "user", "item", blocks)
    sent = _sent(_factors(model.itemFactors, rank, blocks), _asked(users, blocks), blocks)

    def task(records):
        got, ids, factors = [], np.empty(0, "i4"), np.empty((0, rank), "f4")
        for _, (tag, *columns) in records:
            if tag == "factors":
                got.append(columns)
            elif tag == "own":
                ids, factors = columns
            elif tag == "side":
                table = _table(columns[1], got, rank, blocks)
            elif tag == "chunk":
                own, starts, index, rating = columns
                mine = np.repeat(_found(ids, factors, own), np.diff(starts, append=len(index)), axis=0)
                prediction = np.einsum("ij,ij->i", mine, table[index])
                for at in range(0, len(index), PACKED_ROWS):
                    yield rating[at : at + PACKED_ROWS].tobytes(), prediction[at : at + PACKED_ROWS].tobytes()

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.frombuffer(b"".join(batch.column(i).to_pylist()), t) for i, t in enumerate(("f8", "f4"))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rating", "prediction"])

    pairs = sent.union(_factors(model.userFactors, rank, blocks)).union(users).mapPartitions(task)
    rows = known.sparkSession.createDataFrame(pairs, "rating binary, prediction binary", verifySchema=False)
    return rows.mapInArrow(unpacked, "rating double, prediction float")
