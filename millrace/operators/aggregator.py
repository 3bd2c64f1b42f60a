"""Aggregates that the caller writes: state per group and task, merged before and after one shuffle, all on Arrow tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of state that a task collects before it merges them, and beyond which what is merged is sent on.
STATE_ROWS = 1 << 16


class Aggregate:
    """State, merge and finish. ``state`` and ``result`` are schemas without the keys; every method keeps the key columns in front.

    ``update`` turns rows into states, ``merge`` makes one state of all that share a key (in any order and any number of steps), and ``finish`` turns one
    state a key into the result.
    """

    state: str
    result: str

    def update(self, rows: pa.Table, keys: list[str]) -> pa.Table:
        raise NotImplementedError

    def merge(self, states: pa.Table, keys: list[str]) -> pa.Table:
        raise NotImplementedError

    def finish(self, states: pa.Table, keys: list[str]) -> pa.Table:
        return states


def _batches(table: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from table.select(schema.names).cast(schema).combine_chunks().to_batches()


def aggregate(df: DataFrame, keys: list[str], wanted: Aggregate) -> DataFrame:
    """One row per key. Rows are reduced to states where they are read: what is shuffled is one state a key and task (more where a task meets more than
    ``STATE_ROWS`` keys). Sorted states are then merged in passing, so a task holds a bounded number of them, and a hot key is one state a task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    state_sql, result_sql = (f"{key_types}, {part}" for part in (wanted.state, wanted.result))
    state_schema, result_schema = (to_arrow_schema(StructType.fromDDL(x)) for x in (state_sql, result_sql))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append(wanted.update(pa.Table.from_batches([batch]), keys).select(state_schema.names).cast(state_schema))
                rows += held[-1].num_rows
            if rows > STATE_ROWS:
                held = [wanted.merge(pa.concat_tables(held), keys).select(state_schema.names).cast(state_schema)]
                rows = held[0].num_rows
                if rows > STATE_ROWS // 2:
                    yield from _batches(held[0], state_schema)
                    held, rows = [], 0
        if held:
            yield from _batches(wanted.merge(pa.concat_tables(held), keys), state_schema)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            more = pa.Table.from_batches([batch]).cast(state_schema)
            held = more if held is None else pa.concat_tables([held, more])
            if held.num_rows > STATE_ROWS:
                last = held.slice(held.num_rows - 1).select(keys)
                at_end = np.ones(held.num_rows, bool)
                for k in keys:
                    value = last.column(k)[0]
                    same = pc.is_null(held.column(k)) if not value.is_valid else pc.fill_null(pc.equal(held.column(k), value), False)
                    at_end &= same.to_numpy()
                whole, held = held.filter(pa.array(~at_end)), wanted.merge(held.filter(pa.array(at_end)), keys).select(state_schema.names).cast(state_schema)
                if whole.num_rows:
                    yield from _batches(wanted.finish(wanted.merge(whole, keys), keys), result_schema)
        if held is not None and held.num_rows:
            yield from _batches(wanted.finish(wanted.merge(held, keys), keys), result_schema)

    states = df.mapInArrow(partial, state_sql)
    return states.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(final, result_sql)


class GeometricMean(Aggregate):
    """exp of the mean logarithm of the positive values; 0 with a zero among them, null without any; negative values count as null."""

    state = "logs double, n bigint, zeros bigint"
    result = "geometric_mean double"

    def __init__(self, value: str) -> None:
        self.value = value

    def update(self, rows: pa.Table, keys: list[str]) -> pa.Table:
        value = rows.column(self.value).cast(pa.float64())
        positive = pc.fill_null(pc.greater(value, 0), False)
        logs = pc.if_else(positive, pc.ln(pc.if_else(positive, value, 1.0)), 0.0)
        columns = {"logs": logs, "n": positive.cast(pa.int64()), "zeros": pc.fill_null(pc.equal(value, 0), False).cast(pa.int64())}
        return self.merge(pa.table({k: rows.column(k) for k in keys} | columns), keys)

    def merge(self, states: pa.Table, keys: list[str]) -> pa.Table:
        sums = states.group_by(keys).aggregate([(n, "sum") for n in ("logs", "n", "zeros")])
        return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names])

    def finish(self, states: pa.Table, keys: list[str]) -> pa.Table:
        n, zeros = states.column("n"), states.column("zeros")
        mean = pc.exp(pc.divide(states.column("logs"), pc.if_else(pc.equal(n, 0), 1, n).cast(pa.float64())))
        known = pc.if_else(pc.equal(n, 0), pa.scalar(None, pa.float64()), mean)
        return states.select(keys).append_column("geometric_mean", pc.if_else(pc.greater(zeros, 0), 0.0, known))


class Occurrences(Aggregate):
    """Rows per key; with the value among the keys, how often each value occurs."""

    state = "n bigint"
    result = "n bigint"

    def update(self, rows: pa.Table, keys: list[str]) -> pa.Table:
        return self.merge(rows.select(keys).append_column("n", pa.array(np.ones(rows.num_rows, np.int64))), keys)

    def merge(self, states: pa.Table, keys: list[str]) -> pa.Table:
        return states.group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


class MostFrequent(Aggregate):
    """From (keys, value, n): the highest n of each key and all values that have it, in order."""

    def __init__(self, value: str, kind: str) -> None:
        self.value = value
        self.state = self.result = f"n bigint, modes array<{kind}>"

    def update(self, rows: pa.Table, keys: list[str]) -> pa.Table:
        one = rows.column(self.value).combine_chunks()
        offsets = pa.array(np.arange(len(one) + 1, dtype=np.int32))
        return self.merge(rows.select([*keys, "n"]).append_column("modes", pa.ListArray.from_arrays(offsets, one)), keys)

    def merge(self, states: pa.Table, keys: list[str]) -> pa.Table:
        best: dict[tuple, tuple[int, set]] = {}
        columns = [states.column(c).to_pylist() for c in (*keys, "n", "modes")]
        for *key, n, modes in zip(*columns):
            held = best.get(tuple(key))
            if held is None or n > held[0]:
                best[tuple(key)] = (n, set(modes))
            elif n == held[0]:
                held[1].update(modes)
        found = {k: pa.array([key[i] for key in best], states.schema.field(k).type) for i, k in enumerate(keys)}
        found["n"] = pa.array([n for n, _ in best.values()], pa.int64())
        found["modes"] = pa.array([sorted(modes) for _, modes in best.values()], states.schema.field("modes").type)
        return pa.table(found)


def modes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent values of each key, ties included (``modes``, in order), and how often each occurs (``n``); nulls are no values.

    Counted per key and value first, so one hot key with many values is spread over tasks.
    """
    counted = aggregate(df.filter(F.col(value).isNotNull()).select(*keys, value), [*keys, value], Occurrences())
    return aggregate(counted, keys, MostFrequent(value, df.schema[value].dataType.simpleString()))
