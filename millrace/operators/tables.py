"""Table functions: generators that keep state over the rows of a key."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


@udtf
class Stretches:
    """``stretches(TABLE(t), 'key', 'order', 'value')``: for each key, the stretches of neighbouring rows with the same value.

    ``analyze`` reads the types of the result from the argument table and asks Spark to bring the rows of a key together in order; a key's rows
    stream through one task, which holds one stretch. A last row tells how many rows the key had (value null, length negative).
    """

    def __init__(self) -> None:
        self.first: Row | None = None
        self.length = self.rows = 0

    @staticmethod
    def analyze(row: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, value: AnalyzeArgument) -> AnalyzeResult:
        if not row.isTable:
            raise ValueError("the first argument is a table")
        types = {f.name: f.dataType for f in row.dataType.fields}
        missing = [a.value for a in (key, order, value) if a.value not in types]
        if missing:
            raise ValueError(f"the table has no column {missing[0]}")
        schema = StructType([StructField(a.value, types[a.value]) for a in (key, order, value)] + [StructField("length", LongType())])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(order.value)])

    def eval(self, row: Row, key: str, order: str, value: str) -> Iterator[tuple]:
        self.names = (key, order, value)
        self.rows += 1
        if self.first is not None and row[value] == self.first[value]:
            self.length += 1
            return
        yield from self._done()
        self.first, self.length = row, 1

    def terminate(self) -> Iterator[tuple]:
        yield from self._done()
        if self.first is not None:
            yield self.first[self.names[0]], None, None, -self.rows

    def _done(self) -> Iterator[tuple]:
        if self.first is not None:
            yield (*(self.first[n] for n in self.names), self.length)


def register(spark: SparkSession) -> None:
    spark.udtf.register("stretches", Stretches)


def stretches(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, order of the first row, value, length) of every stretch of ``df``, and the row of totals of each key."""
    spark = df.sparkSession
    register(spark)
    return spark.sql("SELECT * FROM stretches(TABLE({df}), {key}, {order}, {value})", df=df, key=key, order=order, value=value)
