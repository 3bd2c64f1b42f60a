"""File sources beyond a plain ``spark.read``: delimited text, vectors, labelled and rating lines."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Delimited lines as typed columns; blanks around a field are dropped, bad fields become null."""
    return (
        spark.read.option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path, schema=schema, sep=sep)
    )


def read_ctrl_a(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Hive's default text layout: fields separated by the byte 0x01, nothing quoted."""
    return spark.read.csv(path, schema=schema, sep="\x01", quote="", nullValue="\\N")


def numbers(text: Column, pattern: str = r"\s+") -> Column:
    """A line of numbers as ``array<double>``; a token that is no number becomes null."""
    return F.transform(F.split(F.trim(text), pattern), lambda token: token.try_cast("double"))


def vector_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Space-separated numbers -> ``values`` (array) and ``features`` (vector)."""
    values = lines.withColumn("values", numbers(F.col(column)))
    return values.withColumn("features", array_to_vector("values"))


def labelled_lines(lines: DataFrame, column: str = "value", negative_to_zero: bool = True) -> DataFrame:
    """``label f1 f2 ...`` or ``label,f1 f2 ...`` -> ``label`` and ``values``; label -1 becomes 0."""
    parts = numbers(F.translate(F.col(column), ",", " "))
    label = F.element_at(parts, 1)
    if negative_to_zero:
        label = F.when(label == -1.0, 0.0).otherwise(label)
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return lines.select(label.alias("label"), rest.alias("values"))


def indexed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``label idx:val idx:val ...`` -> ``label`` and a map from (one-based) index to value."""
    tokens = F.split(F.trim(F.col(column)), r"\s+")
    pairs = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    entries = F.transform(
        pairs,
        lambda pair: F.struct(
            F.split_part(pair, F.lit(":"), F.lit(1)).try_cast("int").alias("key"),
            F.split_part(pair, F.lit(":"), F.lit(2)).try_cast("double").alias("value"),
        ),
    )
    return lines.select(F.element_at(tokens, 1).try_cast("double").alias("label"), F.map_from_entries(entries).alias("values"))


def rating_lines(lines: DataFrame, sep: str = "::", offset: float = 0.0, column: str = "value") -> DataFrame:
    """``user<sep>item<sep>rating`` -> typed columns, with ``offset`` taken off the rating."""
    field = lambda i: F.split_part(F.col(column), F.lit(sep), F.lit(i))
    return lines.select(
        field(1).try_cast("bigint").alias("user"),
        field(2).try_cast("bigint").alias("item"),
        (field(3).try_cast("double") - F.lit(offset)).alias("rating"),
    )
