"""Row fingerprints: md5 over a labelled text form of selected columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def python_text(column: Column, dtype: T.DataType) -> Column:
    """The text the loaders have always hashed: ``None`` for null, six digits or none for fractional seconds."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        fraction = F.date_format(column, "SSSSSS")
        text = F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))
    elif isinstance(dtype, T.BooleanType):
        text = F.initcap(column.cast("string"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("None"))


def fill_template(template: str, texts: list[Column]) -> Column:
    """Put the texts into a ``%s`` template."""
    pieces = template.split("%s")
    if len(pieces) != len(texts) + 1:
        raise ValueError(f"template has {len(pieces) - 1} places for {len(texts)} columns")
    parts: list[Column] = []
    for i, piece in enumerate(pieces):
        if piece:
            parts.append(F.lit(piece))
        if i < len(texts):
            parts.append(texts[i])
    return F.concat(*parts)


def row_md5(template: str, columns: list[str], schema: T.StructType) -> Column:
    return F.md5(fill_template(template, [python_text(F.col(c), schema[c].dataType) for c in columns]))
