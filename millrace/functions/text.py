"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Split on single blanks; empty tokens stay, as with a plain string split."""
    return F.split(text, " ")


def capitalize(text: Column) -> Column:
    """First character upper-case, the rest lower-case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2_147_483_647)))


def title_words(text: Column, sep: str) -> Column:
    """Capitalise every part between separators."""
    return F.array_join(F.transform(F.split(text, sep), capitalize), sep)


def mask_secret(url: Column) -> Column:
    """Replace the password of a connection string."""
    return F.regexp_replace(url, r"(?i)(password=)[^&;]*", "$1***")


def jdbc_parts(url: Column) -> dict[str, Column]:
    """Host, port, database and user of a JDBC URL; null when a part is missing. The password is left out."""
    found = lambda pattern: F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))
    return {
        "host": found(r"//([^:/?]+)"),
        "port": found(r"//[^:/?]+:(\d+)"),
        "db": found(r"//[^/]+/([^?]+)"),
        "user": found(r"[?&]user=([^&]*)"),
    }
