"""JSON documents held in string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "rankinglist array<struct<ranking:int,score:double,name:string>>,"
    "analysis struct<stationarray:array<string>>"
)


def parse_report(report: str = "report") -> Column:
    """An exam report; a missing path reads as null."""
    return F.from_json(F.col(report), REPORT_SCHEMA)


def ranking_rows(reports: DataFrame, report: str = "report") -> DataFrame:
    """One row (ranking, score, name) per entry of each report's ranking list."""
    return reports.select(F.inline(parse_report(report)["rankinglist"]))


def station_count(reports: DataFrame, report: str = "report") -> DataFrame:
    """Stations over all reports, as one row; at least 1."""
    size = F.coalesce(F.size(parse_report(report)["analysis"]["stationarray"]), F.lit(0))
    stations = F.sum(F.when(size > 0, size).otherwise(0)).cast("bigint")
    return reports.agg(F.greatest(F.lit(1).cast("bigint"), F.coalesce(stations, F.lit(0))).alias("stations"))


def rejects(reports: DataFrame, report: str = "report") -> DataFrame:
    """Documents that are no valid JSON object."""
    bad = F.get_json_object(F.col(report), "$").isNull() | ~F.trim(F.col(report)).startswith("{")
    return reports.filter(F.col(report).isNotNull() & bad)


def to_json_text(value: Column) -> Column:
    """Keeps null fields; cast decimals to text first, as readers expect them quoted."""
    return F.to_json(value, {"ignoreNullFields": "false"})
