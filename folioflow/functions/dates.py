"""Dates: `DateType` inside the engine, `yyyyMMdd` text at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

EDGE_FORMAT = "yyyyMMdd"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_text(value: Column | str, null_as: str | None = None) -> Column:
    """A date as `yyyyMMdd`; nulls stay null unless `null_as` is given."""
    text = F.date_format(as_column(value), EDGE_FORMAT)
    return text if null_as is None else F.coalesce(text, F.lit(null_as))


def parse_day(value: Column | str) -> Column:
    """Text in `yyyyMMdd` or ISO form (with or without a time) to a date; null if neither."""
    text = as_column(value).cast("string")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(EDGE_FORMAT)).cast("date"),
        F.try_to_timestamp(text).cast("date"),
    )


def compact_date_text(df: DataFrame, name: str) -> Column:
    """Text loses its dashes; date and timestamp columns are formatted."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.regexp_replace(F.col(name), "-", "")
    return date_text(name)


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start)).cast("double")


def month_start(value: Column | str) -> Column:
    return F.trunc(as_column(value), "MM")


def month_end(value: Column | str) -> Column:
    return F.last_day(as_column(value))


def partition_key(value: Column | str, grain: str) -> Column:
    """Partition value of a date: `202103`, `2021`, `20211` (quarter) or `20210301`."""
    day = as_column(value)
    if grain == "month":
        return F.date_format(day, "yyyyMM")
    if grain == "year":
        return F.date_format(day, "yyyy")
    if grain == "quarter":
        return F.concat(F.date_format(day, "yyyy"), F.quarter(day).cast("string"))
    if grain == "day":
        return date_text(day)
    raise ValueError(f"unknown partition grain: {grain}")


def format_edge_dates(df: DataFrame) -> DataFrame:
    """Every date column of a frame as `yyyyMMdd` text."""
    return df.withColumns(
        {f.name: date_text(f.name) for f in df.schema if isinstance(f.dataType, T.DateType)}
    )
