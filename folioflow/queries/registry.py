"""Query registry and shared frames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioflow.functions.dates import date_text

@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _edge_sql(sql: str, dates: list[str]) -> str:
    """The SQL with its date columns as `yyyyMMdd` text."""
    formatted = ", ".join(f"strftime({d}, '%Y%m%d') AS {d}" for d in dates)
    return f"SELECT * REPLACE ({formatted}) FROM ({sql.strip()})"


def query(sql: str | None = None, name: str | None = None, dates: str = ""):
    """Register a query under its function name, with its SQL twin if it has one.

    `dates` names the date columns of the result, which leave the engine as `yyyyMMdd` text.
    """
    columns = dates.split()

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            rows = function(spark, sf_dir)
            return rows.withColumns({c: date_text(c) for c in columns}) if columns else rows

        twin = _edge_sql(sql, columns) if sql and columns else sql
        QUERIES[name or function.__name__] = Query(run, twin)
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> Column:
    return F.col(column).cast("date")


def month(column: str) -> Column:
    return F.trunc(day(column), "MM")


def year(column: str) -> Column:
    return F.trunc(day(column), "YEAR")


# Added before rounding where exact halves occur, on which engines round differently.
NUDGE = 0.00000137
FINE_NUDGE = 0.00000000137


def rounded(df: DataFrame, digits: int, *columns: str, nudge: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + nudge if nudge else c, digits) for c in columns})
