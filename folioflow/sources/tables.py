"""Reading source tables: routing, scans, month ranges, renaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Table prefixes that decide where a table is read from and what it supports.
VENDOR_PREFIX = "INFO_"
DRILL_DOWN_PREFIX = "INDIC_"


@dataclass(frozen=True)
class Location:
    """Where tables live: a Spark format with its options, or a folder of parquet tables.

    `splits` gives, for JDBC tables without a day column, a numeric or date column, its bounds
    and the number of ranges to read in parallel.
    """

    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    splits: Mapping[str, tuple[str, object, object, int]] = field(default_factory=dict)


@dataclass(frozen=True)
class SourceTables:
    """Tables by name. `INFO_*` tables come from the vendor location unless it is not set."""

    spark: SparkSession
    business: Location = Location()
    vendor: Location | None = None
    frames: Mapping[str, DataFrame | Callable[[], DataFrame]] = field(default_factory=dict)

    def location(self, table: str) -> Location:
        if self.vendor is not None and table.upper().startswith(VENDOR_PREFIX):
            return self.vendor
        return self.business

    def supports_drill_down(self, table: str) -> bool:
        return table.upper().startswith(DRILL_DOWN_PREFIX)

    def load(self, table: str, predicates: Sequence[str] | None = None) -> DataFrame:
        """One source table. `predicates` splits a JDBC read into one task per predicate."""
        if table in self.frames:
            frame = self.frames[table]
            return frame if isinstance(frame, DataFrame) else frame()
        place = self.location(table)
        if place.format == "jdbc":
            options = dict(place.options)
            url = options.pop("url")
            if predicates:
                return self.spark.read.jdbc(
                    url, table, predicates=list(predicates), properties=options
                )
            if table in place.splits:
                column, lower, upper, ranges = place.splits[table]
                return self.spark.read.jdbc(
                    url, table, column=column, lowerBound=lower, upperBound=upper,
                    numPartitions=ranges, properties=options,
                )
            return self.spark.read.jdbc(url, table, properties=options)
        if place.path is None:
            return self.spark.read.format(place.format).options(**place.options).table(table)
        return self.spark.read.format(place.format).options(**place.options).load(
            f"{place.path}/{table}"
        )


def scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    upper_columns: bool = False,
    formatter: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Filter, project, optionally upper-case the names, optionally reshape."""
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*columns)
    if upper_columns:
        df = df.toDF(*[c.upper() for c in df.columns])
    return df.transform(formatter) if formatter else df


def month_bounds(start: date, end: date) -> list[tuple[date, date]]:
    """Calendar-month pieces of an inclusive span, first and last clipped."""
    pieces = []
    while start <= end:
        next_month = date(start.year + start.month // 12, start.month % 12 + 1, 1)
        pieces.append((start, min(end, next_month - timedelta(days=1))))
        start = next_month
    return pieces


def month_predicates(column: str, start: date, end: date) -> list[str]:
    """One SQL predicate per month, for `SourceTables.load(..., predicates=)`."""
    return [f"{column} between '{a}' and '{b}'" for a, b in month_bounds(start, end)]


def month_ranges(df: DataFrame, start: str, end: str) -> DataFrame:
    """Per row, the month pieces of the inclusive span `[start, end]`: piece_start, piece_end."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    months = F.sequence(F.trunc(first, "MM"), last, F.expr("interval 1 month"))
    return (
        df.where(first <= last)
        .withColumn("_month", F.explode(months))
        .withColumns(
            {
                "piece_start": F.greatest(first, F.col("_month")),
                "piece_end": F.least(F.last_day("_month"), last),
            }
        )
        .drop("_month")
    )


def all_of(predicates: Sequence[Column]) -> Column:
    """Conjunction; true when the list is empty."""
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def in_span(column: str, start=None, end=None) -> Column:
    """Inclusive date bounds; either may be missing."""
    bounds = []
    if start is not None:
        bounds.append(F.col(column) >= F.lit(start))
    if end is not None:
        bounds.append(F.col(column) <= F.lit(end))
    return all_of(bounds)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_from_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Source names to dataset names, from the lineage in the field metadata."""
    mapping = {}
    for f in schema:
        if f.metadata.get("table_field"):
            mapping[f.metadata["table_field"]] = f.name
        for source in f.metadata.get("source_table", {}).values():
            mapping.setdefault(source, f.name)
    return rename_columns(df, mapping)


def column_comments(sources: SourceTables, wanted: DataFrame, database: str) -> DataFrame:
    """Comments and types of chosen source columns.

    `wanted` has category, model_name, table_name, column_name; the comments come from the
    `information_schema.columns` table of the source database.
    """
    described = sources.load("information_schema.columns").where(
        F.col("table_schema") == database
    )
    described = described.select("table_name", "column_name", "column_comment", "column_type")
    return wanted.join(described, ["table_name", "column_name"])
