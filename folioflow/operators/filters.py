"""Restricting loads to the codes that matter, and first-match lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from folioflow.operators.reshape import union_distinct

# Rating agencies, bond class pattern, key curve tenors in years.
RATING_AGENCIES = ("002", "003", "004", "005", "006", "034", "013", "014", "019")
BOND_CLASS_PATTERN = "A02.02"
KEY_TENORS = (
    0.0, 0.08, 0.17, 0.25, 0.5, 0.75, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 15.0,
    20.0, 30.0, 40.0, 50.0,
)


def held_codes(
    positions: DataFrame,
    types: str | Sequence[str] | None = None,
    code: str = "instrument_code",
    kind: str = "instrument_type",
) -> DataFrame:
    """Distinct codes held, of the given instrument types if any."""
    if types:
        wanted = [types] if isinstance(types, str) else list(types)
        positions = positions.where(F.col(kind).isin(wanted))
    return positions.select(code).distinct()


def restrict_to_codes(df: DataFrame, codes: Sequence[DataFrame], column: str) -> DataFrame:
    """Keep the rows whose code occurs in any of the code frames (their first column)."""
    wanted = union_distinct([c.select(F.col(c.columns[0]).alias(column)) for c in codes])
    return df.join(wanted, column, "left_semi")


def without_codes(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    return df.join(codes.select(F.col(codes.columns[0]).alias(column)).distinct(), column, "left_anti")


def bond_class_only(df: DataFrame, column: str = "bond_type") -> DataFrame:
    return df.where(F.col(column).rlike(BOND_CLASS_PATTERN))


def key_tenors_only(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).cast("double").isin(list(KEY_TENORS)))


def first_match(df: DataFrame, wanted: str, **equal) -> str | None:
    """One value of the first row that matches, or None."""
    for column, value in equal.items():
        df = df.where(F.col(column) == value)
    row = df.select(wanted).limit(1).first()
    return row[wanted] if row else None
