"""Numeric expressions: safe ratios, weighted averages, returns, signs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioflow.functions.dates import as_column


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Null instead of an error when the divisor is zero."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def percent(value: Column | str) -> Column:
    return as_column(value).cast("double") / F.lit(100.0)


def basis_points(value: Column | str) -> Column:
    return as_column(value).cast("double") / F.lit(10000.0)


def number(value: Column | str) -> Column:
    """Dirty text becomes null, never an error."""
    return as_column(value).try_cast("double")


def total(value: Column | str) -> Column:
    """Sum that is 0 when every input is null."""
    return F.coalesce(F.sum(as_column(value)), F.lit(0.0))


def weighted_average(value: Column | str, weight: Column | str, when_zero: float | None = None) -> Column:
    """sum(value * weight) / sum(weight); `when_zero` if the weights add up to 0."""
    value, weight = as_column(value), as_column(weight)
    average = F.try_divide(F.sum(value * weight), F.sum(weight))
    if when_zero is None:
        return average
    return F.when(F.sum(weight) == 0, F.lit(when_zero)).otherwise(average)


def simple_return(price: Column | str, previous: Column | str) -> Column:
    """price / previous - 1, null when either is missing or 0."""
    price, previous = as_column(price), as_column(previous)
    return F.when((price != 0) & (previous != 0), price / previous - 1)


def log_return(simple: Column | str) -> Column:
    simple = as_column(simple)
    return F.when(simple > -1, F.log1p(simple))


def signed(side: Column | str, buy: str, sell: str) -> Column:
    """+1 for the buy code, -1 for the sell code, null for any other."""
    side = as_column(side)
    return F.when(side == buy, F.lit(1.0)).when(side == sell, F.lit(-1.0))
