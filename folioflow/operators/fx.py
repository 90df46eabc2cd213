"""Currency conversion through a pivot currency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from folioflow.columns import PIVOT_CURRENCY
from folioflow.operators.sizes import broadcast_if_small


def first_rates(
    quotes: DataFrame,
    by: Sequence[str] = ("trade_date", "fx_code"),
    rate: str = "exch_rate",
    order: Sequence[str] = (),
) -> DataFrame:
    """One rate per pair (and day): the first by `order`, then the lowest."""
    return quotes.groupBy(*by).agg(F.min_by(rate, F.struct(*order, rate)).alias(rate))


def rate_map(rates: DataFrame, day: str = "trade_date", pair: str = "fx_code", rate: str = "exch_rate") -> DataFrame:
    """Per day, a map from pair to rate. A day has one entry per currency pair."""
    return rates.groupBy(day).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(pair, rate)))).alias("rates")
    )


def factors_to_pivot(
    rates: DataFrame,
    by: Sequence[str] = ("trade_date",),
    pair: str = "fx_code",
    rate: str = "exch_rate",
    pivot: str = PIVOT_CURRENCY,
) -> DataFrame:
    """Value of one unit of each currency in the pivot: the direct quote if there is one, else
    one over the inverse quote. Zero and null quotes count as missing."""
    usable = rates.where((F.col(rate) != 0) & F.col(rate).isNotNull())
    base, quote = F.substring(pair, 1, 3), F.substring(pair, 4, 3)
    legs = usable.select(
        *by,
        F.when(quote == pivot, base).when(base == pivot, quote).alias("currency"),
        F.when(quote == pivot, F.col(rate)).alias("direct"),
        F.when(base == pivot, F.try_divide(F.lit(1.0), F.col(rate))).alias("inverse"),
    ).where(F.col("currency").isNotNull())
    return legs.groupBy(*by, "currency").agg(
        F.coalesce(F.max("direct"), F.max("inverse")).alias("factor")
    )


def convert_currency(
    df: DataFrame,
    rates: DataFrame,
    target: str,
    value: str = "market_value",
    currency: str = "currency",
    by: Sequence[str] = ("trade_date",),
    pivot: str = PIVOT_CURRENCY,
    pair: str = "fx_code",
    rate: str = "exch_rate",
) -> DataFrame:
    """Express `value` in the target currency; `fx_missing` marks rows that lacked a quote.

    `by` names the columns quotes and rows share (the day, or nothing for one set of quotes).
    A missing quote counts as factor 1, as does a missing or equal currency. The factors are a
    few per day; they are counted and broadcast if small, so the rows need no shuffle.
    """
    factors = broadcast_if_small(factors_to_pivot(rates, by, pair, rate, pivot))
    own = factors.withColumnsRenamed({"currency": "_currency", "factor": "_own"})
    asked = factors.where(F.col("currency") == target)
    if by:
        own = own.withColumnsRenamed({c: f"_{c}" for c in by})
        same_day = [df[c] == F.col(f"_{c}") for c in by]
        joined = df.join(own, [*same_day, df[currency] == F.col("_currency")], "left")
        joined = joined.drop("_currency", *[f"_{c}" for c in by])
        joined = joined.join(asked.select(*by, F.col("factor").alias("_asked")), list(by), "left")
    else:
        found = asked.first()
        joined = df.join(own, df[currency] == F.col("_currency"), "left").drop("_currency")
        joined = joined.withColumn("_asked", F.lit(found["factor"] if found else None).cast("double"))
    same = F.col(currency).isNull() | (F.col(currency) == "") | (F.col(currency) == target)
    from_pivot = F.col(currency) == pivot
    own_factor = F.when(from_pivot, F.lit(1.0)).otherwise(F.col("_own"))
    target_factor = F.lit(1.0) if target == pivot else F.col("_asked")
    factor = F.coalesce(own_factor, F.lit(1.0)) / F.coalesce(target_factor, F.lit(1.0))
    return joined.withColumns(
        {
            value: F.when(same, F.col(value)).otherwise(F.col(value) * factor),
            "fx_missing": ~same & (own_factor.isNull() | target_factor.isNull()),
        }
    ).drop("_own", "_asked")
