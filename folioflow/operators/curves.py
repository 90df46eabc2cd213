"""Yield curves and reference rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioflow.functions.labels import (
    IBOR_TENOR_NAMES,
    IBOR_TENOR_YEARS,
    MONEY_MARKET_TENORS,
    SWAP_CURVE_NAMES,
    label,
    swap_tenor_label,
    tenor_label,
)
from folioflow.functions.numeric import percent
from folioflow.operators.filters import key_tenors_only
from folioflow.operators.reshape import stack_series, union_all


def _first_hundredth_at(tenor: Column) -> Column:
    """Index of the first grid point (index / 100) that is not below the tenor."""
    near = F.round(tenor * 100).cast("int")
    return F.when(near / F.lit(100.0) >= tenor, near).otherwise(near + 1)


def interpolate_curve(
    points: DataFrame,
    curve: str = "index",
    day: str = "trade_date",
    tenor: str = "tenor",
    rate: str = "rate",
) -> DataFrame:
    """Piecewise-linear rates on a grid of hundredths of a year, flat outside the knots.

    The grid of a curve runs from 0 to its longest tenor of any day, in steps of one day
    rounded to hundredths. Every knot, paired with the next one of its day, lays out the grid
    points of its own segment, so only the knots are shuffled and the grid never is. Copies of
    a knot count once, with the highest rate.
    """
    knots = (
        points.where(F.col(rate).isNotNull() & F.col(tenor).isNotNull())
        .select(curve, day, F.col(tenor).cast("double").alias("_x"), F.col(rate).cast("double").alias("_y"))
        .groupBy(curve, day, "_x")
        .agg(F.max("_y").alias("_y"))
    )
    longest = knots.groupBy(curve).agg(F.max("_x").alias("_max"))
    by_tenor = Window.partitionBy(curve, day).orderBy("_x")
    segments = knots.withColumns(
        {
            "_x1": F.lead("_x").over(by_tenor),
            "_y1": F.lead("_y").over(by_tenor),
            "_first": F.row_number().over(by_tenor) == 1,
        }
    ).join(longest, curve)
    last_day = F.floor(F.col("_max") * 365)
    top = F.round(F.round(last_day / F.lit(365.0), 2) * 100).cast("int")
    low = F.when(F.col("_first"), F.lit(0)).otherwise(_first_hundredth_at(F.col("_x")))
    high = F.when(F.col("_x1").isNull(), top).otherwise(_first_hundredth_at(F.col("_x1")) - 1)
    laid_out = (
        segments.withColumns({"_low": low, "_high": F.least(high, top)})
        .where(F.col("_low") <= F.col("_high"))
        .withColumn("_i", F.explode(F.sequence("_low", "_high")))
        .withColumn("_g", F.col("_i") / F.lit(100.0))
    )
    slope = (F.col("_y1") - F.col("_y")) / (F.col("_x1") - F.col("_x"))
    flat = (F.col("_g") <= F.col("_x")) | F.col("_x1").isNull()
    value = F.when(flat, F.col("_y")).otherwise(slope * (F.col("_g") - F.col("_x")) + F.col("_y"))
    return laid_out.select(curve, day, F.col("_g").alias(tenor), value.alias(rate))


def _cash_series(df: DataFrame, currency: str = "cny") -> DataFrame:
    """Fields all deposit-like rates share; rows without a day are dropped, percent to ratio."""
    return df.where(F.col("trade_date").isNotNull()).withColumns(
        {
            "currency": F.lit(currency),
            "instrument_type": F.lit("DEPOSIT"),
            "rate": percent("rate"),
        }
    )


def bond_curve_rates(curves: DataFrame) -> DataFrame:
    """Bond curves at the key tenors, labelled; points without a rate are dropped."""
    kept = key_tenors_only(curves, "tenor").withColumns(
        {"tenor": tenor_label("tenor"), "tenor2": tenor_label("tenor2")}
    )
    return _cash_series(kept).where(F.col("rate").isNotNull())


def deposit_loan_rates(rates: DataFrame) -> DataFrame:
    return _cash_series(rates)


def interbank_rates(rates: DataFrame, tenors=None) -> DataFrame:
    return _cash_series(rates).withColumn("tenor", label("index", tenors or IBOR_TENOR_YEARS))


def reference_rates(
    curves: DataFrame, deposits: DataFrame, interbank: DataFrame, curve_types: DataFrame
) -> DataFrame:
    """All reference rates in one frame, with the kind of curve."""
    every = union_all([bond_curve_rates(curves), deposit_loan_rates(deposits), interbank_rates(interbank)])
    return every.join(curve_types, "index", "left")


def curve_types(rate_info: DataFrame, parameters: DataFrame, kind: str = "031001") -> DataFrame:
    """Kind of curve per rate code, named by the parameter table."""
    names = parameters.where(F.col("PARA_OBJ") == kind).select(
        F.col("PARA_CODE").alias("curve_type"), F.col("PARA_NAME").alias("curve_type_name")
    )
    kinds = rate_info.select(F.col("IRCODE").alias("index"), F.col("IRTYPE").alias("curve_type"))
    return kinds.join(names, "curve_type", "left")


def quote_series(quotes: DataFrame) -> DataFrame:
    """Adjusted returns and prices as series without a tenor."""
    series = {"return_percentage_adjusted": "ADJUSTED_RETURN", "close_adjusted": "ADJUSTED_PRICE"}
    long = stack_series(quotes, series)
    return long.withColumnRenamed("instrument_code", "index").withColumn("tenor", F.lit(""))


def curve_series(points: DataFrame) -> DataFrame:
    """Interpolated curves (rates in percent on input) with tenor labels such as `0.5Y`."""
    grid = interpolate_curve(points.withColumn("rate", percent("rate")))
    return grid.withColumns(
        {
            "tenor": F.concat(F.col("tenor").cast("string"), F.lit("Y")),
            "time_series_type": F.lit("YIELD_CURVE"),
        }
    )


def swap_series(points: DataFrame) -> DataFrame:
    """Swap curves of the four codes that have a name."""
    known = points.where(F.col("index").isin(list(SWAP_CURVE_NAMES)) & F.col("rate").isNotNull())
    return _cash_series(known).withColumns(
        {
            "tenor": swap_tenor_label("tenor"),
            "symbol": label("index", SWAP_CURVE_NAMES),
            "time_series_type": F.lit("IRS_CURVE"),
        }
    )


def deposit_series(rates: DataFrame, tenors=None) -> DataFrame:
    """Deposit-like rates as series; `tenors` maps rate code to label."""
    rows = _cash_series(rates).withColumn("time_series_type", F.lit("DEPOSIT"))
    return rows.withColumn("tenor", label("index", tenors)) if tenors else rows


def time_series(
    stock_quotes: DataFrame,
    fund_quotes: DataFrame,
    bond_curves: DataFrame,
    swap_curves: DataFrame,
    deposits: DataFrame,
    interbank: DataFrame,
    money_market: DataFrame,
) -> DataFrame:
    """Every series in long form with its type."""
    return union_all(
        [
            quote_series(stock_quotes),
            quote_series(fund_quotes),
            curve_series(bond_curves),
            swap_series(swap_curves),
            deposit_series(deposits),
            deposit_series(interbank, IBOR_TENOR_NAMES),
            deposit_series(money_market, MONEY_MARKET_TENORS),
        ]
    )


def shockable_factors(rates: DataFrame) -> DataFrame:
    """Distinct factors that have a tenor."""
    columns = ["index", "index_name", "tenor", "instrument_type"]
    return rates.where(F.col("tenor").isNotNull()).select(*columns).distinct()
