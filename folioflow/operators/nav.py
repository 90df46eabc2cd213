"""Unit values and returns of products and quotes, by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from folioflow.functions.numeric import log_return, ratio, simple_return
from folioflow.operators.ordered import previous_row


def adjusted_nav(
    assets: DataFrame,
    start_dates: DataFrame,
    product: str = "instrument_code",
    day: str = "trade_date",
    net_asset: str = "close",
    inflow: str = "net_cptl_inflow_amt",
    shares: str = "quantity",
) -> DataFrame:
    """Adjusted unit value and its daily return per product.

    value = (net assets - inflow) / shares of the day before; return = value / value of the
    day before - 1. On the product's start date the value is 1, the shares are the net assets
    and the return is null. `start_dates` has one row per product: product, start_date. A
    product has one row per day, so its window is bounded by the calendar.
    """
    rows = assets.join(start_dates.select(product, "start_date"), product, "left")
    starts = F.col(day) == F.col("start_date")
    rows = rows.withColumns(
        {
            "_starts": F.coalesce(starts, F.lit(False)),
            "_shares": F.when(starts, F.col(net_asset)).otherwise(F.col(shares)),
        }
    )
    by_day = Window.partitionBy(product).orderBy(day)
    value = ratio(F.col(net_asset) - F.col(inflow), F.lag("_shares").over(by_day))
    valued = rows.withColumn(
        "close_adjusted", F.when(F.col("_starts"), F.lit(1.0)).otherwise(value)
    )
    change = ratio("close_adjusted", F.lag("close_adjusted").over(by_day)) - 1
    return valued.withColumn(
        "return_percentage", F.when(~F.col("_starts"), change)
    ).drop("_starts", "_shares", "start_date")


def fill_missing_nav(
    nav: DataFrame,
    computed: DataFrame,
    product: str = "instrument_code",
    day: str = "trade_date",
) -> DataFrame:
    """Computed value and return where the stored adjusted value is null."""
    extra = computed.select(
        product,
        day,
        F.col("close_adjusted").alias("_value"),
        F.col("return_percentage").alias("_return"),
    )
    joined = nav.join(extra, [product, day], "left")
    missing = F.col("close_adjusted").isNull()
    return joined.withColumns(
        {
            "close_adjusted": F.coalesce("close_adjusted", "_value"),
            "return_percentage": F.when(
                missing, F.coalesce("return_percentage", "_return")
            ).otherwise(F.col("return_percentage")),
        }
    ).select(*nav.columns)


def returns(
    quotes: DataFrame,
    price: str = "close_adjusted",
    previous: str | None = None,
    by: tuple[str, ...] = ("instrument_code",),
    order: tuple[str, ...] = ("trade_date",),
    simple: str = "return_percentage_adjusted",
    log: str = "return_percentage_adjusted_log",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Simple and log return. The previous price is a column, or that of the row before; the
    first row here looks back to the last of `earlier`."""
    rows = quotes
    if previous is None:
        rows = previous_row(rows, by, order, {price: "_previous"}, earlier=earlier)
    change = simple_return(price, previous or "_previous")
    rows = rows.withColumn(simple, change)
    return rows.withColumn(log, log_return(simple)).drop("_previous")
