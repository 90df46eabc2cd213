"""Bond master data, outstanding principal, pricing inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.functions.dates import EDGE_FORMAT, date_text, days_between
from folioflow.operators.dedupe import keep_last
from folioflow.operators.ordered import asof_join

# Right types, par, the adjustment that stands for none.
CALL_RIGHT, PUT_RIGHT = "002", "001"
FULL_PRINCIPAL = 100.0
NO_ADJUSTMENT = 100000.0
COUPON_ACCURACY, CREATE_NEW = 4, 1


def outstanding_principal(
    valuation: DataFrame,
    cashflow: DataFrame,
    code: str = "instrument_code",
    day: str = "trade_date",
    principal: str = "cash_amt_aft",
    default: float = FULL_PRINCIPAL,
    sliced: bool = False,
) -> DataFrame:
    """Principal left after the last payment on or before the day; `default` before any.

    A bond has a few valuations per day, so its window is bounded by the calendar.
    """
    paid = cashflow.where(F.col(principal).isNotNull())
    rows = asof_join(
        valuation, paid, [code], day, day, [principal], tie_break=[principal], sliced=sliced
    )
    return rows.fillna(default, [principal])


def dated_map(day: str, value: str | Column, condition: Column | None = None) -> Column:
    """Aggregate: JSON object from `yyyyMMdd` to value, in date order. Rows are one per day
    after `keep_last`, so an object has at most one entry per calendar day."""
    value = F.col(value) if isinstance(value, str) else value
    entry = F.struct(date_text(day).alias("key"), value.alias("value"))
    wanted = F.col(day).isNotNull() if condition is None else F.col(day).isNotNull() & condition
    entries = F.array_sort(F.collect_list(F.when(wanted, entry)))
    return F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(entries)))


def repayment_maps(
    repayments: DataFrame, code: str = "instrument_code", day: str = "trade_date",
    ratio: str = "advance_repay_ratio", order: Sequence[str] = (),
) -> DataFrame:
    """Per bond, a JSON map from repayment date to share repaid; on one date the last wins."""
    unique = keep_last(repayments.select(code, day, ratio, *order), [code, day], [*order, ratio])
    return unique.groupBy(code).agg(dated_map(day, ratio).alias("notional_reduce_map"))


def right_maps(
    rights: DataFrame,
    code: str = "instrument_code",
    day: str = "trade_date",
    kind: str = "rit_type",
    price: str = "strike_price",
    high: str = "high_interest_rate_adj",
    low: str = "low_interest_rate_adj",
    order: Sequence[str] = (),
) -> DataFrame:
    """Per bond, the JSON maps of its embedded rights: call and put prices, rate adjustments.

    Prices are unique per kind and date, adjustments per date over all kinds.
    """
    per_kind = keep_last(rights.select(code, day, kind, price, *order), [code, day, kind], [*order, price])
    prices = per_kind.groupBy(code).agg(
        dated_map(day, price, F.col(kind) == CALL_RIGHT).alias("call_option_map"),
        dated_map(day, price, F.col(kind) == PUT_RIGHT).alias("put_option_map"),
    )
    filled = rights.select(code, day, kind, high, low, *order).fillna(NO_ADJUSTMENT, [high, low])
    per_day = keep_last(filled, [code, day], [*order, kind, high, low])
    adjustments = per_day.groupBy(code).agg(
        dated_map(day, high).alias("high_interest_rate_adj"),
        dated_map(day, low).alias("low_interest_rate_adj"),
    )
    return prices.join(adjustments, code, "full")


def coupon_periods(
    coupons: DataFrame,
    code: str = "instrument_code",
    start: str = "interest_start_date",
    end: str = "interest_end_date",
    rate: str = "interest_period_interest_rate",
) -> DataFrame:
    """Per bond, parallel arrays of its periods in date order, the rate map, the first start.

    The arrays hold one bond's own periods, which its life in days bounds.
    """
    period = F.struct(
        date_text(start).alias("start"),
        date_text(end).alias("end"),
        F.coalesce(F.col(rate), F.lit(0.0)).alias("rate"),
    )
    arrays = coupons.groupBy(code).agg(
        F.array_sort(F.collect_list(period)).alias("_periods"), F.min(start).alias("_first_start")
    )
    last_per_start = F.filter(
        "_periods",
        lambda p, i: (i + 1 == F.size("_periods"))
        | (F.try_element_at(F.col("_periods"), i + 2).getField("start") != p["start"]),
    )
    entries = F.transform(
        F.filter(last_per_start, lambda p: p["start"].isNotNull()),
        lambda p: F.struct(p["start"].alias("key"), p["rate"].alias("value")),
    )
    return arrays.select(
        code,
        F.col("_periods.start").alias(start),
        F.col("_periods.end").alias(end),
        F.col("_periods.rate").alias(rate),
        F.to_json(F.map_from_entries(entries)).alias("coupon_change_map"),
        "_first_start",
    )


def bond_master(
    basic: DataFrame,
    repayments: DataFrame,
    rights: DataFrame,
    coupons: DataFrame,
    classes: DataFrame,
    code: str = "instrument_code",
    start: str = "start_date",
) -> DataFrame:
    """One row per bond: basic data with its schedules as arrays and JSON maps.

    Every schedule is first reduced to one row per bond, so the joins share one partitioning
    by bond and multiply nothing.
    """
    joined = (
        basic.join(repayment_maps(repayments, code), code, "left")
        .join(right_maps(rights, code), code, "left")
        .join(coupon_periods(coupons, code), code, "left")
        .join(classes, code, "left")
    )
    adjust = F.coalesce(days_between(start, "_first_start"), F.lit(0.0))
    full = joined.withColumns(
        {
            "coupon_accuracy": F.lit(COUPON_ACCURACY).cast("long"),
            "is_create_new": F.lit(CREATE_NEW).cast("long"),
            "adjust_num_for_lastest": adjust,
        }
    ).drop("_first_start")
    settings = ["coupon_accuracy", "is_create_new", "adjust_num_for_lastest", "frn_adjust_rate", "calc_way"]
    return full.withColumn("float_rate_records", F.array(*[F.col(c).cast("double") for c in settings]))


def coupon_inputs(
    bonds: DataFrame,
    settle_date: str | Column = "settle_date",
    start: str = "interest_start_date",
    end: str = "interest_end_date",
    rate: str = "interest_period_interest_rate",
) -> DataFrame:
    """Pricing inputs of each bond as of its settlement day (a date or `yyyyMMdd` text).

    Periods that start later are cut from all three arrays; the expected maturity counts before
    the actual one; a zero-coupon bond issued below par is a discount bond; both kinds pay once
    unless a frequency is known.
    """
    day = F.col(settle_date) if isinstance(settle_date, str) else settle_date
    settle = F.coalesce(F.try_to_timestamp(day.cast("string")).cast("date"), F.to_date(day.cast("string"), EDGE_FORMAT))
    known = F.filter(
        F.array_sort(F.coalesce(start, F.array().cast("array<string>"))), lambda s: s <= date_text(settle)
    )
    discount = (F.col("coupon_type") == "ZeroCouponBond") & (F.col("issue_price") < 100)
    kind = F.when(discount, F.lit("DiscountBond")).otherwise(F.col("coupon_type"))
    one_payment = F.col("pricing_type").isin("DiscountBond", "ZeroCouponBond")
    return (
        bonds.withColumns({"_known": known, "pricing_type": kind})
        .withColumns(
            {
                "pricing_maturity": F.coalesce("estimated_maturity_date", "maturity_date"),
                "pricing_frequency": F.coalesce(
                    F.col("pay_frequency"), F.when(one_payment, F.lit("Once"))
                ),
                start: F.col("_known"),
                end: F.slice(F.coalesce(end, F.array().cast("array<string>")), F.lit(1), F.size("_known")),
                rate: F.slice(F.coalesce(rate, F.array().cast("array<double>")), F.lit(1), F.size("_known")),
            }
        )
        .drop("_known")
    )
