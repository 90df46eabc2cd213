"""Instrument master data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.functions.dates import date_text
from folioflow.functions.labels import (
    BOARD_INDEX_CODES,
    BOARD_INDEX_NAMES,
    CALCULATION_WAYS,
    COUPON_TYPES,
    DAY_COUNTS,
    FLOAT_ADJUST_MODES,
    INTEREST_RATE_TYPES,
    PAY_FREQUENCIES,
    label,
    symbol_with_market,
)
from folioflow.functions.numeric import basis_points, number, percent
from folioflow.operators.bonds import bond_master
from folioflow.operators.reshape import union_all
from folioflow.plans.build import BuildContext, builds, rename_for

OTHER_CLASS = "其他"
REPAY_BY_SHARE, RIGHT_RECORDS, PUBLIC_ISSUE = "001", "002", "001"


@builds("BenchMarkInfo")
def benchmark_info(ctx: BuildContext) -> DataFrame:
    rows = rename_for("BenchMarkInfo", ctx.table("PERFORMANCE_BENCHMARKS"))
    return rows.withColumn("instrument_type", F.lit("BENCH_MARK"))


@builds("StockIndexInfo")
def stock_index_info(ctx: BuildContext) -> DataFrame:
    rows = rename_for("StockIndexInfo", ctx.table("INFO_IDX_BASICINFO"))
    return rows.withColumn("instrument_type", F.lit("STOCK_INDEX"))


@builds("FundInfo")
def fund_info(ctx: BuildContext) -> DataFrame:
    own = ctx.table("PROD_FUNDS").select(
        F.col("FUND_CODE").alias("instrument_code"), F.col("FUND_NAME").alias("instrument_name")
    )
    listed = ctx.table("INFO_FUND_BASICINFO").select(
        F.col("FUND_CODE").alias("instrument_code"),
        F.col("CSNAME").alias("instrument_name"),
        F.col("DELIST_DATE").cast("date").alias("delist_date"),
    )
    return union_all([own, listed]).withColumn("instrument_type", F.lit("FUND"))


@builds("StockInfo")
def stock_info(ctx: BuildContext) -> DataFrame:
    stocks = ctx.table("INFO_STK_BASICINFO")
    return stocks.select(
        F.col("STK_CODE").alias("instrument_code"),
        F.col("SYMBOL").alias("symbol"),
        F.col("PARTY_CODE").alias("issuer_code"),
        F.col("LIST_STATUS").cast("string").alias("list_status"),
        date_text("LIST_DATE", null_as="").alias("list_date"),
        date_text("DELIST_DATE", null_as="").alias("delist_date"),
        F.col("EXCH_CODE").alias("exchange_code"),
        F.lit("STOCK").alias("instrument_type"),
        label("LIST_BRD", BOARD_INDEX_CODES, "").alias("index"),
        label("LIST_BRD", BOARD_INDEX_NAMES, "").alias("index_name"),
        F.col("SEC_TYPE").alias("sec_type"),
    )


def bond_basics(basic: DataFrame, issues: DataFrame) -> DataFrame:
    """Bonds with a maturity, their issue terms, codes turned into labels.

    `ISS_MODE` may be a column of either table.
    """
    terms = issues.select(
        "BOND_CODE", "PAR_VALUE", "REF_FLD", *[c for c in issues.columns if c == "ISS_MODE"]
    )
    rows = basic.join(terms, "BOND_CODE", "left").where(F.col("ISS_MODE") == PUBLIC_ISSUE)
    rows = rename_for("BondInfo", rows.where(F.col("ACT_DUE_DATE").isNotNull()))
    rows = rows.withColumns(
        {
            "symbol": symbol_with_market("symbol", "market"),
            "day_count": label("day_count", DAY_COUNTS),
            "coupon_type": label("coupon_type", COUPON_TYPES),
            "interest_rate_type": label("interest_rate_type", INTEREST_RATE_TYPES),
            "pay_frequency": label("pay_frequency", PAY_FREQUENCIES),
            "frn_adjust_rate": label("frn_adjust_rate", FLOAT_ADJUST_MODES, 2).cast("long"),
            "calc_way": label("calc_way", CALCULATION_WAYS, 9).cast("long"),
            "reference_rate_issue": percent("reference_rate_issue"),
            "par_rate_issue": percent("par_rate_issue"),
            "spread": percent("spread"),
            "start_date": F.col("start_date").cast("date"),
            "instrument_type": F.lit("BOND"),
        }
    )
    pays_once = F.col("coupon_type") == "ZeroCouponBond"
    return rows.withColumn(
        "pay_frequency", F.when(pays_once, F.lit("Once")).otherwise(F.col("pay_frequency"))
    )


@builds("BondInfo")
def bond_info(ctx: BuildContext) -> DataFrame:
    repayments = ctx.table("INFO_FI_ADVANCE_REPAY").where(
        (F.col("ADV_PAY_MODE") == REPAY_BY_SHARE)
        & F.col("ADV_PAY_RAT").isNotNull()
        & F.col("ADV_PAY_DATE").isNotNull()
    )
    rights = ctx.table("INFO_FI_RIT_EMB_XCS").where(
        (F.col("DATA_TYPE") == RIGHT_RECORDS) & F.col("XCS_THRT_DATE").isNotNull()
    )
    coupons = ctx.table("INFO_FI_IR_DETAILED")
    classes = ctx.table("INFO_ZG_SEC_CLASSIFICATION")
    levels = ["CLS_CODE_1ST", "CLS_CODE_2ND", "CLS_CODE_3RD", "CLS_CODE_4TH"]
    code = F.col("BOND_CODE").alias("instrument_code")
    return bond_master(
        bond_basics(ctx.table("INFO_FI_BASICINFO"), ctx.table("INFO_FI_BONDISSUE")),
        repayments.select(
            code,
            F.col("ADV_PAY_DATE").cast("date").alias("trade_date"),
            percent("ADV_PAY_RAT").alias("advance_repay_ratio"),
        ),
        rights.select(
            code,
            F.col("XCS_THRT_DATE").cast("date").alias("trade_date"),
            F.col("RIT_TYPE").alias("rit_type"),
            number("XCS_PRC").alias("strike_price"),
            basis_points("HI_IR_ADJ").alias("high_interest_rate_adj"),
            basis_points("LO_IR_ADJ").alias("low_interest_rate_adj"),
        ),
        coupons.select(
            code,
            F.col("IR_START_DATE").cast("date").alias("interest_start_date"),
            F.col("IR_END_DATE").cast("date").alias("interest_end_date"),
            percent("IP_PAR_IR").alias("interest_period_interest_rate"),
        ),
        classes.select(F.col("SEC_CODE").alias("instrument_code"), *levels).fillna(OTHER_CLASS, levels),
    )
