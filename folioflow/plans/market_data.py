"""Quotes, valuations, curves, rates, ratings, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.columns import DEFAULT_INDEXES
from folioflow.functions.numeric import percent
from folioflow.operators import curves
from folioflow.operators.bonds import outstanding_principal
from folioflow.operators.calendar import scoped_calendar
from folioflow.operators.dedupe import first_known, keep_first, keep_last
from folioflow.operators.filters import RATING_AGENCIES, restrict_to_codes
from folioflow.operators.nav import adjusted_nav, fill_missing_nav, returns
from folioflow.operators.ordered import asof_join
from folioflow.operators.reshape import union_all, union_distinct
from folioflow.plans.build import BuildContext, builds, keeps_last_rows, rename_for, restrict
from folioflow.schemas import DATASETS
from folioflow.sources.storage import staged

# Source codes that select rows.
MID_PRICE, PUBLISHER = "001", "001"
VALUATION_SOURCE = "001"
EXPECTED_CASHFLOW = 0
INDUSTRY_PARAMETER = "020601"
BOND_CURVE_KIND = "023"
CURVE_FACTOR_KIND = 2
REPO_FIXING = "FR001001"
MEMBER_INDEX = "SEC024342013"
DIRECT_HOLDINGS = "0"


@builds("BenchmarkDailyIndustryReturn")
def benchmark_daily_industry_return(ctx: BuildContext) -> DataFrame:
    return rename_for("BenchmarkDailyIndustryReturn", ctx.table("INDIC_DERI_BHMARK_INDU", "BUSI_DATE"))


@builds("BenchmarkDailyQuote")
def benchmark_daily_quote(ctx: BuildContext) -> DataFrame:
    quotes = ctx.table("INFO_IDX_EODVALUE", "TRD_DATE")
    if ctx.codes is None:
        quotes = quotes.where(F.col("IDX_CODE").isin(*DEFAULT_INDEXES))
    rows = rename_for("BenchmarkDailyQuote", restrict(quotes, ctx.codes, "IDX_CODE"))
    return rows.withColumn("return_percentage", percent("return_percentage"))


@builds("BondDailyQuote")
def bond_daily_quote(ctx: BuildContext) -> DataFrame:
    quotes = restrict(ctx.table("INFO_FI_EODPRICE", "TRD_DATE"), ctx.held("BOND"), "BOND_CODE")
    measures = ["volume", "trade_amount", "high", "low", "turnover"]
    rows = rename_for("BondDailyQuote", quotes).select("instrument_code", "trade_date", *measures)
    return keep_first(rows, ["instrument_code", "trade_date"], measures)


def expected_cashflow(ctx: BuildContext) -> DataFrame:
    flows = ctx.table("INFO_FI_CASHFLOW").where(F.col("IS_ACT_CF") == EXPECTED_CASHFLOW)
    return flows.select(
        F.col("BOND_CODE").alias("instrument_code"),
        F.col("CASH_DATE").cast("date").alias("trade_date"),
        F.col("PAY_INT").cast("double").alias("interest"),
        F.col("PRCP_CASH").cast("double").alias("principal"),
        F.col("CASH_AMT_AFT").cast("double").alias("cash_amt_aft"),
    )


@builds("BondValCNBD")
def bond_val_cnbd(ctx: BuildContext) -> DataFrame:
    held = ctx.held("BOND")
    values = ctx.table("INFO_FI_VAL_CNBD", "TRD_DATE").where(
        F.col("YIELD").isNotNull() & (F.col("DATA_SRC") == VALUATION_SOURCE)
    )
    rows = rename_for("BondValCNBD", restrict(values, held, "BOND_CODE")).withColumns(
        {"ytm": percent("ytm"), "trade_date": F.col("trade_date").cast("date")}
    )
    flows = restrict(expected_cashflow(ctx), held, "instrument_code")
    paid = rows.join(flows.drop("cash_amt_aft"), ["instrument_code", "trade_date"], "left")
    return outstanding_principal(paid.fillna(0.0, ["interest", "principal"]), flows)


@builds("BondValCSI")
def bond_val_csi(ctx: BuildContext) -> DataFrame:
    held = ctx.held("BOND")
    values = ctx.table("INFO_FI_VAL_CSI", "TRD_DATE").where(F.col("YIELD").isNotNull())
    rows = rename_for("BondValCSI", restrict(values, held, "BOND_CODE")).withColumns(
        {"ytm": percent("ytm"), "trade_date": F.col("trade_date").cast("date")}
    )
    flows = restrict(expected_cashflow(ctx), held, "instrument_code").drop("cash_amt_aft")
    return rows.join(flows, ["instrument_code", "trade_date"], "left")


@builds("FiYieldCurve")
def fi_yield_curve(ctx: BuildContext) -> DataFrame:
    return rename_for("FiYieldCurve", ctx.table("INFO_FI_CFETS_YIELD_CURV", "TRD_DATE"))


def product_values(ctx: BuildContext) -> DataFrame:
    """Stored unit values of products; missing adjusted values are computed from the assets."""
    values = ctx.table("INDIC_BASE_PORT_IDX", "BIZ_DATE").join(
        ctx.table("INDIC_DERI_PORT_PRFT_IDX", "BIZ_DATE"), ["PRD_CODE", "BIZ_DATE"]
    )
    stored = values.select(
        F.col("PRD_CODE").alias("instrument_code"),
        F.col("BIZ_DATE").cast("date").alias("trade_date"),
        F.col("UNIT_NAV").cast("double").alias("close"),
        F.col("DAY_UNIT_NAV_GROW_RATE").cast("double").alias("return_percentage"),
        F.col("ADJ_UNIT_NAV").cast("double").alias("close_adjusted"),
    )
    assets = ctx.table("DM_PORT_ASSET")
    held = assets.where(F.col("DOWN_FLAG") == DIRECT_HOLDINGS)
    if ctx.end is not None:
        # Values look back only. A row without a day comes before all others.
        held = held.where(F.col("BUSI_DATE").isNull() | (F.col("BUSI_DATE").cast("date") <= F.lit(ctx.end)))
    direct = rename_for("CombAsset", held).select(
        "instrument_code",
        F.col("trade_date").cast("date").alias("trade_date"),
        *[F.col(c).cast("double").alias(c) for c in ("close", "quantity", "net_cptl_inflow_amt")],
    )
    starts = assets.groupBy(F.col("PRODUCT_CODE").alias("instrument_code")).agg(
        F.min(F.col("SET_UP_DATE").cast("date")).alias("start_date")
    )
    return fill_missing_nav(stored, adjusted_nav(direct, starts).where(ctx.in_span("trade_date")))


keeps_last_rows("FundDailyQuote", ("instrument_code",), ("trade_date",))


@builds("FundDailyQuote")
def fund_daily_quote(ctx: BuildContext) -> DataFrame:
    listed = restrict(ctx.table("INFO_FUND_EODPRICE", "END_DATE"), ctx.held("FUND"), "FUND_CODE")
    listed = rename_for("FundDailyQuote", listed).withColumns(
        {"return_percentage": percent("return_percentage"), "trade_date": F.col("trade_date").cast("date")}
    )
    return returns(union_all([listed, product_values(ctx)]), earlier=ctx.earlier("FundDailyQuote"))


@builds("FxExchRate")
def fx_exch_rate(ctx: BuildContext) -> DataFrame:
    quotes = ctx.table("INFO_FX_EXCHRATE", "END_DATE").where(
        (F.col("PRC_TYPE") == MID_PRICE) & (F.col("PUB_ORG") == PUBLISHER)
    )
    return rename_for("FxExchRate", quotes)


def curve_codes(ctx: BuildContext) -> list[DataFrame]:
    """Codes asked for, else those of the sample curves and of the scenario curves."""
    if ctx.codes is not None:
        return [ctx.codes]
    scenario = ctx.table("PLATO_CFG_FACTOR").where(F.col("FACTOR_TYPE") == CURVE_FACTOR_KIND)
    return [ctx.dataset("YieldCurveCNBDSample").select("index"), scenario.select("FACTOR_CODE")]


def _bond_curves(ctx: BuildContext) -> DataFrame:
    points = ctx.table("INFO_FI_CNBD_YIELD_CURV", "TRD_DATE")
    return restrict_to_codes(points, curve_codes(ctx), "CURV_CODE").select(
        F.col("CURV_CODE").alias("index"),
        F.col("CURV_CNAME").alias("index_name"),
        F.col("TRD_DATE").cast("date").alias("trade_date"),
        F.col("STD_TERM").cast("double").alias("tenor"),
        F.col("FWD_TERM_N").cast("double").alias("tenor2"),
        F.col("YIELD").cast("double").alias("rate"),
    )


def _rates(ctx: BuildContext, table: str, day: str, rate: str, named: bool = False) -> DataFrame:
    return ctx.table(table, day).select(
        F.col("IR_CODE").alias("index"),
        *([F.col("CNAME").alias("index_name")] if named else []),
        F.col(day).cast("date").alias("trade_date"),
        F.col(rate).cast("double").alias("rate"),
    )


def _with_rate_info(ctx: BuildContext, rates: DataFrame) -> DataFrame:
    """Names and symbols from the rate master; rates it does not know drop out."""
    info = ctx.table("INFO_FI_IR_BASICINFO").select(
        F.col("IRCODE").alias("index"),
        F.col("CNAME").alias("index_name"),
        F.col("SYMBOL").alias("symbol"),
    )
    return rates.join(info, "index")


@builds("IndexRate")
def index_rate(ctx: BuildContext) -> DataFrame:
    kinds = curves.curve_types(ctx.table("INFO_FI_IR_BASICINFO"), ctx.table("INFO_PARA_INFO"))
    return curves.reference_rates(
        _bond_curves(ctx),
        _rates(ctx, "INFO_FI_BNK_DL_IR", "CHG_START_DATE", "INTR_RAT", named=True),
        _rates(ctx, "INFO_FI_GLOBAL_IBOR", "TRD_DATE", "INTR_RAT", named=True),
        kinds,
    )


@builds("TimeSeries")
def time_series(ctx: BuildContext) -> DataFrame:
    bond_kind = ctx.table("INFO_FI_IR_BASICINFO").where(F.col("IRTYPE") == BOND_CURVE_KIND)
    swaps = ctx.table("INFO_FI_CFETS_YIELD_CURV", "TRD_DATE").select(
        F.col("CURV_CODE").alias("index"),
        F.col("TRD_DATE").cast("date").alias("trade_date"),
        F.col("STD_TERM").cast("double").alias("tenor"),
        F.col("YIELD").cast("double").alias("rate"),
    )
    fixing = _rates(ctx, "INFO_FI_MM_QUO", "TRD_DATE", "CLS_QUO_IR")
    return curves.time_series(
        ctx.dataset("StockDailyQuote").where(ctx.in_span("trade_date")),
        ctx.dataset("FundDailyQuote").where(ctx.in_span("trade_date")),
        restrict_to_codes(_bond_curves(ctx), [bond_kind.select("IRCODE")], "index").select(
            "index", "trade_date", "tenor", "rate"
        ),
        swaps,
        _rates(ctx, "INFO_FI_BNK_DL_IR", "CHG_START_DATE", "INTR_RAT", named=True),
        _with_rate_info(ctx, _rates(ctx, "INFO_FI_GLOBAL_IBOR", "TRD_DATE", "INTR_RAT")),
        _with_rate_info(ctx, fixing.where(F.col("index") == REPO_FIXING)),
    )


@builds("IndustryClassificationMktData")
def industry_classification(ctx: BuildContext) -> DataFrame:
    systems = ctx.table("INFO_PARA_INFO").where(F.col("PARA_OBJ") == INDUSTRY_PARAMETER)
    names = systems.select(
        F.col("PARA_CODE").alias("industry_code"), F.col("PARA_NAME").alias("industry_name")
    )
    history = rename_for("IndustryClassificationMktData", ctx.table("INFO_PARTY_INDUSTRY"))
    return history.join(names, "industry_code")


@builds("InstrumentRating")
def instrument_rating(ctx: BuildContext) -> DataFrame:
    ratings = ctx.table("INFO_FI_BONDRATING", "ANC_DATE").where(F.col("RAT_ORG").isin(*RATING_AGENCIES))
    return rename_for("InstrumentRating", ratings)


@builds("IssuerRating")
def issuer_rating(ctx: BuildContext) -> DataFrame:
    return rename_for("IssuerRating", ctx.table("INFO_PARTY_RATING", "ANC_DATE"))


@builds("Calendar")
def calendar(ctx: BuildContext) -> DataFrame:
    defaults = ctx.table("CALENDARS").where(F.col("IS_DEFAULT_CALENDAR") == 1)
    dates = ctx.table("CALENDAR_DATES").where(F.col("IS_TRADING_DAY") == 1)
    return scoped_calendar(
        defaults.select(F.col("CALENDAR_ID").alias("calendar_id")),
        dates.select(
            F.col("CALENDAR_ID").alias("calendar_id"),
            F.col("CALENDAR_DATE").cast("date").alias("calendar_date"),
        ),
    )


SHARE_COLUMNS = ("preferred_stock", "due_date", "shares_outstanding", "circulating_shares")


def with_share_structure(quotes: DataFrame, changes: DataFrame) -> DataFrame:
    """Share counts as of each day per issuer; days before the first change take the first.

    Of several changes announced on one day the latest change date counts. An issuer may have
    any number of instruments, so its days are cut into slices.
    """
    per_day = keep_last(changes, ["issuer_code", "announced"], ["due_date", *SHARE_COLUMNS])
    asof = asof_join(
        quotes,
        per_day,
        ["issuer_code"],
        "trade_date",
        "announced",
        {c: f"_{c}" for c in SHARE_COLUMNS},
        per_column=True,
    )
    first = per_day.groupBy("issuer_code").agg(*first_known(SHARE_COLUMNS, ["announced"]))
    return asof.join(first, "issuer_code", "left").select(
        *quotes.columns, *[F.coalesce(f"_{c}", c).alias(c) for c in SHARE_COLUMNS]
    )


@builds("StockDailyQuote")
def stock_daily_quote(ctx: BuildContext) -> DataFrame:
    prices = ctx.table("INFO_STK_EODPRICE", "END_DATE")
    members = ctx.table("INFO_IDX_WT_STK", "TRD_DATE").where(F.col("IDX_CODE") == MEMBER_INDEX)
    held = ctx.held("STOCK")
    wanted = [members.select("CPN_CODE")] if held is None else [held, members.select("CPN_CODE")]
    issuers = ctx.table("INFO_STK_BASICINFO").select("STK_CODE", "PARTY_CODE")
    # By code and day first, as both sides lie; then by code alone, restricted and named at once.
    # The codes are distinct, so this is the semi join, which Spark would move below the first.
    codes = union_distinct([c.select(F.col(c.columns[0]).alias("STK_CODE")) for c in wanted])
    rows = prices.join(ctx.table("INFO_STK_VALUATION", "END_DATE"), ["STK_CODE", "END_DATE"]).join(
        codes, "STK_CODE"
    ).join(issuers, "STK_CODE", "left")
    quotes = rename_for("StockDailyQuote", rows).withColumns(
        {
            "trade_date": F.col("trade_date").cast("date"),
            "return_percentage": percent("return_percentage"),
            "dividend_yield": percent("dividend_yield"),
        }
    )
    # Read three times from here on (rows, last values of their slices, rows without a key), so
    # written once instead of joined three times.
    named = [f.name for f in DATASETS["StockDailyQuote"].schema if f.name in quotes.columns]
    quotes = staged(quotes.select(*named))
    # All announcements, whatever the span: days before an issuer's first take that one.
    changes = ctx.table("INFO_PARTY_SHRSTRUC").select(
        F.col("PARTY_CODE").alias("issuer_code"),
        F.col("ANC_DATE").cast("date").alias("announced"),
        F.col("SHR_PS").cast("double").alias("preferred_stock"),
        F.col("CHG_DATE").cast("date").alias("due_date"),
        F.col("SHR_TTL").cast("double").alias("shares_outstanding"),
        F.col("SHR_CRC").cast("double").alias("circulating_shares"),
    )
    return returns(with_share_structure(quotes, changes), previous="prev_close_adjusted")


@builds("VolatilitySurface")
def volatility_surface(ctx: BuildContext) -> DataFrame:
    return rename_for("VolatilitySurface", ctx.table("OPTION_VOLATILITY_SURFACE"))


@builds("YieldCurveCNBDSample")
def yield_curve_sample(ctx: BuildContext) -> DataFrame:
    rows = restrict(ctx.table("INFO_FI_YC_CNBD_SAMPLE", "TRD_DATE"), ctx.held("BOND"), "BOND_CODE")
    return rename_for("YieldCurveCNBDSample", rows)
