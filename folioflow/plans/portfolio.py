"""Positions, assets, ownership, index members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from folioflow.columns import DEFAULT_INDEXES
from folioflow.functions.numeric import percent
from folioflow.operators.graph import look_through
from folioflow.operators.positions import (
    consolidate_positions,
    penetrate_positions,
    scaled_positions,
    weighted_term,
    with_previous,
    with_repo_term,
)
from folioflow.plans.build import BuildContext, builds, keeps_last_rows, rename_for, restrict

HELD_TO_MATURITY = "H"
DIRECT_HOLDINGS = "0"
POSITION_ORDER = (
    "trade_date", "currency", "market", "secu_type_code", "symbol", "instrument_name",
    "instrument_type", "held_to_maturity",
)


def _clean(positions: DataFrame) -> DataFrame:
    """Booleans for codes, zeros and empty names for nulls."""
    return positions.withColumns(
        {
            "held_to_maturity": F.coalesce(
                F.col("held_to_maturity") == HELD_TO_MATURITY, F.lit(False)
            ),
            "market_value": F.coalesce(F.col("market_value").cast("double"), F.lit(0.0)),
            "quantity": F.coalesce(F.col("quantity").cast("double"), F.lit(0.0)),
            "instrument_name": F.coalesce("instrument_name", F.lit("")),
        }
    )


#: Looked-through positions meet their owners by book and day.
BY_BOOK = ("book_id", "trade_date")


def position_detail(ctx: BuildContext, laid_out: Sequence[str] = ()) -> DataFrame:
    """Direct holdings of the span, consolidated and cleaned; no lags yet."""
    detail = ctx.table("INDIC_BASE_PORT_POS_DTL", "BIZ_DATE").where(
        F.col("DOWN_FLAG") == DIRECT_HOLDINGS
    )
    keys = [
        "book_id", "currency", "trade_date", "instrument_code", "secu_type_code", "symbol",
        "instrument_name", "held_to_maturity", "instrument_type", "market",
    ]
    rows = _clean(consolidate_positions(rename_for("CombPosition", detail), keys, laid_out=laid_out))
    return rows.replace("CASH_OTHER", "CASH", ["instrument_type"])


def repo_terms(ctx: BuildContext) -> DataFrame:
    repos = ctx.table("INDIC_BASE_REPO_POS_DTL", "BIZ_DATE").select(
        F.col("PRD_CODE").alias("book_id"),
        F.col("BIZ_DATE").cast("date").alias("trade_date"),
        F.col("SECU_CODE").alias("instrument_code"),
        F.col("REMN_TERM").cast("double").alias("remn_term"),
        F.col("POS_COST").cast("double").alias("cost"),
    )
    # As positions lie for their lags.
    return weighted_term(
        repos, ["book_id", "trade_date", "instrument_code"], laid_out=["book_id", "instrument_code"]
    )


keeps_last_rows("CombPosition", ("book_id", "instrument_code"), POSITION_ORDER)


@builds("CombPosition")
def comb_position(ctx: BuildContext) -> DataFrame:
    rows = with_previous(position_detail(ctx), POSITION_ORDER, earlier=ctx.earlier("CombPosition"))
    return with_repo_term(rows, repo_terms(ctx))


def _pairs(ctx: BuildContext) -> DataFrame:
    return look_through(ctx.dataset("DownRelationPortfolio").where(ctx.in_span("trade_date")))


@builds("CombPositionPenetrate")
def comb_position_penetrate(ctx: BuildContext) -> DataFrame:
    """The stored rows do not tell the share they were scaled with, which orders the rows of a
    day; so what came before the span is worked out from the sources."""
    before = ctx.before()
    earlier = scaled_positions(position_detail(before, BY_BOOK), _pairs(before)) if before else None
    return penetrate_positions(position_detail(ctx, BY_BOOK), _pairs(ctx), repo_terms(ctx), earlier=earlier)


@builds("DownRelationPortfolio")
def down_relation(ctx: BuildContext) -> DataFrame:
    return rename_for("DownRelationPortfolio", ctx.table("INDIC_DOWN_RELATION", "VALUATION_DATE"))


@builds("BondPosition")
def bond_position(ctx: BuildContext) -> DataFrame:
    detail = rename_for("BondPosition", ctx.table("INDIC_BASE_BOND_POS_DTL", "BIZ_DATE"))
    keys = [
        "book_id", "currency", "trade_date", "instrument_code", "secu_type_code", "symbol",
        "instrument_name", "held_to_maturity", "market", "rmn_cost", "shadow_market_value",
    ]
    return _clean(consolidate_positions(detail, keys))


@builds("CombAsset")
def comb_asset(ctx: BuildContext) -> DataFrame:
    return rename_for("CombAsset", ctx.table("DM_PORT_ASSET", "BUSI_DATE"))


@builds("StockIndexPortfolio")
def stock_index_portfolio(ctx: BuildContext) -> DataFrame:
    members = ctx.table("INFO_IDX_WT_STK", "TRD_DATE")
    if ctx.codes is None:
        members = members.where(F.col("IDX_CODE").isin(*DEFAULT_INDEXES))
    rows = rename_for("StockIndexPortfolio", restrict(members, ctx.codes, "IDX_CODE"))
    return rows.withColumn("quantity", percent("quantity"))
