"""Trades: booked and implied."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.operators.positions import bond_position_changes, stock_position_changes
from folioflow.operators.trades import net_trades_buy_sell, net_trades_signed
from folioflow.plans.build import BuildContext, builds, rename_for, restrict

KEYS = ["book_id", "trade_date", "instrument_code"]


@builds("BondTradeInfo")
def bond_trades(ctx: BuildContext) -> DataFrame:
    trades = restrict(ctx.table("INDIC_BASE_TX_BOND", "TX_DATE"), ctx.held("BOND"), "SECU_CODE")
    return net_trades_signed(
        rename_for("BondTradeInfo", trades),
        KEYS,
        "TX_TYPE_CODE",
        ["notional", "trade_amount", "settlement_amount"],
        ["acr_int"],
    )


@builds("StockTradeInfo")
def stock_trades(ctx: BuildContext) -> DataFrame:
    trades = ctx.table("INDIC_BASE_TX_STOCK", "CLR_DATE").withColumnsRenamed(
        {"PRD_CODE": "book_id", "CLR_DATE": "trade_date", "SECU_CODE": "instrument_code"}
    )
    return net_trades_buy_sell(trades, KEYS, "TX_TYPE_CODE", "TRAN_AMT", "TX_FEE", "TRAN_QTY")


def _looked_through(ctx: BuildContext, instrument_type: str) -> DataFrame:
    positions = ctx.dataset("CombPositionPenetrate")
    return positions.where(
        (F.col("instrument_type") == instrument_type) & ctx.in_span("trade_date")
    )


@builds("BondTradePenetrateInfo")
def bond_trades_looked_through(ctx: BuildContext) -> DataFrame:
    return bond_position_changes(_looked_through(ctx, "BOND"))


@builds("StockTradePenetrateInfo")
def stock_trades_looked_through(ctx: BuildContext) -> DataFrame:
    return stock_position_changes(_looked_through(ctx, "STOCK"))
