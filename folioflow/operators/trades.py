"""Trades netted per book, day and instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from folioflow.functions.numeric import signed, total

# Side codes.
BOND_BUY, BOND_SELL = "T02.02.000.001", "T02.02.000.002"
STOCK_BUY, STOCK_SELL = "T01.01.000.001", "T01.01.000.002"


def net_trades_signed(
    trades: DataFrame,
    keys: Sequence[str],
    side: str,
    signed_measures: Sequence[str],
    unsigned_measures: Sequence[str] = (),
    buy: str = BOND_BUY,
    sell: str = BOND_SELL,
    drop_null_keys: bool = True,
) -> DataFrame:
    """Buys count plus, sells minus. A row of another side adds nothing to the signed measures;
    the unsigned ones (accrued interest) are summed as they are."""
    rows = trades.dropna(subset=list(keys)) if drop_null_keys else trades
    sign = signed(side, buy, sell)
    return rows.groupBy(*keys).agg(
        *[total(F.col(m).cast("double") * sign).alias(m) for m in signed_measures],
        *[total(F.col(m).cast("double")).alias(m) for m in unsigned_measures],
    )


def net_trades_buy_sell(
    trades: DataFrame,
    keys: Sequence[str],
    side: str,
    amount: str,
    fee: str,
    quantity: str,
    buy: str = STOCK_BUY,
    sell: str = STOCK_SELL,
) -> DataFrame:
    """Bought and sold amounts, fees of both sides, bought minus sold quantity.

    One conditional aggregate gives what a full join of the two sides would.
    """
    rows = trades.dropna(subset=list(keys)).where(F.col(side).isin(buy, sell))
    bought, sold = F.col(side) == buy, F.col(side) == sell
    return rows.groupBy(*keys).agg(
        total(fee).alias("trading_fee"),
        total(F.when(bought, F.col(quantity)).when(sold, -F.col(quantity))).alias("notional"),
        total(F.when(bought, F.col(amount))).alias("buy_amount"),
        total(F.when(sold, F.col(amount))).alias("sell_amount"),
    )
