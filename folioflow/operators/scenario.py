"""Stress scenarios: factor moves, curve moves by tenor."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.functions.dates import compact_date_text
from folioflow.operators.reshape import union_all, unpivot_measures

# Curve move columns and the tenor each stands for.
CURVE_TENORS = {
    "ZERO_MONTH_DATA": "0Y",
    "ONE_MONTH_DATA": "0.08Y",
    "TWO_MONTH_DATA": "0.17Y",
    "THREE_MONTH_DATA": "0.25Y",
    "SIX_MONTH_DATA": "0.5Y",
    "NINE_MONTH_DATA": "0.75Y",
    "ONE_YEAR_DATA": "1Y",
    "TWO_YEAR_DATA": "2Y",
    "THREE_YEAR_DATA": "3Y",
    "FOUR_YEAR_DATA": "4Y",
    "FIVE_YEAR_DATA": "5Y",
    "SIX_YEAR_DATA": "6Y",
    "SEVEN_YEAR_DATA": "7Y",
    "EIGHT_YEAR_DATA": "8Y",
    "NINE_YEAR_DATA": "9Y",
    "TEN_YEAR_DATA": "10Y",
    "FIFTEEN_YEAR_DATA": "15Y",
    "TWENTY_YEAR_DATA": "20Y",
    "THIRTY_YEAR_DATA": "30Y",
    "FORTY_YEAR_DATA": "40Y",
    "FIFTY_YEAR_DATA": "50Y",
}
CURVE_FACTOR, CHANGE_VALUES = 2, 2

_IDS = ["trade_date", "scene_id", "index", "factor_type", "factor_name", "modification_type"]


def _named_moves(scenes: DataFrame, moves: DataFrame, factors: DataFrame) -> DataFrame:
    """Moves of existing scenarios with the code of their factor."""
    named = (
        moves.withColumn("trade_date", compact_date_text(moves, "TRADING_DATE"))
        .join(scenes.select(F.col("ID").alias("SCENE_ID")), "SCENE_ID")
        .join(factors.select(F.col("ID").alias("FACTOR_ID"), "FACTOR_CODE"), "FACTOR_ID")
    )
    return named.withColumnsRenamed(
        {
            "SCENE_ID": "scene_id",
            "FACTOR_CODE": "index",
            "FACTOR_TYPE": "factor_type",
            "FACTOR_NAME": "factor_name",
            "MODIFICATION_TYPE": "modification_type",
            "MODIFICATION_VALUE": "modification_value",
        }
    )


def scenario_factors(
    scenes: DataFrame, moves: DataFrame, curve_moves: DataFrame, factors: DataFrame
) -> DataFrame:
    """Curve moves, one row per tenor that has a value, and the moves of all other factors."""
    named = _named_moves(scenes, moves, factors)
    by_tenor = curve_moves.where(F.col("TYPE") == CHANGE_VALUES).select(
        F.col("SCENE_FACTOR_REL_ID").alias("ID"), *CURVE_TENORS
    )
    curves = unpivot_measures(
        named.join(by_tenor, "ID"), _IDS, CURVE_TENORS, "tenor", "modification_value"
    )
    others = named.where(F.col("factor_type") != CURVE_FACTOR).select(*_IDS, "modification_value")
    return union_all([curves, others])
