"""Sectors, ratings and asset classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from folioflow.functions.labels import rating_bucket
from folioflow.operators.ordered import asof_join
from folioflow.operators.reshape import union_distinct


def classify(
    df: DataFrame, history: DataFrame, system: str, sliced: bool = True
) -> DataFrame:
    """Sector of each row's issuer on its day, in one classification system."""
    of_system = history.where(F.col("industry_code") == system)
    return asof_join(
        df,
        of_system,
        ["issuer_code"],
        "trade_date",
        "trade_date",
        ["sector_code"],
        tie_break=["sector_code"],
        sliced=sliced,
    )


def rate_instruments(
    df: DataFrame, ratings: DataFrame, sliced: bool = True
) -> DataFrame:
    """Latest rating of each instrument on its day, and the bucket of that rating."""
    rated = _latest_rating(df, ratings, "instrument_code", sliced)
    return rated.withColumn("rating_type", rating_bucket("rating"))


def rate_issuers(
    df: DataFrame, ratings: DataFrame, sliced: bool = True
) -> DataFrame:
    """Latest rating of each issuer on its day."""
    return _latest_rating(df, ratings, "issuer_code", sliced)


def _latest_rating(df, ratings, code, sliced) -> DataFrame:
    return asof_join(
        df,
        ratings,
        [code],
        "trade_date",
        "trade_date",
        ["rating"],
        tie_break=["rating_organization", "rating"],
        sliced=sliced,
    )


def sector_names(
    history: DataFrame, codes: Sequence[str] = (), systems: Sequence[str] = ()
) -> DataFrame:
    """Distinct sector codes and names, of chosen sectors or systems."""
    if codes:
        history = history.where(F.col("sector_code").isin(list(codes)))
    if systems:
        history = history.where(F.col("industry_code").isin(list(systems)))
    return history.select("sector_code", "sector_name").distinct()


def _classes(classes: DataFrame, types: DataFrame, type_column: str) -> DataFrame:
    named = classes.select(
        F.col(type_column).alias("cls_type"),
        F.col("CLS_CODE").alias("cls_code"),
        F.col("CLS_NAME").alias("cls_name"),
    )
    return named.join(types.select(F.col("CLS_TYPE_CODE").alias("cls_type")), "cls_type")


def asset_classes(
    system: DataFrame, system_types: DataFrame, own: DataFrame, own_types: DataFrame
) -> DataFrame:
    """Classes of the system and of the user, each once."""
    return union_distinct(
        [_classes(system, system_types, "CLS_TYPE"), _classes(own, own_types, "CLS_TYPE_CODE")]
    ).select("cls_type", "cls_code", "cls_name")


def security_classes(links: DataFrame, system: DataFrame, own: DataFrame) -> DataFrame:
    """Every security's classes, in the system's and the user's classifications. A class counts
    once, so the links of a code are bounded by the classifications that have it."""
    base = links.select(
        F.col("SECU_CODE").alias("instrument_code"),
        F.col("SYMBOL").alias("symbol"),
        F.col("SECU_NAME").alias("instrument_name"),
        F.col("CLS_CODE").alias("cls_code"),
        F.col("CLS_NAME").alias("_link_name"),
    )
    of_system = base.withColumn("cls_name", F.col("_link_name")).join(
        system.select(F.col("CLS_CODE").alias("cls_code"), F.col("CLS_TYPE").alias("cls_type")).distinct(),
        "cls_code",
    )
    of_user = base.join(
        own.select(
            F.col("CLS_CODE").alias("cls_code"),
            F.col("CLS_TYPE_CODE").alias("cls_type"),
            F.col("CLS_NAME").alias("cls_name"),
        ).distinct(),
        "cls_code",
    )
    columns = ["instrument_code", "symbol", "instrument_name", "cls_type", "cls_code", "cls_name"]
    return of_system.select(*columns).unionByName(of_user.select(*columns))
