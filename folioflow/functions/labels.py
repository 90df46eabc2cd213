"""Labels: code maps, tenor labels, rating buckets, symbols."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from folioflow.functions.dates import as_column

# Rate code to tenor, as labels in years.
IBOR_TENOR_YEARS = {
    "CN002001": "5Y",
    "SH001001": "0.0027Y",
    "SH001002": "0.0194Y",
    "SH001003": "0.0389Y",
    "SH001004": "0.0833Y",
    "SH001005": "0.25Y",
    "SH001006": "0.5Y",
    "SH001007": "0.75Y",
    "SH001008": "1Y",
    "SH002001": "1Y",
}
# Rate code to tenor, as market names.
IBOR_TENOR_NAMES = {
    "CN002001": "5Y",
    "SH001001": "1D",
    "SH001002": "1W",
    "SH001003": "2W",
    "SH001004": "1M",
    "SH001005": "3M",
    "SH001006": "6M",
    "SH001007": "9M",
    "SH001008": "1Y",
    "SH002001": "1Y",
}
MONEY_MARKET_TENORS = {"FR001001": "7D"}
# Swap curve names and the names of its terms below one year.
SWAP_CURVE_NAMES = {
    "CFE100372": "SHIB3M",
    "CFE100432": "SHIBON",
    "CFE100552": "FR007",
    "CFE101562": "FDR007",
}
SWAP_TERM_NAMES = {"0.0833": "1M", "0.25": "3M", "0.5": "6M", "0.75": "9M"}

# Bond codes.
DAY_COUNTS = {
    "001": "A/365",
    "002": "Act/Act",
    "003": "A/360",
    "004": "30/360",
    "006": "A/366",
    "007": "A/365F",
    "008": "AVG/ACT",
}
COUPON_TYPES = {
    "001": "ZeroCouponBond",
    "002": "DiscountBond",
    "003": "CouponBond",
    "999": "ELSE",
}
INTEREST_RATE_TYPES = {
    "001": "FixedRateBond",
    "002": "FloatRateBond",
    "003": "FixedRateBond",
    "999": "ELSE",
}
PAY_FREQUENCIES = {
    "001": "Annual",
    "002": "Semiannual",
    "003": "Once",
    "004": "Quarterly",
    "005": "Monthly",
    "006": "OtherFrequency",
    "007": "OtherFrequency",
    "008": "EveryFourthMonth",
    "009": "OtherFrequency",
    "010": "OtherFrequency",
    "011": "Bimonthly",
    "999": "NoFrequency",
}
FLOAT_ADJUST_MODES = {"001": 1, "002": 4, "003": 2, "005": 3, "999": 2}
CALCULATION_WAYS = {"001": 2, "002": 1, "999": 9}

# Listing board to index code and index name.
BOARD_INDEX_CODES = {"001": "SEC026261761", "003": "SEC024022199", "004": "SEC045336986"}
BOARD_INDEX_NAMES = {"001": "上证综指", "003": "创业板指数", "004": "上证科创板50成份指数"}


def label(code: Column | str, mapping: Mapping, default=None) -> Column:
    """Look a code up in a small fixed mapping; `default` (or null) if it is not there."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), as_column(code))
    return found if default is None else F.coalesce(found, F.lit(default))


def tenor_label(years: Column | str) -> Column:
    """5.0 gives `5Y`, 0.25 gives `0.25Y`."""
    years = as_column(years).cast("double")
    whole = F.when(years == F.floor(years), years.cast("long").cast("string"))
    return F.concat(F.coalesce(whole, years.cast("string")), F.lit("Y"))


def swap_tenor_label(years: Column | str) -> Column:
    """Whole years give `5Y`; shorter terms take their market name, others none."""
    years = as_column(years).cast("double")
    return F.when(years == F.floor(years), tenor_label(years)).otherwise(
        label(years.cast("string"), SWAP_TERM_NAMES)
    )


def rating_bucket(rating: Column | str) -> Column:
    """AAA+, AAA and AAA- are one bucket, AA+ its own, every other rating is AA."""
    rating = as_column(rating)
    return (
        F.when(rating.isin("AAA+", "AAA", "AAA-"), F.lit("AAA"))
        .when(rating == "AA+", F.lit("AA+"))
        .when(rating != "", F.lit("AA"))
    )


def symbol_with_market(symbol: Column | str, market: Column | str) -> Column:
    return F.concat(as_column(symbol), F.lit("."), as_column(market))
