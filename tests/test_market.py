"""Calendar, unit values, curves, bonds, statements, classes by hand."""

import random
from datetime import date, timedelta

import numpy as np
import pytest

from folioflow.functions.dates import compact_date_text, parse_day
from folioflow.functions.labels import rating_bucket, swap_tenor_label, tenor_label
from folioflow.functions.numeric import log_return, simple_return
from folioflow.operators import bonds, classes, curves, nav, reshape, statements
from folioflow.operators.calendar import business_day_shift, last_business_days

D = [date(2022, 1, d) for d in range(1, 32)]


def shift(spark, days, dates, n):
    calendar = spark.createDataFrame([("c", d) for d in days], "calendar_id string, calendar_date date")
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    rows = business_day_shift(df, calendar, "d", n, "to").collect()
    return {r["d"]: r["to"] for r in rows}


def reference_shift(days, x, n):
    """The rule in words: a list of days on one side, cut to |n| + 1, its last entry."""
    if n > 0:
        side = sorted((d for d in days if d <= x), reverse=True)[: n + 1]
    elif n < 0:
        side = sorted(d for d in days if d >= x)[: -n + 1]
    else:
        side = sorted((d for d in days if d >= x), reverse=True)
    return side[-1] if side else None


@pytest.mark.parametrize("n", [1, 3, 0, -1, -4, 100, -100])
def test_business_day_shift(spark, n):
    days = [d for d in D if d.weekday() < 5 and d.day not in (5, 20)]
    dates = [D[0] - timedelta(days=3)] + D + [D[-1] + timedelta(days=9)]
    assert shift(spark, days, dates, n) == {x: reference_shift(days, x, n) for x in dates}


def test_shift_there_and_back(spark):
    days = [d for d in (D[0] + timedelta(days=i) for i in range(90)) if d.weekday() < 5 and d.day % 18]
    inner = days[10:-10]
    there = shift(spark, days, inner, 4)
    back = shift(spark, days, list(there.values()), -4)
    assert all(back[there[d]] == d for d in inner)


def test_shift_by_calendar_column(spark):
    calendar = spark.createDataFrame(
        [("a", D[3]), ("a", D[5]), ("b", D[4])], "calendar_id string, calendar_date date"
    )
    df = spark.createDataFrame([("a", D[6]), ("b", D[6]), ("z", D[6])], "calendar_id string, d date")
    got = {r["calendar_id"]: r["to"] for r in business_day_shift(df, calendar, "d", 1, "to").collect()}
    assert got == {"a": D[3], "b": D[4], "z": None}
    last = last_business_days(calendar, D[5], 1).collect()
    assert [r["calendar_date"] for r in last] == [D[5], D[4]]


def test_adjusted_nav(spark):
    rows = [
        ("p", D[2], 110.0, 5.0, 105.0), ("p", D[0], 100.0, 0.0, 90.0), ("p", D[1], 102.0, 2.0, 80.0),
        ("q", D[0], 50.0, 0.0, 0.0), ("q", D[1], 60.0, 0.0, 50.0), ("q", D[2], 75.0, 0.0, 50.0),
    ]
    assets = spark.createDataFrame(
        rows, "instrument_code string, trade_date date, close double, net_cptl_inflow_amt double, quantity double"
    )
    starts = spark.createDataFrame([("p", D[0])], "instrument_code string, start_date date")
    got = {
        (r["instrument_code"], r["trade_date"]): (r["close_adjusted"], r["return_percentage"])
        for r in nav.adjusted_nav(assets, starts).collect()
    }
    assert got[("p", D[0])] == (1.0, None)
    assert got[("p", D[1])] == (1.0, 0.0)
    assert got[("p", D[2])] == (105 / 80, 105 / 80 - 1)
    assert got[("q", D[0])] == (None, None) and got[("q", D[1])] == (None, None)
    assert got[("q", D[2])][0] == 1.5
    stored = spark.createDataFrame(
        [("p", D[2], None, None), ("p", D[1], 9.0, 0.5), ("z", D[1], None, 0.1)],
        "instrument_code string, trade_date date, close_adjusted double, return_percentage double",
    )
    filled = {
        (r["instrument_code"], r["trade_date"]): r["close_adjusted"]
        for r in nav.fill_missing_nav(stored, nav.adjusted_nav(assets, starts)).collect()
    }
    assert filled == {("p", D[2]): 105 / 80, ("p", D[1]): 9.0, ("z", D[1]): None}


def test_returns_skip_zero_and_null(spark):
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 1.0), (1.0, 0.0), (None, 1.0)], "p double, q double")
    got = [r[0] for r in df.select(simple_return("p", "q")).collect()]
    assert got == [1.0, None, None, None]
    logs = spark.createDataFrame([(0.0,), (-1.0,), (None,)], "r double").select(log_return("r")).collect()
    assert [r[0] for r in logs] == [0.0, None, None]
    quotes = spark.createDataFrame(
        [("a", D[1], 4.0), ("a", D[0], 2.0), ("b", D[1], 3.0)],
        "instrument_code string, trade_date date, close_adjusted double",
    )
    got = {(r[0], r[1]): r[3] for r in nav.returns(quotes).collect()}
    assert got == {("a", D[0]): None, ("a", D[1]): 1.0, ("b", D[1]): None}


def test_interpolation_equals_numpy(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for curve in ("u", "v", "w"):
        dates = {d: {0.08: 1.5} if curve == "w" else {} for d in D[:3]}
        for d in D[:3]:
            for _ in range(rng.randint(1, 6)):
                dates[d][rng.choice([0.0, 0.07, 0.08, 0.0833, 0.17, 0.29, 0.5, 0.58, 1.0, 2.0, 3.37])] = rng.random()
        top = max(t for knots in dates.values() for t in knots)
        grid = sorted({round(i / 365, 2) for i in range(int(top * 365 + 1))})
        for d, knots in dates.items():
            xs = sorted(knots)
            rows += [(curve, d, x, knots[x]) for x in xs]
            for g, y in zip(grid, np.interp(grid, xs, [knots[x] for x in xs])):
                want[(curve, d, g)] = y
    df = spark.createDataFrame(rows, "index string, trade_date date, tenor double, rate double")
    got = {(r[0], r[1], r[2]): r[3] for r in curves.interpolate_curve(df).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_labels(spark):
    df = spark.createDataFrame([(5.0,), (0.25,), (0.0833,), (0.3,), (0.0,)], "t double")
    got = [(r[0], r[1]) for r in df.select(tenor_label("t"), swap_tenor_label("t")).collect()]
    assert got == [("5Y", "5Y"), ("0.25Y", "3M"), ("0.0833Y", "1M"), ("0.3Y", None), ("0Y", "0Y")]
    ratings = spark.createDataFrame([("AAA-",), ("AA+",), ("AA",), ("",), (None,)], "r string")
    assert [r[0] for r in ratings.select(rating_bucket("r")).collect()] == ["AAA", "AA+", "AA", None, None]
    text = spark.createDataFrame([("2022-01-04",), ("20220104",), ("x",), (None,)], "d string")
    assert [r[0] for r in text.select(parse_day("d")).collect()] == [D[3], D[3], None, None]
    assert [r[0] for r in text.select(compact_date_text(text, "d")).collect()][0] == "20220104"


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0)], "k string, x double, y double")
    long = reshape.unpivot_measures(df, ["k"], {"x": "0.5Y", "y": "1Y"}, "tenor", "v")
    assert {tuple(r) for r in long.collect()} == {("a", "0.5Y", 1.0), ("b", "0.5Y", 2.0), ("b", "1Y", 3.0)}
    wide = reshape.pivot_series(long, ["k"], "tenor", ["0.5Y", "1Y"], "v")
    assert {tuple(r) for r in wide.collect()} == {("a", 1.0, None), ("b", 2.0, 3.0)}


def test_outstanding_principal(spark):
    values = spark.createDataFrame([("b", D[0]), ("b", D[4]), ("b", D[9]), ("c", D[9])], "instrument_code string, trade_date date")
    flows = spark.createDataFrame(
        [("b", D[4], 60.0), ("b", D[6], None), ("b", D[8], 40.0)],
        "instrument_code string, trade_date date, cash_amt_aft double",
    )
    got = {(r[0], r[1]): r[2] for r in bonds.outstanding_principal(values, flows).collect()}
    assert got == {("b", D[0]): 100.0, ("b", D[4]): 60.0, ("b", D[9]): 40.0, ("c", D[9]): 100.0}


def test_coupon_periods_and_inputs(spark):
    coupons = spark.createDataFrame(
        [("b", D[9], D[19], 0.02), ("b", D[0], D[9], None), ("b", D[19], D[29], 0.03), ("b", D[19], D[29], 0.04)],
        "instrument_code string, interest_start_date date, interest_end_date date, interest_period_interest_rate double",
    )
    row = bonds.coupon_periods(coupons).first()
    assert row["interest_start_date"] == ["20220101", "20220110", "20220120", "20220120"]
    assert row["interest_period_interest_rate"] == [0.0, 0.02, 0.03, 0.04]
    assert row["coupon_change_map"] == '{"20220101":0.0,"20220110":0.02,"20220120":0.04}'
    basic = spark.createDataFrame(
        [("b", "ZeroCouponBond", 95.0, None, D[30], None, "20220112"), ("c", "CouponBond", 95.0, D[29], D[30], None, "2022-01-12")],
        "instrument_code string, coupon_type string, issue_price double, estimated_maturity_date date, "
        "maturity_date date, pay_frequency string, settle_date string",
    )
    joined = basic.join(bonds.coupon_periods(coupons), "instrument_code", "left")
    got = {r["instrument_code"]: r for r in bonds.coupon_inputs(joined).collect()}
    assert got["b"]["interest_start_date"] == ["20220101", "20220110"]
    assert got["b"]["interest_end_date"] == ["20220110", "20220120"]
    assert (got["b"]["pricing_type"], got["b"]["pricing_frequency"], got["b"]["pricing_maturity"]) == (
        "DiscountBond", "Once", D[30],
    )
    assert (got["c"]["pricing_type"], got["c"]["pricing_frequency"], got["c"]["pricing_maturity"]) == (
        "CouponBond", None, D[29],
    )
    assert got["c"]["interest_start_date"] == []


def test_right_maps(spark):
    rights = spark.createDataFrame(
        [("b", D[1], "002", 101.0, 0.01, None), ("b", D[0], "002", 102.0, None, 0.02), ("b", D[0], "001", 99.0, 0.03, 0.04)],
        "instrument_code string, trade_date date, rit_type string, strike_price double, "
        "high_interest_rate_adj double, low_interest_rate_adj double",
    )
    row = bonds.right_maps(rights).first()
    assert row["call_option_map"] == '{"20220101":102.0,"20220102":101.0}'
    assert row["put_option_map"] == '{"20220101":99.0}'
    assert row["high_interest_rate_adj"] == '{"20220101":100000.0,"20220102":0.01}'
    assert row["low_interest_rate_adj"] == '{"20220101":0.02,"20220102":100000.0}'


def test_statements_match_null_keys_and_keep_duplicates(spark):
    schema = "issuer_code string, report_type string, {} double"
    a = spark.createDataFrame([("x", None, 1.0), ("y", "r", 2.0)], schema.format("a"))
    b = spark.createDataFrame([("x", None, 5.0), ("x", None, 6.0)], schema.format("b"))
    c = spark.createDataFrame([("z", "r", 50.0)], schema.format("c"))
    d = spark.createDataFrame([("y", "r", 7.0)], schema.format("d"))
    merged = statements.merge_statements(a, b, c, d, ["issuer_code", "report_type"], ["c"])
    got = sorted((tuple(r) for r in merged.collect()), key=str)
    assert got == [
        ("x", None, 1.0, 5.0, None, None), ("x", None, 1.0, 6.0, None, None),
        ("y", "r", 2.0, None, None, 7.0), ("z", "r", None, None, 0.5, None),
    ]


def test_classify_and_rate(spark):
    history = spark.createDataFrame(
        [("i", D[0], "075", "s1"), ("i", D[5], "075", "s2"), ("i", D[6], "076", "s3")],
        "issuer_code string, trade_date date, industry_code string, sector_code string",
    )
    rows = spark.createDataFrame([("i", D[4]), ("i", D[5]), ("i", D[9]), ("j", D[9])], "issuer_code string, trade_date date")
    got = {(r[0], r[1]): r[2] for r in classes.classify(rows, history, "075").collect()}
    assert got == {("i", D[4]): "s1", ("i", D[5]): "s2", ("i", D[9]): "s2", ("j", D[9]): None}
    ratings = spark.createDataFrame(
        [("b", "AA+", D[1], "002"), ("b", "AAA-", D[3], "003"), ("b", "AA", D[3], "002")],
        "instrument_code string, rating string, trade_date date, rating_organization string",
    )
    held = spark.createDataFrame([("b", D[0]), ("b", D[2]), ("b", D[3])], "instrument_code string, trade_date date")
    got = {r["trade_date"]: (r["rating"], r["rating_type"]) for r in classes.rate_instruments(held, ratings).collect()}
    assert got == {D[0]: (None, None), D[2]: ("AA+", "AA+"), D[3]: ("AAA-", "AAA")}


def test_key_tenors(spark):
    curve = spark.createDataFrame(
        [("c", "n", D[0], 0.08, 1.0, 3.0), ("c", "n", D[0], 0.0833, 1.0, 3.0), ("c", "n", D[0], 5.0, 0.5, None)],
        "index string, index_name string, trade_date date, tenor double, tenor2 double, rate double",
    )
    row = curves.bond_curve_rates(curve).collect()
    assert [(r["tenor"], r["tenor2"], r["rate"]) for r in row] == [("0.08Y", "1Y", 0.03)]
    assert row[0]["currency"] == "cny"
