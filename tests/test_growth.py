"""Steps whose tasks, shuffles or driver traffic must not grow faster than the input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.operators import graph, positions
from folioflow.operators.ordered import asof_join
from folioflow.plans import BuildContext, build_dataset
from folioflow.plans.market_data import with_share_structure
from folioflow.sources import datasets, state
from folioflow.sources.tables import SourceTables

D = dt.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_are_not_shuffled_by_day_in_an_upsert(spark):
    schema = "code string, trade_date date, price double"
    stored = spark.createDataFrame([("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 2), 2.0), ("b", None, 3.0)], schema)
    batch = spark.createDataFrame([("c", D(2020, 1, 2), 9.0), ("c", None, 8.0)], schema)
    kept = datasets.not_held(stored, batch, ["trade_date"], few=True)
    assert "BroadcastHashJoin" in plan_of(kept) and "SortMergeJoin" not in plan_of(kept)
    assert [tuple(r) for r in kept.collect()] == [("a", D(2020, 1, 1), 1.0)]


def test_look_through_never_broadcasts_edges(spark):
    edges = spark.createDataFrame([(D(2020, 1, 1), "a", "b", 0.5)], "day date, root string, child string, share double")
    rates = edges.toDF("_day", "_owner", "_held", "_rate")
    for step in (graph._next_level(edges, rates), graph._product(edges, edges)):
        assert "SortMergeJoin" in plan_of(step) and "BroadcastHashJoin" not in plan_of(step)


def test_positions_are_shuffled_once_for_lag_and_term(spark):
    schema = "book_id string, instrument_code string, trade_date date, quantity double"
    rows = spark.createDataFrame([("a", "x", D(2020, 1, 1), 1.0), ("a", "x", D(2020, 1, 2), 2.0), (None, "x", None, 3.0)], schema)
    terms = spark.createDataFrame(
        [("a", "x", D(2020, 1, 2), 7.0), ("a", "x", D(2020, 1, 2), None), (None, "x", None, 5.0)],
        "book_id string, instrument_code string, trade_date date, remn_term double",
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        laid_out = rows.repartition("book_id", "instrument_code")
        done = positions.with_repo_term(laid_out, terms)
        join = plan_of(done).split("SortMergeJoin")[1]
        left = join[: join.index("Aggregate")]
        assert left.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_COL" in left, join
        got = sorted((r["book_id"] or "", r["quantity"], r["remn_term"]) for r in done.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # As a left join: a repeated term repeats the row, a null key has no term.
    assert got == [("", 3.0, 0.0), ("a", 1.0, 0.0), ("a", 2.0, 0.0), ("a", 2.0, 7.0)]


def test_shares_of_an_issuer_are_found_slice_by_slice(spark):
    quotes = spark.createDataFrame(
        [("p", "i", D(2020, 1, 1)), ("q", "i", D(2020, 3, 1)), ("p", "i", D(2020, 5, 1)), ("r", None, D(2020, 1, 1))],
        "instrument_code string, issuer_code string, trade_date date",
    )
    changes = spark.createDataFrame(
        [("i", D(2020, 2, 1), D(2020, 2, 1), None, 10.0, 5.0), ("i", D(2020, 4, 1), D(2020, 4, 1), 2.0, None, 6.0)],
        "issuer_code string, announced date, due_date date, preferred_stock double, shares_outstanding double, circulating_shares double",
    )
    done = with_share_structure(quotes, changes)
    assert "_slice" in plan_of(done)
    got = sorted((r["instrument_code"], r["trade_date"].month, r["preferred_stock"], r["shares_outstanding"], r["circulating_shares"]) for r in done.collect())
    assert got == [("p", 1, 2.0, 10.0, 5.0), ("p", 5, 2.0, 10.0, 6.0), ("q", 3, 2.0, 10.0, 5.0), ("r", 1, None, None, None)]


def test_last_rows_of_numbers_are_hashed_not_sorted(spark):
    data = [("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 2), None), ("b", None, 3.0), ("c", None, 4.0), ("c", D(2020, 1, 1), 5.0)]
    last = state.last_rows(spark.createDataFrame(data, "code string, trade_date date, price double"), ["code"], ["trade_date"])
    assert "SortAggregate" not in plan_of(last)
    assert sorted(map(tuple, last.collect())) == [("a", D(2020, 1, 2), None), ("b", None, 3.0), ("c", D(2020, 1, 1), 5.0)]


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def looked_through(spark):
    """Two books in two instruments, one owner each; a null day and a null book."""
    schema = "book_id string, trade_date date, instrument_code string, currency string, quantity double, cost double, market_value double, unit_cost double, valuation_price double"
    detail = spark.createDataFrame(
        [
            ("a", D(2020, 1, 1), "x", "c", 2.0, 3.0, 4.0, 1.0, 9.0),
            ("a", D(2020, 1, 1), "x", "c", 2.0, 5.0, 1.0, 2.0, 8.0),
            ("b", D(2020, 1, 1), "x", "c", 1.0, 7.0, 1.0, 2.0, 8.0),
            ("a", None, "x", "c", 1.0, 7.0, 1.0, 2.0, 8.0),
            (None, D(2020, 1, 1), "y", "c", 1.0, 7.0, 1.0, 2.0, 8.0),
        ],
        schema,
    )
    pairs = spark.createDataFrame(
        [("r", "a", D(2020, 1, 1), 0.5), ("s", "a", D(2020, 1, 1), 0.25), ("r", "b", D(2020, 1, 1), 0.1)],
        "root_book_id string, children_book_id string, trade_date date, invest_rate double",
    )
    keys = ["book_id", "currency", "trade_date", "instrument_code"]
    return lambda **how: positions.scaled_positions(positions.consolidate_positions(detail, keys, **how), pairs)


def test_consolidated_positions_meet_their_owners_where_they_lie(spark, no_broadcast):
    make = looked_through(spark)
    done = make(laid_out=["book_id", "trade_date"])
    plan = plan_of(done)
    held = plan[plan.index("SortMergeJoin") :]
    assert held.count("REPARTITION_BY_COL") == 1
    # One exchange of the positions, one of the pairs.
    assert held.count("Exchange hashpartitioning") == 2, plan
    assert sorted(map(tuple, done.collect())) == sorted(map(tuple, make().collect()))
    got = sorted((r["book_id"], r["invest_rate"], r["quantity"], r["cost"], r["market_value"]) for r in done.collect())
    assert got == [("r", 0.1, 0.1, 0.7000000000000001, 0.1), ("r", 0.5, 2.0, 2.0, 2.5), ("s", 0.25, 1.0, 1.0, 1.25)]


def test_positions_are_scaled_behind_their_shuffle(spark, no_broadcast):
    plan = plan_of(looked_through(spark)(laid_out=["book_id", "trade_date"]))
    laid_out = plan.index("REPARTITION_BY_COL")
    assert "* invest_rate" in plan[:laid_out] and "* invest_rate" not in plan[laid_out:], plan


def test_asof_rows_meet_carried_values_where_they_lie(spark, no_broadcast):
    left = spark.createDataFrame([("a", D(2020, 1, 5)), ("a", D(2020, 3, 5)), (None, D(2020, 3, 5))], "k string, day date")
    right = spark.createDataFrame([("a", D(2020, 1, 1), 7.0), (None, D(2020, 1, 1), 8.0)], "k string, known date, value double")
    done = asof_join(left, right, ["k"], "day", "known", ["value"])
    assert "isnull(_k0" not in plan_of(done)
    assert sorted(map(tuple, done.collect()), key=repr) == [("a", D(2020, 1, 5), 7.0), ("a", D(2020, 3, 5), 7.0), (None, D(2020, 3, 5), None)]


def test_stock_quotes_are_joined_once(spark, no_broadcast):
    day = D(2020, 1, 2)
    prices = "STK_CODE string, END_DATE date, CLS_PRC_ADJ double, PRE_CLS_PRC_ADJ double, PCT_CHG double"
    frames = {
        "INFO_STK_EODPRICE": spark.createDataFrame([(c, day, 2.0, 1.0, 3.0) for c in ("p", "q", "r", None)], prices),
        "INFO_STK_VALUATION": spark.createDataFrame([(c, day, 5.0, 6.0, 7.0) for c in ("p", "p", "r", None)], "STK_CODE string, END_DATE date, CV double, MV double, DVD_YLD double"),
        "INFO_IDX_WT_STK": spark.createDataFrame([("SEC024342013", c) for c in ("p", "p", "q", None)], "IDX_CODE string, CPN_CODE string").withColumn("TRD_DATE", F.lit(day)),
        "INFO_STK_BASICINFO": spark.createDataFrame([("p", "i"), ("p", "j")], "STK_CODE string, PARTY_CODE string"),
        "INFO_PARTY_SHRSTRUC": spark.createDataFrame([("i", day, 1.0, day, 10.0, 5.0)], "PARTY_CODE string, ANC_DATE date, SHR_PS double, CHG_DATE date, SHR_TTL double, SHR_CRC double"),
    }
    done = build_dataset("StockDailyQuote", BuildContext(SourceTables(spark, frames=frames)))
    # What is read from here on is the written quotes, not the price tables again.
    assert "CLS_PRC_ADJ" not in plan_of(done)
    # Code p: two valuations of the day and two issuers; q has no valuation, r is no member.
    got = sorted((r["instrument_code"], r["issuer_code"], r["shares_outstanding"]) for r in done.collect())
    assert got == [("p", "i", 10.0), ("p", "i", 10.0), ("p", "j", None), ("p", "j", None)]


def test_terms_meet_positions_where_they_lie(spark, no_broadcast):
    repos = spark.createDataFrame(
        [("a", "x", D(2020, 1, 1), 2.0, 1.0), ("a", "x", D(2020, 1, 1), 4.0, 3.0), ("a", None, D(2020, 1, 1), 4.0, 3.0)],
        "book_id string, instrument_code string, trade_date date, remn_term double, cost double",
    )
    rows = repos.select("book_id", "instrument_code", "trade_date").repartition("book_id", "instrument_code")
    terms = positions.weighted_term(repos, ["book_id", "trade_date", "instrument_code"], laid_out=["book_id", "instrument_code"])
    done = positions.with_repo_term(rows, terms)
    assert plan_of(done).count("Exchange hashpartitioning") == 2, plan_of(done)
    assert sorted(r["remn_term"] for r in done.collect()) == [0.0, 3.5, 3.5]
