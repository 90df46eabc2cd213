"""Fills, lags and as-of joins, whole and sliced, against brute force."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from folioflow.operators.dedupe import first_known, keep_first, keep_last
from folioflow.operators.ordered import (
    asof_join,
    fill_backward,
    fill_forward,
    previous_row,
    slice_of,
)

START = date(2024, 1, 1)


def random_rows(seed, n=300):
    """Three keys, one of them with most rows; dates repeat, some values are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        value = rng.randint(0, 99) if rng.random() < 0.4 else None
        rows.append((i, key, START + timedelta(days=rng.randint(0, 60)), value))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, key string, day date, value int")


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


@pytest.mark.parametrize("sliced", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_fill_forward_and_backward(spark, seed, sliced):
    rows = random_rows(seed)
    forward, backward = {}, {}
    for group in by_key(rows).values():
        last = None
        for r in group:
            last = r[3] if r[3] is not None else last
            forward[r[0]] = last
        last = None
        for r in reversed(group):
            last = r[3] if r[3] is not None else last
            backward[r[0]] = last
    df = frame(spark, rows)
    got = fill_forward(df, ["key"], ["day", "id"], ["value"], sliced).collect()
    assert {r["id"]: r["value"] for r in got} == forward and len(got) == len(rows)
    got = fill_backward(df, ["key"], ["day", "id"], ["value"], sliced).collect()
    assert {r["id"]: r["value"] for r in got} == backward and len(got) == len(rows)


@pytest.mark.parametrize("sliced", [False, True])
def test_previous_row(spark, sliced):
    rows = random_rows(3)
    want = {}
    for group in by_key(rows).values():
        for before, r in zip([None] + group, group):
            want[r[0]] = (before[3], before[0]) if before else (None, None)
    got = previous_row(
        frame(spark, rows), ["key"], ["day", "id"], {"value": "p", "id": "q"}, sliced
    ).collect()
    assert {r["id"]: (r["p"], r["q"]) for r in got} == want


def brute_asof(left, right, forward=False):
    out = {}
    for i, key, day, _ in left:
        best = None
        for j, rkey, rday, value in right:
            if key is None or rkey != key or value is None:
                continue
            if forward and rday >= day and (best is None or (rday, value, j) < best[:3]):
                best = (rday, value, j)
            if not forward and rday <= day and (best is None or (rday, value, j) > best[:3]):
                best = (rday, value, j)
        out[i] = best[1] if best else None
    return out


@pytest.mark.parametrize("sliced", [False, True])
@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("seed", [5, 6])
def test_asof_join(spark, seed, direction, sliced):
    left, right = random_rows(seed, 150), random_rows(seed + 100, 150)
    known = frame(spark, right).where("value is not null").withColumnRenamed("value", "found")
    got = asof_join(
        frame(spark, left), known, ["key"], "day", "day", ["found"], tie_break=["found", "id"],
        direction=direction, sliced=sliced,
    ).collect()
    assert len(got) == len(left)
    assert {r["id"]: r["found"] for r in got} == brute_asof(left, right, direction == "forward")


def test_asof_same_day_counts_and_names_may_differ(spark):
    left = spark.createDataFrame([("x", START)], "code string, day date")
    right = spark.createDataFrame(
        [("x", START, 1, None), ("x", START - timedelta(days=3), 2, 7)],
        "other string, since date, a int, b int",
    )
    row = asof_join(left, right, [("code", "other")], "day", "since", ["a", "b"]).first()
    assert (row["a"], row["b"]) == (1, None)
    row = asof_join(
        left, right, [("code", "other")], "day", "since", {"a": "a1", "b": "b1"}, per_column=True
    ).first()
    assert (row["a1"], row["b1"]) == (1, 7)


ORDERS = {
    "string": [None, "", "1", "10", "2", "59", "ab", "abc", "b", "é", "éa", "Z"],
    "double": [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.5, 0.5, 1e300, -1e300, 3.25, 3.5, 1e-9],
    "decimal(20,4)": [None, *[Decimal(x) for x in ("-12.5", "-0.0001", "0", "0.0001", "7", "99999999.9999")]],
    "timestamp": [None, *[datetime(2020, 1, 1) + timedelta(days=17 * i, hours=i) for i in range(12)]],
    "boolean": [None, False, True],
    "int": [None, -(2**31), -7, 0, 1, 2, 3, 1000, 2**31 - 1],
}


@pytest.mark.parametrize("kind", list(ORDERS))
def test_slices_change_nothing_whatever_the_order_type(spark, kind):
    rng = random.Random(4)
    rows = [(i, rng.choice("xy"), rng.choice(ORDERS[kind]), rng.choice([None, i])) for i in range(120)]
    df = spark.createDataFrame(rows, f"id int, key string, o {kind}, value int")
    for fill in (fill_forward, fill_backward):
        plain, cut = (
            sorted((r["id"], r["value"]) for r in fill(df, ["key"], ["o", "id"], ["value"], s).collect())
            for s in (False, True)
        )
        assert plain == cut
    lags = [
        sorted(((r["id"], r["p"]) for r in previous_row(df, ["key"], ["o", "id"], {"id": "p"}, s).collect()), key=repr)
        for s in (False, True)
    ]
    assert lags[0] == lags[1]
    placed = df.withColumn("s", slice_of(df, "o")).orderBy("o").select("s").collect()
    assert [r["s"] for r in placed] == sorted(r["s"] for r in placed)


def test_large_keys_are_cut_without_a_job(spark):
    df = frame(spark, random_rows(7))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    sliced = fill_forward(df, ["key"], ["day", "id"], ["value"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert df.select(slice_of(df, "day")).distinct().count() > 1 and sliced.count() == df.count()


def test_the_first_row_looks_back_to_earlier_ones(spark):
    rows = random_rows(9)
    key = lambda r: (r[2], r[0])
    cut = START + timedelta(days=30)
    whole = previous_row(frame(spark, rows), ["key"], ["day", "id"], {"value": "p"})
    want = {r["id"]: r["p"] for r in whole.collect() if r["day"] >= cut}
    late = frame(spark, [r for r in sorted(rows, key=key) if r[2] >= cut])
    early = frame(spark, [r for r in rows if r[2] < cut])
    for sliced in (False, True):
        got = previous_row(late, ["key"], ["day", "id"], {"value": "p"}, sliced, earlier=early)
        assert {r["id"]: r["p"] for r in got.collect()} == want and set(got.columns) == {*late.columns, "p"}


def test_dedupe_keeps_first_and_last(spark):
    df = spark.createDataFrame(
        [("a", 2, "x", None), ("a", 1, None, 5), ("b", 3, "z", 1)], "k string, o int, s string, v int"
    )
    first = {r["k"]: (r["o"], r["s"]) for r in keep_first(df, ["k"], ["o"]).collect()}
    last = {r["k"]: (r["o"], r["s"]) for r in keep_last(df, ["k"], ["o"]).collect()}
    assert first == {"a": (1, None), "b": (3, "z")} and last == {"a": (2, "x"), "b": (3, "z")}
    known = df.groupBy("k").agg(*first_known(["s", "v"], ["o"])).where("k = 'a'").first()
    assert (known["s"], known["v"]) == ("x", 5)
    assert keep_first(df, ["k"], ["o"]).columns == df.columns


def test_fill_reads_its_input_once(spark):
    """The tails of the slices reuse the exchange of the rows: one scan of the input."""
    import re

    from folioflow.operators.ordered import fill_forward

    path = f"{spark.sparkContext.getCheckpointDir()}/fill-once"
    spark.range(2000).selectExpr(
        "id % 3 AS k", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS d", "IF(id % 5 = 0, id, NULL) AS v"
    ).write.mode("overwrite").parquet(path)
    filled = fill_forward(spark.read.parquet(path), ["k"], ["d"], ["v"])
    rows = filled.collect()
    plan = filled._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", plan)) == 1 and "ReusedExchange" in plan
    expected = {}
    for k in range(3):
        last = None
        for i in range(k, 2000, 3):
            last = i if i % 5 == 0 else last
            expected[(k, i)] = last
    assert {(r["k"], (r["d"] - __import__("datetime").date(2020, 1, 1)).days): r["v"] for r in rows} == expected
