"""As-of joins, fills, deduplication, returns, unit values, calendar."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from folioflow.functions.labels import rating_bucket
from folioflow.operators import calendar, classes, dedupe, nav, ordered
from folioflow.operators.filters import held_codes, restrict_to_codes
from folioflow.operators.reshape import tagged_union
from folioflow.queries.registry import NUDGE, day, query, rounded, table

RATED_SQL = """
rated AS (
  SELECT p.event_id, s.event_id AS rating_event,
         CASE CAST(floor(s.value) AS BIGINT) % 5 WHEN 0 THEN 'AAA+' WHEN 1 THEN 'AAA-' WHEN 2 THEN 'AA+'
              WHEN 3 THEN 'AA' WHEN 4 THEN '' END AS rating
  FROM events p
  ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s
    ON p.user_id = s.user_id AND p.ts >= s.ts
)"""


def _events(spark, sf_dir, kind):
    """All events; those of other kinds have no user, so they match nothing."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("user_id", F.when(F.col("event_type") == kind, F.col("user_id")))


def _asking(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts")


def _rated(spark, sf_dir):
    """Events with the user's latest signup, whose value stands for a rating."""
    grade = F.floor("value").cast("bigint") % 5
    names = F.array(*[F.lit(r) for r in ("AAA+", "AAA-", "AA+", "AA", "")])
    ratings = _events(spark, sf_dir, "signup").select(
        "user_id",
        "ts",
        F.col("event_id").alias("rating_event"),
        F.element_at(names, grade.cast("int") + 1).alias("rating"),
    )
    return ordered.asof_join(
        _asking(spark, sf_dir), ratings, ["user_id"], "ts", "ts", ["rating_event", "rating"],
        tie_break=["rating_event"],
    )


@query(f"WITH {RATED_SQL} SELECT event_id, coalesce(rating_event, -1) AS rating_event, rating FROM rated")
def asof_rating(spark, sf_dir):
    return _rated(spark, sf_dir).select("event_id", "rating_event", "rating").fillna(-1, ["rating_event"])


@query(f"""
WITH {RATED_SQL}
SELECT event_id, CASE WHEN rating IN ('AAA+', 'AAA', 'AAA-') THEN 'AAA' WHEN rating = 'AA+' THEN 'AA+'
                      WHEN rating <> '' THEN 'AA' END AS rating_type
FROM rated
""")
def asof_rating_bucket(spark, sf_dir):
    return _rated(spark, sf_dir).select("event_id", rating_bucket("rating").alias("rating_type"))


@query("""
SELECT p.event_id, coalesce(s.event_id, -1) AS next_event
FROM events p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s
  ON p.user_id = s.user_id AND p.ts <= s.ts
""")
def asof_forward(spark, sf_dir):
    later = _events(spark, sf_dir, "signup").select("user_id", "ts", F.col("event_id").alias("next_event"))
    return ordered.asof_join(
        _asking(spark, sf_dir), later, ["user_id"], "ts", "ts", ["next_event"], tie_break=["next_event"],
        direction="forward",
    ).select("event_id", "next_event").fillna(-1, ["next_event"])


def _brand_items(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("p_brand").alias("instrument_code"),
        day("l_shipdate").alias("trade_date"),
        "l_quantity",
        "l_extendedprice",
    )


@query(f"""
WITH priced AS (
  SELECT p_brand AS instrument_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS priced_on,
         sum(l_extendedprice) / sum(l_quantity) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
), items AS (
  SELECT l_orderkey, l_partkey, l_linenumber, p_brand AS instrument_code,
         CAST(l_shipdate AS DATE) AS trade_date
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
SELECT l_orderkey, l_partkey, l_linenumber, trade_date, priced_on, round(price + {NUDGE}, 4) AS price
FROM items i ASOF LEFT JOIN priced p
  ON i.instrument_code = p.instrument_code AND i.trade_date >= p.priced_on
""", dates="trade_date priced_on")
def asof_price(spark, sf_dir):
    items = _brand_items(spark, sf_dir)
    priced = items.groupBy("instrument_code", F.trunc("trade_date", "MM").alias("priced_on")).agg(
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price")
    )
    left = items.select("l_orderkey", "l_partkey", "l_linenumber", "instrument_code", "trade_date")
    found = ordered.asof_join(
        left, priced, ["instrument_code"], "trade_date", "priced_on", ["priced_on", "price"],
    )
    return rounded(found.drop("instrument_code"), 4, "price", nudge=NUDGE)


@query("""
WITH ranked AS (
  SELECT user_id, event_type, event_id, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS from_start,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS from_end
  FROM events
)
SELECT user_id, event_type, event_id, value FROM ranked WHERE from_start = 1
""")
def first_dedupe(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return dedupe.keep_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""
WITH ranked AS (
  SELECT user_id, event_type, event_id, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS from_end
  FROM events
)
SELECT user_id, event_type, event_id, value FROM ranked WHERE from_end = 1
""")
def latest_dedupe(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return dedupe.keep_last(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""
SELECT user_id, min_by(value, ts) FILTER (event_type IN ('view', 'click')) AS first_value,
       min_by(event_type, ts) AS first_type
FROM events GROUP BY user_id
""")
def first_known_attributes(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "ts",
        F.when(F.col("event_type").isin("view", "click"), F.col("value")).alias("first_value"),
        F.col("event_type").alias("first_type"),
    )
    return events.groupBy("user_id").agg(
        *dedupe.first_known(["first_value", "first_type"], ["ts"])
    )


def _gappy(spark, sf_dir):
    known = ~F.col("event_type").isin("error", "view")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(known, F.col("value")).alias("value")
    )


@query("""
SELECT event_id, user_id,
       last_value(CASE WHEN event_type NOT IN ('error', 'view') THEN value END IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM events
""")
def fill_forward(spark, sf_dir):
    filled = ordered.fill_forward(
        _gappy(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["value"]
    )
    return filled.drop("ts")


@query("""
SELECT event_id, user_id,
       first_value(CASE WHEN event_type NOT IN ('error', 'view') THEN value END IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value
FROM events
""")
def fill_backward(spark, sf_dir):
    filled = ordered.fill_backward(
        _gappy(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["value"]
    )
    return filled.drop("ts")


@query("""
SELECT event_id, user_id, lag(value) OVER w AS prev_value, lag(event_type) OVER w AS prev_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def previous_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    lagged = ordered.previous_row(
        events, ["user_id"], ["ts", "event_id"], {"value": "prev_value", "event_type": "prev_type"}
    )
    return lagged.select("event_id", "user_id", "prev_value", "prev_type")


@query(f"""
WITH prices AS (
  SELECT p_brand AS instrument_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
         sum(l_extendedprice) / sum(l_quantity) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
), changes AS (
  SELECT *, price / lag(price) OVER (PARTITION BY instrument_code ORDER BY trade_date) - 1 AS simple
  FROM prices
)
SELECT instrument_code, trade_date, round(price + {NUDGE}, 4) AS price, round(simple, 8) AS simple,
       round(ln(1 + simple), 8) AS log
FROM changes
""", dates="trade_date")
def simple_log_returns(spark, sf_dir):
    prices = (
        _brand_items(spark, sf_dir)
        .groupBy("instrument_code", F.trunc("trade_date", "MM").alias("trade_date"))
        .agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price"))
    )
    changes = nav.returns(prices, "price", simple="simple", log="log")
    return rounded(rounded(changes, 4, "price", nudge=NUDGE), 8, "simple", "log")


ASSETS_SQL = """
daily AS (
  SELECT o_custkey AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
         sum(o_totalprice) AS amount, sum(o_orderkey % 7 + 1) AS new_shares
  FROM orders GROUP BY 1, 2
), assets AS (
  SELECT instrument_code, trade_date, amount AS net_cptl_inflow_amt,
         sum(amount) OVER w AS close, CAST(sum(new_shares) OVER w AS DOUBLE) AS quantity,
         min(trade_date) OVER (PARTITION BY instrument_code) AS start_date
  FROM daily
  WINDOW w AS (PARTITION BY instrument_code ORDER BY trade_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), counted AS (
  SELECT *, CASE WHEN trade_date = start_date THEN close ELSE quantity END AS shares FROM assets
), valued AS (
  SELECT *, CASE WHEN trade_date = start_date THEN 1
            ELSE (close - net_cptl_inflow_amt)
                 / lag(shares) OVER (PARTITION BY instrument_code ORDER BY trade_date) END AS nav
  FROM counted
), computed AS (
  SELECT instrument_code, trade_date, close, nav AS close_adjusted,
         CASE WHEN trade_date = start_date THEN NULL
         ELSE nav / lag(nav) OVER (PARTITION BY instrument_code ORDER BY trade_date) - 1 END
           AS return_percentage
  FROM valued
)"""


def _assets(spark, sf_dir):
    """A customer's orders as inflows: net assets and shares are running totals."""
    daily = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("instrument_code"), day("o_orderdate").alias("trade_date")
    ).agg(F.sum("o_totalprice").alias("net_cptl_inflow_amt"), F.sum(F.col("o_orderkey") % 7 + 1).alias("new"))
    so_far = Window.partitionBy("instrument_code").orderBy("trade_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return daily.select(
        "instrument_code",
        "trade_date",
        "net_cptl_inflow_amt",
        F.sum("net_cptl_inflow_amt").over(so_far).alias("close"),
        F.sum("new").over(so_far).cast("double").alias("quantity"),
    )


def _computed_nav(spark, sf_dir):
    assets = _assets(spark, sf_dir)
    starts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("instrument_code")).agg(
        F.min(day("o_orderdate")).alias("start_date")
    )
    return nav.adjusted_nav(assets, starts)


@query(f"""
WITH {ASSETS_SQL}
SELECT instrument_code, trade_date, round(close, 2) AS close, round(close_adjusted + {NUDGE}, 4) AS close_adjusted,
       round(return_percentage, 8) AS return_percentage
FROM computed
""", dates="trade_date")
def adjusted_nav(spark, sf_dir):
    computed = _computed_nav(spark, sf_dir).drop("net_cptl_inflow_amt", "quantity")
    computed = rounded(rounded(computed, 2, "close"), 4, "close_adjusted", nudge=NUDGE)
    return rounded(computed, 8, "return_percentage")


@query(f"""
WITH {ASSETS_SQL},
stored AS (
  SELECT o_custkey AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
         max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS close_adjusted,
         CAST(NULL AS DOUBLE) AS return_percentage
  FROM orders GROUP BY 1, 2
)
SELECT s.instrument_code, s.trade_date,
       round(coalesce(s.close_adjusted, c.close_adjusted) + {NUDGE}, 4) AS close_adjusted,
       round(CASE WHEN s.close_adjusted IS NULL THEN c.return_percentage END, 8) AS return_percentage
FROM stored s LEFT JOIN computed c USING (instrument_code, trade_date)
""", dates="trade_date")
def fill_missing_nav(spark, sf_dir):
    known = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    stored = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("instrument_code"), day("o_orderdate").alias("trade_date")
    ).agg(F.max(known).alias("close_adjusted")).withColumn("return_percentage", F.lit(None).cast("double"))
    filled = nav.fill_missing_nav(stored, _computed_nav(spark, sf_dir))
    return rounded(rounded(filled, 4, "close_adjusted", nudge=NUDGE), 8, "return_percentage")


CALENDAR_SQL = """
calendar AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS calendar_date FROM orders
  WHERE dayofweek(CAST(o_orderdate AS DATE)) BETWEEN 1 AND 5
), ranked AS (
  SELECT calendar_date, row_number() OVER (ORDER BY calendar_date) AS rank, count(*) OVER () AS n_days
  FROM calendar
), ships AS (
  SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem
)"""


def _weekdays(spark, sf_dir):
    """Days with orders, Monday to Friday, as one calendar."""
    days = table(spark, sf_dir, "orders").select(day("o_orderdate").alias("calendar_date")).distinct()
    return days.where(F.dayofweek("calendar_date").between(2, 6)).withColumn("calendar_id", F.lit("CAL"))


def _shifted(spark, sf_dir, n):
    ships = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", day("l_shipdate").alias("ship_date")
    )
    return calendar.business_day_shift(ships, _weekdays(spark, sf_dir), "ship_date", n, "business_day")


_SHIFT_BACK_SQL = f"""
WITH {CALENDAR_SQL},
based AS (SELECT s.*, r.rank, r.n_days FROM ships s ASOF LEFT JOIN ranked r ON s.ship_date >= r.calendar_date)
SELECT l_orderkey, l_partkey, l_linenumber, ship_date, t.calendar_date AS business_day
FROM based b LEFT JOIN ranked t
  ON b.rank IS NOT NULL AND t.rank = greatest(1, b.rank - %d)
"""
_SHIFT_ON_SQL = f"""
WITH {CALENDAR_SQL},
based AS (SELECT s.*, r.rank, r.n_days FROM ships s ASOF LEFT JOIN ranked r ON s.ship_date <= r.calendar_date)
SELECT l_orderkey, l_partkey, l_linenumber, ship_date, t.calendar_date AS business_day
FROM based b LEFT JOIN ranked t ON t.rank = least(b.n_days, b.rank + %d)
"""


@query(_SHIFT_BACK_SQL % 5, dates="ship_date business_day")
def business_day_prev(spark, sf_dir):
    return _shifted(spark, sf_dir, 5)


@query(_SHIFT_ON_SQL % 3, dates="ship_date business_day")
def business_day_next(spark, sf_dir):
    return _shifted(spark, sf_dir, -3)


@query(_SHIFT_ON_SQL % 0, dates="ship_date business_day")
def business_day_on_or_after(spark, sf_dir):
    return _shifted(spark, sf_dir, 0)


@query("""
WITH days AS (
  SELECT DISTINCT o_orderpriority AS calendar_id, CAST(o_orderdate AS DATE) AS calendar_date FROM orders
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY calendar_id ORDER BY calendar_date DESC) AS rank
  FROM days WHERE calendar_date <= DATE '1998-12-31'
)
SELECT calendar_id, calendar_date, rank FROM ranked WHERE rank <= 253
""", dates="calendar_date")
def last_n_days(spark, sf_dir):
    import datetime

    days = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("calendar_id"), day("o_orderdate").alias("calendar_date")
    )
    last = calendar.last_business_days_by_calendar(days, datetime.date(1998, 12, 31), 252)
    return last.withColumn("rank", F.col("rank").cast("bigint"))


@query("""
SELECT 'CAL0004' AS scope, o_orderpriority AS calendar_id, CAST(o_orderdate AS DATE) AS calendar_date
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2, 3
UNION ALL
SELECT 'ALL' AS scope, o_orderpriority AS calendar_id, CAST(o_orderdate AS DATE) AS calendar_date
FROM orders GROUP BY 1, 2, 3
""", dates="calendar_date")
def calendar_tagged_union(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("calendar_id"), day("o_orderdate").alias("calendar_date")
    ).distinct()
    urgent = days.where(F.col("calendar_id") == "1-URGENT")
    return tagged_union({"CAL0004": urgent, "ALL": days}, "scope")


@query("""
SELECT p_brand AS calendar_id, CAST(l_shipdate AS DATE) AS calendar_date, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type = 'ECONOMY' AND l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1998-01-01'
GROUP BY 1, 2
""", dates="calendar_date")
def days_of_calendar(spark, sf_dir):
    import datetime

    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    days = items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        "p_brand", F.col("p_type").alias("calendar_id"), day("l_shipdate").alias("calendar_date")
    )
    of_type = calendar.days_of_calendar(
        days, "ECONOMY", datetime.date(1996, 1, 1), datetime.date(1997, 12, 31)
    )
    counted = of_type.groupBy("p_brand", "calendar_date").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumnRenamed("p_brand", "calendar_id")


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
WHERE l_partkey IN (
  SELECT l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal < 0
  UNION SELECT p_partkey FROM part WHERE p_type = 'PROMO')
""")
def held_quotes(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0)
    holdings = items.join(suppliers, items["l_suppkey"] == suppliers["s_suppkey"])
    held = held_codes(holdings, code="l_partkey")
    members = table(spark, sf_dir, "part").where(F.col("p_type") == "PROMO").select("p_partkey")
    quotes = items.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return restrict_to_codes(quotes, [held, members], "l_partkey")


@query("""
WITH history AS (
  SELECT user_id AS issuer_code, CAST(ts AS DATE) AS trade_date, max(event_type) AS sector_code
  FROM events WHERE event_id % 3 <> 0 GROUP BY 1, 2
), rows_ AS (
  SELECT event_id, user_id AS issuer_code, CAST(ts AS DATE) AS trade_date FROM events
)
SELECT event_id, sector_code FROM rows_ r ASOF LEFT JOIN history h
  ON r.issuer_code = h.issuer_code AND r.trade_date >= h.trade_date
""")
def sector_asof(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    history = events.select(
        F.col("user_id").alias("issuer_code"),
        day("ts").alias("trade_date"),
        F.col("event_type").alias("sector_code"),
        F.when(F.col("event_id") % 3 == 0, F.lit("076")).otherwise(F.lit("075")).alias("industry_code"),
    )
    rows = events.select("event_id", F.col("user_id").alias("issuer_code"), day("ts").alias("trade_date"))
    return classes.classify(rows, history, "075").select("event_id", "sector_code")


@query("""
SELECT DISTINCT p_brand AS sector_code, p_type AS sector_name FROM part
WHERE p_size % 5 IN (1, 4) AND p_brand IN ('Brand#1', 'Brand#3', 'Brand#7', 'Brand#12')
""")
def sector_names(spark, sf_dir):
    history = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("sector_code"),
        F.col("p_type").alias("sector_name"),
        (F.col("p_size") % 5).cast("string").alias("industry_code"),
    )
    brands = ["Brand#1", "Brand#3", "Brand#7", "Brand#12"]
    return classes.sector_names(history, codes=brands, systems=["1", "4"])


@query("""
WITH purchases AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS trade_date FROM events
), views AS (
  SELECT user_id, CAST(ts AS DATE) AS trade_date, max(value) AS cash_amt_aft
  FROM events WHERE event_type = 'view' GROUP BY 1, 2
)
SELECT event_id, coalesce(cash_amt_aft, 100) AS cash_amt_aft FROM purchases p
ASOF LEFT JOIN views v ON p.user_id = v.user_id AND p.trade_date >= v.trade_date
""")
def outstanding_default(spark, sf_dir):
    from folioflow.operators.bonds import outstanding_principal

    valued = _asking(spark, sf_dir).select("event_id", "user_id", day("ts").alias("trade_date"))
    paid = _events(spark, sf_dir, "view").select(
        "user_id", day("ts").alias("trade_date"), F.col("value").alias("cash_amt_aft")
    )
    rows = outstanding_principal(valued, paid, code="user_id", sliced=True)
    return rows.select("event_id", "cash_amt_aft")
