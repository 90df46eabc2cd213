"""Curves, rates, series, coupons, statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions.labels import swap_tenor_label, tenor_label
from folioflow.operators import bonds, curves, reshape, statements
from folioflow.operators.filters import KEY_TENORS
from folioflow.queries.registry import FINE_NUDGE, day, month, query, rounded, table, year

KNOTS_SQL = """
knots AS (
  SELECT p_brand AS index, CAST(date_trunc('year', l_shipdate) AS DATE) AS trade_date,
         CAST(p_size AS DOUBLE) / 5.0e0 AS tenor, sum(l_extendedprice) / sum(l_quantity) / 1000.0e0 AS rate
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3
)"""


def _knots(spark, sf_dir):
    """A brand's yearly mean price by size as a curve: size / 5 is the tenor."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).groupBy(
        F.col("p_brand").alias("index"),
        year("l_shipdate").alias("trade_date"),
        (F.col("p_size").cast("double") / 5.0).alias("tenor"),
    ).agg((F.sum("l_extendedprice") / F.sum("l_quantity") / 1000.0).alias("rate"))


GRID_SQL = KNOTS_SQL + """,
tops AS (SELECT index, max(tenor) AS top FROM knots GROUP BY 1),
grid AS (
  SELECT DISTINCT k.index, k.trade_date, round(i / 365.0e0, 2) AS tenor
  FROM (SELECT DISTINCT index, trade_date FROM knots) k
  JOIN tops t ON k.index = t.index,
  LATERAL (SELECT unnest(generate_series(0, CAST(floor(t.top * 365) AS BIGINT))) AS i)
),
placed AS (
  SELECT g.index, g.trade_date, g.tenor, l.tenor AS x0, l.rate AS y0, r.tenor AS x1, r.rate AS y1
  FROM grid g
  ASOF LEFT JOIN knots l ON g.index = l.index AND g.trade_date = l.trade_date AND g.tenor >= l.tenor
  ASOF LEFT JOIN knots r ON g.index = r.index AND g.trade_date = r.trade_date AND g.tenor <= r.tenor
),
curve AS (
  SELECT index, trade_date, tenor,
         CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL OR x1 = x0 THEN y0
              ELSE (y1 - y0) / (x1 - x0) * (tenor - x0) + y0 END AS rate
  FROM placed
)"""


@query(f"WITH {GRID_SQL} SELECT index, trade_date, tenor, round(rate + {FINE_NUDGE:.12f}, 6) AS rate FROM curve", dates="trade_date")
def curve_interpolate(spark, sf_dir):
    return rounded(curves.interpolate_curve(_knots(spark, sf_dir)), 6, "rate", nudge=FINE_NUDGE)


@query(f"""
WITH {GRID_SQL}
SELECT index, trade_date, CAST(tenor AS STRING) || 'Y' AS tenor, 'YIELD_CURVE' AS time_series_type,
       round(rate / 100.0e0 + {FINE_NUDGE:.12f}, 6) AS rate
FROM curve
""", dates="trade_date")
def curve_series(spark, sf_dir):
    return rounded(curves.curve_series(_knots(spark, sf_dir)), 6, "rate", nudge=FINE_NUDGE)


_MEASURES = {"l_quantity": "QUANTITY", "l_discount": "DISCOUNT", "l_tax": "TAX"}


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, tenor, modification_value FROM (
  SELECT l_orderkey, l_partkey, l_linenumber, 'QUANTITY' AS tenor,
         l_quantity AS modification_value FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_partkey, l_linenumber, 'DISCOUNT' AS tenor,
         CASE WHEN l_discount > 0 THEN l_discount END AS modification_value FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_partkey, l_linenumber, 'TAX' AS tenor, l_tax AS modification_value FROM lineitem
) WHERE modification_value IS NOT NULL
""")
def scenario_unpivot(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_discount") > 0, F.col("l_discount"))
    )
    ids = ["l_orderkey", "l_partkey", "l_linenumber"]
    return reshape.unpivot_measures(items, ids, _MEASURES, "tenor", "modification_value")


@query("""
SELECT o_orderpriority AS index,
       round(sum(CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice END), 2) AS "1995",
       round(sum(CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice END), 2) AS "1996",
       round(sum(CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice END), 2) AS "1997",
       round(sum(CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice END), 2) AS "1998",
       round(sum(CASE WHEN year(o_orderdate) = 1999 THEN o_totalprice END), 2) AS "1999",
       round(sum(CASE WHEN year(o_orderdate) = 2000 THEN o_totalprice END), 2) AS "2000",
       round(sum(CASE WHEN year(o_orderdate) = 2001 THEN o_totalprice END), 2) AS "2001"
FROM orders GROUP BY 1
""")
def series_pivot(spark, sf_dir):
    totals = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("index"), F.year("o_orderdate").alias("year")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return reshape.pivot_series(totals, ["index"], "year", range(1995, 2002), "total")


@query("""
WITH monthly AS (
  SELECT o_custkey AS index, CAST(date_trunc('month', o_orderdate) AS DATE) AS trade_date,
         max(o_totalprice) AS price, min(o_totalprice) AS low
  FROM orders GROUP BY 1, 2
)
SELECT index, trade_date, 'ADJUSTED_PRICE' AS time_series_type, price AS rate, '' AS tenor FROM monthly
UNION ALL
SELECT index, trade_date, 'ADJUSTED_RETURN' AS time_series_type, low AS rate, '' AS tenor FROM monthly
""", dates="trade_date")
def series_stack(spark, sf_dir):
    monthly = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("instrument_code"), month("o_orderdate").alias("trade_date")
    ).agg(
        F.max("o_totalprice").alias("close_adjusted"),
        F.min("o_totalprice").alias("return_percentage_adjusted"),
    )
    return curves.quote_series(monthly)


KEY_TENORS_SQL = ", ".join(f"{t}e0" for t in KEY_TENORS)

RATES_SQL = f"""
bond AS (
  SELECT p_brand AS index, p_type AS index_name, CAST(l_shipdate AS DATE) AS trade_date,
         CAST(p_size AS DOUBLE) / 4.0e0 AS tenor, CAST(l_linenumber AS DOUBLE) / 2.0e0 AS tenor2,
         CASE WHEN l_discount > 0 THEN l_discount END AS rate
  FROM lineitem JOIN part ON l_partkey = p_partkey
), rates AS (
  SELECT index, index_name, trade_date, rate / 100.0e0 AS rate,
         CASE WHEN tenor = floor(tenor) THEN CAST(CAST(tenor AS BIGINT) AS STRING)
              ELSE CAST(tenor AS STRING) END || 'Y' AS tenor,
         CASE WHEN tenor2 = floor(tenor2) THEN CAST(CAST(tenor2 AS BIGINT) AS STRING)
              ELSE CAST(tenor2 AS STRING) END || 'Y' AS tenor2
  FROM bond WHERE tenor IN ({KEY_TENORS_SQL}) AND rate IS NOT NULL
  UNION ALL BY NAME
  SELECT o_orderpriority AS index, o_orderstatus AS index_name, CAST(o_orderdate AS DATE) AS trade_date,
         o_totalprice / 100.0e0 AS rate FROM orders
  UNION ALL BY NAME
  SELECT 'SH00100' || CAST(user_id % 9 + 1 AS STRING) AS index, event_type AS index_name,
         CAST(ts AS DATE) AS trade_date, value / 100.0e0 AS rate,
         CASE user_id % 9 WHEN 0 THEN '0.0027Y' WHEN 1 THEN '0.0194Y' WHEN 2 THEN '0.0389Y'
              WHEN 3 THEN '0.0833Y' WHEN 4 THEN '0.25Y' WHEN 5 THEN '0.5Y' WHEN 6 THEN '0.75Y'
              WHEN 7 THEN '1Y' END AS tenor
  FROM events
), kinds AS (SELECT p_brand AS index, max(p_type) AS curve_type FROM part GROUP BY 1)"""


def _rates(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    bond = items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        F.col("p_brand").alias("index"),
        F.col("p_type").alias("index_name"),
        day("l_shipdate").alias("trade_date"),
        (F.col("p_size") / 4.0).alias("tenor"),
        (F.col("l_linenumber") / 2.0).alias("tenor2"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("rate"),
    )
    deposits = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("index"),
        F.col("o_orderstatus").alias("index_name"),
        day("o_orderdate").alias("trade_date"),
        F.col("o_totalprice").alias("rate"),
    )
    interbank = table(spark, sf_dir, "events").select(
        F.concat(F.lit("SH00100"), (F.col("user_id") % 9 + 1).cast("string")).alias("index"),
        F.col("event_type").alias("index_name"),
        day("ts").alias("trade_date"),
        F.col("value").alias("rate"),
    )
    kinds = parts.groupBy(F.col("p_brand").alias("index")).agg(F.max("p_type").alias("curve_type"))
    return curves.reference_rates(bond, deposits, interbank, kinds)


@query(f"""
WITH {RATES_SQL}
SELECT r.index, r.index_name, r.trade_date, r.tenor, r.tenor2, round(r.rate, 8) AS rate,
       'cny' AS currency, 'DEPOSIT' AS instrument_type, k.curve_type
FROM rates r LEFT JOIN kinds k ON r.index = k.index
""", dates="trade_date")
def rate_union(spark, sf_dir):
    return rounded(_rates(spark, sf_dir), 8, "rate")


@query(f"""
WITH {RATES_SQL}
SELECT DISTINCT index, index_name, tenor, 'DEPOSIT' AS instrument_type FROM rates WHERE tenor IS NOT NULL
""")
def distinct_factors(spark, sf_dir):
    return curves.shockable_factors(_rates(spark, sf_dir))


@query("""
WITH points AS (
  SELECT CASE p_size % 4 WHEN 0 THEN 'CFE100372' WHEN 1 THEN 'CFE100432' WHEN 2 THEN 'CFE100552'
              ELSE 'OTHER' END AS index,
         CAST(l_shipdate AS DATE) AS trade_date,
         CASE l_linenumber WHEN 1 THEN 0.0833e0 WHEN 2 THEN 0.25e0 WHEN 3 THEN 0.3e0
              ELSE CAST(l_linenumber AS DOUBLE) END AS tenor, l_tax AS rate
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
SELECT index, trade_date,
       CASE WHEN tenor = 0.0833e0 THEN '1M' WHEN tenor = 0.25e0 THEN '3M' WHEN tenor = 0.3e0 THEN NULL
            ELSE CAST(CAST(tenor AS BIGINT) AS STRING) || 'Y' END AS tenor,
       CASE index WHEN 'CFE100372' THEN 'SHIB3M' WHEN 'CFE100432' THEN 'SHIBON' ELSE 'FR007' END AS symbol,
       round(rate / 100.0e0, 8) AS rate, 'cny' AS currency, 'DEPOSIT' AS instrument_type,
       'IRS_CURVE' AS time_series_type
FROM points WHERE index <> 'OTHER'
""", dates="trade_date")
def swap_series(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    codes = F.array(*[F.lit(c) for c in ("CFE100372", "CFE100432", "CFE100552", "OTHER")])
    line = F.col("l_linenumber")
    points = items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        F.element_at(codes, F.col("p_size") % 4 + 1).alias("index"),
        day("l_shipdate").alias("trade_date"),
        F.when(line == 1, 0.0833).when(line == 2, 0.25).when(line == 3, 0.3)
        .otherwise(line.cast("double")).alias("tenor"),
        F.col("l_tax").alias("rate"),
    )
    return rounded(curves.swap_series(points), 8, "rate")


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN CAST(p_size // 4 AS STRING)
                       ELSE CAST(p_size / 4.0e0 AS STRING) END || 'Y' AS tenor,
       CASE WHEN p_size % 4 = 0 THEN CAST(p_size // 4 AS STRING) || 'Y'
            WHEN p_size = 1 THEN '3M' WHEN p_size = 2 THEN '6M' WHEN p_size = 3 THEN '9M' END AS swap_tenor
FROM part
""")
def tenor_labels(spark, sf_dir):
    years = F.col("p_size") / 4.0
    return table(spark, sf_dir, "part").select(
        "p_partkey", tenor_label(years).alias("tenor"), swap_tenor_label(years).alias("swap_tenor")
    )


def _customer_coupons(spark, sf_dir):
    """A customer's orders as coupon periods."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").alias("instrument_code"),
        day("o_orderdate").alias("interest_start_date"),
        F.date_add(day("o_orderdate"), 90).alias("interest_end_date"),
        F.col("o_totalprice").alias("interest_period_interest_rate"),
    )


@query("""
SELECT instrument_code, unnest(starts) AS start, unnest(ends) AS end_, unnest(rates) AS rate,
       CAST(unnest(range(1, len(starts) + 1)) AS INTEGER) AS place
FROM (
  SELECT o_custkey AS instrument_code,
         list(strftime(o_orderdate, '%Y%m%d') ORDER BY o_orderdate, o_totalprice) AS starts,
         list(strftime(o_orderdate + INTERVAL 90 DAY, '%Y%m%d') ORDER BY o_orderdate, o_totalprice) AS ends,
         list(o_totalprice ORDER BY o_orderdate, o_totalprice) AS rates
  FROM orders GROUP BY 1
)
""")
def coupon_arrays(spark, sf_dir):
    arrays = bonds.coupon_periods(_customer_coupons(spark, sf_dir))
    together = F.arrays_zip(
        "interest_start_date", "interest_end_date", "interest_period_interest_rate"
    )
    one = arrays.select("instrument_code", F.posexplode(together).alias("place", "period"))
    return one.select(
        "instrument_code",
        F.col("period.interest_start_date").alias("start"),
        F.col("period.interest_end_date").alias("end_"),
        F.col("period.interest_period_interest_rate").alias("rate"),
        (F.col("place") + 1).alias("place"),
    )


@query("""
SELECT o_custkey AS instrument_code, strftime(o_orderdate, '%Y%m%d') AS start, max(o_totalprice) AS rate
FROM orders GROUP BY 1, 2
""")
def coupon_json(spark, sf_dir):
    arrays = bonds.coupon_periods(_customer_coupons(spark, sf_dir))
    steps = F.from_json("coupon_change_map", "map<string,double>")
    return arrays.select("instrument_code", F.explode(steps).alias("start", "rate"))


@query("""
WITH repaid AS (
  SELECT o_custkey AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
         max(o_totalprice) AS ratio FROM orders GROUP BY 1, 2
)
SELECT instrument_code, count(*) AS n, min(strftime(trade_date, '%Y%m%d')) AS first_day,
       round(sum(ratio), 2) AS total
FROM repaid GROUP BY 1
""")
def repayment_json(spark, sf_dir):
    repayments = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("instrument_code"),
        day("o_orderdate").alias("trade_date"),
        F.col("o_totalprice").alias("advance_repay_ratio"),
    )
    maps = bonds.repayment_maps(repayments)
    entries = maps.select(
        "instrument_code",
        F.explode(F.from_json("notional_reduce_map", "map<string,double>")).alias("day", "ratio"),
    )
    return entries.groupBy("instrument_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("day").alias("first_day"),
        F.round(F.sum("ratio"), 2).alias("total"),
    )


@query("""
SELECT o_orderpriority AS priority, o_orderstatus AS status, quarter(o_orderdate) AS quarter,
       round(sum(o_totalprice) FILTER (year(o_orderdate) % 2 = 0), 2) AS "0",
       round(sum(o_totalprice) FILTER (year(o_orderdate) % 2 = 1), 2) AS "1"
FROM orders GROUP BY ALL
""")
def series_pivot_by_keys(spark, sf_dir):
    """Several index columns; the pivoted value can only be one of the two listed."""
    totals = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.quarter("o_orderdate").cast("bigint").alias("quarter"),
        (F.year("o_orderdate") % 2).alias("half"),
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return reshape.pivot_series(totals, ["priority", "status", "quarter"], "half", [0, 1], "total")


@query("""
WITH periods AS (
  SELECT o_custkey AS c, o_orderdate AS start, o_orderdate + INTERVAL 90 DAY AS end_, o_totalprice AS rate
  FROM orders
), terms AS (
  SELECT o_custkey AS c, CAST(max(o_orderdate) FILTER (o_orderstatus = 'F') AS DATE) AS expected,
         CAST(max(o_orderdate) AS DATE) AS actual,
         max(o_orderpriority) FILTER (o_orderpriority > '3') AS frequency
  FROM orders GROUP BY 1
)
SELECT c_custkey AS instrument_code,
       CASE WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_acctbal < 100 THEN 'DiscountBond'
            ELSE 'ZeroCouponBond' END ELSE 'CouponBond' END AS pricing_type,
       coalesce(frequency, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Once' END) AS pricing_frequency,
       coalesce(expected, actual) AS pricing_maturity,
       count(start) FILTER (start <= DATE '1998-06-30') AS n_periods,
       max(strftime(end_, '%Y%m%d')) FILTER (start <= DATE '1998-06-30') AS last_end,
       round(coalesce(sum(rate) FILTER (start <= DATE '1998-06-30'), 0), 2) AS rates
FROM customer LEFT JOIN periods ON c_custkey = c LEFT JOIN terms ON c_custkey = terms.c
GROUP BY ALL
""", dates="pricing_maturity")
def coupon_inputs(spark, sf_dir):
    building = F.col("c_mktsegment") == "BUILDING"
    basic = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("instrument_code"),
        F.when(building, F.lit("ZeroCouponBond")).otherwise(F.lit("CouponBond")).alias("coupon_type"),
        F.col("c_acctbal").alias("issue_price"),
        F.lit("19980630").alias("settle_date"),
    )
    on = day("o_orderdate")
    terms = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("instrument_code")).agg(
        F.max(F.when(F.col("o_orderstatus") == "F", on)).alias("estimated_maturity_date"),
        F.max(on).alias("maturity_date"),
        F.max(F.when(F.col("o_orderpriority") > "3", F.col("o_orderpriority"))).alias("pay_frequency"),
    )
    periods = bonds.coupon_periods(_customer_coupons(spark, sf_dir))
    known = basic.join(terms, "instrument_code", "left").join(periods, "instrument_code", "left")
    return bonds.coupon_inputs(known).select(
        "instrument_code",
        "pricing_type",
        "pricing_frequency",
        "pricing_maturity",
        F.size("interest_start_date").cast("bigint").alias("n_periods"),
        F.array_max("interest_end_date").alias("last_end"),
        F.round(
            F.aggregate("interest_period_interest_rate", F.lit(0.0), lambda a, x: a + x), 2
        ).alias("rates"),
    )


STATEMENTS_SQL = """
base AS (
  SELECT o_custkey AS issuer_code, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS report_type,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS trade_date, o_totalprice, o_orderpriority
  FROM orders
),
balance AS (SELECT issuer_code, report_type, trade_date, sum(o_totalprice) AS total_assets FROM base
            WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2, 3),
income AS (SELECT issuer_code, report_type, trade_date, max(o_totalprice) AS net_return FROM base
           WHERE o_orderpriority = '2-HIGH' GROUP BY 1, 2, 3),
cash AS (SELECT issuer_code, report_type, trade_date, min(o_totalprice) AS ocf FROM base
         WHERE o_orderpriority = '3-MEDIUM' GROUP BY 1, 2, 3),
derived AS (SELECT issuer_code, report_type, trade_date, count(*) / 100.0e0 AS roa FROM base
            WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') GROUP BY 1, 2, 3),
keys AS (
  SELECT issuer_code, report_type, trade_date FROM balance
  UNION SELECT issuer_code, report_type, trade_date FROM income
  UNION SELECT issuer_code, report_type, trade_date FROM cash
  UNION SELECT issuer_code, report_type, trade_date FROM derived
)"""


def _same(alias):
    return (
        f"k.issuer_code = {alias}.issuer_code AND k.trade_date = {alias}.trade_date "
        f"AND k.report_type IS NOT DISTINCT FROM {alias}.report_type"
    )


@query(f"""
WITH {STATEMENTS_SQL}
SELECT k.issuer_code, k.report_type, k.trade_date, round(b.total_assets, 2) AS total_assets,
       i.net_return, c.ocf, d.roa
FROM keys k LEFT JOIN balance b ON {_same("b")} LEFT JOIN income i ON {_same("i")}
LEFT JOIN cash c ON {_same("c")} LEFT JOIN derived d ON {_same("d")}
""", dates="trade_date")
def statement_outer_join(spark, sf_dir):
    base = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("issuer_code"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("report_type"),
        year("o_orderdate").alias("trade_date"),
        "o_totalprice",
        "o_orderpriority",
    )
    keys = ["issuer_code", "report_type", "trade_date"]

    def part(measure, *priorities):
        return base.where(F.col("o_orderpriority").isin(*priorities)).groupBy(*keys).agg(measure)

    merged = statements.merge_statements(
        part(F.sum("o_totalprice").alias("total_assets"), "1-URGENT"),
        part(F.max("o_totalprice").alias("net_return"), "2-HIGH"),
        part(F.min("o_totalprice").alias("ocf"), "3-MEDIUM"),
        part(F.count(F.lit(1)).alias("roa"), "4-NOT SPECIFIED", "5-LOW"),
        keys,
        percent_columns=["roa"],
    )
    return rounded(merged, 2, "total_assets")
