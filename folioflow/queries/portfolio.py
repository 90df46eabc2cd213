"""Positions, trades, look-through, currencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.operators import fx, graph, positions, trades
from folioflow.queries.registry import NUDGE, month, query, rounded, table, year
from folioflow.sources.storage import staged

DETAIL_SQL = """
detail AS (
  SELECT l_suppkey AS book_id, p_brand AS instrument_code,
         CAST(date_trunc('year', l_shipdate) AS DATE) AS trade_date,
         l_quantity AS quantity, l_extendedprice AS cost,
         l_extendedprice * (1 - l_discount) AS market_value,
         l_extendedprice / l_quantity AS unit_cost, p_retailprice AS valuation_price
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

POSITIONS_SQL = DETAIL_SQL + """,
grouped AS (
  SELECT book_id, instrument_code, trade_date, max(unit_cost) AS unit_cost,
         max(valuation_price) AS valuation_price,
         CASE WHEN sum(quantity) = 0 THEN 0 ELSE sum(quantity * cost) / sum(quantity) END AS cost,
         sum(market_value) AS market_value, sum(quantity) AS quantity
  FROM detail GROUP BY book_id, instrument_code, trade_date
),
positions AS (
  SELECT *, lag(quantity) OVER w AS prev_quantity, lag(market_value) OVER w AS prev_market_value,
         lag(cost) OVER w AS prev_cost
  FROM grouped WINDOW w AS (PARTITION BY book_id, instrument_code ORDER BY trade_date)
)"""


def position_detail(spark, sf_dir):
    """Line items as holdings of a supplier's book in a brand, by year."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_suppkey").alias("book_id"),
        F.col("p_brand").alias("instrument_code"),
        year("l_shipdate").alias("trade_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("cost"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("market_value"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_cost"),
        F.col("p_retailprice").alias("valuation_price"),
    )


def held_positions(spark, sf_dir):
    keys = ["book_id", "instrument_code", "trade_date"]
    consolidated = positions.consolidate_positions(position_detail(spark, sf_dir), keys)
    return positions.with_previous(consolidated, ["trade_date"])


@query(f"""
WITH {POSITIONS_SQL}
SELECT book_id, instrument_code, trade_date, round(unit_cost + {NUDGE}, 4) AS unit_cost,
       round(valuation_price, 4) AS valuation_price, round(cost + {NUDGE}, 4) AS cost,
       round(market_value, 4) AS market_value, round(quantity, 4) AS quantity,
       round(prev_quantity, 4) AS prev_quantity,
       round(prev_market_value, 4) AS prev_market_value, round(prev_cost + {NUDGE}, 4) AS prev_cost
FROM positions
""", dates="trade_date")
def consolidated_positions(spark, sf_dir):
    rows = rounded(held_positions(spark, sf_dir), 4, "unit_cost", "cost", "prev_cost", nudge=NUDGE)
    return rounded(
        rows, 4, "valuation_price", "market_value", "quantity", "prev_quantity", "prev_market_value"
    )


@query(f"""
SELECT l_suppkey AS book_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
       round(sum(l_linenumber * l_extendedprice) / sum(l_extendedprice) + {NUDGE}, 4) AS remn_term
FROM lineitem GROUP BY 1, 2
""", dates="trade_date")
def weighted_term(spark, sf_dir):
    repos = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("book_id"),
        month("l_shipdate").alias("trade_date"),
        F.col("l_linenumber").cast("double").alias("remn_term"),
        F.col("l_extendedprice").alias("cost"),
    )
    return rounded(positions.weighted_term(repos, ["book_id", "trade_date"]), 4, "remn_term", nudge=NUDGE)


def _trades(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("book_id"),
        month("l_shipdate").alias("trade_date"),
        F.col("l_partkey").alias("instrument_code"),
        F.col("l_returnflag").alias("side"),
        F.col("l_quantity").alias("notional"),
        F.col("l_extendedprice").alias("trade_amount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("acr_int"),
    )


@query("""
SELECT l_suppkey AS book_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
       l_partkey AS instrument_code,
       round(coalesce(sum(CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'R' THEN -l_quantity END), 0), 4)
         AS notional,
       round(coalesce(sum(CASE l_returnflag WHEN 'A' THEN l_extendedprice
                                            WHEN 'R' THEN -l_extendedprice END), 0), 4) AS trade_amount,
       round(sum(l_extendedprice * l_tax), 5) AS acr_int
FROM lineitem GROUP BY 1, 2, 3
""", dates="trade_date")
def net_trades_signed(spark, sf_dir):
    net = trades.net_trades_signed(
        _trades(spark, sf_dir),
        ["book_id", "trade_date", "instrument_code"],
        "side",
        ["notional", "trade_amount"],
        ["acr_int"],
        buy="A",
        sell="R",
    )
    return rounded(rounded(net, 4, "notional", "trade_amount"), 5, "acr_int")


@query("""
WITH bought AS (
  SELECT l_suppkey AS book_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
         l_partkey AS instrument_code, sum(l_extendedprice) AS buy_amount,
         sum(l_extendedprice * l_tax) AS buy_fee, sum(l_quantity) AS buy_quantity
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2, 3
), sold AS (
  SELECT l_suppkey AS book_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
         l_partkey AS instrument_code, sum(l_extendedprice) AS sell_amount,
         sum(l_extendedprice * l_tax) AS sell_fee, sum(l_quantity) AS sell_quantity
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
)
SELECT book_id, trade_date, instrument_code,
       round(coalesce(buy_fee, 0) + coalesce(sell_fee, 0), 5) AS trading_fee,
       round(coalesce(buy_quantity, 0) - coalesce(sell_quantity, 0), 4) AS notional,
       round(coalesce(buy_amount, 0), 4) AS buy_amount, round(coalesce(sell_amount, 0), 4) AS sell_amount
FROM bought FULL JOIN sold USING (book_id, trade_date, instrument_code)
""", dates="trade_date")
def net_trades_buy_sell(spark, sf_dir):
    net = trades.net_trades_buy_sell(
        _trades(spark, sf_dir),
        ["book_id", "trade_date", "instrument_code"],
        "side",
        "trade_amount",
        "acr_int",
        "notional",
        buy="A",
        sell="R",
    )
    return rounded(rounded(net, 4, "notional", "buy_amount", "sell_amount"), 5, "trading_fee")


@query(f"""
WITH {POSITIONS_SQL}
SELECT book_id, trade_date, instrument_code,
       round(coalesce(quantity - prev_quantity, 0), 4) AS notional,
       round(coalesce(cost - prev_cost, 0) + {NUDGE}, 4) AS trade_amount,
       round(coalesce(cost - prev_cost, 0) + {NUDGE}, 4) AS settlement_amount,
       CAST(0 AS DOUBLE) AS trading_fee
FROM positions
""", dates="trade_date")
def implied_trades(spark, sf_dir):
    changes = positions.bond_position_changes(held_positions(spark, sf_dir))
    changes = rounded(changes, 4, "trade_amount", "settlement_amount", nudge=NUDGE)
    return rounded(changes, 4, "notional")


@query(f"""
WITH {POSITIONS_SQL}
SELECT book_id, trade_date, instrument_code, round(quantity - prev_quantity, 4) AS notional,
       round(CASE WHEN cost - prev_cost < 0 THEN 0 ELSE cost - prev_cost END + {NUDGE}, 4) AS buy_amount,
       round(CASE WHEN cost - prev_cost < 0 THEN cost - prev_cost ELSE 0 END + {NUDGE}, 4) AS sell_amount,
       CAST(0 AS DOUBLE) AS trading_fee
FROM positions
""", dates="trade_date")
def implied_trades_buy_sell(spark, sf_dir):
    changes = positions.stock_position_changes(held_positions(spark, sf_dir))
    changes = rounded(changes, 4, "buy_amount", "sell_amount", nudge=NUDGE)
    return rounded(changes, 4, "notional")


EDGES_SQL = """
owners AS (
  SELECT DISTINCT l_suppkey AS k, CAST(date_trunc('year', l_shipdate) AS DATE) AS trade_date
  FROM lineitem
),
wanted AS (
  SELECT k, trade_date, 2 * k + 1 AS child FROM owners
  UNION ALL SELECT k, trade_date, 2 * k + 2 AS child FROM owners
  UNION ALL SELECT k, trade_date, k + 5 AS child FROM owners WHERE k % 10 = 0
),
edges AS (
  SELECT k AS book_id, trade_date, child AS children_book_id, 0.1e0 + (k % 9) / 10.0e0 AS invest_rate
  FROM wanted WHERE child IN (SELECT s_suppkey FROM supplier)
)"""

PAIRS_SQL = EDGES_SQL + """,
paths AS (
  SELECT book_id AS root_book_id, children_book_id, trade_date, invest_rate FROM edges
  UNION ALL
  SELECT p.root_book_id, e.children_book_id, p.trade_date, p.invest_rate * e.invest_rate
  FROM paths p JOIN edges e ON p.children_book_id = e.book_id AND p.trade_date = e.trade_date
),
pairs AS (
  SELECT root_book_id, children_book_id, trade_date, sum(invest_rate) AS invest_rate
  FROM paths GROUP BY 1, 2, 3
)"""


def ownership(spark, sf_dir):
    """A book k owns 2k+1 and 2k+2, every tenth one also k+5, on each year it trades."""
    owners = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("book_id"), year("l_shipdate").alias("trade_date")
    ).distinct()
    k = F.col("book_id")
    rows = owners.withColumn(
        "children_book_id",
        F.explode(
            F.concat(
                F.array(2 * k + 1, 2 * k + 2),
                F.when(k % 10 == 0, F.array(k + 5)).otherwise(F.array().cast("array<bigint>")),
            )
        ),
    ).withColumn("invest_rate", 0.1 + (k % 9) / 10.0)
    books = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("children_book_id"))
    return rows.join(books, "children_book_id", "left_semi")


@query(f"""
WITH RECURSIVE {PAIRS_SQL}
SELECT root_book_id, children_book_id, trade_date, round(invest_rate, 9) AS invest_rate FROM pairs
""", dates="trade_date")
def look_through(spark, sf_dir):
    return rounded(graph.look_through(ownership(spark, sf_dir)), 9, "invest_rate")


CHANGED_EDGES_SQL = EDGES_SQL + """,
changed AS (
  SELECT book_id, trade_date, children_book_id,
         CASE WHEN book_id = 5 THEN invest_rate / 2 ELSE invest_rate END AS invest_rate
  FROM edges WHERE NOT (book_id = 3 AND children_book_id = 8)
  UNION ALL
  SELECT DISTINCT book_id, trade_date, CAST(7 AS BIGINT) AS children_book_id, 0.25e0 AS invest_rate
  FROM edges WHERE book_id = 40
)"""


def changed_ownership(edges):
    """One edge removed (3 owns 8), the rates of book 5 halved, an edge added (40 owns 7)."""
    kept = edges.where(~((F.col("book_id") == 3) & (F.col("children_book_id") == 8))).withColumn(
        "invest_rate", F.when(F.col("book_id") == 5, F.col("invest_rate") / 2).otherwise(F.col("invest_rate"))
    )
    added = (
        edges.where(F.col("book_id") == 40)
        .select("book_id", "trade_date")
        .distinct()
        .select("book_id", "trade_date", F.lit(7).cast("long").alias("children_book_id"), F.lit(0.25).alias("invest_rate"))
    )
    return kept.unionByName(added.select(*kept.columns))


@query(f"""
WITH RECURSIVE {CHANGED_EDGES_SQL},
paths AS (
  SELECT book_id AS root_book_id, children_book_id, trade_date, invest_rate FROM changed
  UNION ALL
  SELECT p.root_book_id, e.children_book_id, p.trade_date, p.invest_rate * e.invest_rate
  FROM paths p JOIN changed e ON p.children_book_id = e.book_id AND p.trade_date = e.trade_date
)
SELECT root_book_id, children_book_id, trade_date, round(sum(invest_rate), 9) AS invest_rate
FROM paths GROUP BY 1, 2, 3
""", dates="trade_date")
def look_through_refreshed(spark, sf_dir):
    """A full look-through is stored; three edges change; only the roots above them are redone."""
    old = ownership(spark, sf_dir)
    stored = staged(graph.look_through(old))
    refreshed, _ = graph.refresh_look_through(stored, old, changed_ownership(old))
    return rounded(refreshed, 9, "invest_rate")


@query(f"""
WITH {EDGES_SQL},
two AS (
  SELECT book_id, children_book_id, trade_date, invest_rate FROM edges
  UNION ALL
  SELECT a.book_id, b.children_book_id, a.trade_date, a.invest_rate * b.invest_rate
  FROM edges a JOIN edges b ON a.children_book_id = b.book_id AND a.trade_date = b.trade_date
)
SELECT book_id AS root_book_id, children_book_id, trade_date, round(sum(invest_rate), 9) AS invest_rate
FROM two GROUP BY 1, 2, 3
""", dates="trade_date")
def look_through_two_levels(spark, sf_dir):
    return rounded(graph.look_through(ownership(spark, sf_dir), max_depth=2), 9, "invest_rate")


@query(f"""
WITH RECURSIVE {POSITIONS_SQL}, {PAIRS_SQL},
terms AS (
  SELECT book_id, trade_date, instrument_code, sum(quantity * cost) / sum(cost) AS remn_term
  FROM detail GROUP BY 1, 2, 3
),
scaled AS (
  SELECT r.root_book_id AS book_id, d.trade_date, d.instrument_code, d.valuation_price, r.invest_rate,
         sum(d.market_value * r.invest_rate) AS market_value,
         sum(d.quantity * r.invest_rate) AS quantity, sum(d.cost * r.invest_rate) AS cost
  FROM grouped d JOIN pairs r ON d.trade_date = r.trade_date AND d.book_id = r.children_book_id
  GROUP BY 1, 2, 3, 4, 5
),
lagged AS (
  SELECT *, lag(quantity) OVER w AS prev_quantity, lag(cost) OVER w AS prev_cost
  FROM scaled
  WINDOW w AS (PARTITION BY book_id, instrument_code
               ORDER BY trade_date, valuation_price, round(invest_rate, 12))
)
SELECT book_id, trade_date, instrument_code, count(*) AS n_rows,
       round(sum(market_value) + {NUDGE}, 3) AS market_value, round(sum(quantity) + {NUDGE}, 4) AS quantity,
       round(sum(cost) + {NUDGE}, 3) AS cost, round(sum(coalesce(remn_term, 0)) + {NUDGE}, 4) AS remn_term,
       count(prev_quantity) AS n_previous
FROM lagged LEFT JOIN terms USING (book_id, trade_date, instrument_code)
GROUP BY 1, 2, 3
""", dates="trade_date")
def look_through_positions(spark, sf_dir):
    detail = position_detail(spark, sf_dir)
    terms = positions.weighted_term(
        detail.withColumn("remn_term", F.col("quantity")),
        ["book_id", "trade_date", "instrument_code"],
        laid_out=["book_id", "instrument_code"],
    )
    consolidated = positions.consolidate_positions(
        detail, ["book_id", "instrument_code", "trade_date"], laid_out=["book_id", "trade_date"]
    )
    seen = positions.penetrate_positions(
        consolidated.withColumn("currency", F.lit("CNY")),
        graph.look_through(ownership(spark, sf_dir)),
        terms,
        attributes=(),
    )
    return seen.groupBy("book_id", "trade_date", "instrument_code").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum("market_value") + NUDGE, 3).alias("market_value"),
        F.round(F.sum("quantity") + NUDGE, 4).alias("quantity"),
        F.round(F.sum("cost") + NUDGE, 3).alias("cost"),
        F.round(F.sum("remn_term") + NUDGE, 4).alias("remn_term"),
        F.count("prev_quantity").alias("n_previous"),
    )


@query(f"""
WITH {EDGES_SQL}
SELECT s_suppkey AS book_id, CASE WHEN s_suppkey IN (SELECT book_id FROM edges) THEN '0' ELSE '1' END
         AS down_flag
FROM supplier
""")
def look_through_flag(spark, sf_dir):
    books = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("book_id"))
    return graph.with_look_through_flag(books, ownership(spark, sf_dir), ["book_id"], "1")


# Quotes derived from the orders of a nation's customers: region 0 is quoted against the pivot
# directly, 1 inversely, 2 both ways, 3 is the pivot itself, 4 has no quote.
QUOTES_SQL = """
customers AS (
  SELECT c_custkey, c_acctbal, CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'HKD' WHEN 2 THEN 'EUR'
           WHEN 3 THEN 'CNY' ELSE 'YEN' END AS currency
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
spent AS (
  SELECT c_custkey, currency, CAST(date_trunc('year', o_orderdate) AS DATE) AS trade_date,
         o_orderkey, o_totalprice AS market_value
  FROM orders JOIN customers ON o_custkey = c_custkey
),
means AS (
  SELECT trade_date, currency, round(avg(market_value) / 100000.0e0, 6) AS mean
  FROM spent GROUP BY 1, 2
),
quotes AS (
  SELECT trade_date, currency || 'CNY' AS fx_code, mean AS exch_rate FROM means
  WHERE currency IN ('USD', 'EUR')
  UNION ALL
  SELECT trade_date, 'CNY' || currency AS fx_code, mean * 2 AS exch_rate FROM means
  WHERE currency IN ('HKD', 'EUR')
),
factors AS (
  SELECT trade_date, currency,
         coalesce(max(CASE WHEN side = 1 THEN exch_rate END), max(CASE WHEN side = 2 THEN 1 / exch_rate END))
           AS factor
  FROM (SELECT trade_date, substr(fx_code, 1, 3) AS currency, 1 AS side, exch_rate FROM quotes
        WHERE substr(fx_code, 4, 3) = 'CNY'
        UNION ALL
        SELECT trade_date, substr(fx_code, 4, 3) AS currency, 2 AS side, exch_rate FROM quotes
        WHERE substr(fx_code, 1, 3) = 'CNY') legs
  GROUP BY 1, 2
)"""


def spending(spark, sf_dir):
    code = F.element_at(
        F.array(*[F.lit(c) for c in ("USD", "HKD", "EUR", "CNY", "YEN")]), F.col("n_regionkey") + 1
    )
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(nations, customers["c_nationkey"] == nations["n_nationkey"])
        .select(
            "c_custkey",
            code.alias("currency"),
            year("o_orderdate").alias("trade_date"),
            "o_orderkey",
            F.col("o_totalprice").alias("market_value"),
        )
    )


def yearly_quotes(spent):
    means = spent.groupBy("trade_date", "currency").agg(
        F.round(F.avg("market_value") / 100000.0, 6).alias("mean")
    )
    direct = means.where(F.col("currency").isin("USD", "EUR")).select(
        "trade_date", F.concat("currency", F.lit("CNY")).alias("fx_code"), F.col("mean").alias("exch_rate")
    )
    inverse = means.where(F.col("currency").isin("HKD", "EUR")).select(
        "trade_date", F.concat(F.lit("CNY"), "currency").alias("fx_code"), (F.col("mean") * 2).alias("exch_rate")
    )
    return direct.unionByName(inverse)


@query(f"""
WITH {QUOTES_SQL}
SELECT s.o_orderkey, s.currency, s.trade_date,
       round(CASE WHEN s.currency = 'HKD' THEN s.market_value
             ELSE s.market_value * (CASE WHEN s.currency = 'CNY' THEN 1 ELSE coalesce(f.factor, 1) END)
                  / coalesce(t.factor, 1) END, 4) AS market_value,
       s.currency <> 'HKD' AND ((s.currency <> 'CNY' AND f.factor IS NULL) OR t.factor IS NULL) AS fx_missing
FROM spent s
LEFT JOIN factors f ON s.trade_date = f.trade_date AND s.currency = f.currency
LEFT JOIN factors t ON s.trade_date = t.trade_date AND t.currency = 'HKD'
""", dates="trade_date")
def fx_convert_by_day(spark, sf_dir):
    spent = spending(spark, sf_dir)
    rates = fx.first_rates(yearly_quotes(spent))
    converted = fx.convert_currency(spent, rates, "HKD")
    return rounded(converted.drop("c_custkey"), 4, "market_value")


@query(f"""
WITH {QUOTES_SQL},
latest AS (SELECT * FROM factors WHERE trade_date = (SELECT max(trade_date) FROM quotes))
SELECT c.c_custkey, c.currency,
       round(CASE WHEN c.currency = 'CNY' THEN c.c_acctbal
             ELSE c.c_acctbal * coalesce(f.factor, 1) END, 4) AS c_acctbal,
       c.currency <> 'CNY' AND f.factor IS NULL AS fx_missing
FROM customers c LEFT JOIN latest f ON c.currency = f.currency
""")
def fx_convert(spark, sf_dir):
    spent = spending(spark, sf_dir)
    quotes = yearly_quotes(spent)
    latest = quotes.groupBy("fx_code").agg(F.max_by("exch_rate", "trade_date").alias("exch_rate"))
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    code = F.element_at(
        F.array(*[F.lit(c) for c in ("USD", "HKD", "EUR", "CNY", "YEN")]), F.col("n_regionkey") + 1
    )
    balances = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"]).select(
        "c_custkey", code.alias("currency"), "c_acctbal"
    )
    return rounded(fx.convert_currency(balances, latest, "CNY", "c_acctbal", by=()), 4, "c_acctbal")


@query(f"""
WITH {QUOTES_SQL}
SELECT trade_date, string_agg(fx_code || '=' || CAST(CAST(round(exch_rate * 1000000) AS BIGINT) AS STRING), ';'
                              ORDER BY fx_code) AS rates
FROM quotes GROUP BY trade_date
""", dates="trade_date")
def fx_rate_map(spark, sf_dir):
    maps = fx.rate_map(fx.first_rates(yearly_quotes(spending(spark, sf_dir))))
    entry = F.transform(
        F.array_sort(F.map_entries("rates")),
        lambda e: F.concat(
            e["key"], F.lit("="), F.round(e["value"] * 1000000).cast("bigint").cast("string")
        ),
    )
    return maps.select("trade_date", F.array_join(entry, ";").alias("rates"))
