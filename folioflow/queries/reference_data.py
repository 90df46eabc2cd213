"""Labels, flags, classes, scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions.dates import (
    date_text,
    days_between,
    format_edge_dates,
    month_end,
    month_start,
    parse_day,
)
from folioflow.functions.labels import BOARD_INDEX_CODES, DAY_COUNTS, label, symbol_with_market
from folioflow.functions.numeric import basis_points, number, percent, ratio, signed
from folioflow.operators import classes
from folioflow.operators.filters import bond_class_only, without_codes
from folioflow.operators.reshape import union_distinct
from folioflow.queries.registry import day, query, rounded, table


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 1 THEN 'SEC026261761' WHEN 3 THEN 'SEC024022199'
                  WHEN 4 THEN 'SEC045336986' ELSE '' END AS index,
       CASE p_size % 9 WHEN 1 THEN 'A/365' WHEN 2 THEN 'Act/Act' WHEN 3 THEN 'A/360' WHEN 4 THEN '30/360'
            WHEN 6 THEN 'A/366' WHEN 7 THEN 'A/365F' WHEN 8 THEN 'AVG/ACT' END AS day_count,
       p_name || '.' || p_brand AS symbol
FROM part
""")
def label_map(spark, sf_dir):
    def code(n):
        return F.lpad((F.col("p_size") % n).cast("string"), 3, "0")

    return table(spark, sf_dir, "part").select(
        "p_partkey",
        label(code(5), BOARD_INDEX_CODES, "").alias("index"),
        label(code(9), DAY_COUNTS).alias("day_count"),
        symbol_with_market("p_name", "p_brand").alias("symbol"),
    )


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS day_text,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, last_day(CAST(l_shipdate AS DATE)) AS month_end,
       CAST(CAST(l_shipdate AS DATE) - CAST(date_trunc('month', l_shipdate) AS DATE) AS DOUBLE) AS days,
       CAST(l_shipdate AS DATE) AS parsed,
       round(l_quantity / 100.0e0, 6) AS as_percent, round(l_extendedprice / 10000.0e0, 8) AS as_points,
       CASE l_returnflag WHEN 'A' THEN 1.0e0 WHEN 'R' THEN -1.0e0 END AS sign,
       CASE WHEN l_discount <> 0 THEN round(l_quantity / l_discount, 4) END AS ratio,
       l_returnflag = 'R' AS held
FROM lineitem
""", dates="month_start month_end parsed")
def column_expressions(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("d", day("l_shipdate"))
    rows = items.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        date_text("d").alias("day_text"),
        month_start("d").alias("month_start"),
        month_end("d").alias("month_end"),
        days_between("d", month_start("d")).alias("days"),
        parse_day(date_text("d")).alias("parsed"),
        percent("l_quantity").alias("as_percent"),
        basis_points("l_extendedprice").alias("as_points"),
        signed("l_returnflag", "A", "R").alias("sign"),
        ratio("l_quantity", "l_discount").alias("ratio"),
        F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("held"),
    )
    return rounded(rounded(rounded(rows, 6, "as_percent"), 8, "as_points"), 4, "ratio")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS first_day,
       strftime(last_day(CAST(o_orderdate AS DATE)), '%Y%m%d') AS last_day
FROM orders
""")
def edge_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", day("o_orderdate").alias("first_day"), month_end(day("o_orderdate")).alias("last_day")
    )
    return format_edge_dates(orders)


@query("""
SELECT conv_id, turn, TRY_CAST(regexp_extract(text, '[0-9.]+') AS DOUBLE) AS first_number
FROM conversations
""")
def dirty_numbers(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", number(F.regexp_extract("text", "[0-9.]+", 0)).alias("first_number")
    )


@query("""
SELECT DISTINCT p_brand AS cls_type, p_type AS cls_code, p_type AS cls_name FROM part
WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size > 25)
UNION
SELECT DISTINCT c_mktsegment, c_mktsegment, c_mktsegment FROM customer
WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_acctbal > 0)
""")
def class_union(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    customers = table(spark, sf_dir, "customer")
    system = parts.select(
        F.col("p_brand").alias("CLS_TYPE"), F.col("p_type").alias("CLS_CODE"), F.col("p_type").alias("CLS_NAME")
    )
    segment = F.col("c_mktsegment")
    own = customers.select(
        segment.alias("CLS_TYPE_CODE"), segment.alias("CLS_CODE"), segment.alias("CLS_NAME")
    )
    big = parts.select(F.when(F.col("p_size") > 25, F.col("p_brand")).alias("CLS_TYPE_CODE")).distinct()
    rich = customers.select(F.when(F.col("c_acctbal") > 0, segment).alias("CLS_TYPE_CODE")).distinct()
    return classes.asset_classes(system, big, own, rich)


@query("""
SELECT CAST(l_partkey AS BIGINT) AS code FROM lineitem UNION SELECT p_partkey FROM part
""")
def code_union(spark, sf_dir):
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return union_distinct(
        [items.select(F.col("l_partkey").alias("code")), parts.select(F.col("p_partkey").alias("code"))]
    )


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def without_held(spark, sf_dir):
    building = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return without_codes(orders, building.select("c_custkey"), "o_custkey")


@query("""
SELECT p_partkey, bond_type
FROM (SELECT p_partkey, 'A0' || CAST(p_size % 4 AS STRING) || '.02' AS bond_type FROM part)
WHERE regexp_matches(bond_type, 'A02.02')
""")
def bond_classes(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("A0"), (F.col("p_size") % 4).cast("string"), F.lit(".02")).alias("bond_type")
    )
    return bond_class_only(parts)
