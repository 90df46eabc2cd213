"""Datasets built span by span with upserts: the stored result equals the build of all time.

The SQL is that of the whole build. Previous values at the first day of a span, share counts and
returns come from before it; a load of some codes replaces only these; a backfill is not skipped.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from folioflow.functions.dates import date_text
from folioflow.plans import BuildContext, run_dataset
from folioflow.plans.build import dataset_path
from folioflow.queries.bindings import bound_sources, with_sources
from folioflow.queries.built_datasets import DATES, FINISH, label_of
from folioflow.queries.dataset_layer import ORDER_SCHEMA, _orders, _scratch
from folioflow.queries.registry import QUERIES, Query, day, query, table
from folioflow.schemas import DATASETS
from folioflow.sources import datasets
from folioflow.sources.tables import rename_from_schema

_CUTS = (datetime.date(1997, 1, 1), datetime.date(1999, 6, 20), datetime.date(2100, 1, 1))
SPANS = tuple(zip((None, *_CUTS[:-1]), (d - datetime.timedelta(days=1) for d in _CUTS)))


def built_by_span(spark, sf_dir: str, name: str, order=SPANS) -> DataFrame:
    """Run the builder for each span, upserting into one stored dataset, and read it back."""
    root = _scratch(spark, f"spans-{name}")
    sources = bound_sources(spark, sf_dir)
    for start, end in order:
        run_dataset(name, BuildContext(sources, start, end), root, f"{root}/ledger")
    spec = DATASETS[name]
    return datasets.read_dataset(spark, dataset_path(root, name), spec.schema, spec.partition_by, spec.grain)


def span_query(label: str, name: str, order=SPANS) -> None:
    def run(spark, sf_dir):
        rows = FINISH[name](built_by_span(spark, sf_dir, name, order))
        return rows.withColumns({c: date_text(c) for c in DATES[name]})

    QUERIES[label] = Query(run, QUERIES[f"dataset_{label_of(name)}"].sql)


#: The first span, the last, then the middle one: a backfill between stored spans.
BACKFILL = (SPANS[0], SPANS[2], SPANS[1])


span_query("span_comb_position", "CombPosition")
span_query("span_stock_daily_quote", "StockDailyQuote")
span_query("span_fund_daily_quote", "FundDailyQuote")
span_query("span_penetrated_trades", "BondTradePenetrateInfo")
span_query("backfill_comb_position", "CombPosition", BACKFILL)
span_query("backfill_fund_daily_quote", "FundDailyQuote", BACKFILL)

_STORED = """
SELECT CAST(o_custkey AS STRING) AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
       o_orderkey AS order_id, {} AS amount
FROM orders
"""


BOOK_SCHEMA = T.StructType([*ORDER_SCHEMA, T.StructField("book_id", T.StringType())])


def _upserted_by(spark, stored: DataFrame, batch: DataFrame, schema, partition_by=(), replace_by=None) -> DataFrame:
    path = _scratch(spark, "orders-upsert")
    datasets.write_dataset(stored, path, schema, partition_by, "month")
    datasets.upsert_by_date(batch, path, schema, partition_by, "month", replace_by=replace_by)
    return datasets.read_dataset(spark, path, schema, partition_by, "month")


@query(_STORED.format("""CASE WHEN c_mktsegment = 'BUILDING' AND year(o_orderdate) = 1997
         THEN o_totalprice * 2 ELSE o_totalprice END""") + "JOIN customer ON o_custkey = c_custkey", dates="trade_date")
def upsert_by_code(spark, sf_dir):
    """A load of some codes replaces their rows of its days and leaves the others of these days."""
    building = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    batch = (
        table(spark, sf_dir, "orders")
        .where(F.year("o_orderdate") == 1997)
        .join(building, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .withColumns({"o_totalprice": F.col("o_totalprice") * 2, "o_orderdate": day("o_orderdate")})
    )
    return _upserted_by(
        spark,
        _orders(spark, sf_dir),
        rename_from_schema(batch, ORDER_SCHEMA),
        ORDER_SCHEMA,
        replace_by=["trade_date", "instrument_code"],
    )


@query("""
SELECT CAST(o_custkey AS STRING) AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
       o_orderkey AS order_id, o_totalprice AS amount,
       CASE WHEN year(o_orderdate) = 1997 AND month(o_orderdate) > 6 THEN 'moved ' ELSE '' END || o_orderstatus AS book_id
FROM orders
""", dates="trade_date")
def upsert_partitioned(spark, sf_dir):
    """Folders by book and month: those whose rows all move to another book become empty."""
    orders = table(spark, sf_dir, "orders").withColumns(
        {"o_orderdate": day("o_orderdate"), "book_id": F.col("o_orderstatus")}
    )
    stored = rename_from_schema(orders, ORDER_SCHEMA)
    late = (F.year("trade_date") == 1997) & (F.month("trade_date") > 6)
    moved = stored.where(late).withColumn("book_id", F.concat(F.lit("moved "), "book_id"))
    return _upserted_by(spark, stored, moved, BOOK_SCHEMA, partition_by=["book_id"])


@query(with_sources("INFO_FX_EXCHRATE", """
SELECT FX_CODE AS fx_code, EXCH_PRC AS exch_rate, END_DATE AS trade_date, PRC_TYPE AS prc_type, PUB_ORG AS pub_org
FROM INFO_FX_EXCHRATE WHERE PRC_TYPE = '001' AND PUB_ORG = '001'"""), dates="trade_date")
def backfill_then_read(spark, sf_dir):
    """The newest span first, then the ones before it, then all again: none is skipped wrongly."""
    return built_by_span(spark, sf_dir, "FxExchRate", [*SPANS[::-1], *SPANS])
