"""The dataset layer on the benchmark tables: reads, writes, upserts, ledger, catalog."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F, types as T

from folioflow.functions.dates import partition_key
from folioflow.schemas import DatasetSpec
from folioflow.sources import datasets, ledger, lineage, tables
from folioflow.sources.storage import ensure_checkpoint_dir
from folioflow.queries.registry import day, month, query, rounded, table

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("instrument_code", T.StringType(), True, {"table_field": "o_custkey"}),
        T.StructField("trade_date", T.DateType(), True, {"table_field": "o_orderdate"}),
        T.StructField("order_id", T.LongType(), True, {"table_field": "o_orderkey"}),
        T.StructField("amount", T.DoubleType(), True, {"table_field": "o_totalprice"}),
    ]
)


def _orders(spark, sf_dir):
    """Orders under dataset names, through the lineage of the schema."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", day("o_orderdate"))
    return datasets.conform(tables.rename_from_schema(orders, ORDER_SCHEMA), ORDER_SCHEMA)


def _scratch(spark, name):
    """A new folder beside the session's checkpoints, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("""
SELECT CAST(o_custkey AS STRING) AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
       o_totalprice AS amount
FROM orders
WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""", dates="trade_date")
def dated_read(spark, sf_dir):
    building = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return datasets.filter_dataset(
        _orders(spark, sf_dir),
        codes=building.select(F.col("c_custkey").cast("string").alias("instrument_code")),
        start=datetime.date(1996, 1, 1),
        end=datetime.date(1998, 12, 31),
        columns=["amount"],
    )


@query("""
SELECT o_orderstatus AS down_flag, o_orderpriority AS kind, o_orderkey AS order_id
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def conditional_read(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("down_flag"),
        F.col("o_orderpriority").alias("kind"),
        F.col("o_orderkey").alias("order_id"),
    )
    conditions = datasets.drill_down_predicate(
        {"kind": ["1-URGENT", "2-HIGH"]}, supported=True, flag="F"
    )
    return datasets.filter_dataset(orders, where=conditions, columns=["order_id"])


_UPSERT_SQL = """
WITH batch AS (
  SELECT CAST(o_custkey AS STRING) AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
         o_orderkey AS order_id, o_totalprice * 2 AS amount
  FROM orders WHERE o_orderpriority = '1-URGENT' AND month(o_orderdate) = 6
), merged AS (
  SELECT CAST(o_custkey AS STRING) AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
         o_orderkey AS order_id, o_totalprice AS amount
  FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT trade_date FROM batch)
  UNION ALL SELECT * FROM batch
)
SELECT %s AS part, count(*) AS n, round(sum(amount), 2) AS amount, min(trade_date) AS first_day,
       max(trade_date) AS last_day
FROM merged GROUP BY 1
"""


def _upserted(spark, sf_dir, grain):
    """Store all orders by `grain`, upsert the doubled urgent June orders, read back."""
    path = _scratch(spark, f"orders-{grain}")
    datasets.write_dataset(_orders(spark, sf_dir), path, ORDER_SCHEMA, grain=grain)
    june = (F.col("o_orderpriority") == "1-URGENT") & (F.month("o_orderdate") == 6)
    batch = table(spark, sf_dir, "orders").where(june).withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "o_orderdate": day("o_orderdate")}
    )
    datasets.upsert_by_date(
        tables.rename_from_schema(batch, ORDER_SCHEMA), path, ORDER_SCHEMA, grain=grain
    )
    stored = spark.read.schema(datasets.stored_schema(ORDER_SCHEMA, (), grain)).parquet(path)
    merged = stored.groupBy(F.col(grain).alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("amount"),
        F.min("trade_date").alias("first_day"),
        F.max("trade_date").alias("last_day"),
    )
    return rounded(merged, 2, "amount")


@query(_UPSERT_SQL.replace("%s", "strftime(trade_date, '%Y%m')"), dates="first_day last_day")
def month_partitions(spark, sf_dir):
    return _upserted(spark, sf_dir, "month")


@query(
    _UPSERT_SQL.replace("%s", "CAST(year(trade_date) AS STRING) || CAST(quarter(trade_date) AS STRING)"),
    dates="first_day last_day",
)
def quarter_partitions(spark, sf_dir):
    return _upserted(spark, sf_dir, "quarter")


@query("""
WITH batch AS (
  SELECT CAST(o_orderdate AS DATE) AS trade_date FROM orders
  WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
)
SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderkey AS order_id, o_totalprice AS amount
FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT trade_date FROM batch)
UNION ALL
SELECT CAST(o_orderdate AS DATE), o_orderkey, -o_totalprice FROM orders
WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
""", dates="trade_date")
def merge_by_date(spark, sf_dir):
    """The rule of the upsert without storage: dates of the batch are replaced as a whole."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", day("o_orderdate"))
    batch = orders.where(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    ).withColumn("o_totalprice", -F.col("o_totalprice"))
    names = {"o_orderdate": "trade_date", "o_orderkey": "order_id", "o_totalprice": "amount"}
    stored, new = (
        tables.rename_columns(df, names).select("trade_date", "order_id", "amount")
        for df in (orders, batch)
    )
    return datasets.merge_by_date(stored, new)


@query("""
SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y%m') AS month, strftime(o_orderdate, '%Y') AS year,
       strftime(o_orderdate, '%Y') || CAST(quarter(o_orderdate) AS STRING) AS quarter,
       strftime(o_orderdate, '%Y%m%d') AS day
FROM orders
""")
def partition_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), day("o_orderdate").alias("d")
    )
    return orders.select(
        "order_id", *[partition_key("d", g).alias(g) for g in ("month", "year", "quarter", "day")]
    )


@query("""
WITH spans AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
  FROM orders GROUP BY 1
), months AS (
  SELECT o_custkey, a, b, CAST(unnest(generate_series(date_trunc('month', a), CAST(b AS TIMESTAMP),
                                                      INTERVAL 1 MONTH)) AS DATE) AS m
  FROM spans
)
SELECT o_custkey, greatest(a, m) AS piece_start, least(b, last_day(m)) AS piece_end FROM months
""", dates="piece_start piece_end")
def month_ranges(spark, sf_dir):
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(day("o_orderdate")).alias("a"), F.max(day("o_orderdate")).alias("b")
    )
    return tables.month_ranges(spans, "a", "b").drop("a", "b")


def _load_events(spark, sf_dir):
    """Orders as load events: a priority is a dataset, the order's state the outcome."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dataset"),
        day("o_orderdate").alias("business_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("event_id"),
    )


@query("""
SELECT o_orderpriority AS dataset, arg_max(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) AS status,
       CAST(max(o_orderdate) AS DATE) AS business_date, count(*) AS n_events
FROM orders GROUP BY 1
""", dates="business_date")
def load_ledger(spark, sf_dir):
    return ledger.latest_status(_load_events(spark, sf_dir), ("business_date", "event_id"))


@query("""
WITH loaded AS (
  SELECT DISTINCT c_mktsegment AS dataset, CAST(o_orderdate AS DATE) AS trade_date
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'
), spans AS (SELECT dataset, min(trade_date) AS a, max(trade_date) AS b FROM loaded GROUP BY 1)
SELECT s.dataset, c.trade_date
FROM spans s JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date FROM orders) c
  ON c.trade_date BETWEEN s.a AND s.b
LEFT JOIN loaded l ON l.dataset = s.dataset AND l.trade_date = c.trade_date
WHERE l.dataset IS NULL
""", dates="trade_date")
def missing_load_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    loaded = orders.where(F.col("o_orderstatus") == "P").join(
        customers, orders["o_custkey"] == customers["c_custkey"]
    )
    loaded = loaded.select(F.col("c_mktsegment").alias("dataset"), day("o_orderdate").alias("trade_date"))
    calendar = orders.select(day("o_orderdate").alias("trade_date"))
    return ledger.missing_dates(calendar, loaded)


@query("""
SELECT 'orders' AS dataset, count(*) AS n_rows, CAST(min(o_orderdate) AS DATE) AS first_day,
       CAST(max(o_orderdate) AS DATE) AS last_day, 6 * count(*) - count(o_orderkey) - count(o_custkey)
         - count(o_orderstatus) - count(o_totalprice) - count(o_orderdate) - count(o_orderpriority) AS n_null_cells,
       CAST(6 AS BIGINT) AS n_columns FROM orders
UNION ALL
SELECT 'events', count(*), CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), 6 * count(*) - count(event_id) - count(ts)
         - count(user_id) - count(event_type) - count(value) - count(props), 6 FROM events
UNION ALL
SELECT 'documents', count(*), NULL, NULL, 5 * count(*) - count(doc_id) - count(text) - count(lang)
         - count(source) - count(n_chars), 5 FROM documents
UNION ALL
SELECT 'labels', count(*), NULL, NULL, 3 * count(*) - count(doc_id) - count(quality) - count(toxic), 3 FROM labels
UNION ALL
SELECT 'conversations', count(*), NULL, NULL, 4 * count(*) - count(conv_id) - count(turn) - count(role)
         - count(text), 4 FROM conversations
""", dates="first_day last_day")
def dataset_audit(spark, sf_dir):
    audited = {"orders": "o_orderdate", "events": "ts", "documents": None, "labels": None, "conversations": None}
    return lineage.audit_all({n: (table(spark, sf_dir, n), d) for n, d in audited.items()})


@query("""
SELECT 'Portfolio' AS category, 'orders' AS model, f.field_name, f.field_type, f.description, 'orders' AS table_name,
       f.table_field, n.n_rows, n.n_null_cells
FROM (VALUES ('instrument_code', 'string', 'customer', 'o_custkey'), ('trade_date', 'date', '-', 'o_orderdate'),
             ('order_id', 'bigint', 'number of the order', 'o_orderkey'), ('amount', 'double', '-', 'o_totalprice'))
     f(field_name, field_type, description, table_field),
     (SELECT count(*) AS n_rows, 4 * count(*) - count(o_custkey) - count(o_orderdate) - count(o_orderkey)
             - count(o_totalprice) AS n_null_cells FROM orders) n
""")
def field_catalog(spark, sf_dir):
    """Fields and lineage of a stored table, read back from its files, beside its audited size."""
    path = _scratch(spark, "orders-catalog")
    notes = {"instrument_code": "customer", "order_id": "number of the order"}
    described = T.StructType(
        [
            T.StructField(f.name, f.dataType, True, {**f.metadata, **({"description": notes[f.name]} if f.name in notes else {})})
            for f in ORDER_SCHEMA
        ]
    )
    datasets.write_dataset(_orders(spark, sf_dir), path, described)
    stored = spark.read.parquet(path)
    spec = DatasetSpec(category="Portfolio", name="orders", schema=stored.schema, main_table="orders")
    size = lineage.audit("orders", stored, "trade_date").first()
    fields = lineage.field_catalog(spark, [spec]).withColumnRenamed("field_description", "description")
    return fields.select(
        "category", "model", "field_name", "field_type", "description", "table_name", "table_field",
        F.lit(size["n_rows"]).cast("long").alias("n_rows"),
        F.lit(size["n_null_cells"]).cast("long").alias("n_null_cells"),
    )


@query("""
WITH stored AS (
  SELECT CAST(o_custkey AS STRING) AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
         o_totalprice AS amount FROM orders
)
SELECT instrument_code, arg_max(trade_date, trade_date) AS trade_date, count(*) AS n, max(amount) AS amount
FROM stored GROUP BY 1
""", dates="trade_date")
def newest_first_read(spark, sf_dir):
    """A read of every row, newest first, reshaped by the caller's function."""

    def per_code(df):
        return df.groupBy("instrument_code").agg(
            F.max("trade_date").alias("trade_date"),
            F.count(F.lit(1)).alias("n"),
            F.max("amount").alias("amount"),
        )

    return datasets.filter_dataset(
        _orders(spark, sf_dir),
        columns=["instrument_code", "trade_date", "amount"],
        newest_first=True,
        transform=per_code,
    )


@query("""
SELECT CAST(o_custkey AS STRING) AS instrument_code, CAST(o_orderdate AS DATE) AS trade_date,
       o_totalprice AS amount, o_orderkey AS order_id
FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, o_totalprice DESC, o_orderkey LIMIT 100
""", dates="trade_date")
def newest_rows(spark, sf_dir):
    """A report of the newest rows: by date descending, then amount descending, then id."""
    return datasets.filter_dataset(
        _orders(spark, sf_dir),
        columns=["instrument_code", "trade_date", "amount", "order_id"],
        newest_first=True,
        sort=[("amount", False), ("order_id", True)],
        transform=lambda df: df.limit(100),
    )


@query("""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS N_ROWS,
       round(sum(l_extendedprice), 2) AS AMOUNT
FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' AND l_quantity > 10 GROUP BY 1
""", dates="month")
def source_scan(spark, sf_dir):
    """One scan: predicates ANDed, a formatter applied, names turned to upper case."""
    wanted = tables.all_of(
        [tables.in_span("l_shipdate", datetime.date(1996, 1, 1)), F.col("l_quantity") > 10]
    )

    def monthly(df):
        totals = df.groupBy(month("L_SHIPDATE").alias("month")).agg(
            F.count(F.lit(1)).alias("N_ROWS"), F.sum("L_EXTENDEDPRICE").alias("AMOUNT")
        )
        return rounded(totals, 2, "AMOUNT")

    return tables.scan(
        table(spark, sf_dir, "lineitem"),
        ["l_shipdate", "l_extendedprice"],
        wanted,
        upper_columns=True,
        formatter=monthly,
    )
