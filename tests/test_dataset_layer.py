"""Stored datasets: writes, upserts, pruning, lineage, ledger, runs."""

import os
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from folioflow.operators.filters import first_match, held_codes
from folioflow.plans import BuildContext, run_dataset
from folioflow.sources.storage import ensure_checkpoint_dir
from folioflow.plans.build import dataset_path
from folioflow.schemas import CATEGORIES, DATASETS
from folioflow.sources import datasets, ledger, lineage, tables

SCHEMA = T.StructType(
    [
        T.StructField("instrument_code", T.StringType(), True, {"table_field": "CODE"}),
        T.StructField("trade_date", T.DateType(), True, {"table_field": "DAY", "description": "交易日期"}),
        T.StructField("close", T.DoubleType(), True, {"source_table": {"T1": "PRC", "T2": "VAL"}}),
    ]
)


def quotes(spark, rows):
    return spark.createDataFrame(
        [(c, date.fromisoformat(d), v) for c, d, v in rows], "instrument_code string, trade_date date, close double"
    )


STORED = [("a", "2022-01-03", 1.0), ("a", "2022-01-04", 2.0), ("b", "2022-02-01", 3.0), ("b", "2022-03-01", 4.0)]


def contents(spark, path, **filters):
    rows = datasets.read_dataset(spark, path, SCHEMA, grain="month", **filters).collect()
    return sorted((r["instrument_code"], r["trade_date"].isoformat(), r["close"]) for r in rows)


def test_upsert_replaces_whole_dates_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "q")
    datasets.write_dataset(quotes(spark, STORED), path, SCHEMA, grain="month")
    untouched = {f: os.path.getmtime(f"{path}/month=202203/{f}") for f in os.listdir(f"{path}/month=202203")}
    batch = quotes(spark, [("c", "2022-01-04", 9.0), ("c", "2022-02-02", 8.0)])
    want = sorted(
        [("a", "2022-01-03", 1.0), ("c", "2022-01-04", 9.0), ("b", "2022-02-01", 3.0), ("c", "2022-02-02", 8.0),
         ("b", "2022-03-01", 4.0)]
    )
    for _ in range(2):
        datasets.upsert_by_date(batch, path, SCHEMA, grain="month")
        assert contents(spark, path) == want
    assert {f: os.path.getmtime(f"{path}/month=202203/{f}") for f in os.listdir(f"{path}/month=202203")} == untouched


def test_upsert_into_nothing_and_rebuild(spark, tmp_path):
    path = str(tmp_path / "q")
    datasets.upsert_by_date(quotes(spark, STORED[:2]), path, SCHEMA, grain="month")
    assert len(contents(spark, path)) == 2
    datasets.write_dataset(quotes(spark, STORED[2:]), path, SCHEMA, grain="month", rebuild=True)
    assert contents(spark, path) == sorted(STORED[2:])


BOOKED = T.StructType([*SCHEMA, T.StructField("currency", T.StringType())])


def booked(spark, rows):
    rows = [(c, date.fromisoformat(d) if d else None, v, k) for c, d, v, k in rows]
    return spark.createDataFrame(rows, BOOKED)


def booked_contents(spark, path, partition_by=("currency",)):
    rows = datasets.read_dataset(spark, path, BOOKED, partition_by, "month").select(*BOOKED.fieldNames()).collect()
    return sorted(((r[0], str(r[1]) if r[1] else None, r[2], r[3]) for r in rows), key=repr)


def test_upsert_empties_folders_that_lose_all_rows(spark, tmp_path):
    path = str(tmp_path / "q")
    datasets.write_dataset(booked(spark, [("a", "2022-01-05", 1.0, "USD/x y"), ("b", "2022-01-06", 2.0, "CNY")]), path, BOOKED, ["currency"], "month")
    datasets.upsert_by_date(booked(spark, [("a", "2022-01-05", 3.0, "CNY")]), path, BOOKED, ["currency"], "month")
    assert booked_contents(spark, path) == [("a", "2022-01-05", 3.0, "CNY"), ("b", "2022-01-06", 2.0, "CNY")]


def test_upsert_keeps_and_replaces_null_dates(spark, tmp_path):
    path = str(tmp_path / "q")
    datasets.write_dataset(booked(spark, [("a", None, 1.0, "CNY"), ("b", "2022-01-06", 2.0, "CNY")]), path, BOOKED, (), "month")
    datasets.upsert_by_date(booked(spark, [("c", "2022-01-07", 3.0, "CNY")]), path, BOOKED, (), "month")
    assert len(booked_contents(spark, path, ())) == 3
    datasets.upsert_by_date(booked(spark, [("d", None, 4.0, "CNY")]), path, BOOKED, (), "month")
    assert [r[0] for r in booked_contents(spark, path, ())] == ["b", "c", "d"]


def test_upsert_by_code_leaves_other_codes(spark, tmp_path):
    path = str(tmp_path / "q")
    both = ["trade_date", "instrument_code"]
    for code, value in (("a", 1.0), ("b", 2.0), ("a", 3.0)):
        datasets.upsert_by_date(quotes(spark, [(code, "2022-01-05", value)]), path, SCHEMA, grain="month", replace_by=both)
    assert contents(spark, path) == [("a", "2022-01-05", 3.0), ("b", "2022-01-05", 2.0)]


def test_upsert_evaluates_its_batch_once_and_cleans_up(spark, tmp_path):
    path = str(tmp_path / "q")
    datasets.write_dataset(quotes(spark, STORED), path, SCHEMA, grain="month")
    seen = spark.sparkContext.accumulator(0)
    batch = quotes(spark, [("c", "2022-01-04", 9.0)])

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    counted = spark.createDataFrame(batch.rdd.mapPartitions(count), SCHEMA)
    ensure_checkpoint_dir(spark)
    shared = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    files = shared.getFileSystem(spark._jsc.hadoopConfiguration())
    before = {str(f.getPath()) for f in files.listStatus(shared)}
    datasets.upsert_by_date(counted, path, SCHEMA, grain="month")
    assert seen.value == 1
    assert {str(f.getPath()) for f in files.listStatus(shared)} == before


def test_runs_cover_spans_not_end_dates(spark, tmp_path):
    log = str(tmp_path / "ledger")
    jan, feb = (date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 29))
    for (start, end), scope in ((jan, "*"), (feb, "2 codes 7")):
        ledger.record(spark, log, "X", end, ledger.START, start_date=start, scope=scope)
        ledger.record(spark, log, "X", end, ledger.COMPLETE, start_date=start, scope=scope)
    events = ledger.read_ledger(spark, log)
    assert ledger.is_complete(events, "X", jan[1], jan[0])
    assert ledger.is_complete(events, "X", date(2024, 1, 20), date(2024, 1, 10))
    assert not ledger.is_complete(events, "X", date(2020, 1, 31), date(2020, 1, 1))
    assert not ledger.is_complete(events, "X", jan[1])
    assert not ledger.is_complete(events, "X", feb[1], jan[0])
    assert ledger.is_complete(events, "X", feb[1], jan[0], "2 codes 7")
    ledger.record(spark, log, "X", date(2024, 1, 5), ledger.FAILED, start_date=date(2024, 1, 5))
    assert not ledger.is_complete(ledger.read_ledger(spark, log), "X", jan[1], jan[0])


class StubReader:
    def __init__(self, frame, calls):
        self.frame, self.calls = frame, calls

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self.frame


def test_jdbc_reads_are_split_by_month_or_by_range(spark, context):
    calls = []
    frame = context.sources.frames["INFO_FX_EXCHRATE"]
    stub = type("Stub", (), {"read": property(lambda self: StubReader(frame, calls))})()
    place = tables.Location("jdbc", {"url": "jdbc:none", "user": "u"}, splits={"PROD_FUNDS": ("ID", 0, 900, 3)})
    sources = tables.SourceTables(stub, business=place)
    span = BuildContext(sources, date(2022, 1, 4), date(2022, 3, 2))
    assert span.table("INFO_FX_EXCHRATE", "END_DATE").count() == 2
    span.table("PROD_FUNDS")
    BuildContext(sources, end=date(2022, 1, 3)).table("INFO_FX_EXCHRATE", "END_DATE")
    assert calls[0][1]["predicates"] == [
        "END_DATE between '2022-01-04' and '2022-01-31'",
        "END_DATE between '2022-02-01' and '2022-02-28'",
        "END_DATE between '2022-03-01' and '2022-03-02'",
    ]
    assert (calls[1][1]["column"], calls[1][1]["numPartitions"]) == ("ID", 3)
    assert "predicates" not in calls[2][1]


def test_months_are_not_read_for_other_spans(spark, context):
    inside = BuildContext(context.sources, date(2022, 1, 4), date(2022, 1, 4))
    outside = BuildContext(context.sources, date(2022, 2, 1), date(2022, 2, 28))
    assert inside.table("INFO_FX_EXCHRATE", "END_DATE").count() == 2
    assert outside.table("INFO_FX_EXCHRATE", "END_DATE").count() == 0
    assert inside.table("INFO_FX_EXCHRATE", "END_DATE", history=True).count() == 2


def test_read_filters_and_prunes_months(spark, tmp_path):
    path = str(tmp_path / "q")
    datasets.write_dataset(quotes(spark, STORED), path, SCHEMA, grain="month")
    assert contents(spark, path, start=date(2022, 1, 4), end=date(2022, 2, 1)) == sorted(STORED[1:3])
    assert contents(spark, path, codes=["b"], where={"close": 3.0}) == [STORED[2]]
    codes = spark.createDataFrame([("a",)], "instrument_code string")
    assert contents(spark, path, codes=codes) == STORED[:2]
    df = datasets.read_dataset(spark, path, SCHEMA, grain="month", start=date(2022, 2, 1), end=date(2022, 2, 28))
    plan = df._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "202202" in partition_filters and "PushedFilters: [IsNotNull(trade_date)" in plan
    assert len(df.inputFiles()) >= 1 and df.count() == 1
    newest = datasets.read_dataset(spark, path, SCHEMA, grain="month", newest_first=True).collect()
    assert newest[0]["trade_date"] == date(2022, 3, 1)


def test_projection_keeps_filter_columns_and_dateless_data_ignores_dates(spark):
    df = quotes(spark, STORED)
    got = datasets.filter_dataset(df, start=date(2022, 1, 1), where={"close": [1.0]}, columns=["instrument_code"])
    assert got.columns == ["instrument_code", "trade_date", "close"] and got.count() == 1
    dateless = df.drop("trade_date")
    assert datasets.filter_dataset(dateless, start=date(2023, 1, 1)).count() == 4
    upper = datasets.filter_dataset(df, transform=lambda d: d.withColumn("instrument_code", F.upper("instrument_code")))
    assert {r[0] for r in upper.collect()} == {"A", "B"}


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "q")
    datasets.write_dataset(quotes(spark, STORED), path, SCHEMA, grain="quarter")
    assert sorted(p for p in os.listdir(path) if "=" in p) == ["quarter=20221"]
    df = datasets.read_dataset(spark, path, grain="quarter")
    assert df.schema["quarter"].dataType == T.StringType()


def test_file_and_row_group_sizes(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = spark.range(1000).selectExpr("cast(id as string) instrument_code", "date'2022-01-01' trade_date", "1D close")
    datasets.write_dataset(rows.coalesce(1), path, SCHEMA, max_rows_per_file=300)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert sorted(pq.ParquetFile(f"{path}/{f}").metadata.num_rows for f in files) == [100, 300, 300, 300]


def test_lineage_survives_parquet_and_renames(spark, tmp_path):
    path = str(tmp_path / "q")
    raw = quotes(spark, STORED).toDF("CODE", "DAY", "VAL").withColumn("EXTRA", F.lit(1))
    named = datasets.conform(tables.rename_from_schema(raw, SCHEMA), SCHEMA)
    assert named.columns == SCHEMA.names
    named.write.parquet(path)
    stored = spark.read.parquet(path).schema
    assert stored["trade_date"].metadata["description"] == "交易日期"
    assert stored["close"].metadata["source_table"] == {"T1": "PRC", "T2": "VAL"}
    absent = datasets.conform(named.drop("close"), SCHEMA)
    assert absent.where("close is null").count() == 4


def test_catalog_lists_every_source(spark, tmp_path):
    catalog = lineage.field_catalog(spark, [s for s in DATASETS.values() if s.schema is not None])
    rows = catalog.where("model = 'FinancialIndicator' and field_name = 'issuer_code'").collect()
    assert len(rows) == 4 and {r["table_field"] for r in rows} == {"PARTY_CODE"}
    unknown = catalog.where("model = 'BenchMarkInfo' and field_name = 'instrument_type'").first()
    assert (unknown["table_name"], unknown["table_field"]) == ("-", "-")
    assert catalog.select("model").distinct().count() == 36 and len(DATASETS) == 46 and len(CATEGORIES) == 7
    one = lineage.schema_table(spark, DATASETS["FxExchRate"]).collect()
    assert {(r["name"], r["type"], r["table_field"]) for r in one} >= {("exch_rate", "double", "EXCH_PRC")}
    datasets.export_csv(catalog, str(tmp_path / "catalog"))
    back = spark.read.option("header", True).csv(str(tmp_path / "catalog"))
    assert back.count() == catalog.count()


def test_months_and_predicates():
    assert tables.month_bounds(date(2021, 11, 15), date(2022, 2, 3)) == [
        (date(2021, 11, 15), date(2021, 11, 30)), (date(2021, 12, 1), date(2021, 12, 31)),
        (date(2022, 1, 1), date(2022, 1, 31)), (date(2022, 2, 1), date(2022, 2, 3)),
    ]
    assert tables.month_bounds(date(2022, 1, 5), date(2022, 1, 31)) == [(date(2022, 1, 5), date(2022, 1, 31))]
    assert tables.month_predicates("D", date(2022, 1, 5), date(2022, 1, 9)) == ["D between '2022-01-05' and '2022-01-09'"]


def test_drill_down_default():
    assert datasets.drill_down_predicate({}, True) == {"down_flag": "1"}
    assert datasets.drill_down_predicate({"down_flag": "0"}, True) == {"down_flag": "0"}
    assert datasets.drill_down_predicate({}, False) == {}


def test_source_routing(spark):
    vendor, own = tables.Location("jdbc", {"url": "jdbc:v"}), tables.Location("parquet", path="/data")
    sources = tables.SourceTables(spark, own, vendor)
    assert sources.location("info_FX") is vendor and sources.location("DM_PORT_ASSET") is own
    assert tables.SourceTables(spark, own).location("INFO_FX") is own
    assert sources.supports_drill_down("INDIC_X") and not sources.supports_drill_down("INFO_X")


def test_column_comments(spark):
    described = spark.createDataFrame(
        [("s", "T", "A", "note", "int"), ("other", "T", "A", "no", "int"), ("s", "T", "B", "unused", "int")],
        "table_schema string, table_name string, column_name string, column_comment string, column_type string",
    )
    sources = tables.SourceTables(spark, frames={"information_schema.columns": described})
    wanted = spark.createDataFrame(
        [("market", "M", "T", "A")], "category string, model_name string, table_name string, column_name string"
    )
    rows = tables.column_comments(sources, wanted, "s").collect()
    assert [(r["model_name"], r["column_comment"]) for r in rows] == [("M", "note")]


@pytest.fixture()
def context(spark):
    factor = spark.createDataFrame([("USDCNY", 6.5, date(2022, 1, 4), "001", "001"), ("USDCNY", 6.6, date(2022, 1, 4), "002", "001")],
                                   "FX_CODE string, EXCH_PRC double, END_DATE date, PRC_TYPE string, PUB_ORG string")
    levels = spark.createDataFrame([("SEC024342013", date(2022, 1, 4), 4000.0, 1.5), ("X", date(2022, 1, 4), 1.0, 1.0)],
                                   "IDX_CODE string, TRD_DATE date, CLS_PRC double, PCT_CHG double")
    sources = tables.SourceTables(spark, frames={"INFO_FX_EXCHRATE": factor, "INFO_IDX_EODVALUE": levels})
    return BuildContext(sources, end=date(2022, 1, 31))


def test_run_records_skips_and_rebuilds(spark, tmp_path, context):
    root, log = str(tmp_path / "data"), str(tmp_path / "ledger")
    assert run_dataset("FxExchRate", context, root, log)
    assert not run_dataset("FxExchRate", context, root, log)
    assert run_dataset("FxExchRate", context, root, log, rebuild=True)
    stored = spark.read.parquet(dataset_path(root, "FxExchRate")).collect()
    assert [(r["fx_code"], r["exch_rate"]) for r in stored] == [("USDCNY", 6.5)]
    assert run_dataset("BenchmarkDailyQuote", context, root, log)
    index = datasets.read_dataset(
        spark, dataset_path(root, "BenchmarkDailyQuote"), DATASETS["BenchmarkDailyQuote"].schema, grain="month"
    ).collect()
    assert [(r["instrument_code"], r["return_percentage"]) for r in index] == [("SEC024342013", 0.015)]
    with pytest.raises(KeyError):
        run_dataset("DoesNotExist", context, root, log)
    with pytest.raises(Exception):
        run_dataset("CombAsset", context, root, log)
    events = ledger.read_ledger(spark, log)
    newest = {r["dataset"]: r["status"] for r in ledger.latest_status(events).collect()}
    assert newest == {"FxExchRate": "COMP", "BenchmarkDailyQuote": "COMP", "CombAsset": "FAILED"}
    assert ledger.is_complete(events, "FxExchRate", date(2022, 1, 31))
    assert not ledger.is_complete(events, "FxExchRate", date(2022, 2, 1))
    assert not ledger.is_complete(events, "FxExchRate")


def test_missing_dates(spark):
    calendar = spark.createDataFrame([(date(2022, 1, d),) for d in (3, 4, 5, 6)], "trade_date date")
    loaded = spark.createDataFrame([("a", date(2022, 1, 3)), ("a", date(2022, 1, 6)), ("b", date(2022, 1, 4))],
                                   "dataset string, trade_date date")
    rows = ledger.missing_dates(calendar, loaded).collect()
    assert sorted((r["dataset"], r["trade_date"].day) for r in rows) == [("a", 4), ("a", 5)]


def test_tables_from_a_folder_and_lookups(spark, tmp_path):
    names = spark.createDataFrame(
        [("A1", "first", "s"), ("A2", "second", "t")], "instrument_code string, instrument_name string, symbol string"
    )
    names.write.parquet(str(tmp_path / "NAMES"))
    sources = tables.SourceTables(spark, tables.Location("parquet", path=str(tmp_path)))
    stored = sources.load("NAMES")
    assert first_match(stored, "instrument_name", instrument_code="A2") == "second"
    assert first_match(stored, "instrument_code", instrument_name="first", symbol="s") == "A1"
    assert first_match(stored, "instrument_code", instrument_name="none") is None
    assert lineage.file_counts("NAMES", stored).agg(F.sum("n_rows")).first()[0] == 2
    upper = tables.scan(stored, ["symbol"], F.col("symbol") == "s", upper_columns=True)
    assert upper.columns == ["SYMBOL"] and upper.count() == 1
    held = spark.createDataFrame([("A1", "BOND"), ("A2", "STOCK")], "instrument_code string, instrument_type string")
    assert [r[0] for r in held_codes(held, "BOND").collect()] == ["A1"]
    assert held_codes(held).count() == 2
