"""The state of the last rows: versions, backfills, and loads that read one version only."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from folioflow.plans import BuildContext, run_dataset
from folioflow.plans.build import LAST_ROWS, dataset_path, state_path
from folioflow.queries.bindings import bound_sources
from folioflow.queries.span_builds import SPANS
from folioflow.schemas import DATASETS
from folioflow.sources import datasets, state

SCHEMA = "code string, trade_date date, price double"
D = dt.date


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def folder(spark):
    return f"{spark.sparkContext.getCheckpointDir()}/state-test-{uuid.uuid4().hex}"


def test_last_rows_take_the_latest_of_each_key(spark):
    df = rows(spark, [("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 3), 3.0), ("b", D(2020, 1, 2), None), ("a", D(2020, 1, 2), 2.0)])
    got = {r["code"]: r["price"] for r in state.last_rows(df, ["code"], ["trade_date"]).collect()}
    assert got == {"a": 3.0, "b": None}


def test_versions_are_made_merged_and_invalidated(spark):
    path, stored_path = folder(spark), folder(spark)
    history = rows(spark, [("a", D(2020, 1, d), float(d)) for d in range(1, 29)] + [("b", D(2020, 1, 5), 5.0)])
    history.write.parquet(stored_path)
    schema = history.schema

    def stored_between(start, end):
        df = spark.read.schema(schema).parquet(stored_path)
        if start:
            df = df.where(F.col("trade_date") >= start)
        return df.where(F.col("trade_date") <= end) if end else df

    first = state.before(spark, path, D(2020, 1, 10), stored_between, ["code"], ["trade_date"], schema)
    assert state.versions(spark, path) == [D(2020, 1, 9)]
    assert {r["code"]: r["price"] for r in first.collect()} == {"a": 9.0, "b": 5.0}
    # A later load merges the version with the days after it only.
    later = state.before(spark, path, D(2020, 1, 20), stored_between, ["code"], ["trade_date"], schema)
    assert {r["code"]: r["price"] for r in later.collect()} == {"a": 19.0, "b": 5.0}
    assert state.versions(spark, path) == [D(2020, 1, 19)]
    assert all(f.startswith(f"{path}/as_of=2020-01-19".replace("file:", "")) or "as_of=2020-01-19" in f for f in later.inputFiles())
    # A backfill from the 15th makes the version of the 19th stale.
    state.invalidate(spark, path, D(2020, 1, 15))
    assert state.versions(spark, path) == []


def test_a_load_reads_one_version_not_the_history(spark):
    """After two loads, the rows before the third come from one version alone."""
    sf_dir = "/root/testdata/sf0.001"
    root = folder(spark)
    sources = bound_sources(spark, sf_dir)
    name = "FundDailyQuote"
    for start, end in SPANS[:2]:
        run_dataset(name, BuildContext(sources, start, end), root)
    states = state_path(root, name)
    assert state.versions(spark, states) == [SPANS[1][1]]
    spec = DATASETS[name]
    path = dataset_path(root, name)

    def stored_between(start, end):
        return datasets.read_dataset(spark, path, spec.schema, spec.partition_by, spec.grain, start=start, end=end)

    held = state.before(spark, states, SPANS[2][0], stored_between, *LAST_ROWS[name], spec.schema)
    assert held.inputFiles() and all("as_of=" in f for f in held.inputFiles())
    whole = state.last_rows(stored_between(None, None), *LAST_ROWS[name])
    assert sorted(map(tuple, held.collect()), key=str) == sorted(map(tuple, whole.select(*held.columns).collect()), key=str)
