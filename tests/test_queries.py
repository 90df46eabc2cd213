"""Every registered query against its SQL twin on the smallest tables, and its plan."""

import re

import pytest
from oracle import compare, duck

from folioflow.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


WRITES = {"month_partitions", "quarter_partitions", "field_catalog"}
#: Built by running their builders several times; the plans are those of the dataset queries.
SPANS = {n for n in QUERIES if n.startswith(("span_", "backfill_"))} | {"backfill_then_read"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES - SPANS))
def test_plan(spark, name):
    """No Python in the plan, no products of two sides."""
    execution = QUERIES[name].run(spark, SF_DIR)._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    assert not re.search(r"PythonUDF|EvalPython|InPandas|InArrow", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["weighted_term"].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate",
    }
