"""Run queries and their SQL twins side by side: `python tests/oracle.py [sf] [name ...]`."""

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame):
    """Columns by name, rows sorted as text; numbers keep their full value."""
    columns = sorted(frame.columns)
    rows = []
    for row in frame[columns].itertuples(index=False, name=None):
        cells = []
        for v in row:
            if v is None or v != v:
                cells.append("NULL")
            elif isinstance(v, bool):
                cells.append(str(v))
            elif isinstance(v, float):
                cells.append(repr(v + 0.0))
            elif hasattr(v, "isoformat"):
                cells.append(v.isoformat()[:10] if "T00:00:00" in v.isoformat() else v.isoformat())
            else:
                cells.append(str(v))
        rows.append("|".join(cells))
    return columns, sorted(rows)


def compare(spark, con, sf_dir, name):
    """None if both sides agree, else a message."""
    from folioflow.queries import QUERIES

    entry = QUERIES[name]
    ours = entry.run(spark, sf_dir)
    got = ours.toPandas().astype(object)
    got = got.where(got.notna(), None)
    if entry.sql is None:
        return None if len(got) else "no rows"
    relation = con.sql(entry.sql)
    want = relation.df().astype(object)
    want = want.where(want.notna(), None)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types]))
    names = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
        "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
    }
    for f in ours.schema:
        if names.get(kinds[f.name], kinds[f.name]) != f.dataType.simpleString():
            return f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}"
    a, b = canonical(got)[1], canonical(want)[1]
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        return f"{len(different)} of {len(a)} rows differ, first: {different[0]}"
    return None if a else "no rows"


def main():
    from pyspark.sql import SparkSession

    from folioflow.queries import QUERIES

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("0") else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in args or list(QUERIES):
        start = time.time()
        try:
            message = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {name} {time.time() - start:.2f}s {message or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
