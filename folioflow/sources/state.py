"""State of the last rows: one row per key, as of the end of a load, kept beside a dataset.

A dataset whose rows look back at the previous row of their key (previous quantities, the
previous price of a return) needs, at the first day of a load, the last stored row of every
key before it. Reading all stored history for that grows with every month loaded. Instead,
every load leaves a version: the last row of each key up to the load's last day, written to
`<state>/as_of=<day>`. The next load takes the newest version before its first day and only
the stored rows between that day and its own first day (none, when loads follow each other),
merges them by key with `max_by`, and after its write leaves the version of its own last day.

A load of days that a version already covers (a backfill) removes every version from its first
day on before it writes, so no version ever describes rows that have changed. Versions are
kept to one: the newest is written completely before the older ones are removed, so an
interrupted load leaves either the old version or both, never none that is wrong.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PREFIX = "as_of="


def _fs(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[date]:
    """The days of the complete versions below `path`, oldest first (a handful of names)."""
    location, fs = _fs(spark, path)
    if not fs.exists(location):
        return []
    found = []
    for status in fs.listStatus(location):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if status.isDirectory() and name.startswith(PREFIX) and fs.exists(done):
            found.append(date.fromisoformat(name[len(PREFIX) :]))
    return sorted(found)


def _remove(spark: SparkSession, path: str, days: Sequence[date]) -> None:
    for day in days:
        location, fs = _fs(spark, f"{path}/{PREFIX}{day.isoformat()}")
        fs.delete(location, True)


def last_rows(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by `order`: an aggregate that combines before its shuffle.

    Where one day orders the rows the others are taken one by one: all see the rows in the same
    order, so they come from one row, and numbers and days are then aggregated in hash tables,
    without a sort of all rows. A row without a day comes before all others."""
    columns = [c for c in rows.columns if c not in by]
    if len(order) == 1:
        place = F.coalesce(F.unix_date(order[0]), F.lit(-(1 << 31))) if rows.schema[order[0]].dataType == T.DateType() else F.struct(*order)
        last = [F.max_by(c, place).alias(c) for c in columns if c != order[0]]
        return rows.groupBy(*by).agg(F.max(order[0]).alias(order[0]), *last).select(*by, *columns)
    last = rows.groupBy(*by).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    return last.select(*by, *[F.col("_last").getField(c).alias(c) for c in columns])


def invalidate(spark: SparkSession, path: str, first_day: date) -> None:
    """Remove the versions that a load from `first_day` on makes stale."""
    _remove(spark, path, [d for d in versions(spark, path) if d >= first_day])


def before(
    spark: SparkSession,
    path: str,
    first_day: date,
    stored_between,
    by: Sequence[str],
    order: Sequence[str],
    schema,
) -> DataFrame:
    """The last row of every key before `first_day`, as the version of the day before.

    `stored_between(start, end)` reads stored rows of those days (either may be None). Where
    that version is missing it is made from the newest version before the day and the stored
    rows after it, or without any version from all stored rows before the day, and written.
    """
    usable = [d for d in versions(spark, path) if d < first_day]
    last_day = first_day - timedelta(days=1)
    if not usable or usable[-1] != last_day:
        if not usable:
            rows = stored_between(None, last_day)
        else:
            held = spark.read.schema(schema).parquet(f"{path}/{PREFIX}{usable[-1].isoformat()}")
            gap = stored_between(usable[-1] + timedelta(days=1), last_day)
            rows = held.unionByName(gap.select(*schema.fieldNames()))
        # Written before the load rewrites the stored rows it was read from.
        write_version(spark, path, last_day, last_rows(rows, by, order).select(*schema.fieldNames()))
    return spark.read.schema(schema).parquet(f"{path}/{PREFIX}{last_day.isoformat()}")


def write_version(spark: SparkSession, path: str, day: date, rows: DataFrame) -> None:
    """Write the version of `day`, then remove every other one."""
    rows.write.mode("overwrite").parquet(f"{path}/{PREFIX}{day.isoformat()}")
    _remove(spark, path, [d for d in versions(spark, path) if d != day])
