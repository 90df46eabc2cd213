"""Load ledger: one appended row per run event, queried for what is complete."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Run states.
START, COMPLETE, FAILED = "START", "COMP", "FAILED"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("scope", T.StringType()),
    ]
)
EVERY_CODE = "*"


def record(
    spark: SparkSession,
    path: str,
    dataset: str,
    business_date: date,
    status: str,
    message: str = "",
    start_date: date | None = None,
    scope: str = EVERY_CODE,
) -> None:
    """Append one event of a run from `start_date` (none: all history) to `business_date`.
    `scope` tells runs of all codes from runs of some."""
    row = spark.createDataFrame(
        [(dataset, business_date, status, message, start_date, scope)],
        "dataset string, business_date date, status string, message string, start_date date, scope string",
    )
    row.withColumn("event_time", F.current_timestamp()).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def latest_status(ledger: DataFrame, order: tuple[str, ...] = ("event_time",)) -> DataFrame:
    """Newest status and business date of each dataset."""
    newest = ledger.groupBy("dataset").agg(
        F.max_by(F.struct("status", "business_date"), F.struct(*order)).alias("last"),
        F.count(F.lit(1)).alias("n_events"),
    )
    return newest.select("dataset", "last.status", "last.business_date", "n_events")


def is_complete(
    ledger: DataFrame,
    dataset: str,
    until: date | None = None,
    start: date | None = None,
    scope: str = EVERY_CODE,
) -> bool:
    """Whether completed runs of these codes (or of all) cover the span from `start` (none: all
    history) to `until` without a gap. A run counts if no later event of its span failed or is
    still open. Without an end date the answer is no. A dataset has one row per run here."""
    if until is None:
        return False
    events = ledger.where(
        (F.col("dataset") == dataset) & F.col("scope").isin(scope, EVERY_CODE)
    ).orderBy("event_time", F.col("status") != START)
    covered: list[tuple[date, date]] = []
    for event in events.select("start_date", "business_date", "status").collect():
        first, last = event["start_date"] or date.min, event["business_date"]
        if event["status"] == COMPLETE:
            covered.append((first, last))
        else:
            covered = [c for c in covered if c[1] < first or last < c[0]]
    reached = start or date.min
    for first, last in sorted(covered):
        if first > reached:
            break
        if last >= until:
            return True
        reached = max(reached, last + timedelta(days=1))
    return False


def missing_dates(
    calendar: DataFrame, loaded: DataFrame, day: str = "trade_date", dataset: str = "dataset"
) -> DataFrame:
    """Calendar days within a dataset's first and last load on which it has no rows."""
    have = loaded.select(dataset, day).distinct()
    span = have.groupBy(dataset).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    expected = span.withColumn(
        day, F.explode(F.sequence("_first", "_last", F.expr("interval 1 day")))
    ).select(dataset, day)
    business = calendar.select(day).distinct()
    return expected.join(business, day, "left_semi").join(have, [dataset, day], "left_anti")
