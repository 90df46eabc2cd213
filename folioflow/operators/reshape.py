"""Long and wide forms, tagged unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack labelled frames and drop rows with a null."""
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in frames.items()]).dropna()


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str],
    name: str,
    value: str,
    keep_nulls: bool = False,
) -> DataFrame:
    """Columns to (label, value) rows: `measures` maps column to label."""
    labelled = df.select(*ids, *[F.col(c).cast("double").alias(l) for c, l in measures.items()])
    columns = [F.col(f"`{label}`") for label in measures.values()]
    long = labelled.unpivot(list(ids), columns, name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def pivot_series(
    df: DataFrame, index: Sequence[str], column: str, values: Sequence, measure: str
) -> DataFrame:
    """One column per listed value, for presentation. The values are given, so no extra pass
    looks for them, and one row per index and value is combined before the shuffle. A value
    that is not listed (null included) fails the query; leave such rows out beforehand."""
    listed = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    unlisted = F.raise_error(
        F.concat(F.lit(f"{column} has a value that is not listed: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    )
    # The check sits in the measure, which every row hands to the aggregate.
    checked = df.withColumn(measure, F.when(listed, F.col(measure)).otherwise(unlisted.cast(df.schema[measure].dataType)))
    return checked.groupBy(*index).pivot(column, list(values)).agg(F.first(measure, ignorenulls=True))


def stack_series(
    df: DataFrame,
    series: Mapping[str, str],
    index: str = "instrument_code",
    day: str = "trade_date",
    name: str = "time_series_type",
    value: str = "rate",
) -> DataFrame:
    """Several measures of one quote frame as one long series frame: `{column: type}`."""
    return unpivot_measures(df, [index, day], series, name, value)
