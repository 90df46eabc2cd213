"""Business days: shifts and day lists. A calendar has one row per calendar id and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from folioflow.operators.ordered import asof_join
from folioflow.operators.sizes import broadcast_if_small

DEFAULT_SCOPE, ALL_SCOPE = "CAL0004", "ALL"


def ranked_calendar(calendar: DataFrame, calendar_id: str = "calendar_id", day: str = "calendar_date") -> DataFrame:
    """Each calendar's days numbered from 1, with the number of days."""
    days = calendar.select(calendar_id, day).distinct()
    by_day = Window.partitionBy(calendar_id).orderBy(day)
    whole = Window.partitionBy(calendar_id)
    return days.withColumns(
        {"rank": F.row_number().over(by_day), "n_days": F.count(F.lit(1)).over(whole)}
    )


def business_day_shift(
    df: DataFrame,
    calendar: DataFrame,
    column: str,
    n: int,
    output: str,
    calendar_id: str = "calendar_id",
    day: str = "calendar_date",
) -> DataFrame:
    """The business day `n` steps before a date.

    n > 0 counts back from the last business day on or before the date, n < 0 counts forward
    from the first on or after it, n = 0 is the first on or after. If the calendar is too
    short the farthest day is taken; a date outside the calendar gives null. Rows choose their
    calendar by `calendar_id` if they have that column; otherwise the calendar must hold one.

    The answer is worked out once for every day of the calendar's span and looked up, so the
    rows of `df` are joined to a frame of one row per calendar and day and never sorted.
    """
    ranked = ranked_calendar(calendar, calendar_id, day)
    keyed = calendar_id in df.columns
    keys = [calendar_id] if keyed else []
    span = calendar.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if span["first"] is None:
        return df.withColumn(output, F.lit(None).cast("date"))
    before, after = F.date_sub(F.lit(span["first"]), 1), F.date_add(F.lit(span["last"]), 1)
    dates = ranked.select(calendar_id).distinct().withColumn(
        "_date", F.explode(F.sequence(before, after))
    )
    base = asof_join(
        dates,
        ranked,
        [calendar_id],
        "_date",
        day,
        {"rank": "_rank", "n_days": "_n_days"},
        direction="backward" if n > 0 else "forward",
        sliced=False,
    ).where(F.col("_rank").isNotNull())
    wanted = base.withColumn(
        "_rank", F.greatest(F.lit(1), F.least(F.col("_n_days"), F.col("_rank") - F.lit(n)))
    )
    target = ranked.select(calendar_id, F.col("rank").alias("_rank"), F.col(day).alias(output))
    shifted = wanted.join(target, [calendar_id, "_rank"]).select(*keys, "_date", output)
    own_day = F.col(column).cast("date")
    within = F.when(own_day.isNotNull(), F.greatest(before, F.least(after, own_day)))
    return (
        df.withColumn("_date", within)
        .join(broadcast_if_small(shifted), [*keys, "_date"], "left")
        .select(*df.columns, output)
    )


def last_business_days(
    calendar: DataFrame, until, n: int = 252, day: str = "calendar_date"
) -> DataFrame:
    """The last n + 1 business days on or before a date, newest first."""
    return calendar.where(F.col(day) <= F.lit(until)).orderBy(F.desc(day)).limit(n + 1)


def last_business_days_by_calendar(
    calendar: DataFrame,
    until,
    n: int = 252,
    calendar_id: str = "calendar_id",
    day: str = "calendar_date",
) -> DataFrame:
    """The same for every calendar at once."""
    days = calendar.where(F.col(day) <= F.lit(until)).select(calendar_id, day).distinct()
    newest = Window.partitionBy(calendar_id).orderBy(F.desc(day))
    return days.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n + 1)


def days_of_calendar(
    calendar: DataFrame,
    chosen: str | None = "CAL0002",
    start=None,
    end=None,
    calendar_id: str = "calendar_id",
    day: str = "calendar_date",
) -> DataFrame:
    """Business days of one calendar within a span."""
    days = calendar
    if start is not None:
        days = days.where(F.col(day) >= F.lit(start))
    if end is not None:
        days = days.where(F.col(day) <= F.lit(end))
    return days.where(F.col(calendar_id) == chosen) if chosen else days


def scoped_calendar(defaults: DataFrame, dates: DataFrame) -> DataFrame:
    """All business days twice: under the default calendar's scope and under `ALL`."""
    of_default = dates.join(defaults, "calendar_id").withColumn("scope", F.lit(DEFAULT_SCOPE))
    everything = dates.withColumn("scope", F.lit(ALL_SCOPE))
    columns = ["scope", "calendar_id", "calendar_date"]
    return of_default.select(*columns).unionByName(everything.select(*columns)).dropna()
