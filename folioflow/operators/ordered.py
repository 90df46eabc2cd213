"""Ordered operators per key: previous row, fills, as-of joins.

A window puts all rows of one key into one task. So the rows of a key are cut into slices by a
bucket of the order value, months for days and times, and each slice starts with one extra row
that carries what the earlier slices leave behind. Buckets never decrease with the order value,
so the result is that of the plain window, row for row, whatever the sizes; nothing is counted
beforehand. Carried values are found per slice by an aggregate, combined before the shuffle, and
handed on along the few slices of a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_SLICE = "_slice"
_CARRY = "_carry"


def slice_of(df: DataFrame, order: str) -> Column:
    """A bucket that never decreases along the order column, in the column's own order.

    Months of days and times, the first two characters of texts, the magnitude of numbers (to a
    sixteenth of a power of two; NaN above all numbers). Null is below everything. Values of
    other types are one slice.
    """
    kind = df.schema[order].dataType
    value = F.col(order)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        bucket = F.year(value) * 12 + F.month(value)
    elif isinstance(kind, T.StringType):
        return F.struct(value.isNotNull(), F.coalesce(F.substring(value, 1, 2), F.lit("")))
    elif isinstance(kind, T.NumericType):
        number = value.cast("double")
        steps = F.least(F.floor(F.log2(F.lit(1.0) + F.abs(number)) * 16), F.lit(1 << 20))
        bucket = F.when(F.isnan(number), F.lit(1 << 40)).otherwise(
            F.when(number < 0, -steps - 1).otherwise(steps)
        )
    else:
        return F.lit(0)
    return F.when(value.isNull(), F.lit(-(1 << 40))).otherwise(bucket.cast("long"))


def _sorted(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc(c) if descending else F.asc(c) for c in order]


def _with_carry_rows(df, by, order, values, descending) -> DataFrame:
    """Add, per key and slice, the last non-null of each value in the slices before it."""
    place = F.struct(*order)
    pick = F.min_by if descending else F.max_by
    tails = df.groupBy(*by, _SLICE).agg(
        *[pick(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c) for c in values]
    )
    before = (
        Window.partitionBy(*by)
        .orderBy(F.desc(_SLICE) if descending else F.asc(_SLICE))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = tails.select(
        *by,
        _SLICE,
        *[F.last(c, ignorenulls=True).over(before).alias(c) for c in values],
        F.lit(True).alias(_CARRY),
    )
    return df.withColumn(_CARRY, F.lit(False)).unionByName(carried, allowMissingColumns=True)


def _over_keys(df, by, order, values, outputs, make, descending, sliced) -> DataFrame:
    """Apply `make(value column, window)` per key in order, slice by slice."""
    if not sliced:
        w = Window.partitionBy(*by).orderBy(*_sorted(order, descending))
        return df.withColumns({out: make(c, w) for c, out in zip(values, outputs)})
    full = _with_carry_rows(df.withColumn(_SLICE, slice_of(df, order[0])), by, order, values, descending)
    w = Window.partitionBy(*by, _SLICE).orderBy(F.desc(_CARRY), *_sorted(order, descending))
    done = full.withColumns({out: make(c, w) for c, out in zip(values, outputs)})
    return done.where(~F.col(_CARRY)).drop(_CARRY, _SLICE)


def _last_known(name: str, window) -> Column:
    return F.last(name, ignorenulls=True).over(
        window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _fill(
    df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str], descending: bool, null_keys: bool = True
) -> DataFrame:
    """Fill nulls by the last known value of the key, the input read once.

    Within each slice of a key a window fills what the slice itself knows. The tail of every
    slice (its last known values) is an aggregate over the same partitioning, so it needs no
    exchange of its own and the exchange of the rows is reused: the input is scanned once. The
    tails, one row per slice, are carried along the key and joined back to the slices' rows,
    filling what is still null. Without `null_keys` the rows meet them where they lie: a join
    that matches nulls is one on other keys and shuffles them again.
    """
    sliced = df.withColumn(_SLICE, slice_of(df, order[0]))
    inside = Window.partitionBy(*by, _SLICE).orderBy(*_sorted(order, descending))
    local = sliced.withColumns({c: _last_known(c, inside) for c in columns})
    place = F.struct(*order)
    pick = F.min_by if descending else F.max_by
    tails = local.groupBy(*by, _SLICE).agg(
        *[pick(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns]
    )
    before = (
        Window.partitionBy(*by)
        .orderBy(F.desc(_SLICE) if descending else F.asc(_SLICE))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    keys = [*by, _SLICE]
    carried = tails.select(
        *[F.col(c).alias(f"_key_{i}") for i, c in enumerate(keys)],
        *[F.last(c, ignorenulls=True).over(before).alias(f"_in_{i}") for i, c in enumerate(columns)],
    )
    # Null keys meet null keys, as in the window. A slice is never null.
    pairs = [(F.col(f"_rows.`{c}`"), F.col(f"_key_{i}")) for i, c in enumerate(keys)]
    joined = local.alias("_rows").join(
        carried,
        [a.eqNullSafe(b) if null_keys else a == b for a, b in pairs],
        "left",
    )
    return joined.select(
        *[
            F.coalesce(F.col(f"_rows.`{c}`"), F.col(f"_in_{columns.index(c)}")).alias(c) if c in columns else F.col(f"_rows.`{c}`")
            for c in df.columns
        ]
    )


def fill_forward(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    sliced: bool = True,
) -> DataFrame:
    """Replace nulls by the last known value of the key; sliced, the input is read once."""
    if sliced:
        return _fill(df, by, order, list(columns), False)
    return _over_keys(df, by, order, columns, columns, _last_known, False, sliced)


def fill_backward(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    sliced: bool = True,
) -> DataFrame:
    """Replace nulls by the next known value of the key; sliced, the input is read once."""
    if sliced:
        return _fill(df, by, order, list(columns), True)
    return _over_keys(df, by, order, columns, columns, _last_known, True, sliced)


def previous_row(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    sliced: bool = False,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Value of the previous row of the key: `{column: output name}`.

    Not sliced unless asked for: callers have a row per day, so a key is bounded by the calendar.
    `earlier` holds rows that come before all of `df`: only the last one of each key is kept,
    by an aggregate, as the previous row of the key's first row here.
    """
    if earlier is not None:
        needed = list(dict.fromkeys([*order, *columns]))
        last = earlier.groupBy(*by).agg(F.max_by(F.struct(*needed), F.struct(*order)).alias("_last"))
        both = df.withColumn("_earlier", F.lit(False)).unionByName(
            last.select(*by, *[F.col("_last").getField(c).alias(c) for c in needed if c not in by])
            .withColumn("_earlier", F.lit(True)),
            allowMissingColumns=True,
        )
        done = previous_row(both, by, order, columns, sliced)
        return done.where(~F.col("_earlier")).drop("_earlier")
    if not sliced:
        w = Window.partitionBy(*by).orderBy(*[F.asc(c) for c in order])
        return df.withColumns({out: F.lag(c).over(w) for c, out in columns.items()})
    packed = df.withColumn("_row", F.struct(*columns))
    lagged = _over_keys(
        packed, by, order, ["_row"], ["_prev"], lambda c, w: F.lag(c).over(w), False, sliced
    )
    return lagged.withColumns(
        {out: F.col("_prev").getField(c) for c, out in columns.items()}
    ).drop("_row", "_prev")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str | tuple[str, str]],
    left_on: str,
    right_on: str,
    columns: Sequence[str] | dict[str, str],
    tie_break: Sequence[str] = (),
    direction: str = "backward",
    per_column: bool = False,
    sliced: bool = True,
) -> DataFrame:
    """Left join to the latest right row of the key at or before the left row's time
    (`direction="forward"`: the earliest at or after it).

    Among right rows at one time the largest by `tie_break` wins (the smallest when looking
    forward). With `per_column` each column takes its own latest known value instead of that
    of one row. Null keys match nothing. One shuffle: both sides are stacked and the last right
    row is carried over the left rows, so no row pairs are formed.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction: {direction}")
    backward = direction == "backward"
    pairs = [(c, c) if isinstance(c, str) else c for c in by]
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    keys = [f"_k{i}" for i in range(len(pairs))]
    ties = [f"_tie{i}" for i in range(len(tie_break))]

    if per_column:
        found = {f"_found{i}": F.col(c).alias(f"_found{i}") for i, c in enumerate(names)}
        results = [F.col(f).alias(out) for f, out in zip(found, names.values())]
    else:
        row = F.struct(*[F.col(c).alias(out) for c, out in names.items()])
        found = {"_found": row.alias("_found")}
        results = [F.col("_found").getField(out).alias(out) for out in names.values()]

    has_key = reduce(lambda a, b: a & b, [F.col(l).isNotNull() for l, _ in pairs], F.lit(True))
    stacked_left = left.where(has_key & F.col(left_on).isNotNull()).select(
        "*",
        *[F.col(l).alias(k) for (l, _), k in zip(pairs, keys)],
        F.col(left_on).alias("_time"),
        F.lit(1 if backward else 0).alias("_side"),
    )
    usable = reduce(lambda a, b: a & b, [F.col(r).isNotNull() for _, r in pairs], F.lit(True))
    stacked_right = right.where(usable & F.col(right_on).isNotNull()).select(
        *[F.col(r).alias(k) for (_, r), k in zip(pairs, keys)],
        F.col(right_on).alias("_time"),
        F.lit(0 if backward else 1).alias("_side"),
        *[F.col(c).alias(t) for c, t in zip(tie_break, ties)],
        *found.values(),
    )
    both = stacked_left.unionByName(stacked_right, allowMissingColumns=True)
    order = ["_time", "_side", *ties]
    if sliced:
        filled = _fill(both, keys, order, list(found), not backward, null_keys=False)
    else:
        filled = (fill_forward if backward else fill_backward)(both, keys, order, list(found), False)
    matched = filled.where(F.col("_side") == (1 if backward else 0)).select(
        *left.columns, *results
    )
    without_key = left.where(~(has_key & F.col(left_on).isNotNull()))
    return matched.unionByName(without_key, allowMissingColumns=True)
