"""Financial statements side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

KEYS = ("issuer_code", "report_type", "reporting_period_type", "trade_date", "due_date")


def full_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join in which null keys match null keys."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(F.col(f"_{k}")) for k in keys])
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return left.withColumn("_left", F.lit(True)).join(other, same, "full").select(
        *[F.when(F.col("_left"), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys], *rest
    )


def merge_statements(
    balance: DataFrame,
    income: DataFrame,
    cashflow: DataFrame,
    derived: DataFrame,
    keys: Sequence[str] = KEYS,
    percent_columns: Sequence[str] = (),
) -> DataFrame:
    """One row per company, report and period that occurs in any statement."""
    merged = reduce(
        lambda a, b: full_join_null_safe(a, b, keys), [income, cashflow, derived], balance
    )
    return merged.withColumns({c: F.col(c).cast("double") / 100.0 for c in percent_columns})
