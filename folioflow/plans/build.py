"""Building, writing and recording datasets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.schemas import DATASETS, DatasetSpec
from folioflow.sources import ledger, state
from folioflow.sources.datasets import (
    INSTRUMENT_CODE,
    TRADE_DATE,
    conform,
    dataset_exists,
    read_dataset,
    upsert_by_date,
    write_dataset,
)
from folioflow.sources.tables import SourceTables, in_span, month_predicates, rename_from_schema

BUILDERS: dict[str, Callable[["BuildContext"], DataFrame]] = {}
#: Datasets whose rows look back at the last earlier row of their key: (key, order).
LAST_ROWS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {}


@dataclass(frozen=True)
class BuildContext:
    """What a builder reads: source tables, a span of days, codes, datasets already stored.

    `stored` holds what earlier runs stored of the dataset that is being built; its rows before
    the span give previous values at the span's first day.
    """

    sources: SourceTables
    start: date | None = None
    end: date | None = None
    codes: DataFrame | None = None
    datasets: Mapping[str, DataFrame] = field(default_factory=dict)
    stored: Mapping[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str, day: str | None = None, history: bool = False) -> DataFrame:
        """A source table, bounded by the span if it has a day column; with `history` by its end
        only. A span with both ends is read month by month, each in a task of its own, where
        the source takes predicates."""
        start = None if history else self.start
        months = month_predicates(day, start, self.end) if day and start and self.end else None
        df = self.sources.load(name, months)
        if day is None:
            return df
        return df.withColumn(day, F.col(day).cast("date")).where(in_span(day, start, self.end))

    def earlier(self, name: str) -> DataFrame | None:
        """Rows of a dataset before the span: stored ones, else those its builder gives for the
        time before. None if the span has no start."""
        if self.start is None:
            return None
        if name in self.stored:
            return self.stored[name].where(F.col(TRADE_DATE) < F.lit(self.start))
        return build_dataset(name, self.before())

    def before(self) -> "BuildContext | None":
        """The same reads for all the time before the span; None if the span has no start."""
        if self.start is None:
            return None
        return replace(self, start=None, end=self.start - timedelta(days=1))

    def in_span(self, day: str) -> Column:
        return in_span(day, self.start, self.end)

    def dataset(self, name: str) -> DataFrame:
        """A stored dataset if there is one, else its plan."""
        return self.datasets[name] if name in self.datasets else build_dataset(name, self)

    def held(self, types: str | None = None) -> DataFrame | None:
        """The codes to load: those asked for, else those held, else no restriction."""
        if self.codes is not None:
            return self.codes
        if "CombPosition" not in self.datasets:
            return None
        positions = self.datasets["CombPosition"]
        if types:
            positions = positions.where(F.col("instrument_type") == types)
        return positions.select("instrument_code").distinct()


def builds(name: str):
    """Register the builder of a dataset."""

    def register(builder):
        BUILDERS[name] = builder
        return builder

    return register


def keeps_last_rows(name: str, by: tuple[str, ...], order: tuple[str, ...]) -> None:
    """Declare that loads of a dataset read the last row of each key before their span, so
    that a state of these rows is kept beside the stored dataset (see `sources.state`)."""
    LAST_ROWS[name] = (tuple(by), tuple(order))


def build_dataset(name: str, context: BuildContext) -> DataFrame:
    rows = BUILDERS[name](context)
    schema = DATASETS[name].schema
    return conform(rows, schema) if schema is not None else rows


def rename_for(name: str, df: DataFrame) -> DataFrame:
    """Source column names to the names of a declared dataset."""
    return rename_from_schema(df, DATASETS[name].schema)


def restrict(df: DataFrame, codes: DataFrame | None, column: str) -> DataFrame:
    if codes is None:
        return df
    wanted = codes.select(F.col(codes.columns[0]).alias(column)).distinct()
    return df.join(wanted, column, "left_semi")


def store(
    df: DataFrame,
    spec: DatasetSpec,
    path: str,
    rebuild: bool = False,
    by_code: bool = False,
    partial: bool = False,
) -> None:
    """Month datasets are upserted by date, by date and code if the load was for some codes; so
    are other dated ones if the load was `partial`, for a span or some codes. The rest is
    replaced."""
    options = {"max_rows_per_file": spec.max_rows_per_file, "sort_within": spec.sort_within}
    dated = spec.schema is not None and TRADE_DATE in spec.schema.fieldNames()
    if dated and (spec.grain or partial) and not rebuild:
        coded = by_code and INSTRUMENT_CODE in spec.schema.fieldNames()
        keys = [TRADE_DATE, INSTRUMENT_CODE] if coded else [TRADE_DATE]
        upsert_by_date(df, path, spec.schema, spec.partition_by, spec.grain, replace_by=keys, **options)
    else:
        write_dataset(
            df, path, spec.schema, spec.partition_by, spec.grain, rebuild=rebuild, **options
        )


def dataset_path(root: str, name: str) -> str:
    return f"{root}/{DATASETS[name].category}/{name}"


def run_dataset(
    name: str,
    context: BuildContext,
    root: str,
    ledger_path: str | None = None,
    rebuild: bool = False,
) -> bool:
    """Build and store a dataset. With a ledger, a run whose span and codes earlier runs already
    cover is skipped (unless rebuilding), and the outcome is recorded. Errors are raised."""
    spark = context.sources.spark
    spec = DATASETS[name]
    until = context.end or date.today()
    scope = ledger.EVERY_CODE
    if context.codes is not None:
        codes = context.codes.select(F.col(context.codes.columns[0]).cast("string").alias("c")).distinct()
        total = codes.agg(F.count(F.lit(1)), F.sum(F.xxhash64("c").cast("decimal(38,0)"))).first()
        scope = f"{total[0]} codes {total[1]}"
    if ledger_path and not rebuild and dataset_exists(spark, ledger_path):
        events = ledger.read_ledger(spark, ledger_path)
        if ledger.is_complete(events, name, until, context.start, scope):
            return False

    def record(status: str, message: str = "") -> None:
        if ledger_path:
            ledger.record(spark, ledger_path, name, until, status, message, context.start, scope)

    path = dataset_path(root, name)
    record(ledger.START)
    try:
        _load(name, context, root, path, rebuild)
    except Exception as error:
        record(ledger.FAILED, str(error)[:500])
        raise
    record(ledger.COMPLETE, "OK")
    return True


def state_path(root: str, name: str) -> str:
    return f"{root}/_state/{name}"


def _load(name: str, context: BuildContext, root: str, path: str, rebuild: bool, repair: bool = True) -> None:
    """Build and store one load. A dataset that keeps the state of its last rows reads, before
    the span, only that state (and stored days it does not cover yet), and leaves the state of
    its last day; a load of days that later stored rows look back at works these rows out again
    (`_repair_after`)."""
    spark = context.sources.spark
    spec = DATASETS[name]
    dated = spec.schema is not None and TRADE_DATE in spec.schema.fieldNames()
    keyed = LAST_ROWS.get(name) if dated else None
    states = state_path(root, name)

    def stored_between(start: date | None, end: date | None) -> DataFrame:
        return read_dataset(spark, path, spec.schema, spec.partition_by, spec.grain, start=start, end=end)

    exists = dated and dataset_exists(spark, path)
    held = None
    if context.start and exists:
        if keyed:
            state.invalidate(spark, states, context.start)
            held = state.before(spark, states, context.start, stored_between, *keyed, spec.schema)
        else:
            held = stored_between(None, context.start - timedelta(days=1))
        context = replace(context, stored={**context.stored, name: held})
    by_code = context.codes is not None
    partial = by_code or context.start is not None or context.end is not None
    store(build_dataset(name, context), spec, path, rebuild, by_code, partial)
    if not keyed:
        return
    if by_code:
        # Only some codes changed within the span: what stays true is the state before it.
        # That is the version of the day before the span, which `state.before` left.
        return
    last_day = context.end or date.today()
    written = stored_between(context.start, last_day)
    rows = written if held is None else held.unionByName(written.select(*held.columns))
    state.write_version(spark, states, last_day, state.last_rows(rows, *keyed).select(*spec.schema.fieldNames()))
    if repair and context.end is not None:
        _repair_after(name, context, root, path, last_day, stored_between)


def _repair_after(name: str, context: BuildContext, root: str, path: str, last_day: date, stored_between) -> None:
    """After a load that ends before stored rows (a backfill), the first stored row of each key
    after it looked back at rows that have changed. All these rows lie between the day after
    the load and the latest of the keys' first days after it: that span is built again from the
    new state, and its own state is left. Later rows look back at rows of that span, which keep
    their values, so nothing further changes. A forward load finds no later rows."""
    spark = context.sources.spark
    by, _ = LAST_ROWS[name]
    later = stored_between(last_day + timedelta(days=1), None)
    until = later.groupBy(*by).agg(F.min(TRADE_DATE).alias("_first")).agg(F.max("_first")).first()[0]
    if until is None:
        return
    again = replace(context, start=last_day + timedelta(days=1), end=until, codes=None)
    _load(name, again, root, path, rebuild=False, repair=False)
