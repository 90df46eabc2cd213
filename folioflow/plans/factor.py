"""Factor panels and financial indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.functions.dates import parse_day
from folioflow.operators.statements import KEYS, merge_statements
from folioflow.plans.build import BuildContext, builds, rename_for
from folioflow.schemas import DATASETS, PANEL_TABLES

AUDIT_COLUMNS = ("create_time", "update_time")
ANNUAL_PERIOD, MERGED_REPORT = "004", "003"
PERCENT_INDICATORS = ("return_on_total_assets_float", "gross_profit_margin_float")


def load_panel(
    ctx: BuildContext,
    table: str,
    day: str = "trade_date",
    drop: tuple[str, ...] = (),
    parse: bool = False,
    bounded: bool = False,
) -> DataFrame:
    """A factor table as it comes: audit columns dropped, text dates parsed, span applied."""
    panel = ctx.table(table).drop(*drop)
    panel = panel.withColumn(day, parse_day(day) if parse else F.col(day).cast("date"))
    return panel.where(ctx.in_span(day)) if bounded else panel


def _register_panel(name: str, table: str) -> None:
    audited = table.endswith("_CNE5")
    parse = "LEVEL3_" in table

    @builds(name)
    def panel(ctx: BuildContext) -> DataFrame:
        drop = AUDIT_COLUMNS if audited else ()
        return load_panel(ctx, table, drop=drop, parse=parse, bounded=audited)


for _name, _table in PANEL_TABLES.items():
    _register_panel(_name, _table)


def _statement(ctx: BuildContext, table: str, day: str = "ANC_DATE") -> DataFrame:
    """One statement under dataset names: keys, then the fields taken from this table."""
    fields = [
        f.name
        for f in DATASETS["FinancialIndicator"].schema
        if f.metadata.get("table_name") == table
    ]
    rows = ctx.table(table, day)
    if day != "ANC_DATE":
        rows = rows.withColumnRenamed(day, "ANC_DATE")
    rows = rename_for("FinancialIndicator", rows)
    return rows.select(
        *[F.col(k).cast("date" if k.endswith("_date") else "string").alias(k) for k in KEYS],
        *[F.col(f).cast("double").alias(f) for f in fields],
    )


@builds("FinancialIndicator")
def financial_indicator(ctx: BuildContext) -> DataFrame:
    merged = F.col("report_type") == MERGED_REPORT
    annual = merged & (F.col("reporting_period_type") == ANNUAL_PERIOD)
    return merge_statements(
        _statement(ctx, "INFO_PARTY_FIN_BALANCE").where(merged),
        _statement(ctx, "INFO_PARTY_FIN_INCOME").where(annual),
        _statement(ctx, "INFO_PARTY_FIN_CASHFLOW").where(annual),
        _statement(ctx, "INFO_PARTY_FIN_INDDRV", "ANC_DATE_LAT"),
        percent_columns=PERCENT_INDICATORS,
    )
