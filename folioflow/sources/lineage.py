"""Field catalog and dataset audit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

UNKNOWN = "-"

_CATALOG = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("field_type", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("field_description", T.StringType()),
        T.StructField("sources", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _field_sources(f: T.StructField, main_table: str | None) -> dict:
    sources = dict(f.metadata.get("source_table", {}))
    if f.metadata.get("table_field"):
        sources[f.metadata.get("table_name") or main_table or UNKNOWN] = f.metadata["table_field"]
    return sources


def field_catalog(spark: SparkSession, datasets) -> DataFrame:
    """One row per dataset, field and source column; `-` where nothing is known."""
    rows = [
        (
            spec.category,
            spec.name,
            f.name,
            f.dataType.simpleString(),
            f.nullable,
            f.metadata.get("description"),
            _field_sources(f, spec.main_table),
        )
        for spec in datasets
        for f in spec.schema
    ]
    catalog = spark.createDataFrame(rows, _CATALOG)
    exploded = catalog.select(
        *[c for c in catalog.columns if c != "sources"],
        F.explode_outer("sources").alias("table_name", "table_field"),
    )
    return exploded.fillna(UNKNOWN)


def schema_table(spark: SparkSession, spec) -> DataFrame:
    """Fields of one dataset: name, type, nullable, source column, description."""
    return field_catalog(spark, [spec]).select(
        F.col("field_name").alias("name"),
        F.col("field_type").alias("type"),
        "nullable",
        "table_name",
        "table_field",
        F.col("field_description").alias("description"),
        "model",
    )


def audit(name: str, df: DataFrame, date_column: str | None = None) -> DataFrame:
    """Rows, days and null cells of one dataset, in one pass."""
    day = F.col(date_column).cast("date") if date_column else F.lit(None).cast("date")
    nulls = [F.count(F.when(F.col(c).isNull(), 1)) for c in df.columns]
    return df.agg(
        F.lit(name).alias("dataset"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        sum(nulls[1:], nulls[0]).alias("n_null_cells"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
    )


def audit_all(datasets: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """One row per dataset; each is scanned once."""
    audits = [audit(name, df, day) for name, (df, day) in datasets.items()]
    union = audits[0]
    for one in audits[1:]:
        union = union.unionByName(one)
    return union


def file_counts(name: str, df: DataFrame) -> DataFrame:
    """Rows per stored file of a dataset."""
    return (
        df.groupBy(F.input_file_name().alias("file"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("dataset", F.lit(name))
    )
