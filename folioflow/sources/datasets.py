"""Stored datasets: filtered reads, partitioned writes, upserts by date, exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folioflow.functions.dates import partition_key
from folioflow.sources.storage import remove_path, staging
from folioflow.sources.tables import all_of, in_span

# Default column names, date grains and rows per row group.
TRADE_DATE = "trade_date"
INSTRUMENT_CODE = "instrument_code"
DOWN_FLAG = "down_flag"
DATE_GRAINS = ("year", "month", "day", "quarter")
ROW_GROUP_ROWS = 1024 * 1024


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Schema order and types; undeclared columns are dropped, absent ones are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name, metadata=f.metadata)
            for f in schema
        ]
    )


def match(column: str, value) -> Column:
    """A list means IN, anything else equality."""
    if isinstance(value, (list, tuple, set)):
        return F.col(column).isin(list(value))
    return F.col(column) == F.lit(value)


def drill_down_predicate(conditions: Mapping, supported: bool, flag: str = "1") -> dict:
    """Add `down_flag = flag` for drill-down datasets unless the caller already chose."""
    chosen = dict(conditions)
    if supported:
        chosen.setdefault(DOWN_FLAG, flag)
    return chosen


def filter_dataset(
    df: DataFrame,
    codes: Sequence[str] | DataFrame | None = None,
    start: date | None = None,
    end: date | None = None,
    where: Mapping | None = None,
    columns: Sequence[str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    newest_first: bool = False,
    sort: Sequence[tuple[str, bool]] = (),
    date_column: str = TRADE_DATE,
    code_column: str = INSTRUMENT_CODE,
    grain: str | None = None,
) -> DataFrame:
    """The read of every dataset: conditions are ANDed, filter columns stay in the projection.

    The date bounds are ignored by datasets without a date column. With a `grain`, they also
    bound the partition column, so only the partitions needed are listed. `codes` may be a
    frame of codes, which becomes a semi join. `sort` lists (column, ascending) pairs that
    order the rows after the date of `newest_first`.
    """
    where = dict(where or {})
    predicates = []
    kept = list(columns) if columns is not None else None
    dated = date_column in df.columns and (start is not None or end is not None)
    if dated:
        predicates.append(in_span(date_column, start, end))
        if kept is not None:
            kept.append(date_column)
        if grain in df.columns:
            if start is not None:
                predicates.append(F.col(grain) >= partition_key(F.lit(start), grain))
            if end is not None:
                predicates.append(F.col(grain) <= partition_key(F.lit(end), grain))
    if codes is not None and not isinstance(codes, DataFrame):
        where[code_column] = list(codes)
    predicates += [match(c, v) for c, v in where.items()]
    if kept is not None:
        kept += list(where)
        if isinstance(codes, DataFrame):
            kept.append(code_column)
    found = df.where(all_of(predicates))
    if isinstance(codes, DataFrame):
        found = found.join(codes.select(code_column).distinct(), code_column, "left_semi")
    if kept is not None:
        found = found.select(*dict.fromkeys(kept))
    order = [F.desc(date_column)] if newest_first and date_column in found.columns else []
    order += [F.asc(c) if ascending else F.desc(c) for c, ascending in sort]
    if order:
        found = found.orderBy(*order)
    return found.transform(transform) if transform else found


def stored_schema(
    schema: T.StructType, partition_by: Sequence[str], grain: str | None
) -> T.StructType:
    """Schema on disk: partition values are text, so `202001` stays text."""
    fields = [f for f in schema if f.name not in partition_by]
    fields += [f for f in schema if f.name in partition_by]
    if grain:
        fields.append(T.StructField(grain, T.StringType()))
    return T.StructType(fields)


def read_dataset(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    grain: str | None = None,
    **filters,
) -> DataFrame:
    """Read a stored dataset; the filters are those of `filter_dataset`."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(stored_schema(schema, partition_by, grain))
    df = reader.parquet(path)
    if grain and schema is None:
        df = df.withColumn(grain, F.col(grain).cast("string"))
    found = filter_dataset(df, grain=grain, **filters)
    return found.drop(grain) if grain and schema is not None else found


def write_dataset(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    grain: str | None = None,
    date_column: str = TRADE_DATE,
    rebuild: bool = False,
    max_rows_per_file: int | None = None,
    sort_within: Sequence[str] = (),
) -> None:
    """Write parquet. Partitioned data replaces only the partitions it holds, unless `rebuild`.

    Rows are gathered by partition through the rebalance hint: each partition is written by
    few tasks, and adaptive execution splits a partition that is too large for one.
    """
    rows = conform(df, schema) if schema is not None else df
    folders = list(partition_by)
    if grain:
        rows = rows.withColumn(grain, partition_key(date_column, grain))
        folders.append(grain)
    if folders:
        rows = rows.hint("rebalance", *[F.col(c) for c in folders])
    if sort_within:
        rows = rows.sortWithinPartitions(*folders, *sort_within)
    writer = rows.write.mode("overwrite")
    if folders:
        mode = "static" if rebuild else "dynamic"
        writer = writer.partitionBy(*folders).option("partitionOverwriteMode", mode)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.option("parquet.block.row.count.limit", ROW_GROUP_ROWS).parquet(path)


def dataset_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def not_held(stored: DataFrame, batch: DataFrame, keys: Sequence[str], few: bool = False) -> DataFrame:
    """Stored rows whose keys the batch does not hold. Null equals null.

    `few` says that the keys have few values, such as days: these are broadcast. A join on them
    would put all stored rows of a day into one task.
    """
    held = batch.select(*[F.col(c).alias(f"_held_{c}") for c in keys]).distinct()
    same = all_of([F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in keys])
    return stored.join(F.broadcast(held) if few else held, same, "left_anti")


def merge_by(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose keys the batch does not hold, plus the batch. Null equals null."""
    return not_held(stored, batch, keys).unionByName(batch, allowMissingColumns=True)


def merge_by_date(stored: DataFrame, batch: DataFrame, date_column: str = TRADE_DATE) -> DataFrame:
    """Stored rows of dates the batch does not hold, plus the batch."""
    return merge_by(stored, batch, [date_column])


def _folder(spark: SparkSession, path: str, columns: Sequence[str], row) -> str:
    """The folder of a partition, with its values escaped as Spark does."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    values = ["__HIVE_DEFAULT_PARTITION__" if row[c] in (None, "") else escape(str(row[c])) for c in columns]
    return "/".join([path, *[f"{escape(c)}={v}" for c, v in zip(columns, values)]])


def upsert_by_date(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    grain: str | None = "month",
    date_column: str = TRADE_DATE,
    replace_by: Sequence[str] | None = None,
    **write_options,
) -> None:
    """Replace what the batch holds: the newest batch wins, other rows of the same months stay.

    `replace_by` names the keys whose values are replaced, by default the date; a load of some
    codes replaces by date and code. A null date is a value like any other.

    The batch is evaluated once, into a staged table. Its months are few and listed once to
    prune the stored read; without a grain the whole dataset is read and written again. The
    stored rows that stay are staged as well, since a folder cannot be overwritten while it is
    being read. Folders that lost all their rows are removed after the write. Stages are removed
    at the end. Days are few (the calendar bounds them), so a replacement by date broadcasts them.
    """
    spark = batch.sparkSession
    keys = list(replace_by or [date_column])
    folders = [*partition_by, *([grain] if grain else [])]

    def in_folders(df: DataFrame) -> DataFrame:
        placed = df.withColumn(grain, partition_key(date_column, grain)) if grain else df
        return placed.select(*[F.col(c).cast("string").alias(c) for c in folders]).distinct()

    with staging(spark) as stage:
        batch = stage(conform(batch, schema))
        emptied = []
        if dataset_exists(spark, path):
            stored = spark.read.schema(stored_schema(schema, partition_by, grain)).parquet(path)
            if grain:
                touched = batch.select(partition_key(date_column, grain).alias("key")).distinct()
                months = [row["key"] for row in touched.collect()]
                wanted = F.col(grain).isin([m for m in months if m is not None])
                if None in months:
                    wanted = wanted | F.col(grain).isNull()
                stored = stored.where(wanted).drop(grain)
            before = in_folders(stored).collect() if folders else []
            if before or not folders:
                kept = not_held(stored.select(*schema.fieldNames()), batch, keys, few=keys == [date_column])
                batch = stage(kept).unionByName(batch)
            if before:
                lost = set(before) - set(in_folders(batch).collect())
                emptied = [_folder(spark, path, folders, row) for row in lost]
        write_dataset(batch, path, schema, partition_by, grain, date_column, **write_options)
        for folder in emptied:
            remove_path(spark, folder)


def export_csv(df: DataFrame, path: str) -> None:
    """Catalog-sized frames as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    df.write.jdbc(url, table, mode="append", properties=dict(properties))
