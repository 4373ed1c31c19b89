"""Reading warehouse tables and hand-kept trackers, and cleaning what comes in."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_any_date
from ..functions.values import present

BOM = "﻿"


def read_table(
    spark: SparkSession, name: str, schema: T.StructType | str | None = None, format: str | None = None,
) -> DataFrame:
    """A catalog table, or files by path (``format`` defaults to parquet)."""
    if "/" not in name and format is None:
        return spark.table(name)
    reader = spark.read.format(format or "parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(name)


def read_jdbc(
    spark: SparkSession, url: str, query: str, partition_column: str | None = None,
    lower: str | None = None, upper: str | None = None, partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A warehouse query read in parallel ranges of ``partition_column``."""
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column:
        reader = (
            reader.option("dbtable", f"({query}) source")
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    else:
        reader = reader.option("query", query)
    return reader.options(**(properties or {})).load()


def read_mapping_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV with a header, every column as text; a byte-order mark is dropped."""
    df = spark.read.csv(path, header=True, sep=sep, multiLine=False, enforceSchema=False)
    return df.toDF(*[name.removeprefix(BOM).strip() for name in df.columns])


def read_mapping_tabs(spark: SparkSession, folder: str, tabs: Iterable[str]) -> dict[str, DataFrame]:
    """One table per tab: ``<folder>/<tab>.csv``, else parquet at ``<folder>/<tab>``."""
    tables = {}
    for tab in tabs:
        path = f"{folder.rstrip('/')}/{tab}"
        try:
            tables[tab] = read_mapping_csv(spark, f"{path}.csv")
        except Exception as error:  # only "path not found" is retried as parquet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            tables[tab] = spark.read.parquet(path)
    return tables


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A few configured rows as a table whose small size Spark can see."""
    fields = T.StructType.fromDDL(schema).fields
    values = ", ".join("(" + ", ".join(_literal(value) for value in row) + ")" for row in rows)
    names = ", ".join(f"`{field.name}`" for field in fields)
    casts = ", ".join(f"CAST(`{field.name}` AS {field.dataType.simpleString()}) AS `{field.name}`" for field in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS rows({names})")


def promote_header(df: DataFrame, order: str, keep_order: bool = False) -> DataFrame:
    """Use the first row (lowest ``order``) as header and leave it out of the rows.

    Only that single row reaches the driver. ``keep_order`` carries the order column along.
    """
    data = [name for name in df.columns if name != order]
    first = df.orderBy(order).limit(1).collect()[0]
    names = [str(first[name]).strip() if first[name] is not None else name for name in data]
    if len(set(names)) != len(names):
        raise ValueError(f"the header row repeats a name: {names}")
    return df.where(F.col(order) > F.lit(first[order])).select(
        *[F.col(f"`{old}`").alias(new) for old, new in zip(data, names)], *([order] if keep_order else []),
    )


def clean_tracker(
    df: DataFrame, key: str, columns: Iterable[str] = (), derive: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Keep the key and the listed columns, drop rows with a blank key, add derived columns."""
    kept = df.select(F.col(f"`{key}`"), *[F.col(f"`{name}`") for name in columns if name != key])
    kept = kept.where(present(F.col(f"`{key}`").cast("string")).isNotNull())
    return kept.withColumns(dict(derive)) if derive else kept


def at_snapshot(df: DataFrame, as_of, column: str = "snapshot_date") -> DataFrame:
    """The dated tab of one day; prunes partitions where ``column`` is one."""
    return df.where(F.col(column) == F.lit(as_of).cast(df.schema[column].dataType))


def coerce_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns as timestamps; what cannot be read becomes missing."""
    changes = {}
    for name in columns:
        if name not in df.columns:
            continue
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            changes[name] = parse_any_date(F.col(f"`{name}`"))
        elif not isinstance(kind, T.TimestampType):
            changes[name] = F.col(f"`{name}`").try_cast("timestamp")
    return df.withColumns(changes) if changes else df


def null_profile(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Missing count and percentage per column, in one pass."""
    names = [name for name in columns if name in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(f"_missing_{at}") for at, name in enumerate(names)],
    )
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"_missing_{at}").alias("missing_count"))
        for at, name in enumerate(names)
    ])
    rows = counts.select("total_rows", F.inline(pairs))
    share = F.try_divide(F.col("missing_count") * 100.0, F.col("total_rows"))
    return rows.select(
        "column_name", "missing_count", "total_rows", F.bround(share, 1).alias("missing_percent")
    )


def conform(df: DataFrame, required: Iterable[str] = ()) -> DataFrame:
    """Trim column names and insist on the required ones."""
    trimmed = df.toDF(*[name.strip() for name in df.columns])
    missing = [name for name in required if name not in trimmed.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return trimmed
