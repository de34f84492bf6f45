"""Raw sources: relational tables, CSV files, the order table with its snapshot."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    properties: dict | None = None,
) -> DataFrame:
    """Table scan over JDBC, in parallel ranges where a numeric column is named."""
    if split_column and bounds:
        return spark.read.jdbc(
            url,
            table,
            column=split_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
            properties=properties or {},
        )
    return spark.read.jdbc(url, table, properties=properties or {})


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """UTF-8 CSV with header; quoted text may hold line breaks.

    Single-line files are split among tasks; a multi-line file is read by one
    task, so large raw text should be landed as many files.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


class PayloadError(ValueError):
    """The landed file is not the CSV it should be."""


def _check_header(spark: SparkSession, path: str, schema: T.StructType) -> None:
    head = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    first = head[0][0].strip().lstrip(chr(0xFEFF)) if head else ""
    if not first:
        raise PayloadError(f"{path}: empty file")
    if first[0] in "{[<":
        raise PayloadError(f"{path}: JSON or HTML instead of CSV")
    names = [n.strip().strip('"') for n in first.split(",")]
    if names != schema.fieldNames():
        raise PayloadError(f"{path}: header {names} instead of {schema.fieldNames()}")


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files whose first lines are checked: JSON or HTML answers and other headers are errors."""
    files = spark.read.text(path).inputFiles()
    if not files:
        raise PayloadError(f"{path}: empty file")
    for file in files:
        _check_header(spark, file, schema)
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def with_audit(df: DataFrame, source: str, now: Column | None = None, **extra: str) -> DataFrame:
    """Add `_ingested_at`, `_source` and source-specific columns such as `_drive_file_id`."""
    out = df.withColumn("_ingested_at", now if now is not None else F.current_timestamp())
    out = out.withColumn("_source", F.lit(source))
    for name, value in extra.items():
        out = out.withColumn(f"_{name}", F.lit(value))
    return out


def load_order_table(spark: SparkSession, table_path: str, snapshot_path: str, schema: T.StructType):
    """The flat order table, or its CSV snapshot when the table cannot be read.

    Returns the frame and whether the snapshot was used.
    """
    try:
        return spark.read.parquet(table_path), False
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.read.option("header", True).schema(schema).csv(snapshot_path)
        return raw.withColumn("purchase_date", F.to_date("purchase_date")), True
