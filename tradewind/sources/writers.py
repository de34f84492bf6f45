"""Table replacement, write-back and export."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CODEC = "zstd"  # of written tables


@dataclass(frozen=True)
class LoadReport:
    """Rows and figures were counted by the job that wrote them."""

    table: str
    rows: int
    seconds: float
    figures: Mapping[str, int] = field(default_factory=dict)


def counted(df: DataFrame, figures: Mapping[str, Column] | None = None) -> tuple[DataFrame, Callable[..., int]]:
    """The frame, and a function that gives its row count, or a named figure, once it was written."""
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in (figures or {}).items()])
    return watched, lambda name="_rows": int(seen.get[name] or 0)


def nulls(df: DataFrame) -> dict[str, Column]:
    """Figures of a load: missing values of every column."""
    return {f"nulls_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}


def _written(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], figures: Mapping[str, Column] | None) -> LoadReport:
    started = time.monotonic()
    watched, value = counted(df, figures)
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", CODEC)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return LoadReport(path, value(), time.monotonic() - started, {n: value(n) for n in figures or {}})


def one_plan(df: DataFrame, keep: bool = False) -> DataFrame:
    """A step that writes nothing: what comes before and after it stays one plan."""
    return df


class Steps:
    """Frames between the steps of a load, written to a folder and read back.

    The shuffle files of a step go when it is written, so a load of several wide joins holds those of one at a time.
    A step replaces the ones before, unless they are to be kept; the rest goes with `clear`.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.written = spark, root, []

    def __call__(self, df: DataFrame, keep: bool = False) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.option("compression", CODEC).parquet(path)
        if not keep:
            self.clear()
        self.written.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.written:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.written = []


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), figures: Mapping[str, Column] | None = None
) -> LoadReport:
    """Full replacement of a table; `figures` are aggregates over the written rows."""
    return _written(df, path, "static", partition_by, figures)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], figures: Mapping[str, Column] | None = None
) -> LoadReport:
    """Replace only the partitions present in the frame."""
    return _written(df, path, "dynamic", partition_by, figures)


def replace_if_any(df: DataFrame, path: str) -> LoadReport | None:
    """Leave the old table alone when the input has no row."""
    return None if df.isEmpty() else replace_table(df, path)


def ingest(spark: SparkSession, source: DataFrame, target: str) -> LoadReport | None:
    """Copy one raw source as it is."""
    return replace_if_any(source, target)


def write_back(table: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Replace the score columns of a table by a left join on its key."""
    fresh = [c for c in scores.columns if c != key]
    joined = table.drop(*fresh).join(scores, key, "left")
    return joined.select(*[c for c in table.columns if c not in fresh], *fresh)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
