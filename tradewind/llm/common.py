"""Expressions and prefix sums shared by the operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tradewind

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
PARTS = 10  # bits of the spread hash that cut a key into 1024 parts


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def python_workers(spark: SparkSession) -> None:
    """Prepare Python stages: workers get the package, and rows in small batches, so that long texts fit."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    context = spark.sparkContext
    if getattr(context, "_tradewind_sent", False):
        return
    package = Path(tradewind.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tradewind-code-")) / "tradewind-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tradewind_sent = True


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of a frame when its action ends.

    Otherwise they stay until the driver happens to collect the plan, and steps
    that are written one after another hold the disk of all of them at once.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def apart(df: DataFrame, own: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns, but for `own`, under names that no operator uses, and the name of each."""
    names = {c: c if c in own else f"caller_{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; null gives none."""
    bare = F.trim(whole(text), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    part: Column,
    order: Sequence[str | Column],
    sums: dict[str, str],
    peers: bool = False,
) -> DataFrame:
    """Running sums inside each key, whatever the number of its rows.

    `part` cuts a key into ranges that follow `order`. Sums are formed inside
    each range and the totals of the key's earlier ranges are added, so that a
    hot key is shared out among tasks. `sums` maps a new column to the summed
    one. The sum ends before the row; with `peers` it ends with the last row
    that is equal to it in `order`. Keys must not be null.
    """
    cut = df.withColumn("_part", part)
    totals = cut.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_part", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums]
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    inside = (
        inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        if peers
        else inside.rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = cut.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
    joined = summed.join(offsets, [*keys, "_part"])
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_o_{n}")).alias(n) for n in sums])


def hash_part(spread: str, bits: int = PARTS) -> Column:
    """Range of a 64-bit hash, in the hash's own order."""
    return F.shiftright(F.col(spread), 64 - bits).cast("int")
