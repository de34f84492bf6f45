"""Dimension upsert with surrogate keys that survive a reload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3
BUCKETS = 16**BUCKET_DIGITS


def key_bucket(c: str) -> Column:
    """One of 4096 even buckets of a text key."""
    return F.left(F.md5(F.col(c)), F.lit(BUCKET_DIGITS))


def assign_keys(df: DataFrame, bk: str, sk: str, base: Column | int = 0) -> DataFrame:
    """Dense keys base+1, base+2, … in the order (bucket of bk, bk).

    Rows are numbered inside each bucket; the bucket sizes (4096 rows at most,
    whatever the data size) give the offset.  No task sees more than a bucket.
    """
    bucketed = df.withColumn("_bucket", key_bucket(bk))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # at most 4096 rows reach this window and the broadcast
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy(bk)
    start = F.lit(base) if isinstance(base, int) else base
    return (
        bucketed.withColumn("_pos", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(sk, (start + F.col("_offset") + F.col("_pos")).cast("long"))
        .drop("_bucket", "_pos", "_offset")
        .select(sk, *df.columns)
    )


def ensure_member(dim: DataFrame, sk: str, row: dict, stored: DataFrame | None = None) -> DataFrame:
    """Add the stated row unless the table stored before this load holds its key."""
    if stored is not None and not stored.where(F.col(sk) == row[sk]).isEmpty():
        return dim
    literals = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in dim.schema.fields if f.name in row]
    return dim.unionByName(dim.sparkSession.range(1).select(*literals), allowMissingColumns=True)


def upsert_scd1(
    target: DataFrame | None,
    source: DataFrame,
    bk: str,
    sk: str,
    attrs: Sequence[str],
    now: Column,
) -> DataFrame:
    """Overwrite changed attributes, append new members, keep rows the source no longer has.

    Members whose attributes did not change keep their load stamp.  The result
    replaces the dimension as a whole.
    """
    incoming = source.select(bk, *attrs)
    if target is None:
        return assign_keys(incoming, bk, sk).withColumn("load_timestamp", now)

    paired = target.join(incoming.select(bk, F.struct(*attrs).alias("_new")), bk, "left")
    old = F.struct(*[F.col(a).cast(incoming.schema[a].dataType).alias(a) for a in attrs])
    changed = F.col("_new").isNotNull() & ~old.eqNullSafe(F.col("_new"))
    kept = paired.select(
        sk,
        bk,
        *[F.when(changed, F.col(f"_new.{a}")).otherwise(F.col(a)).alias(a) for a in attrs],
        F.when(changed, now).otherwise(F.col("load_timestamp")).alias("load_timestamp"),
    )
    fresh = incoming.join(target.select(bk), bk, "left_anti").select(bk, *attrs)
    top = target.agg(F.greatest(F.max(sk), F.lit(0))).scalar()
    added = assign_keys(fresh, bk, sk, base=top).withColumn("load_timestamp", now)
    return kept.unionByName(added)


def insert_missing(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Target plus the rows whose key it lacks."""
    return target.unionByName(rows.join(target.select(key), key, "left_anti").select(*target.columns))
