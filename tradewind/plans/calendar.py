"""Date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.functions.dates import calendar_parts
from tradewind.operators.upsert import insert_missing


def _spine(days: DataFrame) -> DataFrame:
    parts = calendar_parts(F.col("d"))
    return days.select(*[c.alias(n) for n, c in parts.items()])


def _sentinels(spark: SparkSession) -> DataFrame:
    """The unknown day and the open day."""
    # fixed values: attributes of the two sentinel members
    # (key, day, weekday, name, short, day of month, day of year, week, month, name, short, quarter, name, year)
    rows = [
        (vocab.UNKNOWN_DATE_KEY, vocab.UNKNOWN_DATE, 1, "Unknown", "Unk", 1, 1, 1, 1, "Unknown", "Unk", 1, "Q1", 1900),
        (vocab.OPEN_DATE_KEY, vocab.OPEN_DATE, 1, "Unknown", "Unk", 31, 365, 52, 12, "Unknown", "Unk", 4, "Q4", 9999),
    ]
    names = [n for n in calendar_parts(F.lit(None)) if n not in ("year_month", "is_weekend", "is_holiday")]
    return spark.createDataFrame(rows, names).select(
        *[F.col(n).cast("int").alias(n) if isinstance(v, int) else F.col(n) for n, v in zip(names, rows[0])],
        F.left("full_date", F.lit(7)).alias("year_month"),
        F.lit(False).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    ).withColumn("full_date", F.to_date("full_date"))


def date_spine(spark: SparkSession, start: str = "2016-01-01", end: str = "2020-12-31") -> DataFrame:
    """Both sentinel members and one row per day."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    return _sentinels(spark).unionByName(_spine(days))


def spine_for(orders: DataFrame, column: str = "order_purchase_date") -> DataFrame:
    """Spine over the whole years in which the orders fall (one row of bounds decides)."""
    real = orders.where(~F.year(column).isin(1900, 9999))
    bounds = real.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    last = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    days = bounds.select(F.explode(F.sequence(F.trunc("lo", "YEAR"), last)).alias("d"))
    return _sentinels(orders.sparkSession).unionByName(_spine(days))


def extend_spine(existing: DataFrame, start: str, end: str) -> DataFrame:
    """Add the days that are not there yet."""
    return insert_missing(existing, date_spine(existing.sparkSession, start, end), "date_key")


def year_month_sort(full_date: str = "full_date"):
    return F.year(full_date) * 100 + F.month(full_date)


def visible_days(dim_date: DataFrame) -> DataFrame:
    """The date dimension as reports see it: without the sentinels."""
    return dim_date.where(~F.col("date_key").isin(vocab.UNKNOWN_DATE_KEY, vocab.OPEN_DATE_KEY))
