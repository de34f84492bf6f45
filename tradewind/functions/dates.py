"""Date expressions with the two sentinel days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.functions.text import col


def unknown_day() -> Column:
    return F.lit(vocab.UNKNOWN_DATE).cast("date")


def open_day() -> Column:
    return F.lit(vocab.OPEN_DATE).cast("date")


def day_or_unknown(c: str | Column) -> Column:
    """Parsed day, or 1900-01-01 where it is missing or cannot be read."""
    return F.coalesce(col(c).try_cast("date"), unknown_day())


def milestone_day(c: str | Column, status: Column) -> Column:
    """Parsed day; else 1900-01-01 for orders that never ship and 9999-12-31 for open ones."""
    missing = F.when(status.isin(vocab.NEVER_SHIPPED), unknown_day()).otherwise(open_day())
    return F.coalesce(col(c).try_cast("date"), missing)


def is_real(c: str | Column) -> Column:
    d = col(c)
    return (d != unknown_day()) & (d != open_day())


def date_key(c: str | Column) -> Column:
    d = col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def key_to_day(c: str | Column) -> Column:
    k = col(c)
    return F.make_date(F.floor(k / 10000).cast("int"), F.floor(k / 100).cast("int") % 100, k % 100)


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Days from start to end; NULL when either is a sentinel."""
    return F.when(is_real(start) & is_real(end), F.datediff(col(end), col(start)))


def on_time(delivered: str | Column, estimated: str | Column) -> Column:
    """TRUE on or before the estimate, FALSE after it, NULL when either is a sentinel."""
    return F.when(is_real(delivered) & is_real(estimated), col(delivered) <= col(estimated))


def calendar_parts(d: Column) -> dict[str, Column]:
    """Attributes of the date dimension for one day."""
    weekday = F.weekday(d) + 1
    return {
        "date_key": date_key(d),
        "full_date": d,
        "day_of_week_num": weekday,
        "day_of_week_name": F.date_format(d, "EEEE"),
        "day_of_week_name_short": F.date_format(d, "EEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_name_short": F.date_format(d, "MMM"),
        "quarter_num": F.quarter(d),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d)),
        "year": F.year(d),
        "year_month": F.date_format(d, "yyyy-MM"),
        "is_weekend": weekday.isin(6, 7),
        "is_holiday": F.lit(False),
    }
