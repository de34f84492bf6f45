"""Facts, dimensions and the filter context in which measures are evaluated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.plans.calendar import visible_days

# dimension: table, key column on both sides
DIMS = {
    "customer": ("dim_customer", "customer_sk"),
    "product": ("dim_product", "product_sk"),
    "seller": ("dim_seller", "seller_sk"),
    "payment_type": ("dim_payment_type", "payment_type_sk"),
    "status": ("dim_order_status", "order_status_sk"),
    "channel": ("dim_marketing_channel", "mql_channel_sk"),
    "comments": ("review_comments", "review_sk"),
}

# attribute: dimension that holds it ("date" is joined through a role, "own" is a fact column)
ATTRIBUTES = {
    "full_date": "date",
    "year": "date",
    "quarter_index": "date",
    "month_index": "date",
    "year_month": "date",
    "is_weekend": "date",
    "is_holiday": "date",
    "day_of_week_num": "date",
    "day_of_week_name": "date",
    "day_of_month": "date",
    "week_of_year": "date",
    "month_num": "date",
    "month_name": "date",
    "quarter_num": "date",
    "quarter_name": "date",
    "customer_zip_code_prefix": "customer",
    "product_photos_qty": "product",
    "product_weight_g": "product",
    "product_length_cm": "product",
    "product_height_cm": "product",
    "product_width_cm": "product",
    "product_description_length": "product",
    "seller_zip_code_prefix": "seller",
    "customer_state": "customer",
    "customer_city": "customer",
    "product_category_name": "product",
    "seller_state": "seller",
    "seller_city": "seller",
    "seller_sk": "seller",
    "payment_type": "payment_type",
    "payment_installments": "payment_type",
    "order_status": "status",
    "origin": "channel",
    "business_segment": "channel",
    "lead_type": "channel",
    "lead_behaviour_profile": "channel",
    "business_type": "channel",
    "landing_page_id": "channel",
    "has_company": "channel",
    "has_gtin": "channel",
    "average_stock": "channel",
    "sr_id_bk": "channel",
    "sdr_id_bk": "channel",
    "review_comment_message": "comments",
}
OWN = {"seller_sk", "payment_installments", "sdr_id_bk", "sr_id_bk"}


DAY_PARTS = [
    "day_of_week_num", "day_of_week_name", "day_of_month", "week_of_year", "month_num", "month_name", "quarter_num",
    "quarter_name",
]


@dataclass(frozen=True)
class Fact:
    table: str
    dims: tuple[str, ...]
    roles: Mapping[str, str]
    active: str


FACTS = {
    "items": Fact(
        "fact_order_items",
        ("date", "customer", "product", "seller"),
        {"purchase": "purchase_date_key", "shipping_limit": "shipping_limit_date_key"},
        "purchase",
    ),
    "payments": Fact(
        "fact_payments", ("date", "customer", "payment_type"), {"purchase": "purchase_date_key"}, "purchase"
    ),
    "reviews": Fact(
        "fact_reviews",
        ("date", "customer", "comments"),
        {"answer": "review_answer_date_key", "creation": "review_creation_date_key"},
        "answer",
    ),
    "lifecycle": Fact(
        "fact_order_life_cycle",
        ("date", "customer", "status"),
        {
            "approval": "approval_date_key",
            "purchase": "purchase_date_key",
            "carrier": "carrier_date_key",
            "delivery": "delivery_date_key",
            "estimated_delivery": "estimated_delivery_date_key",
        },
        "approval",
    ),
    "funnel": Fact(
        "fact_marketing_funnel",
        ("date", "seller", "channel"),
        {"first_contact": "first_contact_date_key", "won": "won_date_key"},
        "first_contact",
    ),
}

# dimensions measured on their own, and pairs of facts linked by order
LINKED = {
    "customers": ("customer",),
    "products": ("product",),
    "channels": ("date", "seller", "channel"),
    "days": (),
    "buyers": ("date", "customer", "product", "seller"),
    "reviewed_items": ("date", "customer", "product", "seller"),
    "paid_items": ("date", "customer", "product", "seller", "payment_type"),
    "reviewed_orders": ("date", "customer", "status"),
}


def reach(fact: str) -> tuple[str, ...]:
    return FACTS[fact].dims if fact in FACTS else LINKED[fact]


def reachable(fact: str, attributes: Sequence[str]) -> list[str]:
    return [a for a in attributes if ATTRIBUTES[a] in reach(fact)]


Window_ = tuple[dt.date, dt.date]
ALL_TIME = "all time"
ANY_DAY = (dt.date.min, dt.date.max)


@dataclass(frozen=True)
class Context:
    """Group-by attributes, attribute filters, labelled date windows, date roles and the anchor day."""

    by: tuple[str, ...] = ()
    where: Mapping[str, Sequence] = field(default_factory=dict)
    windows: Mapping[str, Window_] = field(default_factory=dict)
    roles: Mapping[str, str] = field(default_factory=dict)
    anchor: dt.date | None = None

    def but(self, **changes) -> "Context":
        return replace(self, **changes)

    def without(self, attributes: Sequence[str]) -> "Context":
        gone = set(attributes)
        return self.but(
            by=tuple(a for a in self.by if a not in gone),
            where={a: v for a, v in self.where.items() if a not in gone},
        )

    @property
    def labels(self) -> list[str]:
        return list(self.windows)


def day_key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


class Star:
    """The loaded star with the two facts about its dates that measures ask for."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @cached_property
    def last_purchase(self) -> dt.date:
        """Day of the largest purchase key (one row; answered from column statistics)."""
        k = self["fact_order_items"].agg(F.max("purchase_date_key")).first()[0]
        return dt.date(k // 10000, k // 100 % 100, k % 100)

    @cached_property
    def bounds(self) -> Window_:
        """First and last visible day (one row)."""
        row = visible_days(self["dim_date"]).agg(F.min("full_date"), F.max("full_date")).first()
        return row[0], row[1]

    @cached_property
    def days(self) -> DataFrame:
        """Visible days with period numbers; one row per day, so it is broadcast."""
        return visible_days(self["dim_date"]).select(
            "date_key",
            "full_date",
            "year",
            (F.col("year") * 4 + F.col("quarter_num")).alias("quarter_index"),
            (F.col("year") * 12 + F.col("month_num")).alias("month_index"),
            "year_month",
            "is_weekend",
            "is_holiday",
            *DAY_PARTS,
        )


def _fits(attribute: str, values: Sequence) -> Column:
    return F.col(attribute).isin(list(values))


def _disjoint(windows: Mapping[str, Window_]) -> bool:
    spans = sorted(windows.values())
    return all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def _label(key: Column, windows: Mapping[str, Window_]) -> Column:
    """Label of the window a day lies in; overlapping windows give one row for each."""
    marks = [F.when(key.between(day_key(lo), day_key(hi)), label) for label, (lo, hi) in windows.items()]
    if _disjoint(windows):
        return F.coalesce(*marks)
    return F.explode(F.array_compact(F.array(*marks)))


def rows(star: Star, fact: str, attributes: Sequence[str], ctx: Context) -> DataFrame:
    """Rows of a fact in context, with the attributes joined.

    Date windows become ranges of the integer key, so they reach the scan.
    Attributes are joined from the left; grouping or filtering by a date drops
    the rows whose day is a sentinel, everything else keeps them.
    """
    if fact in LINKED:
        return _LINKS[fact](star, attributes, ctx)
    spec = FACTS[fact]
    df = star[spec.table]
    key = F.col(spec.roles[ctx.roles.get(fact, spec.active)])
    if ctx.windows:
        ranges = [key.between(day_key(lo), day_key(hi)) for lo, hi in ctx.windows.values()]
        df = df.where(reduce(Column.__or__, ranges)).withColumn("_win", _label(key, ctx.windows))
    filters = {a: v for a, v in ctx.where.items() if a in reachable(fact, [a])}
    wanted = set(reachable(fact, attributes)) | set(filters)

    dates = [a for a in wanted if ATTRIBUTES[a] == "date"]
    if dates:
        days = star.days.select(F.col("date_key").alias("_day"), *dates)
        sliced = any(a in filters or a in ctx.by for a in dates)
        df = df.join(F.broadcast(days), key == F.col("_day"), "inner" if sliced else "left").drop("_day")
    for dim in dict.fromkeys(ATTRIBUTES[a] for a in wanted if ATTRIBUTES[a] != "date"):
        columns = [a for a in wanted if ATTRIBUTES[a] == dim and a not in OWN]
        if columns:
            table, sk = DIMS[dim]
            df = df.join(star[table].select(sk, *columns), sk, "left")
    for a, values in filters.items():
        df = df.where(_fits(a, values))
    return df


def _dimension(table: str, fact: str):
    def read(star: Star, attributes: Sequence[str], ctx: Context) -> DataFrame:
        df = star[table]
        for a, values in ctx.where.items():
            if a in reachable(fact, [a]) and a in df.columns:
                df = df.where(_fits(a, values))
        return df

    return read


def _split(attributes: Sequence[str], dims: Sequence[str]) -> tuple[list[str], list[str]]:
    inside = [a for a in attributes if ATTRIBUTES[a] in dims]
    return inside, [a for a in attributes if a not in inside]


def _date_parts(ctx: Context, attributes: Sequence[str]) -> list[str]:
    dates = [a for a in attributes if ATTRIBUTES[a] == "date"]
    return dates + (["_win"] if ctx.windows else [])


def _link(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on))


def _reviewed_items(star: Star, attributes: Sequence[str], ctx: Context) -> DataFrame:
    """Reviews of the orders whose items are in context, once per order and item attribute."""
    from_items, from_reviews = _split(attributes, ("product", "seller"))
    dates = _date_parts(ctx, attributes)
    items = rows(star, "items", from_items + [a for a in dates if a != "_win"], ctx)
    orders = items.select("order_id_bk", *from_items, *dates).distinct()
    reviews = rows(star, "reviews", from_reviews, ctx).select("order_id_bk", *from_reviews, *_win(ctx), "review_score")
    return _link(reviews, orders, ["order_id_bk", *dates])


def _win(ctx: Context) -> list[str]:
    return ["_win"] if ctx.windows else []


def _paid_items(star: Star, attributes: Sequence[str], ctx: Context) -> DataFrame:
    """Item values of the orders whose payments are in context, once per payment attribute."""
    from_payments, from_items = _split(attributes, ("payment_type",))
    paid = rows(star, "payments", from_payments, ctx.but(windows={}, where=_only(ctx, "payment_type")))
    orders = paid.select("order_id_bk", *from_payments).distinct()
    items = rows(star, "items", from_items, ctx).groupBy("order_id_bk", *from_items, *_win(ctx))
    return _link(items.agg(F.sum("line_total").alias("line_total")), orders, ["order_id_bk"])


def _only(ctx: Context, *dims: str) -> dict:
    return {a: v for a, v in ctx.where.items() if ATTRIBUTES[a] in dims}


def _reviewed_orders(star: Star, attributes: Sequence[str], ctx: Context) -> DataFrame:
    """Reviews with the delivery result of their order."""
    from_orders, from_reviews = _split(attributes, ("status",))
    reviews = rows(star, "reviews", from_reviews, ctx).select("order_id_bk", *from_reviews, *_win(ctx), "review_score")
    orders = rows(star, "lifecycle", from_orders, ctx.but(windows={}, by=(), where=_only(ctx, "status")))
    return _link(reviews, orders.select("order_id_bk", *from_orders, "days_delivery_variance"), ["order_id_bk"])


def _buyers(star: Star, attributes: Sequence[str], ctx: Context) -> DataFrame:
    """One row per customer and group: revenue in context and orders of all time.

    An order has one purchase day, so orders of all time are the sum of the
    orders per date group; only those pre-summed rows meet in the window.
    """
    dates = [a for a in attributes if ATTRIBUTES[a] == "date"]
    others = [a for a in attributes if ATTRIBUTES[a] != "date"]
    date_filter = _only(ctx, "date")
    free = ctx.but(
        windows={}, by=tuple(others), where={a: v for a, v in ctx.where.items() if ATTRIBUTES[a] != "date"}
    )
    needed = list(dict.fromkeys([*others, *dates, *date_filter]))
    items = rows(star, "items", needed, free)
    inside = reduce(Column.__and__, [_fits(a, v) for a, v in date_filter.items()], F.lit(True))
    items = items.withColumn("_in", F.coalesce(inside, F.lit(False)))
    if ctx.windows:
        # rows outside every window still count towards the orders of all time
        items = items.withColumn("_win", _label(F.col("purchase_date_key"), {**ctx.windows, ALL_TIME: ANY_DAY}))
    groups = [*others, "customer_sk", *dates, "_in", *_win(ctx)]
    summed = items.groupBy(*groups).agg(
        F.count_distinct("order_id_bk").alias("orders"), F.sum("line_total").alias("revenue")
    )
    once = F.when(F.col("_win") == ALL_TIME, F.col("orders")) if ctx.windows else F.col("orders")
    all_time = F.sum(once).over(Window.partitionBy(*others, "customer_sk"))
    summed = summed.withColumn("all_time_orders", all_time).where("_in")
    for c in dates:
        summed = summed.where(F.col(c).isNotNull())
    return summed.where(F.col("_win") != ALL_TIME) if ctx.windows else summed


def _channels(star: Star, attributes: Sequence[str], ctx: Context) -> DataFrame:
    """Leads; what restricts the deals (days, sellers, staff) restricts them to the leads of those deals."""
    wanted = list(dict.fromkeys([*attributes, *ctx.where]))
    through = [a for a in wanted if a in ("sdr_id_bk", "sr_id_bk") or ATTRIBUTES[a] != "channel"]
    through = reachable("funnel", through)
    leads = _dimension("dim_marketing_channel", "channels")(star, attributes, ctx)
    if not through and not ctx.windows:
        return leads
    deals = rows(star, "funnel", through, ctx.but(where={a: v for a, v in ctx.where.items() if a in through}))
    return deals.select("mql_channel_sk", *through, *_win(ctx)).join(leads, "mql_channel_sk")


_LINKS = {
    "customers": _dimension("dim_customer", "customers"),
    "products": _dimension("dim_product", "products"),
    "channels": _channels,
    "days": lambda star, attributes, ctx: star.days,
    "buyers": _buyers,
    "reviewed_items": _reviewed_items,
    "paid_items": _paid_items,
    "reviewed_orders": _reviewed_orders,
}
