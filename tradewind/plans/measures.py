"""The measure registry: what every business figure means.

A measure is one of a few kinds: an aggregate over a fact (`Agg`), arithmetic
on other measures (`Calc`), a base measure with filters removed (`Without`,
`KeepOnly`), a base measure moved in time (`Period`, `Windowed`, `Shift`), a
figure over the values of an attribute (`Over`, `Rank`, `Standing`) or a trend
mark (`Trend`).  `evaluate.py` turns a list of them into one plan.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.functions.dates import key_to_day
from tradewind.functions.numbers import ratio
from tradewind.operators.ranking import name_of_largest


def measure_id(title: str) -> str:
    """'Revenue MoM %' -> 'revenue_mom_pct'."""
    return re.sub(r"[^a-z0-9]+", "_", title.lower().replace("%", " pct ").replace("+", " plus ")).strip("_")


@dataclass(frozen=True)
class Agg:
    """Aggregate over a fact, or over one row per `key` of it (columns in `inner`)."""

    fact: str
    expr: Callable[[object], Column]
    key: str | None = None
    inner: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    needs: tuple[str, ...] = ()
    undated: bool = False


@dataclass(frozen=True)
class Calc:
    deps: tuple[str, ...]
    expr: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Without:
    """Base with the filters and groups on some attributes removed."""

    base: str
    attributes: tuple[str, ...]


@dataclass(frozen=True)
class KeepOnly:
    """Base with every filter and group removed but those on some attributes."""

    base: str
    attributes: tuple[str, ...]


@dataclass(frozen=True)
class Over:
    """Aggregate of other measures over the values of an attribute."""

    attribute: str
    deps: tuple[str, ...]
    expr: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Rank:
    """Dense rank of an attribute's value by a falling measure."""

    base: str
    attribute: str


@dataclass(frozen=True)
class Standing:
    """Rank or cumulative share of a seller among all sellers."""

    base: str
    attribute: str
    part: str


@dataclass(frozen=True)
class Period:
    """To-date comparison: `curr`, `prior`, `pct` or `delta` of a base."""

    base: str
    grain: str
    part: str
    roles: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Windowed:
    """Base over days counted back from the anchor."""

    base: str
    first_day: Callable[[dt.date], dt.date]


@dataclass(frozen=True)
class Shift:
    """Base of the whole previous month, quarter or year: `prior` or `pct`."""

    base: str
    grain: str
    part: str


@dataclass(frozen=True)
class RankChange:
    """Places gained against the same days of the year before."""

    base: str
    attribute: str


@dataclass(frozen=True)
class Trend:
    """Mark of a change: `up`, `down`, `flat` for arrows; `good`, `bad`, `neutral` for colours."""

    base: str
    kind: str
    higher_is_better: bool = True


MEASURES: dict[str, object] = {}
TITLES: dict[str, str] = {}


def define(title: str, measure: object) -> None:
    name = measure_id(title)
    if name in MEASURES:
        raise ValueError(title)
    MEASURES[name] = measure
    TITLES[name] = title


def _agg(title: str, fact: str, expr: Callable[[], Column], **options) -> None:
    define(title, Agg(fact, lambda star: expr(), **options))


def _ratio(title: str, a: str, b: str) -> None:
    define(title, Calc((a, b), lambda m: ratio(m(a), m(b))))


def _alias(title: str, base: str) -> None:
    define(title, Calc((base,), lambda m: m(base)))


def zero(c: Column) -> Column:
    """Blank counts as 0."""
    return F.coalesce(c.cast("double"), F.lit(0.0))


def count_of(condition: Column | str) -> Column:
    """Rows that meet a condition; blank, not 0, when there is none."""
    return F.nullif(F.count_if(F.col(condition) if isinstance(condition, str) else condition), F.lit(0))


def _sum(c: str) -> Callable[[], Column]:
    return lambda: F.sum(c)


def _avg(c: str) -> Callable[[], Column]:
    return lambda: F.avg(c)


def _count() -> Column:
    return F.count("*")


# --- items ------------------------------------------------------------------

_REVENUE = {"revenue": lambda: F.sum("line_total")}
_ORDERS = {"orders": lambda: F.count_distinct("order_id_bk")}
_SPAN = {"first_key": lambda: F.min("purchase_date_key"), "last_key": lambda: F.max("purchase_date_key")}
_WEEKEND = {"weekend": lambda: F.max(F.col("is_weekend").cast("int"))}

_agg("Total Revenue", "items", _sum("line_total"))
_agg("Total Freight", "items", _sum("unit_freight_value"))
_agg("Total Order Items", "items", _count)
# distinct counts are row counts of a pre-grouped fact: one light shuffle per key, no row expansion
_agg("Total Orders", "items", _count, key="order_id_bk")
_agg("Total Customers", "items", _count, key="customer_sk")
_agg("Active Sellers", "items", _count, key="seller_sk")
_agg("Max Order Value", "items", lambda: F.max("revenue"), key="order_id_bk", inner=_REVENUE)
_agg("Top Seller Revenue", "items", lambda: F.max("revenue"), key="seller_sk", inner=_REVENUE)
_agg("Repeat Customers", "items", lambda: count_of(F.col("orders") > 1), key="customer_sk", inner=_ORDERS)
_agg(
    "Reactivation Window",
    "items",
    lambda: F.avg(F.when(F.col("orders") >= 2, F.datediff(key_to_day("last_key"), key_to_day("first_key")))),
    key="customer_sk",
    inner={**_ORDERS, **_SPAN},
)
_agg("Weekend Orders", "items", lambda: count_of(F.col("weekend") == 1), key="order_id_bk", inner=_WEEKEND, needs=("is_weekend",))
_agg("Peak Month Revenue", "items", lambda: F.max("revenue"), key="year_month", inner=_REVENUE, needs=("year_month",))
_agg("Weakest Month Revenue", "items", lambda: F.min("revenue"), key="year_month", inner=_REVENUE, needs=("year_month",))
_agg("Average Daily Revenue", "items", lambda: F.avg("revenue"), key="full_date", inner=_REVENUE, needs=("full_date",))
_agg(
    "Top Revenue State",
    "items",
    lambda: name_of_largest("customer_state", "revenue"),
    key="customer_state",
    inner=_REVENUE,
    needs=("customer_state",),
)
_agg(
    "Top Category",
    "items",
    lambda: name_of_largest("product_category_name", "revenue"),
    key="product_category_name",
    inner=_REVENUE,
    needs=("product_category_name",),
)
_agg(
    "Top Category Revenue",
    "items",
    lambda: F.max("revenue"),
    key="product_category_name",
    inner=_REVENUE,
    needs=("product_category_name",),
)
_agg(
    "Home State Revenue",
    "items",
    lambda: F.sum(F.when(F.col("customer_state") == vocab.HOME_STATE, F.col("line_total"))),
    needs=("customer_state",),
)
_agg("Holiday Revenue", "items", lambda: F.sum(F.when(F.col("is_holiday"), F.col("line_total"))), needs=("is_holiday",))
_agg("Non-Holiday Revenue", "items", lambda: F.sum(F.when(~F.col("is_holiday"), F.col("line_total"))), needs=("is_holiday",))
define(
    "First Year Revenue",
    Agg(
        "items",
        lambda star: F.sum(
            F.when(F.floor(F.col("purchase_date_key") / 10000) == star.bounds[0].year, F.col("line_total"))
        ),
        undated=True,
    ),
)
define(
    "Last Year Revenue",
    Agg(
        "items",
        lambda star: F.sum(
            F.when(F.floor(F.col("purchase_date_key") / 10000) == star.bounds[1].year, F.col("line_total"))
        ),
        undated=True,
    ),
)

_ratio("AOV", "total_revenue", "total_orders")
_ratio("Revenue per Customer", "total_revenue", "total_customers")
_ratio("Repeat Rate", "repeat_customers", "total_customers")
_ratio("Avg Orders per Customer", "total_orders", "total_customers")
_ratio("Revenue per Seller", "total_revenue", "active_sellers")
_ratio("Weekend Order Share", "weekend_orders", "total_orders")

CUSTOMER = ("customer_state", "customer_city")
PRODUCT = ("product_category_name",)
SELLER = ("seller_state", "seller_city", "seller_sk")

define("Revenue of All Products", Without("total_revenue", PRODUCT))
define("Revenue of All Customers", Without("total_revenue", CUSTOMER))
define("Home State Revenue of All", Without("home_state_revenue", CUSTOMER))
define("Customers of All States", Without("total_customers", ("customer_state",)))
_ratio("Category Revenue %", "total_revenue", "revenue_of_all_products")
_ratio("State Revenue %", "total_revenue", "revenue_of_all_customers")
_ratio("SP Revenue Share", "home_state_revenue_of_all", "revenue_of_all_customers")
_ratio("Customer Density %", "total_customers", "customers_of_all_states")
_ratio("Top Category Share", "top_category_revenue", "revenue_of_all_products")
define("State Revenue Rank", Rank("total_revenue", "customer_state"))
define("Category Rank", Rank("total_revenue", "product_category_name"))
define("Seller Rank", Standing("total_revenue", "seller_sk", "dense"))
define("Cumulative Seller Revenue %", Standing("total_revenue", "seller_sk", "share"))
define("Seller Revenue", Without("total_revenue", ("seller_state", "seller_city")))
define("Seller Order Count", Without("total_orders", ("seller_state", "seller_city")))
define(
    "Categories Above 5pct GMV",
    Over(
        "product_category_name",
        ("category_revenue_pct",),
        lambda m: count_of(m("category_revenue_pct") > 0.05),
    ),
)
define("Category Rank Change YoY", RankChange("total_revenue", "product_category_name"))
_alias("Cohort Size", "total_customers")
_alias("Returning Customers", "repeat_customers")
_ratio("Retention Rate", "returning_customers", "cohort_size")

# --- customers by their orders of all time -----------------------------------

_agg("New Customers", "buyers", lambda: count_of(F.col("all_time_orders") == 1))
_agg("New Customer Revenue", "buyers", lambda: F.sum(F.when(F.col("all_time_orders") == 1, F.col("revenue"))))
_agg("Repeat Customer Revenue", "buyers", lambda: F.sum(F.when(F.col("all_time_orders") > 1, F.col("revenue"))))
_agg("Customers 2-3 Orders", "buyers", lambda: count_of(F.col("all_time_orders").between(2, 3)))
_agg("Customers 4+ Orders", "buyers", lambda: count_of(F.col("all_time_orders") >= 4))

# --- dimensions -------------------------------------------------------------

_agg("Avg Photos per Product", "products", _avg("product_photos_qty"), undated=True)
_agg("Avg Description Length", "products", _avg("product_description_length"), undated=True)
_agg("Product Category Count", "products", lambda: F.count_distinct("product_category_name"), undated=True)
_agg("States Active", "customers", lambda: F.count_distinct("customer_state"), undated=True)
_agg("Active Channels", "channels", lambda: F.count_distinct("origin"))
_agg("Leads", "channels", _count)
_agg("Leads With Company", "channels", lambda: count_of(F.col("has_company") == 1))
_ratio("Has Company %", "leads_with_company", "leads")
_agg("Holiday Days", "days", lambda: count_of("is_holiday"), undated=True)
_agg("Non-Holiday Days", "days", lambda: count_of(~F.col("is_holiday")), undated=True)
_agg("Min Date", "days", lambda: F.min("full_date"), undated=True)
_ratio("Holiday Revenue per Day", "holiday_revenue", "holiday_days")
_ratio("Non-Holiday Revenue per Day", "non_holiday_revenue", "non_holiday_days")
define(
    "Holiday Lift %",
    Calc(
        ("holiday_revenue_per_day", "non_holiday_revenue_per_day"),
        lambda m: zero(ratio(m("holiday_revenue_per_day"), m("non_holiday_revenue_per_day"))) - 1,
    ),
)

# --- order life cycle (one row per order) --------------------------------------


def _in_state(*states: str) -> Callable[[], Column]:
    return lambda: count_of(F.col("order_status").isin(*states))


_agg("Life Cycle Orders", "lifecycle", _count)
_agg("Avg Delivery Days", "lifecycle", _avg("days_purchase_to_delivery"))
_agg("Avg Days to Approve", "lifecycle", _avg("days_to_approve"))
_agg("Avg Days to Ship", "lifecycle", _avg("days_to_ship"))
_agg("Avg Days Carrier to Delivery", "lifecycle", _avg("days_to_deliver"))
# an order without a delivery has a blank variance, and blank <= 0 holds
_agg("On-Time Orders", "lifecycle", lambda: count_of(F.coalesce("days_delivery_variance", F.lit(0)) <= 0))
_agg("Strictly On-Time Orders", "lifecycle", lambda: count_of(F.col("days_delivery_variance") <= 0))
_agg("Delivered With Estimate", "lifecycle", lambda: F.count("days_delivery_variance"))
_ratio("On-Time Delivery %", "on_time_orders", "life_cycle_orders")
_ratio("Strict On-Time Delivery %", "strictly_on_time_orders", "delivered_with_estimate")
_agg(
    "North Region Delivery",
    "lifecycle",
    lambda: F.avg(F.when(F.col("customer_state").isin(vocab.NORTH_STATES), F.col("days_purchase_to_delivery"))),
    needs=("customer_state",),
)
for _title, _states in [
    ("Delivered Orders", ["delivered"]),
    ("Approved Orders", vocab.APPROVED_STATES),
    ("Approved", vocab.APPROVED_STATES),
    ("Shipped Orders", vocab.SHIPPED_STATES),
    ("Cancelled Orders", ["canceled"]),
    ("Unavailable Orders", ["unavailable"]),
]:
    _agg(_title, "lifecycle", _in_state(*_states), needs=("order_status",))
define("Delivery Target", Calc((), lambda m: F.lit(vocab.DELIVERY_TARGET_DAYS)))
define(
    "Delivery Variance",
    Calc(("avg_delivery_days",), lambda m: zero(m("avg_delivery_days")) - vocab.DELIVERY_TARGET_DAYS),
)
_ratio("Cancellation Rate", "cancelled_orders", "total_orders")
_ratio("Fulfillment Rate", "delivered_orders", "total_orders")

# --- reviews ------------------------------------------------------------------

_agg("Total Reviews", "reviews", _count)
_agg("Avg Review Score", "reviews", _avg("review_score"))
_agg("1-Star Reviews", "reviews", lambda: count_of(F.col("review_score") == 1))
_agg("5-Star Reviews", "reviews", lambda: count_of(F.col("review_score") == 5))
_agg("Commented Reviews", "reviews", lambda: F.nullif(F.count("review_comment_message"), F.lit(0)), needs=("review_comment_message",))
_ratio("1-Star Rate", "1_star_reviews", "total_reviews")
_ratio("5-Star Rate", "5_star_reviews", "total_reviews")
_ratio("Reviews with Comments", "commented_reviews", "total_reviews")
define("Review Score %", Calc(("avg_review_score",), lambda m: m("avg_review_score") / 5))
define("Score vs Target", Calc(("avg_review_score",), lambda m: zero(m("avg_review_score")) - vocab.SCORE_TARGET))
_agg("Category Avg Score", "reviewed_items", _avg("review_score"))
_agg("Seller Avg Score", "reviewed_items", _avg("review_score"))
_agg("Late Avg Score", "reviewed_orders", lambda: F.avg(F.when(F.col("days_delivery_variance") > 0, F.col("review_score"))))
_agg(
    "OnTime Avg Score",
    "reviewed_orders",
    lambda: F.avg(F.when(F.coalesce("days_delivery_variance", F.lit(0)) <= 0, F.col("review_score"))),
)

# --- payments -------------------------------------------------------------------

_INSTALLMENTS = {"most_installments": lambda: F.max("payment_installments")}


def _of_type(label: str) -> Callable[[], Column]:
    return lambda: count_of(F.col("payment_type") == label)


_agg("Total Payment Value", "payments", _sum("payment_value"))
_agg("Payment Transactions", "payments", _count)
_agg("Avg Payment Value", "payments", _avg("payment_value"))
_agg("Avg Value by Payment Type", "payments", _avg("payment_value"))
_agg("Avg Installments", "payments", _avg("payment_installments"))
_agg("Max Installments Used", "payments", lambda: F.max("payment_installments"))
_agg("Paid Orders", "payments", _count, key="order_id_bk")
_agg("Order Count by Installments", "payments", _count, key="order_id_bk")
_agg(
    "Orders Using Installments",
    "payments",
    lambda: count_of(F.col("most_installments") > 1),
    key="order_id_bk",
    inner=_INSTALLMENTS,
)
_agg("Credit Card Payments", "payments", _of_type("Credit Card"), needs=("payment_type",))
_agg("Boleto Payments", "payments", _of_type("Boleto"), needs=("payment_type",))
_ratio("Orders Using Installments %", "orders_using_installments", "paid_orders")
_ratio("Payment Success %", "paid_orders", "total_orders")
_ratio("Credit Card %", "credit_card_payments", "payment_transactions")
_ratio("Boleto %", "boleto_payments", "payment_transactions")
_agg("Revenue by Payment Type", "paid_items", _sum("line_total"))

# --- marketing funnel (won deals) ---------------------------------------------------

_agg("Total MQLs", "funnel", _count, key="mql_id_bk")
_agg("Total Deals", "funnel", _count, key="closed_deal_sk")
_agg("Avg Days to Close", "funnel", _avg("days_to_close"))
_agg("Avg Declared Monthly Revenue", "funnel", _avg("declared_monthly_revenue"))
_agg("Declared Monthly Revenue", "funnel", _sum("declared_monthly_revenue"))
_agg(
    "Best Channel",
    "funnel",
    lambda: name_of_largest("origin", "deals"),
    key="origin",
    inner={"deals": lambda: F.count("*")},
    needs=("origin",),
)
_ratio("MQL Conversion Rate", "total_deals", "total_mqls")
_ratio("Lead Conversion Rate", "total_deals", "leads")
define("Deals per SDR", KeepOnly("total_deals", ("sdr_id_bk",)))
define("Revenue per SDR", KeepOnly("declared_monthly_revenue", ("sdr_id_bk",)))

# --- composite ------------------------------------------------------------------------

_HEALTH = ("fulfillment_rate", "on_time_delivery_pct", "review_score_pct", "payment_success_pct", "mql_conversion_rate")
define("Operational Health Score", Calc(_HEALTH, lambda m: sum((zero(m(h)) for h in _HEALTH), F.lit(0.0)) / 5))
define(
    "Active Anomalies",
    Calc(
        ("avg_delivery_days", "avg_review_score", "cancellation_rate", "revenue_mom_pct"),
        lambda m: (zero(m("avg_delivery_days")) > vocab.SLOW_DELIVERY_DAYS).cast("int")
        + (zero(m("avg_review_score")) < vocab.LOW_SCORE).cast("int")
        + (zero(m("cancellation_rate")) > vocab.HIGH_CANCELLATION).cast("int")
        + (zero(m("revenue_mom_pct")) < vocab.REVENUE_DROP).cast("int"),
    ),
)
define(
    "Composite Risk Score",
    Calc(
        ("avg_delivery_days", "avg_review_score", "cancellation_rate"),
        lambda m: F.round(
            F.least((zero(m("avg_delivery_days")) - 12) / 12 * 100, F.lit(100.0)) * 0.4
            + F.greatest((4.0 - zero(m("avg_review_score"))) / 4.0 * 100, F.lit(0.0)) * 0.35
            + F.least(zero(m("cancellation_rate")) / 0.05 * 100, F.lit(100.0)) * 0.25,
            1,
        ),
    ),
)

# --- to-date comparisons: title, base, grain, part ----------------------------------------

GRAINS = {"M": "month", "Q": "quarter", "Y": "year"}
PURCHASE = {"lifecycle": "purchase"}


def _compare(title: str, base: str, grain: str, part: str, roles: Mapping[str, str] = {}) -> None:
    define(title, Period(base, grain, part, dict(roles)))


for _name, _base, _roles in [
    ("Revenue", "total_revenue", {}),
    ("Orders", "total_orders", {}),
    ("Customers", "total_customers", {}),
    ("Review Score", "avg_review_score", {}),
    ("Delivery Days", "avg_delivery_days", PURCHASE),
    ("AOV", "aov", {}),
]:
    for _letter, _grain in GRAINS.items():
        _compare(f"{_name} P{_letter}", _base, _grain, "prior", _roles)
        _compare(f"{_name} {_letter}o{_letter} %", _base, _grain, "pct", _roles)

define("Revenue MoM Delta", Period("total_revenue", "month", "delta"))

# fixed values: remaining comparisons (name before the suffix, base measure, suffix)
for _name, _base, _suffix in [
    ("Revenue per Customer", "revenue_per_customer", "YoY"),
    ("MQL Conversion Rate", "mql_conversion_rate", "MoM"),
    ("Category Avg Score", "category_avg_score", "MoM"),
    ("Categories Above 5pct GMV", "categories_above_5pct_gmv", "YoY"),
    ("Avg Days to Close", "avg_days_to_close", "MoM"),
    ("Avg Declared Monthly Revenue", "avg_declared_monthly_revenue", "MoM"),
    ("Payment Value", "total_payment_value", "MoM"),
    ("Revenue per Seller", "revenue_per_seller", "YoY"),
    ("Avg Orders per Customer", "avg_orders_per_customer", "MoM"),
    ("Repeat Rate", "repeat_rate", "MoM"),
    ("Reactivation Window", "reactivation_window", "MoM"),
    ("States Active", "states_active", "YoY"),
    ("SP Revenue Share", "sp_revenue_share", "YoY"),
    ("Delivered Orders", "delivered_orders", "YoY"),
    ("Cancelled Orders", "cancelled_orders", "MoM"),
    ("Unavailable Orders", "unavailable_orders", "MoM"),
    ("Active Sellers", "active_sellers", "YoY"),
    ("Top Seller Revenue", "top_seller_revenue", "YoY"),
    ("Top Category Revenue", "top_category_revenue", "YoY"),
    ("Top Category Share", "top_category_share", "YoY"),
    ("Category Growth Rate", "category_growth_rate_yoy", "MoM"),
    ("Payment Transactions", "payment_transactions", "MoM"),
    ("Avg Payment Value", "avg_payment_value", "MoM"),
    ("Credit Card", "credit_card_pct", "MoM"),
    ("Boleto", "boleto_pct", "MoM"),
    ("Avg Installments", "avg_installments", "MoM"),
    ("Max Installments Used", "max_installments_used", "MoM"),
    ("Orders Using Installments", "orders_using_installments_pct", "MoM"),
    ("Total Deals", "total_deals", "MoM"),
    ("Active Channels", "active_channels", "MoM"),
    ("Peak Month Revenue", "peak_month_revenue", "YoY"),
    ("Weakest Month Revenue", "weakest_month_revenue", "MoM"),
    ("Weekend Order Share", "weekend_order_share", "MoM"),
    ("Holiday Lift", "holiday_lift_pct", "MoM"),
    ("Base Forecast", "base_forecast", "MoM"),
    ("Revenue CAGR", "revenue_cagr", "YoY"),
    ("YTD Revenue", "ytd_revenue", "YoY"),
    ("Active Anomalies", "active_anomalies", "MoM"),
]:
    _compare(f"{_name} {_suffix} %", _base, GRAINS[_suffix[0]], "pct")

for _name, _base in [
    ("Avg Days to Ship", "avg_days_to_ship"),
    ("Avg Days Carrier to Delivery", "avg_days_carrier_to_delivery"),
    ("North Region Delivery", "north_region_delivery"),
    ("Avg Days to Approve", "avg_days_to_approve"),
]:
    _compare(f"{_name} MoM %", _base, "month", "pct", PURCHASE)

for _title, _base in [
    ("Fulfillment Trend %", "fulfillment_rate"),
    ("Cancellation Trend %", "cancellation_rate"),
    ("On-Time Delivery Trend %", "on_time_delivery_pct"),
    ("MQL Trend %", "total_mqls"),
]:
    _compare(_title, _base, "month", "pct")

for _name, _source in [
    ("Revenue", "revenue"),
    ("Orders", "orders"),
    ("Customer", "customers"),
    ("Review Score", "review_score"),
    ("Delivery", "delivery_days"),
    ("AOV", "aov"),
]:
    _alias(f"{_name} Trend %", f"{_source}_yoy_pct")
_alias("Revenue Growth Rate", "revenue_mom_pct")

# --- anchored on the last day ---------------------------------------------------------------


def _january_first(anchor: dt.date) -> dt.date:
    return anchor.replace(month=1, day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    """Same day n months on, the month's last day where it is shorter."""
    month = d.year * 12 + d.month - 1 + n
    first = dt.date(month // 12, month % 12 + 1, 1)
    after = dt.date((month + 1) // 12, (month + 1) % 12 + 1, 1)
    return first.replace(day=min(d.day, (after - first).days))


define("Rolling 3M Avg Revenue", Windowed("average_daily_revenue", lambda a: add_months(a, -3) + dt.timedelta(days=1)))
define("YTD Revenue", Windowed("total_revenue", _january_first))
define(
    "Base Forecast",
    Calc(
        ("revenue_pm", "revenue_mom_pct"),
        lambda m: m("revenue_pm").cast("double") * (1 + zero(m("revenue_mom_pct"))),
    ),
)
define("Optimistic Forecast", Calc(("base_forecast",), lambda m: m("base_forecast") * vocab.OPTIMISTIC_FACTOR))
define("Pessimistic Forecast", Calc(("base_forecast",), lambda m: m("base_forecast") * vocab.PESSIMISTIC_FACTOR))
define("Forecast Periods", Calc((), lambda m: F.lit(vocab.FORECAST_PERIODS)))
define(
    "Category Growth Rate YoY",
    Calc(
        ("total_revenue", "revenue_py"),
        lambda m: ratio(zero(m("total_revenue")) - m("revenue_py").cast("double"), m("revenue_py")),
    ),
)
define(
    "Revenue CAGR",
    Calc(("first_year_revenue", "last_year_revenue", "cagr_years"), lambda m: _cagr(m)),
)
define("CAGR Years", Agg("days", lambda star: F.max("year") - F.min("year"), undated=True))


def _cagr(m: Callable[[str], Column]) -> Column:
    growth = zero(ratio(m("last_year_revenue"), m("first_year_revenue")))
    return F.when(m("cagr_years") > 0, F.pow(growth, 1 / m("cagr_years")) - 1)


# --- whole-period shifts ----------------------------------------------------------------------

for _name, _base, _suffix in [
    ("1-Star Rate", "1_star_rate", "M"),
    ("5-Star Rate", "5_star_rate", "M"),
    ("Reviews with Comments", "reviews_with_comments", "M"),
    ("Repeat Customers", "repeat_customers", "Q"),
    ("Repeat Customer Revenue", "repeat_customer_revenue", "Y"),
]:
    define(f"{_name} P{_suffix}", Shift(_base, GRAINS[_suffix], "prior"))
    define(f"{_name} {_suffix}o{_suffix} %", Shift(_base, GRAINS[_suffix], "pct"))

# --- insight texts ----------------------------------------------------------------------------

# fixed values: sentences of the three insight texts
STRONG = "Strong growth trajectory — maintain momentum."
DECLINE = "Revenue decline: review category mix and promotions."
STABLE = "Stable performance. Monitor AOV for improvement levers."
SLOW = "⚠ Delivery above 15d threshold — logistics review needed."
UNHAPPY = "⚠ Review score below 3.8 — check fulfilment quality."
FINE = "✓ Operations within acceptable parameters."
LEAVING = "⚠ Very low retention — invest in repeat-purchase campaigns."
LOYAL = "✓ Strong repeat behaviour for ecommerce."
MODERATE = "Moderate retention. Target 90-day re-engagement window."


def _shown(pattern: str, c: Column) -> Column:
    """Formatted number, empty text for a blank."""
    return F.coalesce(F.when(c.isNotNull(), F.format_string(pattern, c.cast("double"))), F.lit(""))


def _revenue_insight(m) -> Column:
    yoy = m("revenue_yoy_pct")
    return F.concat(
        F.lit("Revenue is "),
        F.when(zero(yoy) >= 0, "up").otherwise("down"),
        F.lit(" "),
        _shown("%.1f%%", F.abs(yoy) * 100),
        F.lit(" YoY. Total GMV: "),
        _shown("%,.0f", m("total_revenue")),
        F.lit(". "),
        F.when(zero(yoy) > 0.1, STRONG).when(zero(yoy) < -0.05, DECLINE).otherwise(STABLE),
    )


def _operations_insight(m) -> Column:
    days, score = m("avg_delivery_days"), m("avg_review_score")
    return F.concat(
        F.lit("Avg delivery: "),
        _shown("%.1f", days),
        F.lit(" days ("),
        _shown("%.0f%%", m("on_time_delivery_pct") * 100),
        F.lit(" on-time). Review score: "),
        _shown("%.2f", score),
        F.lit("/5. "),
        F.when(zero(days) > 15, SLOW).when(zero(score) < 3.8, UNHAPPY).otherwise(FINE),
    )


def _customer_insight(m) -> Column:
    repeat = m("repeat_rate")
    return F.concat(
        _shown("%,.0f", m("total_customers")),
        F.lit(" unique buyers ("),
        _shown("%+.1f%%", m("customers_yoy_pct") * 100),
        F.lit(" YoY). Repeat rate: "),
        _shown("%.1f%%", repeat * 100),
        F.lit(". "),
        F.when(zero(repeat) < 0.05, LEAVING).when(zero(repeat) > 0.15, LOYAL).otherwise(MODERATE),
    )


define("AI Insight Revenue", Calc(("revenue_yoy_pct", "total_revenue"), _revenue_insight))
define(
    "AI Insight Operations",
    Calc(("avg_delivery_days", "on_time_delivery_pct", "avg_review_score"), _operations_insight),
)
define("AI Insight Customer", Calc(("total_customers", "repeat_rate", "customers_yoy_pct"), _customer_insight))

# --- trend marks --------------------------------------------------------------------------------

for _name in ["Revenue", "Orders", "Customer", "Review Score", "Delivery", "AOV"]:
    _up = _name != "Delivery"
    define(f"{_name} Trend Arrow", Trend(measure_id(f"{_name} Trend %"), "arrow", _up))
    # more delivery days count as bad here, as in every other delivery figure
    define(f"{_name} Trend Color", Trend(measure_id(f"{_name} Trend %"), "color", _up))

# fixed values: figures whose fall is good
LOWER_IS_BETTER = {
    "1-Star Rate",
    "Reactivation Window",
    "Delivery Days MoM",
    "Avg Days to Ship",
    "Avg Days Carrier to Delivery",
    "North Region Delivery",
    "Cancellation Rate",
    "Cancelled Orders",
    "Unavailable Orders",
    "Avg Days to Approve",
    "Avg Days to Close",
    "Active Anomalies",
}
# fixed values: trend name and the comparison it marks
for _name, _source in [
    ("Revenue per Customer", "Revenue per Customer YoY %"),
    ("1-Star Rate", "1-Star Rate MoM %"),
    ("5-Star Rate", "5-Star Rate MoM %"),
    ("Reviews with Comments", "Reviews with Comments MoM %"),
    ("Repeat Customers", "Repeat Customers QoQ %"),
    ("Repeat Customers REV", "Repeat Customer Revenue YoY %"),
    ("ON TIME Delivery", "On-Time Delivery Trend %"),
    ("Review Score MoM", "Review Score MoM %"),
    ("Repeat Rate", "Repeat Rate MoM %"),
    ("Avg Orders per Customer", "Avg Orders per Customer MoM %"),
    ("Reactivation Window", "Reactivation Window MoM %"),
    ("Delivery Days MoM", "Delivery Days MoM %"),
    ("Avg Days to Ship", "Avg Days to Ship MoM %"),
    ("Avg Days Carrier to Delivery", "Avg Days Carrier to Delivery MoM %"),
    ("States Active", "States Active YoY %"),
    ("SP Revenue Share", "SP Revenue Share YoY %"),
    ("North Region Delivery", "North Region Delivery MoM %"),
    ("Fulfillment Rate", "Fulfillment Trend %"),
    ("Cancellation Rate", "Cancellation Trend %"),
    ("Avg Days to Approve", "Avg Days to Approve MoM %"),
    ("Delivered Orders", "Delivered Orders YoY %"),
    ("Cancelled Orders", "Cancelled Orders MoM %"),
    ("Unavailable Orders", "Unavailable Orders MoM %"),
    ("Active Sellers", "Active Sellers YoY %"),
    ("Revenue per Seller", "Revenue per Seller YoY %"),
    ("Top Seller Revenue", "Top Seller Revenue YoY %"),
    ("Top Category Revenue", "Top Category Revenue YoY %"),
    ("Top Category Share", "Top Category Share YoY %"),
    ("Category Growth Rate", "Category Growth Rate MoM %"),
    ("Payment Transactions", "Payment Transactions MoM %"),
    ("Avg Payment Value", "Avg Payment Value MoM %"),
    ("Credit Card", "Credit Card MoM %"),
    ("Boleto", "Boleto MoM %"),
    ("Avg Installments", "Avg Installments MoM %"),
    ("Max Installments Used", "Max Installments Used MoM %"),
    ("Orders Using Installments", "Orders Using Installments MoM %"),
    ("Total MQLs", "MQL Trend %"),
    ("Total Deals", "Total Deals MoM %"),
    ("MQL Conversion Rate", "MQL Conversion Rate MoM %"),
    ("Avg Days to Close", "Avg Days to Close MoM %"),
    ("Active Channels", "Active Channels MoM %"),
    ("Avg Declared Monthly Revenue", "Avg Declared Monthly Revenue MoM %"),
    ("Peak Month Revenue", "Peak Month Revenue YoY %"),
    ("Weakest Month Revenue", "Weakest Month Revenue MoM %"),
    ("Weekend Order Share", "Weekend Order Share MoM %"),
    ("Holiday Lift", "Holiday Lift MoM %"),
    ("Base Forecast", "Base Forecast MoM %"),
    ("Revenue CAGR", "Revenue CAGR YoY %"),
    ("YTD Revenue", "YTD Revenue YoY %"),
    ("Active Anomalies", "Active Anomalies MoM %"),
]:
    define(f"{_name} Trend Color", Trend(measure_id(_source), "color", _name not in LOWER_IS_BETTER))


def dependencies(measure: object) -> tuple[str, ...]:
    """Measures that must be in the same frame."""
    if isinstance(measure, Calc):
        return measure.deps
    if isinstance(measure, (Trend, Rank)):
        return (measure.base,)
    return ()


def ordered(names: Sequence[str]) -> list[str]:
    """The measures and all they are computed from, inputs first."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in out:
            return
        if name not in MEASURES:
            raise KeyError(f"unknown measure {name!r}")
        for d in dependencies(MEASURES[name]):
            visit(d)
        out.append(name)

    for n in names:
        visit(n)
    return out
