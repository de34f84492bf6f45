"""Figures of the four report pages, computed from the flat order table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.functions.numbers import ratio
from tradewind.operators.dedupe import latest_per_key
from tradewind.operators.ranking import top_k
from tradewind.operators.summaries import fixed_sample, histogram


def known_day(column: str = "purchase_date") -> Column:
    """The day, NULL where it is the sentinel of an unknown one."""
    return F.when(F.col(column) != F.lit(vocab.UNKNOWN_DATE).cast("date"), F.col(column))


def apply_context(df: DataFrame, filters: Mapping[str, Sequence]) -> DataFrame:
    """IN-list filters per column; they reach the scan."""
    for column, values in filters.items():
        df = df.where(F.col(column).isin(list(values)))
    return df


def delivered(orders: DataFrame) -> DataFrame:
    return orders.where("order_status = 'delivered'")


def _rate(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def _period() -> Column:
    return F.make_date("purchase_year", "purchase_month", F.lit(1)).alias("period")


# --- overview ---------------------------------------------------------------


def business_kpis(done: DataFrame) -> DataFrame:
    return done.agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_order_value").alias("total_revenue"),
        F.avg("total_order_value").alias("avg_order_value"),
        (_rate("is_delivered_on_time") * 100).alias("on_time_pct"),
        F.avg("review_score").alias("avg_review"),
        F.count_distinct("customer_unique_id").alias("total_customers"),
    )


def monthly_trend(done: DataFrame) -> DataFrame:
    monthly = done.groupBy("purchase_year", "purchase_month").agg(
        F.count("order_id").alias("orders"), F.sum("total_order_value").alias("revenue")
    )
    return monthly.select("*", _period()).orderBy("period")


def revenue_by(done: DataFrame, column: str, k: int) -> DataFrame:
    """The k groups with the largest revenue."""
    sums = done.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum("total_order_value").alias("revenue"))
    return top_k(sums, "revenue", k, [column])


# --- customers --------------------------------------------------------------


def latest_order_per_customer(done: DataFrame) -> DataFrame:
    return latest_per_key(done, ["customer_unique_id"], ["purchase_date"])


def customer_kpis(latest: DataFrame) -> DataFrame:
    """Figures over one row per customer with the score columns filled."""
    high = F.count_if(F.col("churn_risk_tier") == "High")
    return latest.agg(
        F.count("customer_unique_id").alias("total_customers"),
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency_orders").alias("avg_frequency"),
        F.avg("monetary_total").alias("avg_lifetime_value"),
        high.alias("high_churn"),
        (ratio(high, F.count("customer_unique_id")) * 100).alias("high_churn_pct"),
    )


def segment_stats(done: DataFrame, segment: str) -> DataFrame:
    return (
        done.where(F.col(segment).isNotNull())
        .groupBy(segment)
        .agg(
            F.count_distinct("customer_unique_id").alias("customers"),
            F.avg("total_order_value").alias("avg_order_value"),
            F.avg("review_score").alias("avg_review"),
        )
        .orderBy(F.col("avg_order_value").desc_nulls_last())
    )


def segment_state_revenue(done: DataFrame, segment: str, k: int = 8) -> DataFrame:
    """Revenue by state and segment in the k states with most orders."""
    busiest = top_k(value_counts(done, "customer_state"), "n", k, ["customer_state"]).select("customer_state")
    inside = done.join(busiest, "customer_state", "left_semi").where(F.col(segment).isNotNull())
    return inside.groupBy("customer_state", segment).agg(F.sum("total_order_value").alias("revenue"))


def acquisition(done: DataFrame, since: str = "2017-01") -> DataFrame:
    """Customers by the month of their first known order; `unknown` holds those without a known day."""
    first = done.where(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.min(known_day()).alias("first_day")
    )
    month = F.coalesce(F.date_format("first_day", "yyyy-MM"), F.lit("unknown"))
    months = first.groupBy(month.alias("month")).agg(F.count("*").alias("new_customers"))
    return months.where((F.col("month") >= since) | (F.col("month") == "unknown")).orderBy("month")


# --- delivery ---------------------------------------------------------------


def delivery_kpis(done: DataFrame) -> DataFrame:
    return done.agg(
        (_rate("is_delivered_on_time") * 100).alias("on_time_pct"),
        F.avg("days_to_deliver").alias("avg_deliver_days"),
        F.avg("days_delivery_variance").alias("avg_variance"),
        F.count_if(~F.col("is_delivered_on_time")).alias("late_orders"),
    )


def risk_kpis(done: DataFrame) -> DataFrame:
    return done.agg(
        F.count_if(F.col("delay_risk_tier") == "High").alias("high_risk"),
        F.avg("delay_risk_score").alias("avg_risk_score"),
    )


def delivery_day_histogram(done: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(done.where(F.col("days_to_deliver").between(0, 60)), "days_to_deliver", bins)


def category_on_time(done: DataFrame, least_orders: int = 100, k: int = 12) -> DataFrame:
    """On-time share of the k most punctual categories with enough orders, least punctual first."""
    per = (
        done.where("product_category_name IS NOT NULL")
        .groupBy("product_category_name")
        .agg(F.count("order_id").alias("orders"), _rate("is_delivered_on_time").alias("on_time"))
        .where(F.col("orders") >= least_orders)
    )
    best = top_k(per, "on_time", k, ["product_category_name"])
    return best.withColumn("on_time_pct", F.col("on_time") * 100).orderBy("on_time", "product_category_name")


def monthly_variance(done: DataFrame) -> DataFrame:
    monthly = done.groupBy("purchase_year", "purchase_month").agg(
        F.avg("days_delivery_variance").alias("avg_variance")
    )
    return monthly.select("*", _period()).orderBy("period")


def prediction_sample(scored: DataFrame, size: int = 3000) -> DataFrame:
    both = scored.dropna(subset=["review_score", "predicted_review_score"])
    return fixed_sample(both, "order_id", size)


# --- sellers ----------------------------------------------------------------


def first_known(column: str) -> Column:
    """Aggregate: the earliest order's value that is not NULL; orders without a known day come last."""
    moment = F.struct(F.coalesce(known_day(), F.lit("9999-12-31").cast("date")).alias("day"), "order_id")
    return F.min_by(column, F.when(F.col(column).isNotNull(), moment)).alias(column)


def seller_profile(done: DataFrame, attributes: Sequence[str]) -> DataFrame:
    return (
        done.dropna(subset=["seller_id"])
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_order_value").alias("total_revenue"),
            F.avg("review_score").alias("avg_review"),
            _rate("is_delivered_on_time").alias("pct_on_time"),
            *[first_known(a) for a in attributes],
        )
    )


SELLER_ATTRIBUTES = [
    "seller_tier",
    "seller_performance_score",
    "seller_state",
    "seller_city",
    "marketing_origin",
]


def seller_kpis(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count("seller_id").alias("total_sellers"),
        F.count_if(F.col("seller_tier") == "Top Seller").alias("top_sellers"),
        F.avg("seller_performance_score").alias("avg_score"),
        F.avg("total_revenue").alias("avg_revenue"),
        F.avg("avg_review").alias("avg_review"),
        F.count("marketing_origin").alias("via_marketing"),
    )


def score_against_revenue(profile: DataFrame) -> DataFrame:
    full = profile.dropna(subset=["seller_performance_score", "total_revenue", "seller_tier"])
    return full.where("total_revenue > 0")


def sellers_by_state(profile: DataFrame, k: int = 15) -> DataFrame:
    per = profile.groupBy("seller_state").agg(
        F.count("seller_id").alias("sellers"), F.sum("total_revenue").alias("revenue")
    )
    return top_k(per.where("seller_state IS NOT NULL"), "revenue", k, ["seller_state"])


def top_sellers(profile: DataFrame, k: int = 20) -> DataFrame:
    """The k sellers with most revenue, figures formatted for display."""
    best = top_k(profile, "total_revenue", k, ["seller_id"])
    return best.select(
        F.concat(F.left("seller_id", F.lit(12)), F.lit("...")).alias("seller"),
        "seller_state",
        "total_orders",
        F.concat(F.lit("R$"), F.format_number("total_revenue", 0)).alias("revenue_text"),
        F.format_string("%.2f", F.col("avg_review")).alias("review_text"),
        F.concat(F.format_string("%.1f", F.col("pct_on_time") * 100), F.lit("%")).alias("on_time_text"),
        "total_revenue",
    )
