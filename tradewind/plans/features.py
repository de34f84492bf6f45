"""Customer, seller and order features of the models, by aggregation of the flat order table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.operators.ranking import ranked
from tradewind.plans.dashboards import known_day, seller_profile


def _recency(anchor: str) -> Column:
    """Days since the last known purchase day; NULL where no day is known."""
    return F.datediff(F.lit(anchor).cast("date"), F.max(known_day()))


def _known_customer(done: DataFrame) -> DataFrame:
    return done.where("customer_unique_id IS NOT NULL")


def rfm(done: DataFrame, anchor: str = vocab.ANCHOR_DATE) -> DataFrame:
    """Days since the last order, number of orders and total value of every customer."""
    return (
        _known_customer(done)
        .where("total_order_value IS NOT NULL")
        .groupBy("customer_unique_id")
        .agg(
            _recency(anchor).alias("recency_days"),
            F.count("purchase_date").alias("frequency_orders"),
            F.sum("total_order_value").alias("monetary_total"),
        )
    )


def churn(done: DataFrame, anchor: str = vocab.ANCHOR_DATE, churn_days: int = vocab.CHURN_DAYS) -> DataFrame:
    """Eight aggregates per customer and the label: no order for more than `churn_days`."""
    return (
        _known_customer(done)
        .groupBy("customer_unique_id")
        .agg(
            _recency(anchor).alias("recency_days"),
            F.count("purchase_date").alias("frequency"),
            F.sum("total_order_value").alias("monetary"),
            (F.sum("total_order_value").cast("double") / F.count("total_order_value")).alias("avg_order_value"),
            F.avg("review_score").alias("avg_review_score"),
            F.avg(F.col("is_delivered_on_time").cast("int")).alias("pct_on_time"),
            F.avg("days_to_deliver").alias("avg_days_deliver"),
            F.avg("days_delivery_variance").alias("avg_variance"),
        )
        .withColumn("churned", (F.col("recency_days") > churn_days).cast("int"))
    )


# fixed values: share of customers above a tier's lower end
LTV_SHARES = [(0.1, "Platinum"), (0.3, "Gold"), (0.6, "Silver")]


def ltv_tiers(customers: DataFrame, measure: str = "monetary_total") -> DataFrame:
    """Tier by the share of customers who spent more; equal spenders share a tier."""
    placed = ranked(customers, measure, above="_above")
    above = F.col("_above")
    label = None
    for share, name in LTV_SHARES:
        label = F.when(above < share, name) if label is None else label.when(above < share, name)
    return placed.select("customer_unique_id", measure, label.otherwise("Bronze").alias("ltv_tier"))


def customer_table(done: DataFrame, anchor: str = vocab.ANCHOR_DATE, churn_days: int = vocab.CHURN_DAYS) -> DataFrame:
    """Customer-grain feature table."""
    # an order without a known day is older than any other
    newest = F.struct(F.coalesce(known_day(), F.lit(vocab.UNKNOWN_DATE).cast("date")).alias("day"), "order_id")
    return (
        _known_customer(done)
        .groupBy("customer_unique_id")
        .agg(
            F.max_by("customer_state", newest).alias("customer_state"),
            _recency(anchor).alias("recency_days"),
            F.count("purchase_date").alias("frequency_orders"),
            F.sum("total_order_value").alias("monetary_total"),
            F.avg("review_score").alias("avg_review_score"),
            F.avg(F.col("is_delivered_on_time").cast("int")).alias("pct_on_time"),
            F.avg("days_to_deliver").alias("avg_days_deliver"),
            F.avg("days_delivery_variance").alias("avg_variance"),
            F.avg("payment_installments").alias("avg_installments"),
            F.count_distinct("product_category_name").alias("categories"),
        )
        .withColumn("churned", (F.col("recency_days") > churn_days).cast("int"))
    )


def seller_table(done: DataFrame) -> DataFrame:
    """Seller-grain feature table with the newest deal's attributes."""
    attributes = ["seller_state", "seller_city", "marketing_origin", "days_to_close", "business_segment", "lead_type"]
    return seller_profile(done, attributes)


def seller_scores(done: DataFrame, weights: dict[str, float] = vocab.SELLER_WEIGHTS) -> DataFrame:
    """Four figures scaled to 0..1, weighted and put on 0..100.

    A figure that is the same for all sellers counts 0; a missing one counts as
    the smallest.
    """
    sellers = (
        done.where("seller_id IS NOT NULL")
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.avg("review_score").alias("avg_review_score"),
            F.avg(F.col("is_delivered_on_time").cast("int")).alias("pct_on_time"),
            F.sum("total_order_value").alias("total_revenue"),
        )
    )
    ends = sellers.agg(
        F.struct(*[F.min(c).cast("double").alias(f"lo_{c}") for c in weights],
                 *[F.max(c).cast("double").alias(f"hi_{c}") for c in weights])
    ).scalar()
    score = F.lit(0.0)
    for c, weight in weights.items():
        low, high = ends.getField(f"lo_{c}"), ends.getField(f"hi_{c}")
        scaled = F.try_divide(F.coalesce(F.col(c).cast("double"), low) - low, high - low)
        score = score + F.coalesce(scaled, F.lit(0.0)) * weight
    return sellers.withColumn("seller_performance_score", score * 100)


DELAY_NUMBERS = [
    "total_items",
    "total_order_value",
    "total_freight_value",
    "payment_installments",
    "purchase_month",
    "is_weekend_purchase",
    "days_to_approve",
    "days_to_ship",
]
DELAY_LABELS = ["purchase_day_of_week", "product_category_name", "seller_state", "customer_state"]
REVIEW_NUMBERS = DELAY_NUMBERS + ["days_to_deliver", "days_delivery_variance", "is_delivered_on_time"]
REVIEW_LABELS = ["payment_type"] + DELAY_LABELS


def _filled(numbers: list[str], labels: list[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numbers] + [
        F.coalesce(c, F.lit("Unknown")).alias(c) for c in labels
    ]


def delay(done: DataFrame) -> DataFrame:
    """Order features known at dispatch, and whether the order came late."""
    known = done.where("is_delivered_on_time IS NOT NULL")
    late = 1 - F.col("is_delivered_on_time").cast("int")
    return known.select("order_id", late.alias("is_late"), *_filled(DELAY_NUMBERS, DELAY_LABELS))


def review(done: DataFrame) -> DataFrame:
    """Order features and the review score."""
    scored = done.where("review_score IS NOT NULL")
    return scored.select(
        "order_id", F.col("review_score").cast("double").alias("review_score"), *_filled(REVIEW_NUMBERS, REVIEW_LABELS)
    )
