"""The flat table: one row per order with customer, delivery, payment, product, seller, review and lead."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.dedupe import first_per_key, latest_per_key, pick_one
from tradewind.sources.writers import one_plan

# columns the models fill later, with their types
SCORE_COLUMNS = {
    "recency_days": "int",
    "frequency_orders": "int",
    "monetary_total": "decimal(14,2)",
    "customer_segment": "string",
    "churn_probability": "double",
    "churn_risk_tier": "string",
    "delay_risk_score": "double",
    "delay_risk_tier": "string",
    "predicted_review_score": "double",
    "predicted_satisfaction": "string",
    "seller_performance_score": "double",
    "seller_tier": "string",
}


# columns of the life-cycle fact that the flat table leaves out
NOT_SHOWN = ["order_fulfillment_sk", "approval_date_key", "carrier_date_key", "delivery_date_key", "estimated_delivery_date_key"]


def main_payment_type(payments: DataFrame) -> DataFrame:
    """The type that carries most of an order's value; equal totals go to the smaller key."""
    # dealt by order at once: sums, choice and the join to the order need no further shuffle
    dealt = payments.select("order_id_bk", "payment_type_sk", "payment_value", "payment_installments").repartition("order_id_bk")
    per_type = dealt.groupBy("order_id_bk", "payment_type_sk").agg(
        F.sum("payment_value").alias("total_value"),
        F.max("payment_installments").alias("payment_installments"),
    )
    best = pick_one(per_type, ["order_id_bk"], [F.col("total_value").desc(), F.col("payment_type_sk").asc()])
    return best.select("order_id_bk", "payment_type_sk", "payment_installments")


def first_item(items: DataFrame) -> DataFrame:
    """Product and seller of the lowest item number."""
    lines = items.select("order_id_bk", "order_item_id_bk", "product_sk", "seller_sk")
    return first_per_key(lines, ["order_id_bk"], ["order_item_id_bk"]).drop("order_item_id_bk")


def latest_deal(funnel: DataFrame) -> DataFrame:
    """The newest won deal of every known seller; equal days go to the smaller lead id."""
    deals = funnel.where("seller_sk <> -1").select(
        "seller_sk", "won_date_key", "mql_id_bk", "mql_channel_sk", "days_to_close"
    )
    return latest_per_key(deals, ["seller_sk"], ["won_date_key"]).select(
        "seller_sk", "mql_channel_sk", "days_to_close"
    )


def build_order_table(
    star: Mapping[str, DataFrame], with_scores: bool = True, step: Callable[..., DataFrame] = one_plan
) -> DataFrame:
    """Left joins from the life-cycle fact, so every order stays exactly once.

    `step` gets the frame after each shuffle of whole rows and may write it in between.
    """
    day = star["dim_date"].select(
        F.col("date_key").alias("purchase_date_key"),
        F.col("full_date").alias("purchase_date"),
        F.col("year").alias("purchase_year"),
        F.col("month_num").alias("purchase_month"),
        F.col("month_name").alias("purchase_month_name"),
        F.col("day_of_week_name").alias("purchase_day_of_week"),
        F.col("is_weekend").alias("is_weekend_purchase"),
    )
    customer = star["dim_customer"].select(
        "customer_sk",
        F.col("customer_unique_id_bk").alias("customer_unique_id"),
        "customer_state",
        "customer_city",
    )
    seller = star["dim_seller"].select(
        "seller_sk", F.col("seller_id_bk").alias("seller_id"), "seller_state", "seller_city"
    )
    channel = star["dim_marketing_channel"].select(
        "mql_channel_sk", F.col("origin").alias("marketing_origin"), "business_segment", "lead_type", "business_type"
    )
    deals = latest_deal(star["fact_marketing_funnel"]).join(channel, "mql_channel_sk", "left")
    sellers = seller.join(deals, "seller_sk", "left")

    # the order-grain parts share one partitioning by order, dimensions come after
    payment = step(main_payment_type(star["fact_payments"]))
    item = step(first_item(star["fact_order_items"]), keep=True)
    orders = step(
        star["fact_order_life_cycle"]
        .drop(*NOT_SHOWN)
        .join(star["fact_reviews"].select("order_id_bk", "review_score"), "order_id_bk", "left")
        .join(payment, "order_id_bk", "left")
        .join(item, "order_id_bk", "left")
    )
    flat = step(
        orders.join(day, "purchase_date_key", "left")
        .join(F.broadcast(star["dim_order_status"].select("order_status_sk", "order_status")), "order_status_sk", "left")
        .join(F.broadcast(star["dim_payment_type"].select("payment_type_sk", "payment_type")), "payment_type_sk", "left")
        .drop("purchase_date_key", "order_status_sk", "payment_type_sk")
        .join(customer, "customer_sk", "left")
        .drop("customer_sk")
    )
    flat = step(flat.join(star["dim_product"].select("product_sk", "product_category_name"), "product_sk", "left").drop("product_sk"))
    flat = flat.join(sellers, "seller_sk", "left")
    flat = flat.select(
        F.col("order_id_bk").alias("order_id"),
        "purchase_date",
        "purchase_year",
        "purchase_month",
        "purchase_month_name",
        "purchase_day_of_week",
        "is_weekend_purchase",
        "order_status",
        "customer_unique_id",
        "customer_state",
        "customer_city",
        "days_to_approve",
        "days_to_ship",
        "days_to_deliver",
        "days_purchase_to_delivery",
        "days_delivery_variance",
        "is_delivered_on_time",
        "total_items",
        "total_distinct_products",
        "total_distinct_sellers",
        "total_order_value",
        "total_freight_value",
        "total_payment_value",
        "payment_type",
        "payment_installments",
        "product_category_name",
        "seller_id",
        "seller_state",
        "seller_city",
        "review_score",
        "marketing_origin",
        "days_to_close",
        "business_segment",
        "lead_type",
        "business_type",
    )
    if with_scores:
        flat = flat.select("*", *[F.lit(None).cast(t).alias(c) for c, t in SCORE_COLUMNS.items()])
    return flat
