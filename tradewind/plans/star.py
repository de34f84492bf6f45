"""Cleaned tables to dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.functions.dates import date_key, day_diff, on_time, unknown_day
from tradewind.functions.text import null_if_text
from tradewind.operators.dedupe import latest_per_key
from tradewind.operators.lookup import lookup_sk
from tradewind.operators.upsert import assign_keys, ensure_member, upsert_scd1
from tradewind.sources.writers import one_plan

CUSTOMER_ATTRS = ["customer_zip_code_prefix", "customer_city", "customer_state"]
SELLER_ATTRS = ["seller_zip_code_prefix", "seller_city", "seller_state"]
PRODUCT_ATTRS = [
    "product_category_name",
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
CHANNEL_ATTRS = [
    "origin",
    "landing_page_id",
    "business_segment",
    "lead_type",
    "lead_behaviour_profile",
    "business_type",
    "average_stock",
    "has_company",
    "has_gtin",
]

# fixed values: the members that stand for an unresolved reference
UNKNOWN_CUSTOMER = {
    "customer_sk": -1,
    "customer_unique_id_bk": "UNKNOWN",
    "customer_zip_code_prefix": "00000",
    "customer_city": "UNKNOWN",
    "customer_state": "UN",
}
UNKNOWN_SELLER = {
    "seller_sk": -1,
    "seller_id_bk": "UNKNOWN",
    "seller_zip_code_prefix": "00000",
    "seller_city": "UNKNOWN",
    "seller_state": "UN",
}
UNKNOWN_PRODUCT = {"product_sk": -1, "product_id_bk": "UNKNOWN", "product_category_name": "Not Specified"}


def _now(now: Column | None) -> Column:
    return now if now is not None else F.current_timestamp()


# --- dimensions -----------------------------------------------------------


def dim_customer(customers: DataFrame, target: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """One row per person; a person's newest order-level record wins."""
    people = customers.select(
        F.col("customer_unique_id").alias("customer_unique_id_bk"),
        "customer_id",
        *CUSTOMER_ATTRS,
        "_processed_at",
        "_ingested_at",
    )
    people = latest_per_key(people, ["customer_unique_id_bk"], ["_processed_at", "_ingested_at"])
    dim = upsert_scd1(target, people, "customer_unique_id_bk", "customer_sk", CUSTOMER_ATTRS, _now(now))
    return ensure_member(dim, "customer_sk", UNKNOWN_CUSTOMER, target)


def dim_product(products: DataFrame, target: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    source = products.withColumnRenamed("product_id", "product_id_bk")
    dim = upsert_scd1(target, source, "product_id_bk", "product_sk", PRODUCT_ATTRS, _now(now))
    return ensure_member(dim, "product_sk", UNKNOWN_PRODUCT, target)


def dim_seller(sellers: DataFrame, target: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    source = sellers.withColumnRenamed("seller_id", "seller_id_bk")
    dim = upsert_scd1(target, source, "seller_id_bk", "seller_sk", SELLER_ATTRS, _now(now))
    return ensure_member(dim, "seller_sk", UNKNOWN_SELLER, target)


def dim_marketing_channel(
    leads: DataFrame, deals: DataFrame, target: DataFrame | None = None, now: Column | None = None
) -> DataFrame:
    """Every lead, with the attributes of its deal where it was won."""
    won = deals.select("mql_id", *CHANNEL_ATTRS[2:])
    source = (
        leads.join(won, "mql_id", "left")
        .withColumn("has_company", F.coalesce("has_company", F.lit(0).cast("short")))
        .withColumn("has_gtin", F.coalesce("has_gtin", F.lit(0).cast("short")))
        .withColumnRenamed("mql_id", "mql_id_bk")
    )
    return upsert_scd1(target, source, "mql_id_bk", "mql_channel_sk", CHANNEL_ATTRS, _now(now))


def _seeded(spark: SparkSession, values: list[str], sk: str, name: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(values, start=1)), f"{sk} long, {name} string")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _seeded(spark, vocab.PAYMENT_TYPES, "payment_type_sk", "payment_type")


def dim_order_status(spark: SparkSession) -> DataFrame:
    return _seeded(spark, vocab.ORDER_STATUSES, "order_status_sk", "order_status")


# --- facts ----------------------------------------------------------------


def order_customer(orders: DataFrame, customers: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Purchase day and customer key of every order; four facts read it, so it is written once."""
    people = lookup_sk(
        customers.select("customer_id", "customer_unique_id"),
        dim_cust,
        "customer_unique_id",
        "customer_unique_id_bk",
        "customer_sk",
        -1,
    )
    return orders.join(people, "customer_id").select("order_id", "order_purchase_date", "customer_sk")


def fact_order_items(
    items: DataFrame,
    order_cust: DataFrame,
    dim_prod: DataFrame,
    dim_sell: DataFrame,
    step: Callable[..., DataFrame] = one_plan,
) -> DataFrame:
    """One row per line; `step` gets the frame after each shuffle of whole lines and may write it in between."""
    lines = items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "unit_price", "unit_freight_value"
    )
    joined = step(lines.join(order_cust, "order_id"))
    joined = step(lookup_sk(joined, dim_prod, "product_id", "product_id_bk", "product_sk", -1))
    joined = lookup_sk(joined, dim_sell, "seller_id", "seller_id_bk", "seller_sk", -1)
    return joined.select(
        F.monotonically_increasing_id().alias("order_item_sk"),
        date_key("order_purchase_date").alias("purchase_date_key"),
        date_key("shipping_limit_date").alias("shipping_limit_date_key"),
        "customer_sk",
        "product_sk",
        "seller_sk",
        F.col("order_id").alias("order_id_bk"),
        F.col("order_item_id").alias("order_item_id_bk"),
        "unit_price",
        "unit_freight_value",
        (F.col("unit_price") + F.col("unit_freight_value")).cast("decimal(11,2)").alias("line_total"),
    )


def fact_payments(payments: DataFrame, order_cust: DataFrame, types: DataFrame) -> DataFrame:
    joined = payments.join(order_cust, "order_id")
    # five seeded rows
    joined = lookup_sk(joined, F.broadcast(types), "payment_type", "payment_type", "payment_type_sk", 5)
    return joined.select(
        F.monotonically_increasing_id().alias("payment_sk"),
        date_key("order_purchase_date").alias("purchase_date_key"),
        "customer_sk",
        "payment_type_sk",
        F.col("order_id").alias("order_id_bk"),
        F.col("payment_sequential").alias("payment_sequential_bk"),
        "payment_value",
        "payment_installments",
    )


def keyed_reviews(reviews: DataFrame, order_cust: DataFrame) -> DataFrame:
    """Reviews with their surrogate key; fact and comments are both cut from this frame."""
    joined = reviews.join(order_cust, "order_id")
    return assign_keys(joined, "order_id", "review_sk")


def fact_reviews(keyed: DataFrame) -> DataFrame:
    answered = F.col("review_answer_date") != unknown_day()
    return keyed.select(
        "review_sk",
        date_key("review_creation_date").alias("review_creation_date_key"),
        F.when(answered, date_key("review_answer_date"))
        .otherwise(vocab.OPEN_DATE_KEY)
        .alias("review_answer_date_key"),
        "customer_sk",
        F.col("review_id").alias("review_id_bk"),
        F.col("order_id").alias("order_id_bk"),
        "review_score",
    )


def review_comments(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "review_sk",
        null_if_text("review_comment_title", vocab.NO_TITLE).alias("review_comment_title"),
        null_if_text("review_comment_message", vocab.NO_MESSAGE).alias("review_comment_message"),
    )


def fact_order_life_cycle(
    orders: DataFrame,
    order_cust: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    statuses: DataFrame,
    step: Callable[..., DataFrame] = one_plan,
) -> DataFrame:
    """One row per order with its five milestones; children are summed before the join.

    `step` gets each sum over lines or payments and may write it in between.
    """
    # pairs are made distinct first: two distinct counts in one aggregate would multiply the rows
    item_sums = items.groupBy("order_id").agg(
        F.count("*").alias("total_items"),
        F.sum("unit_price").alias("total_order_value"),
        F.sum("unit_freight_value").alias("total_freight_value"),
    )
    distinct_products = items.select("order_id", "product_id").distinct()
    distinct_sellers = items.select("order_id", "seller_id").distinct()
    products = distinct_products.groupBy("order_id").agg(F.count("*").alias("total_distinct_products"))
    sellers = distinct_sellers.groupBy("order_id").agg(F.count("*").alias("total_distinct_sellers"))
    payment_sums = payments.groupBy("order_id").agg(F.sum("payment_value").alias("total_payment_value"))

    base = orders.join(order_cust.select("order_id", "customer_sk"), "order_id")
    # eight seeded rows
    base = lookup_sk(base, F.broadcast(statuses), "order_status", "order_status", "order_status_sk", 1)
    for part in (item_sums, products, sellers, payment_sums):
        base = base.join(step(part, keep=True), "order_id", "left")

    purchase, approved = "order_purchase_date", "order_approved_date"
    carrier, delivered = "order_delivered_carrier_date", "order_delivered_customer_date"
    estimated = "order_estimated_delivery_date"

    def count_or_zero(c: str) -> Column:
        return F.coalesce(c, F.lit(0)).cast("int").alias(c)

    def value_or_zero(c: str) -> Column:
        return F.coalesce(c, F.lit(0)).cast("decimal(12,2)").alias(c)

    return base.select(
        F.monotonically_increasing_id().alias("order_fulfillment_sk"),
        date_key(purchase).alias("purchase_date_key"),
        date_key(approved).alias("approval_date_key"),
        date_key(carrier).alias("carrier_date_key"),
        date_key(delivered).alias("delivery_date_key"),
        date_key(estimated).alias("estimated_delivery_date_key"),
        "customer_sk",
        "order_status_sk",
        F.col("order_id").alias("order_id_bk"),
        day_diff(purchase, approved).alias("days_to_approve"),
        day_diff(approved, carrier).alias("days_to_ship"),
        day_diff(carrier, delivered).alias("days_to_deliver"),
        day_diff(purchase, delivered).alias("days_purchase_to_delivery"),
        day_diff(estimated, delivered).alias("days_delivery_variance"),
        on_time(delivered, estimated).alias("is_delivered_on_time"),
        count_or_zero("total_items"),
        count_or_zero("total_distinct_products"),
        count_or_zero("total_distinct_sellers"),
        value_or_zero("total_order_value"),
        value_or_zero("total_freight_value"),
        value_or_zero("total_payment_value"),
    )


def fact_marketing_funnel(
    deals: DataFrame, leads: DataFrame, dim_sell: DataFrame, channels: DataFrame
) -> DataFrame:
    joined = deals.join(leads.select("mql_id", "first_contact_date"), "mql_id")
    joined = lookup_sk(joined, dim_sell, "seller_id", "seller_id_bk", "seller_sk", -1)
    joined = joined.withColumn("mql_id_bk", F.col("mql_id"))
    joined = lookup_sk(joined, channels, "mql_id", "mql_id_bk", "mql_channel_sk", -1)
    keyed = assign_keys(joined, "mql_id_bk", "closed_deal_sk")
    return keyed.select(
        "closed_deal_sk",
        date_key("first_contact_date").alias("first_contact_date_key"),
        date_key("won_date").alias("won_date_key"),
        "seller_sk",
        "mql_channel_sk",
        "mql_id_bk",
        null_if_text("sdr_id", vocab.UNKNOWN).alias("sdr_id_bk"),
        null_if_text("sr_id", vocab.UNKNOWN).alias("sr_id_bk"),
        day_diff("first_contact_date", "won_date").alias("days_to_close"),
        "declared_monthly_revenue",
        "declared_product_catalog_size",
    )
