"""Raw tables to cleaned tables: one row per key, labels and sentinels in place.

Every job projects first and removes duplicates on the cleaned key afterwards,
so stray blanks cannot keep two copies apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.functions.dates import day_or_unknown, milestone_day
from tradewind.functions.numbers import flag, money, whole
from tradewind.functions.text import (
    clean,
    from_vocabulary,
    lower_clean,
    text_or,
    title_case,
    upper_clean,
    zip5,
)
from tradewind.operators.dedupe import latest_per_key

STAMP = "_ingested_at"


def _finish(df: DataFrame, keys: list[str], stamps: list[str], now: Column | None) -> DataFrame:
    one = latest_per_key(df, keys, stamps)
    return one.withColumn("_processed_at", now if now is not None else F.current_timestamp())


def clean_customers(raw: DataFrame, now: Column | None = None) -> DataFrame:
    out = raw.select(
        clean("customer_id").alias("customer_id"),
        clean("customer_unique_id").alias("customer_unique_id"),
        zip5("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        upper_clean("customer_city").alias("customer_city"),
        upper_clean("customer_state").alias("customer_state"),
        STAMP,
        "_source",
    )
    return _finish(out, ["customer_id"], [STAMP], now)


def clean_sellers(raw: DataFrame, now: Column | None = None) -> DataFrame:
    missing = F.lit(vocab.NOT_SPECIFIED)
    out = raw.select(
        clean("seller_id").alias("seller_id"),
        zip5("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.coalesce(upper_clean("seller_city"), missing).alias("seller_city"),
        F.coalesce(upper_clean("seller_state"), missing).alias("seller_state"),
        STAMP,
        "_source",
    )
    return _finish(out, ["seller_id"], [STAMP], now)


def clean_products(raw: DataFrame, translation: DataFrame, now: Column | None = None) -> DataFrame:
    """English category where a translation exists, else the original, else 'Not Specified'."""
    names = translation.select(
        clean("product_category_name").alias("_category"),
        clean("product_category_name_english").alias("_english"),
        F.col(STAMP).alias("_stamp"),
    )
    names = latest_per_key(names, ["_category"], ["_stamp"]).drop("_stamp")
    out = raw.select(
        clean("product_id").alias("product_id"),
        clean("product_category_name").alias("_category"),
        whole("product_name_lenght").alias("product_name_length"),
        whole("product_description_lenght").alias("product_description_length"),
        whole("product_photos_qty").alias("product_photos_qty"),
        whole("product_weight_g").alias("product_weight_g"),
        whole("product_length_cm").alias("product_length_cm"),
        whole("product_height_cm").alias("product_height_cm"),
        whole("product_width_cm").alias("product_width_cm"),
        STAMP,
        "_source",
    )
    out = latest_per_key(out, ["product_id"], [STAMP]).join(names, "_category", "left")
    label = title_case(F.coalesce("_english", "_category", F.lit("")))
    return out.select(
        "product_id",
        F.coalesce(label, F.lit(vocab.NOT_SPECIFIED)).alias("product_category_name"),
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        STAMP,
        "_source",
        (now if now is not None else F.current_timestamp()).alias("_processed_at"),
    )


def clean_orders(raw: DataFrame, now: Column | None = None) -> DataFrame:
    status = lower_clean("order_status")
    out = raw.select(
        clean("order_id").alias("order_id"),
        clean("customer_id").alias("customer_id"),
        status.alias("order_status"),
        day_or_unknown("order_purchase_timestamp").alias("order_purchase_date"),
        day_or_unknown("order_approved_at").alias("order_approved_date"),
        milestone_day("order_delivered_carrier_date", status).alias("order_delivered_carrier_date"),
        milestone_day("order_delivered_customer_date", status).alias("order_delivered_customer_date"),
        day_or_unknown("order_estimated_delivery_date").alias("order_estimated_delivery_date"),
        STAMP,
        "_source",
    )
    return _finish(out, ["order_id"], [STAMP], now)


def clean_order_items(raw: DataFrame, now: Column | None = None) -> DataFrame:
    out = raw.select(
        clean("order_id").alias("order_id"),
        F.col("order_item_id").cast("int").alias("order_item_id"),
        text_or("product_id", vocab.UNKNOWN).alias("product_id"),
        text_or("seller_id", vocab.UNKNOWN).alias("seller_id"),
        day_or_unknown("shipping_limit_date").alias("shipping_limit_date"),
        money("price").alias("unit_price"),
        money("freight_value").alias("unit_freight_value"),
        STAMP,
        "_source",
    )
    return _finish(out, ["order_id", "order_item_id"], [STAMP], now)


def clean_order_payments(raw: DataFrame, now: Column | None = None) -> DataFrame:
    out = raw.select(
        clean("order_id").alias("order_id"),
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        from_vocabulary("payment_type", vocab.PAYMENT_LABELS, vocab.NOT_SPECIFIED).alias("payment_type"),
        whole("payment_installments").alias("payment_installments"),
        money("payment_value").alias("payment_value"),
        STAMP,
        "_source",
    )
    return _finish(out, ["order_id", "payment_sequential"], [STAMP], now)


def clean_order_reviews(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """One review per order: the one answered last, then the one ingested last."""
    out = raw.select(
        clean("review_id").alias("review_id"),
        clean("order_id").alias("order_id"),
        F.col("review_score").cast("short").alias("review_score"),
        text_or("review_comment_title", vocab.NO_TITLE).alias("review_comment_title"),
        text_or("review_comment_message", vocab.NO_MESSAGE).alias("review_comment_message"),
        day_or_unknown("review_creation_date").alias("review_creation_date"),
        # an unanswered review gets the earliest day, so it also sorts last
        day_or_unknown("review_answer_timestamp").alias("review_answer_date"),
        STAMP,
        "_source",
    )
    return _finish(out, ["order_id"], ["review_answer_date", STAMP], now)


def clean_leads(raw: DataFrame, now: Column | None = None) -> DataFrame:
    out = raw.select(
        clean("mql_id").alias("mql_id"),
        day_or_unknown("first_contact_date").alias("first_contact_date"),
        text_or("landing_page_id", vocab.UNKNOWN).alias("landing_page_id"),
        from_vocabulary("origin", vocab.ORIGIN_LABELS, vocab.OTHER).alias("origin"),
        STAMP,
        "_source",
    )
    return _finish(out, ["mql_id"], [STAMP], now)


def clean_closed_deals(raw: DataFrame, now: Column | None = None) -> DataFrame:
    missing = vocab.NOT_SPECIFIED
    segment = title_case(F.coalesce(clean("business_segment"), F.lit("")))
    out = raw.select(
        clean("mql_id").alias("mql_id"),
        clean("seller_id").alias("seller_id"),
        text_or("sdr_id", vocab.UNKNOWN).alias("sdr_id"),
        text_or("sr_id", vocab.UNKNOWN).alias("sr_id"),
        day_or_unknown("won_date").alias("won_date"),
        F.coalesce(segment, F.lit(missing)).alias("business_segment"),
        from_vocabulary("lead_type", vocab.LEAD_TYPE_LABELS, missing).alias("lead_type"),
        from_vocabulary("lead_behaviour_profile", vocab.BEHAVIOUR_LABELS, missing).alias("lead_behaviour_profile"),
        flag("has_company").alias("has_company"),
        flag("has_gtin").alias("has_gtin"),
        text_or("average_stock", missing).alias("average_stock"),
        from_vocabulary("business_type", vocab.BUSINESS_TYPE_LABELS, missing).alias("business_type"),
        money("declared_product_catalog_size").alias("declared_product_catalog_size"),
        money("declared_monthly_revenue").alias("declared_monthly_revenue"),
        STAMP,
        "_source",
    )
    return _finish(out, ["mql_id"], [STAMP], now)


# table, job and the raw tables it reads, in load order
JOBS = {
    "customers": (clean_customers, ["customers"]),
    "orders": (clean_orders, ["orders"]),
    "order_items": (clean_order_items, ["order_items"]),
    "order_payments": (clean_order_payments, ["order_payments"]),
    "order_reviews": (clean_order_reviews, ["order_reviews"]),
    "sellers": (clean_sellers, ["sellers"]),
    "products": (clean_products, ["products", "product_category_name_translation"]),
    "marketing_qualified_leads": (clean_leads, ["marketing_qualified_leads"]),
    "closed_deals": (clean_closed_deals, ["closed_deals"]),
}
