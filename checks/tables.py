"""Cleaning jobs, dimensions, facts and the flat order table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.registry import add
from tradewind.functions import vocab
from tradewind.functions.dates import unknown_day
from tradewind.functions.text import state_name
from tradewind.operators.upsert import upsert_scd1
from tradewind.plans import calendar, order_table, snapshot, star
from tradewind.plans.warehouse import over_given_tables
from tradewind.session import shared_folder
from tradewind.sources import binding
from tradewind.sources.versions import VersionedTable
from tradewind.sources.writers import write_back
from tradewind.streaming.upsert import batch_upsert, upsert_available


def loaded(spark, folder):
    """The written warehouse."""
    return over_given_tables(spark, folder)


def plan(name):
    """The job of one table over its stored inputs (raw rows for a cleaned table), nothing written."""
    return lambda spark, folder: loaded(spark, folder).plan(name)


# --- cleaned ----------------------------------------------------------------

add(
    "clean_customers",
    "customer_id:s customer_unique_id:s customer_zip_code_prefix:s customer_city:s customer_state:s",
    plan("customers"),
    "SELECT * FROM s_customers",
)
add(
    "clean_sellers",
    "seller_id:s seller_zip_code_prefix:s seller_city:s seller_state:s",
    plan("sellers"),
    "SELECT * FROM s_sellers",
)
add(
    "clean_products",
    "product_id:s product_category_name:s product_name_length:i product_description_length:i product_photos_qty:i "
    "product_weight_g:i product_length_cm:i product_height_cm:i product_width_cm:i",
    plan("products"),
    "SELECT * FROM s_products",
)
add(
    "clean_orders",
    "order_id:s customer_id:s order_status:s order_purchase_date:s order_approved_date:s "
    "order_delivered_carrier_date:s order_delivered_customer_date:s order_estimated_delivery_date:s",
    plan("orders"),
    """SELECT order_id, customer_id, order_status, purchase AS order_purchase_date, approved AS order_approved_date,
              carrier AS order_delivered_carrier_date, delivered AS order_delivered_customer_date,
              estimated AS order_estimated_delivery_date FROM s_orders""",
)
add(
    "latest_items",
    "order_id:s order_item_id:i product_id:s seller_id:s shipping_limit_date:s unit_price:n unit_freight_value:n",
    plan("order_items"),
    "SELECT * FROM s_items",
)
add(
    "clean_payments",
    "order_id:s payment_sequential:i payment_type:s payment_installments:i payment_value:n",
    plan("order_payments"),
    "SELECT * FROM s_payments",
)
add(
    "clean_reviews",
    "review_id:s order_id:s review_score:i review_comment_title:s review_comment_message:s review_creation_date:s "
    "review_answer_date:s",
    plan("order_reviews"),
    "SELECT *, created AS review_creation_date, answered AS review_answer_date FROM s_reviews",
)
add(
    "clean_leads",
    "mql_id:s first_contact_date:s landing_page_id:s origin:s",
    plan("marketing_qualified_leads"),
    "SELECT * FROM s_leads",
)
add(
    "clean_deals",
    "mql_id:s seller_id:s sdr_id:s sr_id:s won_date:s business_segment:s lead_type:s lead_behaviour_profile:s "
    "has_company:i has_gtin:i average_stock:s business_type:s declared_product_catalog_size:n declared_monthly_revenue:n",
    plan("closed_deals"),
    "SELECT * FROM s_deals",
)
add(
    "vocab_counts",
    "payment_type:s n:i",
    lambda spark, folder: plan("order_payments")(spark, folder).groupBy("payment_type").agg(F.count("*").alias("n")),
    "SELECT payment_type, count(*) AS n FROM s_payments GROUP BY 1",
)

# --- dimensions -------------------------------------------------------------

DATE_SPEC = (
    "date_key:i full_date:s day_of_week_num:i day_of_week_name:s day_of_week_name_short:s day_of_month:i day_of_year:i "
    "week_of_year:i month_num:i month_name:s month_name_short:s quarter_num:i quarter_name:s year:i year_month:s "
    "is_weekend:b is_holiday:b"
)
add("dim_date", DATE_SPEC, plan("dim_date"), "SELECT * FROM dim_date")
add(
    "dim_customer",
    "customer_sk:i customer_unique_id_bk:s customer_zip_code_prefix:s customer_city:s customer_state:s",
    plan("dim_customer"),
    "SELECT * FROM dim_customer",
)
add(
    "dim_product",
    "product_sk:i product_id_bk:s product_category_name:s product_name_length:n product_description_length:n "
    "product_photos_qty:n product_weight_g:n product_length_cm:n product_height_cm:n product_width_cm:n",
    plan("dim_product"),
    "SELECT * FROM dim_product",
)
add(
    "dim_seller",
    "seller_sk:i seller_id_bk:s seller_zip_code_prefix:s seller_city:s seller_state:s",
    plan("dim_seller"),
    "SELECT * FROM dim_seller",
)
add(
    "dim_marketing_channel",
    "mql_channel_sk:i mql_id_bk:s origin:s landing_page_id:s business_segment:s lead_type:s lead_behaviour_profile:s "
    "business_type:s average_stock:s has_company:i has_gtin:i",
    plan("dim_marketing_channel"),
    "SELECT * FROM dim_channel",
)
add(
    "state_display_names",
    "customer_state:s state_name:s customers:i",
    lambda spark, folder: plan("dim_customer")(spark, folder)
    .groupBy("customer_state")
    .agg(F.count("*").alias("customers"))
    .withColumn("state_name", state_name("customer_state", vocab.STATE_NAMES)),
    "SELECT customer_state, count(*) AS customers, CASE customer_state "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.STATE_NAMES.items())
    + " END AS state_name FROM dim_customer GROUP BY 1",
)
add(
    "visible_months",
    "year_month:s year_month_sort:i days:i",
    lambda spark, folder: calendar.visible_days(plan("dim_date")(spark, folder))
    .groupBy("year_month", calendar.year_month_sort().alias("year_month_sort"))
    .agg(F.count("*").alias("days")),
    """SELECT year_month, year * 100 + month_num AS year_month_sort, count(*) AS days FROM dim_date
       WHERE date_key NOT IN (19000101, 99991231) GROUP BY 1, 2""",
)


def _second_load(spark, folder):
    """Sellers loaded twice: the second source lacks some, changes some and brings new ones."""
    sellers = loaded(spark, folder)["sellers"].withColumnRenamed("seller_id", "seller_id_bk")
    k = F.col("seller_id_bk").cast("long")
    first = upsert_scd1(
        None, sellers.where(k % 4 != 0), "seller_id_bk", "seller_sk", star.SELLER_ATTRS, F.lit("first load")
    )
    later = sellers.where(k % 5 != 1).withColumn(
        "seller_city", F.when(k % 3 == 0, F.concat("seller_city", F.lit(" NEW"))).otherwise(F.col("seller_city"))
    )
    return upsert_scd1(first, later, "seller_id_bk", "seller_sk", star.SELLER_ATTRS, F.lit("second load"))


add(
    "upsert_dim",
    "seller_sk:i seller_id_bk:s seller_zip_code_prefix:s seller_city:s seller_state:s load_timestamp:s",
    _second_load,
    """SELECT seller_id AS seller_id_bk, seller_zip_code_prefix, seller_state,
              CASE WHEN seller_id::INT % 5 <> 1 AND seller_id::INT % 3 = 0 THEN seller_city || ' NEW' ELSE seller_city END
                AS seller_city,
              CASE WHEN seller_id::INT % 4 <> 0
                   THEN row_number() OVER (PARTITION BY seller_id::INT % 4 <> 0 ORDER BY substr(md5(seller_id), 1, 3), seller_id)
                   ELSE (SELECT count(*) FROM s_sellers WHERE seller_id::INT % 4 <> 0)
                        + row_number() OVER (PARTITION BY seller_id::INT % 4 <> 0 ORDER BY substr(md5(seller_id), 1, 3), seller_id)
              END AS seller_sk,
              CASE WHEN seller_id::INT % 4 <> 0 AND (seller_id::INT % 5 = 1 OR seller_id::INT % 3 <> 0)
                   THEN 'first load' ELSE 'second load' END AS load_timestamp
       FROM s_sellers WHERE seller_id::INT % 4 <> 0 OR seller_id::INT % 5 <> 1""",
)

# --- facts ------------------------------------------------------------------

add(
    "fact_items",
    "purchase_date_key:i shipping_limit_date_key:i customer_sk:i product_sk:i seller_sk:i order_id_bk:s "
    "order_item_id_bk:i unit_price:n unit_freight_value:n line_total:n",
    plan("fact_order_items"),
    "SELECT * FROM f_items",
)
add(
    "fact_payments",
    "purchase_date_key:i customer_sk:i payment_type_sk:i order_id_bk:s payment_sequential_bk:i payment_value:n "
    "payment_installments:i",
    plan("fact_payments"),
    "SELECT * FROM f_payments",
)
add(
    "fact_reviews",
    "review_sk:i review_creation_date_key:i review_answer_date_key:i customer_sk:i review_id_bk:s order_id_bk:s "
    "review_score:i",
    plan("fact_reviews"),
    "SELECT * FROM f_reviews",
)
add(
    "review_comments",
    "review_sk:i review_comment_title:s review_comment_message:s",
    plan("review_comments"),
    "SELECT review_sk, title AS review_comment_title, message AS review_comment_message FROM f_reviews",
)
add(
    "fact_lifecycle",
    "purchase_date_key:i approval_date_key:i carrier_date_key:i delivery_date_key:i estimated_delivery_date_key:i "
    "customer_sk:i order_status_sk:i order_id_bk:s days_to_approve:n days_to_ship:n days_to_deliver:n "
    "days_purchase_to_delivery:n days_delivery_variance:n is_delivered_on_time:b total_items:i total_distinct_products:i "
    "total_distinct_sellers:i total_order_value:n total_freight_value:n total_payment_value:n",
    plan("fact_order_life_cycle"),
    "SELECT * FROM f_life",
)


def _versioned(spark, name):
    return VersionedTable(spark, f"{shared_folder(spark)}/tradewind/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")


def _after_changes(spark, folder):
    """The life cycle as it was known 60 days before the last purchase, refreshed with all that is known now."""
    tables = loaded(spark, folder)
    now = {name: tables[name] for name in snapshot.INPUTS}
    bought, delivered = F.col("order_purchase_date"), F.col("order_delivered_customer_date")
    known = bought != unknown_day()
    then = F.date_sub(now["orders"].agg(F.max(F.when(known, bought))).scalar(), 60)
    on_the_way = known & (delivered > then) & (delivered != unknown_day())
    orders = now["orders"].where(bought <= then)
    orders = orders.withColumns(
        {
            "order_status": F.when(on_the_way, "shipped").otherwise(F.col("order_status")),
            "order_delivered_customer_date": F.when(on_the_way, unknown_day()).otherwise(delivered),
        }
    )
    life = snapshot.LifeCycle(_versioned(spark, "life"))
    life.refresh(now | {"orders": orders}, tables["dim_order_status"])
    life.refresh(now, tables["dim_order_status"])
    return life.read()


add(
    "lifecycle_after_changes",
    "purchase_date_key:i approval_date_key:i carrier_date_key:i delivery_date_key:i estimated_delivery_date_key:i "
    "customer_sk:i order_status_sk:i order_id_bk:s days_to_approve:n days_to_ship:n days_to_deliver:n "
    "days_purchase_to_delivery:n days_delivery_variance:n is_delivered_on_time:b total_items:i total_distinct_products:i "
    "total_distinct_sellers:i total_order_value:n total_freight_value:n total_payment_value:n",
    _after_changes,
    "SELECT * FROM f_life",
)


def _streamed(spark, folder):
    """Customers as a stream of files, then the last batch delivered a second time with other rows."""
    path = f"{folder}/customer.parquet"
    columns = ["c_name", "c_mktsegment", "c_nationkey"]
    key = F.col("c_custkey").cast("string").alias("customer")
    schema = spark.read.parquet(path).schema
    # a pattern: a stream does not take the path of a single file
    stream = spark.readStream.schema(schema).parquet(f"{folder}/customer.parque?").select(key, *columns)
    table = _versioned(spark, "streamed")
    handle = batch_upsert(table, "customers", "customer", "customer_sk", columns, columns)
    upsert_available(stream, handle, f"{table.root}/progress")
    again = spark.read.schema(schema).parquet(path).select(key, F.upper("c_name").alias("c_name"), *columns[1:])
    handle(again, int(table.latest().token.split(":")[1]))
    return table.read()


add(
    "stream_upsert_dim",
    "customer_sk:i customer:s c_name:s c_mktsegment:s c_nationkey:i",
    _streamed,
    """SELECT row_number() OVER (ORDER BY substr(md5(c_custkey::VARCHAR), 1, 3), c_custkey::VARCHAR) AS customer_sk,
              c_custkey::VARCHAR AS customer, c_name, c_mktsegment, c_nationkey FROM customer""",
)
add(
    "fact_funnel",
    "closed_deal_sk:i first_contact_date_key:i won_date_key:i seller_sk:i mql_channel_sk:i mql_id_bk:s sdr_id_bk:s "
    "sr_id_bk:s days_to_close:n declared_monthly_revenue:n declared_product_catalog_size:n",
    plan("fact_marketing_funnel"),
    "SELECT * FROM f_funnel",
)
add(
    "date_role_counts",
    "role:s year_month:s orders:i",
    lambda spark, folder: _role_counts(loaded(spark, folder)),
    " UNION ALL ".join(
        f"SELECT '{r}' AS role, year_month, count(*) AS orders FROM f_life JOIN dim_date ON date_key = {r}_date_key GROUP BY 2"
        for r in ("purchase", "approval", "carrier", "delivery", "estimated_delivery")
    ),
)


def _role_counts(w):
    """Five roles of the date dimension over one fact."""
    from functools import reduce

    from tradewind.operators.lookup import date_role

    life = w["fact_order_life_cycle"]
    frames = []
    for role in ("purchase", "approval", "carrier", "delivery", "estimated_delivery"):
        days = date_role(w["dim_date"], role, ["year_month"])
        per_day = life.groupBy(f"{role}_date_key").agg(F.count("*").alias("n"))
        months = per_day.join(days, f"{role}_date_key").groupBy(F.col(f"{role}_year_month").alias("year_month"))
        frames.append(months.agg(F.sum("n").alias("orders")).withColumn("role", F.lit(role)))
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- flat table -------------------------------------------------------------

FLAT_SPEC = (
    "order_id:s purchase_date:s purchase_year:n purchase_month:n purchase_month_name:s purchase_day_of_week:s "
    "is_weekend_purchase:b order_status:s customer_unique_id:s customer_state:s customer_city:s days_to_approve:n "
    "days_to_ship:n days_to_deliver:n days_purchase_to_delivery:n days_delivery_variance:n is_delivered_on_time:b "
    "total_items:i total_distinct_products:i total_distinct_sellers:i total_order_value:n total_freight_value:n "
    "total_payment_value:n payment_type:s payment_installments:n product_category_name:s seller_id:s seller_state:s "
    "seller_city:s review_score:n marketing_origin:s days_to_close:n business_segment:s lead_type:s business_type:s"
)
add("obt", FLAT_SPEC, plan("order_table"), "SELECT * FROM flat")
add(
    "main_payment_type",
    "order_id_bk:s payment_type_sk:i payment_installments:i",
    lambda spark, folder: order_table.main_payment_type(loaded(spark, folder)["fact_payments"]),
    "SELECT * FROM main_pay",
)
add(
    "first_item",
    "order_id_bk:s product_sk:i seller_sk:i",
    lambda spark, folder: order_table.first_item(loaded(spark, folder)["fact_order_items"]),
    "SELECT * FROM first_line",
)
add(
    "latest_deal",
    "seller_sk:i mql_channel_sk:i days_to_close:n",
    lambda spark, folder: order_table.latest_deal(loaded(spark, folder)["fact_marketing_funnel"]),
    "SELECT * FROM last_deal",
)


def _written_back(spark, folder):
    """Order table with two score columns replaced by left join."""
    orders = loaded(spark, folder)["order_table"]
    table = orders.select("order_id", "seller_id", "order_status", F.lit(None).cast("double").alias("seller_score"))
    per_seller = orders.where("seller_id IS NOT NULL").groupBy("seller_id").agg(
        F.avg("review_score").alias("seller_score"), F.count("*").alias("seller_orders")
    )
    return write_back(table, per_seller.where("seller_orders > 2"), "seller_id")


add(
    "score_write_back",
    "order_id:s seller_id:s order_status:s seller_score:r seller_orders:n",
    _written_back,
    """SELECT f.order_id, f.seller_id, f.order_status, seller_score, seller_orders FROM flat f
       LEFT JOIN (SELECT seller_id, avg(review_score) AS seller_score, count(*) AS seller_orders FROM flat
                  WHERE seller_id IS NOT NULL GROUP BY 1 HAVING count(*) > 2) s USING (seller_id)""",
)


def _raw_frames(spark, folder):
    return {name: read(spark, folder) for name, read in binding.RAW.items()}
