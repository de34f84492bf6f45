"""The given tables in the role of the raw marketplace tables.

Every raw column is a projection of a given column; blanks, gaps, unreadable
dates and unseen labels are planted by arithmetic on keys so that each cleaning
rule has work to do.  Repeated (order, line) pairs and repeated users are those
of the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import vocab

STATE_CODES = list(vocab.STATE_NAMES)


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(index: Column, values: list[str | None]) -> Column:
    """Value at a 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _when(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    nation = given(spark, folder, "nation")
    return nation.select(
        "n_nationkey",
        F.lower("n_name").alias("city"),
        F.lower(_pick(F.col("n_nationkey"), STATE_CODES)).alias("state"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    c = given(spark, folder, "customer").join(_nations(spark, folder), F.expr("c_nationkey = n_nationkey"))
    k = F.col("c_custkey")
    return c.select(
        F.when(k % 10 == 0, F.concat(F.lit(" "), _text(k), F.lit(" "))).otherwise(_text(k)).alias("customer_id"),
        # two accounts per person
        F.concat(F.lit("P"), _text(F.floor(k / 2)), F.when(k % 7 == 0, F.lit(" ")).otherwise(F.lit(""))).alias(
            "customer_unique_id"
        ),
        _when(k % 97 != 0, k * 37 % 100000).alias("customer_zip_code_prefix"),
        F.col("city").alias("customer_city"),
        F.concat(F.col("state"), F.lit(" ")).alias("customer_state"),
        (F.lit("2024-01-01").cast("date") + (k % 3).cast("int")).cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    s = given(spark, folder, "supplier").join(_nations(spark, folder), F.expr("s_nationkey = n_nationkey"))
    k = F.col("s_suppkey")
    return s.select(
        _text(k).alias("seller_id"),
        (k * 53 % 100000).alias("seller_zip_code_prefix"),
        _when(k % 11 != 5, F.col("city")).alias("seller_city"),
        _when(k % 13 != 7, F.col("state")).alias("seller_state"),
        F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    p = given(spark, folder, "part")
    k = F.col("p_partkey")
    name_length = F.length("p_name").cast("double")
    return p.select(
        _text(k).alias("product_id"),
        F.when(k % 50 == 1, "")
        .when(k % 50 != 0, F.replace(F.lower("p_name"), F.lit(" "), F.lit("_")))
        .alias("product_category_name"),
        _when(k % 20 != 3, name_length + 0.5).alias("product_name_lenght"),
        (name_length * 10 + 0.75).alias("product_description_lenght"),
        _when(k % 30 != 4, (F.col("p_size") % 6).cast("double")).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        (F.col("p_size") + 0.5).alias("product_length_cm"),
        (F.col("p_size") / 2).alias("product_height_cm"),
        F.lit(None).cast("double").alias("product_width_cm"),
        F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def translation(spark: SparkSession, folder: str) -> DataFrame:
    """Names beginning with 'blue' stay untranslated."""
    p = given(spark, folder, "part").where(~F.col("p_name").startswith("blue"))
    snake = F.replace(F.lower("p_name"), F.lit(" "), F.lit("_"))
    return p.select(
        F.concat(F.lit(" "), snake).alias("product_category_name"),
        F.concat(snake, F.lit("__goods")).alias("product_category_name_english"),
        F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def _order_status() -> Column:
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    open_states = _pick(
        k % 10, [" CANCELED ", "unavailable", "created", "Shipped"] + ["delivered"] * 6
    )
    partial_states = _pick(
        k % 8, ["shipped", "approved", "invoiced", "processing", "canceled"] + ["delivered"] * 3
    )
    return F.when(s == "O", open_states).when(s == "P", partial_states).otherwise("delivered")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    o = given(spark, folder, "orders")
    k = F.col("o_orderkey")
    status = _order_status()
    label = F.lower(F.trim(status))

    def stamp(days: Column, clock: str) -> Column:
        day = F.date_add(F.col("o_orderdate").cast("date"), days.cast("int"))
        return F.concat(day.cast("string"), F.lit(clock))

    handed = k % 3 + k % 5
    arrived = handed + 1 + k * 7 % 17
    return o.select(
        _text(k).alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        _when(k % 211 != 5, stamp(F.lit(0), " 10:56:33")).alias("order_purchase_timestamp"),
        _when(k % 41 != 7, stamp(k % 3, " 08:00:00")).alias("order_approved_at"),
        F.when(~label.isin("delivered", "shipped"), F.lit(None))
        .when(k % 53 == 9, "unknown")
        .otherwise(stamp(handed, " 12:30:00"))
        .alias("order_delivered_carrier_date"),
        F.when(label != "delivered", F.lit(None))
        .when(k % 59 == 11, "n/a")
        .otherwise(stamp(arrived, " 18:45:10"))
        .alias("order_delivered_customer_date"),
        _when(k % 61 != 13, stamp(12 + k % 9, " 00:00:00")).alias("order_estimated_delivery_date"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def _freight() -> Column:
    return F.col("l_quantity") * 0.25


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    li = given(spark, folder, "lineitem")
    return li.select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _when(F.col("l_partkey") % 101 != 3, _text("l_partkey")).alias("product_id"),
        _when(F.col("l_orderkey") % 97 != 1, F.concat(_text("l_suppkey"), F.lit(" "))).alias("seller_id"),
        F.when(F.col("l_orderkey") % 89 == 2, "soon")
        .otherwise(_text(F.col("l_shipdate").cast("date")))
        .alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        _when(F.col("l_quantity") != 50, _freight()).alias("freight_value"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    li = given(spark, folder, "lineitem")
    kinds = ["credit_card", " BOLETO ", "voucher", "debit_card", "not_defined", None, "pix"]
    return li.select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _pick((F.col("l_orderkey") + F.col("l_linenumber")) % 7, kinds).alias("payment_type"),
        (F.col("l_quantity") % 11 + 0.5).alias("payment_installments"),
        (F.col("l_extendedprice") + _freight()).alias("payment_value"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Several reviews per order: one per line."""
    li = given(spark, folder, "lineitem")
    ship = F.col("l_shipdate").cast("date")
    q = F.col("l_quantity").cast("int")
    answered = F.date_add(ship, (F.col("l_suppkey") % 7).cast("int"))
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        _text("l_orderkey").alias("order_id"),
        (F.lit(1.0) + (F.col("l_partkey") + F.col("l_linenumber")) % 5).alias("review_score"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None))
        .when(F.col("l_linenumber") % 3 == 1, " no title")
        .otherwise(F.concat(F.lit("Rated "), F.col("l_returnflag")))
        .alias("review_comment_title"),
        F.when(q < 25, F.lit(None))
        .when(q < 30, "No message")
        .otherwise(F.concat(F.lit("Bought "), _text(q), F.lit(" pieces ")))
        .alias("review_comment_message"),
        _text(ship).alias("review_creation_date"),
        F.when(q % 10 == 3, F.lit(None))
        .when(q % 10 == 4, "pending")
        .otherwise(F.concat(answered.cast("string"), F.lit(" 21:46:59")))
        .alias("review_answer_timestamp"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
        F.lit("postgres").alias("_source"),
    )


def _events(spark: SparkSession, folder: str, kinds: list[str]) -> DataFrame:
    """Events, moved from January 2024 to the last summer of the orders."""
    ev = given(spark, folder, "events").where(F.col("event_type").isin(kinds))
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    return ev.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.add_months(F.col("ts").cast("date"), (-269 - F.col("user_id") % 3).cast("int")).alias("day"),
        F.concat(F.lit("m"), _text("user_id"), F.lit("-"), _text(week)).alias("mql_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def marketing_qualified_leads(spark: SparkSession, folder: str) -> DataFrame:
    """A user's signups, views, clicks and errors of one week are one lead."""
    ev = _events(spark, folder, ["signup", "view", "click", "error"])
    origins = [
        "organic_search",
        "paid_search",
        "Social ",
        "email",
        "referral",
        "display",
        "direct_traffic",
        "other_publicities",
        None,
    ]
    return ev.select(
        "mql_id",
        _when(F.col("event_id") % 83 != 1, _text("day")).alias("first_contact_date"),
        _when(F.col("event_id") % 17 != 3, F.concat(F.lit("page "), "event_type")).alias("landing_page_id"),
        _pick(F.col("k") % 9, origins).alias("origin"),
        F.col("ts").alias("_ingested_at"),
        F.lit("files").alias("_source"),
        F.lit("f1").alias("_drive_file_id"),
    )


def closed_deals(spark: SparkSession, folder: str) -> DataFrame:
    """A user's purchases of one week are one deal."""
    ev = _events(spark, folder, ["purchase"])
    k = F.col("k")
    return ev.select(
        "mql_id",
        _text("user_id").alias("seller_id"),
        _when(F.col("event_id") % 29 != 2, F.concat(F.lit("sdr"), _text(F.col("event_id") % 7))).alias("sdr_id"),
        _when(F.col("event_id") % 31 != 2, F.concat(F.lit("sr"), _text(F.col("event_id") % 5))).alias("sr_id"),
        F.when(F.col("event_id") % 37 == 4, "later")
        .otherwise(F.concat(F.date_add("day", k % 20).cast("string"), F.lit(" 09:00:00")))
        .alias("won_date"),
        _pick(k % 5, ["home_decor", "health_beauty", "audio_video__electronics", "", None]).alias("business_segment"),
        _pick(k % 6, ["online_big", "online_medium", "Online_Small", "industry", "offline", None]).alias("lead_type"),
        _pick(k % 5, ["cat", "eagle", " wolf", "shark", "cat, wolf"]).alias("lead_behaviour_profile"),
        _pick(k % 3, ["1", "0", None]).cast("double").alias("has_company"),
        _pick(k % 4, ["0", "1", None, "1"]).cast("double").alias("has_gtin"),
        _when(k % 4 != 1, F.lit("5-20 ")).alias("average_stock"),
        _pick(k % 4, ["reseller", "manufacturer", "others", None]).alias("business_type"),
        _when(k % 6 != 5, F.col("value")).alias("declared_product_catalog_size"),
        (F.col("value") * 100).alias("declared_monthly_revenue"),
        F.col("ts").alias("_ingested_at"),
        F.lit("files").alias("_source"),
        F.lit("f2").alias("_drive_file_id"),
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    """Every place (postcode, city, state) of customers and sellers, with coordinates by arithmetic."""
    places = customers(spark, folder).select(
        F.col("customer_zip_code_prefix").cast("long").alias("z"),
        F.col("customer_city").alias("c"),
        F.trim("customer_state").alias("s"),
    )
    shops = sellers(spark, folder).select(F.col("seller_zip_code_prefix").cast("long"), "seller_city", "seller_state")
    z = F.col("z")
    return places.union(shops).where(z.isNotNull()).distinct().select(
        z.alias("geolocation_zip_code_prefix"),
        (z % 180 / 2 - 45).alias("geolocation_lat"),
        (z % 360 / 2 - 90).alias("geolocation_lng"),
        F.col("c").alias("geolocation_city"),
        F.col("s").alias("geolocation_state"),
        F.lit("2024-01-01").cast("timestamp").alias("_ingested_at"),
        F.lit("http").alias("_source"),
    )


RAW = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "sellers": sellers,
    "products": products,
    "product_category_name_translation": translation,
    "marketing_qualified_leads": marketing_qualified_leads,
    "closed_deals": closed_deals,
    "geolocation": geolocation,
}
