"""Business measures in several contexts, beside plain SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import add
from checks.tables import loaded
from tradewind.functions import vocab
from tradewind.plans import measures as M
from tradewind.plans.context import Context, Star
from tradewind.plans.evaluate import evaluate, shift_compare

DAY = dt.date(2001, 7, 20)


def figures(names, **options):
    names = names.split()
    return lambda spark, folder: evaluate(Star(loaded(spark, folder)), names, **options)


def as_rows(frame, names):
    """One wide row to (measure, value) rows."""
    pairs = [F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias("value")) for n in names]
    return frame.select(F.inline(F.array(*pairs)))


MI = """
    SELECT f.*, dc.customer_state, dp.product_category_name, ds.seller_state, dd.year, dd.year_month, dd.is_weekend
    FROM f_items f LEFT JOIN dim_customer dc USING (customer_sk) LEFT JOIN dim_product dp USING (product_sk)
    LEFT JOIN dim_seller ds USING (seller_sk)
    LEFT JOIN dim_date dd ON dd.date_key = f.purchase_date_key AND dd.date_key NOT IN (19000101, 99991231)
"""
ML = """
    SELECT f.*, dc.customer_state FROM f_life f LEFT JOIN dim_customer dc USING (customer_sk)
"""
MP = """
    SELECT f.*, t.payment_type FROM f_payments f LEFT JOIN dim_pay t USING (payment_type_sk)
"""
BLK = {"mi": MI, "ml": ML, "mp": MP}

# --- items ------------------------------------------------------------------

add(
    "item_measures",
    "total_revenue:n total_freight:n total_order_items:i total_orders:i total_customers:i active_sellers:i aov:r "
    "revenue_per_customer:r max_order_value:n repeat_customers:i repeat_rate:r avg_orders_per_customer:r "
    "revenue_per_seller:r top_seller_revenue:n cohort_size:i returning_customers:i retention_rate:r",
    figures(
        "total_revenue total_freight total_order_items total_orders total_customers active_sellers aov "
        "revenue_per_customer max_order_value repeat_customers repeat_rate avg_orders_per_customer revenue_per_seller "
        "top_seller_revenue cohort_size returning_customers retention_rate"
    ),
    """SELECT sum(line_total) AS total_revenue, sum(unit_freight_value) AS total_freight, count(*) AS total_order_items,
              count(DISTINCT order_id_bk) AS total_orders, count(DISTINCT customer_sk) AS total_customers,
              count(DISTINCT seller_sk) AS active_sellers, sum(line_total)::DOUBLE / count(DISTINCT order_id_bk) AS aov,
              sum(line_total)::DOUBLE / count(DISTINCT customer_sk) AS revenue_per_customer,
              (SELECT max(v) FROM (SELECT sum(line_total) AS v FROM f_items GROUP BY order_id_bk)) AS max_order_value,
              (SELECT count(*) FROM (SELECT 1 FROM f_items GROUP BY customer_sk HAVING count(DISTINCT order_id_bk) > 1))
                AS repeat_customers,
              (SELECT count(*) FROM (SELECT 1 FROM f_items GROUP BY customer_sk HAVING count(DISTINCT order_id_bk) > 1))
                / count(DISTINCT customer_sk) AS repeat_rate,
              count(DISTINCT order_id_bk)::DOUBLE / count(DISTINCT customer_sk) AS avg_orders_per_customer,
              sum(line_total)::DOUBLE / count(DISTINCT seller_sk) AS revenue_per_seller,
              (SELECT max(v) FROM (SELECT sum(line_total) AS v FROM f_items GROUP BY seller_sk)) AS top_seller_revenue,
              count(DISTINCT customer_sk) AS cohort_size,
              (SELECT count(*) FROM (SELECT 1 FROM f_items GROUP BY customer_sk HAVING count(DISTINCT order_id_bk) > 1))
                AS returning_customers,
              (SELECT count(*) FROM (SELECT 1 FROM f_items GROUP BY customer_sk HAVING count(DISTINCT order_id_bk) > 1))
                / count(DISTINCT customer_sk) AS retention_rate
       FROM f_items""",
)
add(
    "max_order_value",
    "year:i max_order_value:n total_revenue:n",
    figures("max_order_value total_revenue", by=["year"]),
    """SELECT year, max(v) AS max_order_value, sum(v) AS total_revenue
       FROM (SELECT year, order_id_bk, sum(line_total) AS v FROM mi WHERE year IS NOT NULL GROUP BY 1, 2) GROUP BY 1""",
    **BLK,
)
add(
    "repeat_customers",
    "year_month:s repeat_customers:n total_customers:i repeat_rate:r",
    figures("repeat_customers total_customers repeat_rate", by=["year_month"]),
    """SELECT year_month, nullif(count(*) FILTER (n > 1), 0) AS repeat_customers, count(*) AS total_customers,
              nullif(count(*) FILTER (n > 1), 0) / count(*) AS repeat_rate
       FROM (SELECT year_month, customer_sk, count(DISTINCT order_id_bk) AS n FROM mi WHERE year_month IS NOT NULL GROUP BY 1, 2)
       GROUP BY 1""",
    **BLK,
)
add(
    "share_of_total",
    "product_category_name:s total_revenue:n category_revenue_pct:r category_rank:i",
    figures("total_revenue category_revenue_pct category_rank", by=["product_category_name"]),
    """SELECT product_category_name, sum(line_total) AS total_revenue,
              sum(line_total)::DOUBLE / (SELECT sum(line_total) FROM f_items)::DOUBLE AS category_revenue_pct,
              dense_rank() OVER (ORDER BY sum(line_total) DESC) AS category_rank FROM mi GROUP BY 1""",
    **BLK,
)
add(
    "dense_rank_categories",
    "year:i product_category_name:s category_rank:i category_revenue_pct:r",
    figures("category_rank category_revenue_pct", by=["year", "product_category_name"]),
    """SELECT year, product_category_name, dense_rank() OVER (PARTITION BY year ORDER BY sum(line_total) DESC) AS category_rank,
              sum(line_total)::DOUBLE / (sum(sum(line_total)) OVER (PARTITION BY year))::DOUBLE AS category_revenue_pct
       FROM mi WHERE year IS NOT NULL GROUP BY 1, 2""",
    **BLK,
)
add(
    "state_standing",
    "customer_state:s total_revenue:n state_revenue_pct:r state_revenue_rank:i customer_density_pct:r sp_revenue_share:r",
    figures("total_revenue state_revenue_pct state_revenue_rank customer_density_pct sp_revenue_share", by=["customer_state"]),
    """SELECT customer_state, sum(line_total) AS total_revenue,
              sum(line_total)::DOUBLE / (SELECT sum(line_total) FROM f_items)::DOUBLE AS state_revenue_pct,
              dense_rank() OVER (ORDER BY sum(line_total) DESC) AS state_revenue_rank,
              count(DISTINCT customer_sk)::DOUBLE / (SELECT count(DISTINCT customer_sk) FROM f_items) AS customer_density_pct,
              (SELECT sum(line_total) FILTER (customer_state = 'SP')::DOUBLE / sum(line_total)::DOUBLE FROM mi) AS sp_revenue_share
       FROM mi GROUP BY 1""",
    **BLK,
)
add(
    "pareto_sellers",
    "seller_sk:i total_revenue:n seller_rank:i cumulative_seller_revenue_pct:r seller_revenue:n seller_order_count:i",
    figures(
        "total_revenue seller_rank cumulative_seller_revenue_pct seller_revenue seller_order_count", by=["seller_sk"]
    ),
    """SELECT seller_sk, total_revenue, dense_rank() OVER (ORDER BY total_revenue DESC) AS seller_rank,
              (sum(total_revenue) OVER (ORDER BY total_revenue DESC RANGE UNBOUNDED PRECEDING))::DOUBLE
                / (sum(total_revenue) OVER ())::DOUBLE AS cumulative_seller_revenue_pct,
              total_revenue AS seller_revenue, seller_order_count
       FROM (SELECT seller_sk, sum(line_total) AS total_revenue, count(DISTINCT order_id_bk) AS seller_order_count
             FROM f_items GROUP BY 1)""",
)
add(
    "argmax_category",
    "year:i top_category:s top_category_revenue:n top_category_share:r top_revenue_state:s categories_above_5pct_gmv:n",
    figures(
        "top_category top_category_revenue top_category_share top_revenue_state categories_above_5pct_gmv", by=["year"]
    ),
    """SELECT year, arg_max(product_category_name, (v, -r)) AS top_category, max(v) AS top_category_revenue,
              max(v)::DOUBLE / sum(v)::DOUBLE AS top_category_share,
              nullif(count(*) FILTER (v::DOUBLE / t > 0.05), 0) AS categories_above_5pct_gmv, any_value(s) AS top_revenue_state
       FROM (SELECT c.*, row_number() OVER (PARTITION BY year ORDER BY product_category_name) AS r,
                    (sum(v) OVER (PARTITION BY year))::DOUBLE AS t
             FROM (SELECT year, product_category_name, sum(line_total) AS v FROM mi WHERE year IS NOT NULL GROUP BY 1, 2) c)
       JOIN (SELECT year, customer_state AS s FROM mi WHERE year IS NOT NULL GROUP BY 1, 2
             QUALIFY row_number() OVER (PARTITION BY year ORDER BY sum(line_total) DESC, customer_state) = 1) USING (year)
       GROUP BY 1""",
    **BLK,
)
add(
    "peak_weak_month",
    "customer_state:s peak_month_revenue:n weakest_month_revenue:n",
    figures("peak_month_revenue weakest_month_revenue", by=["customer_state"]),
    """SELECT customer_state, max(v) AS peak_month_revenue, min(v) AS weakest_month_revenue
       FROM (SELECT customer_state, year_month, sum(line_total) AS v FROM mi WHERE year IS NOT NULL GROUP BY 1, 2) GROUP BY 1""",
    **BLK,
)
add(
    "reactivation_window",
    "customer_state:s reactivation_window:r",
    figures("reactivation_window", by=["customer_state"]),
    """SELECT customer_state, avg(CASE WHEN n >= 2 THEN date_diff('day', lo, hi) END) AS reactivation_window
       FROM (SELECT customer_state, customer_sk, count(DISTINCT order_id_bk) AS n, min(day) AS lo, max(day) AS hi
             FROM mi GROUP BY 1, 2) GROUP BY 1""",
    **BLK,
)
add(
    "weekend_share",
    "year:i weekend_order_share:r",
    figures("weekend_order_share", by=["year"]),
    """SELECT year, count(DISTINCT order_id_bk) FILTER (is_weekend)::DOUBLE / count(DISTINCT order_id_bk) AS weekend_order_share
       FROM mi WHERE year IS NOT NULL GROUP BY 1""",
    **BLK,
)
add(
    "holiday_lift",
    "holiday_revenue:n non_holiday_revenue:n holiday_revenue_per_day:r non_holiday_revenue_per_day:r holiday_lift_pct:r",
    figures("holiday_revenue non_holiday_revenue holiday_revenue_per_day non_holiday_revenue_per_day holiday_lift_pct"),
    """SELECT NULL AS holiday_revenue, sum(line_total) AS non_holiday_revenue, NULL AS holiday_revenue_per_day,
              sum(line_total)::DOUBLE / (SELECT count(*) - 2 FROM dim_date) AS non_holiday_revenue_per_day,
              -1 AS holiday_lift_pct FROM mi WHERE year IS NOT NULL""",
    **BLK,
)
_BUYERS = """
    SELECT year, customer_sk, n, v, sum(n) OVER (PARTITION BY customer_sk) AS ever
    FROM (SELECT year, customer_sk, count(DISTINCT order_id_bk) AS n, sum(line_total) AS v FROM mi GROUP BY 1, 2)
"""
add(
    "new_vs_repeat_revenue",
    "year:i new_customers:n new_customer_revenue:n repeat_customer_revenue:n",
    figures("new_customers new_customer_revenue repeat_customer_revenue", by=["year"]),
    """SELECT year, nullif(count(*) FILTER (ever = 1), 0) AS new_customers, sum(v) FILTER (ever = 1) AS new_customer_revenue,
              sum(v) FILTER (ever > 1) AS repeat_customer_revenue FROM buyer WHERE year IS NOT NULL GROUP BY 1""",
    **BLK,
    buyer=_BUYERS,
)
add(
    "order_count_bands",
    "product_category_name:s new_customers:n customers_2_3_orders:n customers_4_plus_orders:n",
    figures("new_customers customers_2_3_orders customers_4_plus_orders", by=["product_category_name"]),
    """SELECT product_category_name, nullif(count(*) FILTER (n = 1), 0) AS new_customers,
              nullif(count(*) FILTER (n BETWEEN 2 AND 3), 0) AS customers_2_3_orders,
              nullif(count(*) FILTER (n >= 4), 0) AS customers_4_plus_orders
       FROM (SELECT product_category_name, customer_sk, count(DISTINCT order_id_bk) AS n FROM mi GROUP BY 1, 2) GROUP BY 1""",
    **BLK,
)
add(
    "filtered_measures",
    "seller_state:s total_revenue:n total_orders:i category_revenue_pct:r",
    figures(
        "total_revenue total_orders category_revenue_pct",
        by=["seller_state"],
        where={"year": [1998, 1999], "product_category_name": ["Red Bolt Goods", "Not Specified", "Small Ring Goods"]},
    ),
    """SELECT seller_state, sum(line_total) FILTER (inside) AS total_revenue,
              count(DISTINCT order_id_bk) FILTER (inside) AS total_orders,
              sum(line_total) FILTER (inside)::DOUBLE / sum(line_total)::DOUBLE AS category_revenue_pct
       FROM (SELECT *, product_category_name IN ('Red Bolt Goods', 'Not Specified', 'Small Ring Goods') AS inside FROM mi
             WHERE year IN (1998, 1999)) GROUP BY 1 HAVING count(*) FILTER (inside) > 0""",
    **BLK,
)

# --- dimensions -------------------------------------------------------------

add(
    "dimension_measures",
    "avg_photos_per_product:r avg_description_length:r product_category_count:i states_active:i active_channels:i "
    "has_company_pct:r min_date:s delivery_target:i forecast_periods:i",
    figures(
        "avg_photos_per_product avg_description_length product_category_count states_active active_channels "
        "has_company_pct min_date delivery_target forecast_periods"
    ),
    """SELECT (SELECT avg(product_photos_qty) FROM dim_product) AS avg_photos_per_product,
              (SELECT avg(product_description_length) FROM dim_product) AS avg_description_length,
              (SELECT count(DISTINCT product_category_name) FROM dim_product) AS product_category_count,
              (SELECT count(DISTINCT customer_state) FROM dim_customer) AS states_active,
              (SELECT count(DISTINCT origin) FROM dim_channel) AS active_channels,
              (SELECT avg((has_company = 1)::INT) FROM dim_channel) AS has_company_pct,
              (SELECT min(full_date) FROM dim_date WHERE date_key <> 19000101) AS min_date, 12 AS delivery_target,
              3 AS forecast_periods""",
)

# --- life cycle -------------------------------------------------------------

add(
    "status_funnel",
    "year:i delivered_orders:n approved_orders:n approved:n shipped_orders:n cancelled_orders:n unavailable_orders:n "
    "cancellation_rate:r fulfillment_rate:r",
    figures(
        "delivered_orders approved_orders approved shipped_orders cancelled_orders unavailable_orders cancellation_rate "
        "fulfillment_rate",
        by=["year"],
    ),
    """SELECT coalesce(a.year, b.year) AS year, d AS delivered_orders, p AS approved_orders, p AS approved, s AS shipped_orders,
              c AS cancelled_orders, u AS unavailable_orders, c::DOUBLE / n AS cancellation_rate, d::DOUBLE / n AS fulfillment_rate
       FROM (SELECT year(approval_day) AS year, nullif(count(*) FILTER (order_status = 'delivered'), 0) AS d,
                    nullif(count(*) FILTER (order_status IN ('approved','processing','shipped','delivered','invoiced')), 0) AS p,
                    nullif(count(*) FILTER (order_status IN ('shipped','delivered')), 0) AS s,
                    nullif(count(*) FILTER (order_status = 'canceled'), 0) AS c,
                    nullif(count(*) FILTER (order_status = 'unavailable'), 0) AS u
             FROM ml WHERE year(approval_day) BETWEEN 1995 AND 2001 GROUP BY 1) a
       FULL JOIN (SELECT year, count(DISTINCT order_id_bk) AS n FROM mi WHERE year IS NOT NULL GROUP BY 1) b USING (year)""",
    **BLK,
)
add(
    "on_time_pct",
    "customer_state:s on_time_delivery_pct:r strict_on_time_delivery_pct:r avg_delivery_days:r avg_days_to_approve:r "
    "avg_days_to_ship:r avg_days_carrier_to_delivery:r delivery_variance:r",
    figures(
        "on_time_delivery_pct strict_on_time_delivery_pct avg_delivery_days avg_days_to_approve avg_days_to_ship "
        "avg_days_carrier_to_delivery delivery_variance",
        by=["customer_state"],
    ),
    """SELECT customer_state, avg((coalesce(days_delivery_variance, 0) <= 0)::INT) AS on_time_delivery_pct,
              avg((days_delivery_variance <= 0)::INT) AS strict_on_time_delivery_pct,
              avg(days_purchase_to_delivery) AS avg_delivery_days, avg(days_to_approve) AS avg_days_to_approve,
              avg(days_to_ship) AS avg_days_to_ship, avg(days_to_deliver) AS avg_days_carrier_to_delivery,
              avg(days_purchase_to_delivery) - 12 AS delivery_variance FROM ml GROUP BY 1""",
    **BLK,
)
add(
    "north_region_delivery",
    "order_status:s north_region_delivery:r avg_delivery_days:r",
    figures("north_region_delivery avg_delivery_days", by=["order_status"]),
    """SELECT order_status, avg(days_purchase_to_delivery) FILTER (customer_state IN ('AM','PA','AC','RO','RR','AP','TO'))
              AS north_region_delivery, avg(days_purchase_to_delivery) AS avg_delivery_days FROM ml GROUP BY 1""",
    **BLK,
)

# --- reviews ----------------------------------------------------------------

add(
    "review_measures",
    "year_month:s total_reviews:i avg_review_score:r one_star_rate:r five_star_rate:r reviews_with_comments:r "
    "review_score_pct:r score_vs_target:r",
    lambda s, f: evaluate(
        Star(loaded(s, f)),
        "total_reviews avg_review_score 1_star_rate 5_star_rate reviews_with_comments review_score_pct score_vs_target".split(),
        by=["year_month"],
    )
    .withColumnRenamed("1_star_rate", "one_star_rate")
    .withColumnRenamed("5_star_rate", "five_star_rate"),
    """SELECT strftime(day, '%Y-%m') AS year_month, count(*) AS total_reviews, avg(review_score) AS avg_review_score,
              nullif(count(*) FILTER (review_score = 1), 0) / count(*) AS one_star_rate,
              nullif(count(*) FILTER (review_score = 5), 0) / count(*) AS five_star_rate,
              nullif(count(message), 0) / count(*) AS reviews_with_comments, avg(review_score) / 5 AS review_score_pct,
              avg(review_score) - 4 AS score_vs_target
       FROM f_reviews WHERE day BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' GROUP BY 1""",
)
add(
    "category_avg_score",
    "product_category_name:s category_avg_score:r",
    figures("category_avg_score", by=["product_category_name"]),
    """SELECT product_category_name, avg(review_score) AS category_avg_score
       FROM (SELECT DISTINCT order_id_bk, product_category_name FROM mi) JOIN f_reviews USING (order_id_bk) GROUP BY 1""",
    **BLK,
)
add(
    "seller_avg_score",
    "seller_sk:i seller_avg_score:r",
    figures("seller_avg_score", by=["seller_sk"]),
    """SELECT seller_sk, avg(review_score) AS seller_avg_score
       FROM (SELECT DISTINCT order_id_bk, seller_sk FROM mi) JOIN f_reviews USING (order_id_bk) GROUP BY 1""",
    **BLK,
)
add(
    "late_vs_ontime_score",
    "year:i late_avg_score:r ontime_avg_score:r",
    figures("late_avg_score ontime_avg_score", by=["year"]),
    """SELECT year(r.day) AS year, avg(review_score) FILTER (days_delivery_variance > 0) AS late_avg_score,
              avg(review_score) FILTER (coalesce(days_delivery_variance, 0) <= 0) AS ontime_avg_score
       FROM f_reviews r JOIN f_life o USING (order_id_bk) WHERE year(r.day) BETWEEN 1995 AND 2001 GROUP BY 1""",
)

# --- payments ---------------------------------------------------------------

add(
    "payment_measures",
    "payment_type:s total_payment_value:n payment_transactions:i avg_payment_value:r avg_value_by_payment_type:r "
    "avg_installments:r max_installments_used:i orders_using_installments_pct:r revenue_by_payment_type:n",
    figures(
        "total_payment_value payment_transactions avg_payment_value avg_value_by_payment_type avg_installments "
        "max_installments_used orders_using_installments_pct revenue_by_payment_type",
        by=["payment_type"],
    ),
    """SELECT * FROM (SELECT payment_type, sum(payment_value) AS total_payment_value, count(*) AS payment_transactions,
              sum(payment_value)::DOUBLE / count(*) AS avg_payment_value,
              sum(payment_value)::DOUBLE / count(*) AS avg_value_by_payment_type,
              avg(payment_installments) AS avg_installments, max(payment_installments) AS max_installments_used,
              nullif(count(DISTINCT order_id_bk) FILTER (payment_installments > 1), 0) / count(DISTINCT order_id_bk)
                AS orders_using_installments_pct FROM mp GROUP BY 1)
       JOIN (SELECT payment_type, sum(v) AS revenue_by_payment_type
             FROM (SELECT DISTINCT order_id_bk, payment_type FROM mp)
             JOIN (SELECT order_id_bk, sum(line_total) AS v FROM f_items GROUP BY 1) USING (order_id_bk) GROUP BY 1)
         USING (payment_type)""",
    **BLK,
)
add(
    "installment_orders",
    "payment_installments:i order_count_by_installments:i",
    figures("order_count_by_installments", by=["payment_installments"]),
    "SELECT payment_installments, count(DISTINCT order_id_bk) AS order_count_by_installments FROM f_payments GROUP BY 1",
)
add(
    "semi_join_revenue_by_payment",
    "year:i payment_type:s revenue_by_payment_type:n",
    figures("revenue_by_payment_type", by=["year", "payment_type"]),
    """SELECT year, payment_type, sum(line_total) AS revenue_by_payment_type
       FROM (SELECT DISTINCT order_id_bk, payment_type FROM mp) JOIN mi USING (order_id_bk) WHERE year IS NOT NULL GROUP BY 1, 2""",
    **BLK,
)
add(
    "payment_success",
    "year:i payment_success_pct:r credit_card_pct:r boleto_pct:r",
    figures("payment_success_pct credit_card_pct boleto_pct", by=["year"]),
    """SELECT year, p::DOUBLE / n AS payment_success_pct, c / t AS credit_card_pct, b / t AS boleto_pct
       FROM (SELECT year(day) AS year, count(DISTINCT order_id_bk) AS p, count(*) AS t,
                    nullif(count(*) FILTER (payment_type = 'Credit Card'), 0) AS c,
                    nullif(count(*) FILTER (payment_type = 'Boleto'), 0) AS b
             FROM mp WHERE year(day) BETWEEN 1995 AND 2001 GROUP BY 1)
       JOIN (SELECT year, count(DISTINCT order_id_bk) AS n FROM mi WHERE year IS NOT NULL GROUP BY 1) USING (year)""",
    **BLK,
)

# --- marketing --------------------------------------------------------------

add(
    "funnel_measures",
    "origin:s total_mqls:i total_deals:i mql_conversion_rate:r avg_days_to_close:r avg_declared_monthly_revenue:r",
    figures(
        "total_mqls total_deals mql_conversion_rate avg_days_to_close avg_declared_monthly_revenue", by=["origin"]
    ),
    """SELECT origin, count(DISTINCT f.mql_id_bk) AS total_mqls, count(DISTINCT closed_deal_sk) AS total_deals,
              1 AS mql_conversion_rate, avg(days_to_close) AS avg_days_to_close,
              sum(declared_monthly_revenue)::DOUBLE / count(*) AS avg_declared_monthly_revenue
       FROM f_funnel f LEFT JOIN dim_channel c USING (mql_channel_sk) GROUP BY 1""",
)
add(
    "best_channel",
    "best_channel:s total_deals:i lead_conversion_rate:r",
    figures("best_channel total_deals lead_conversion_rate"),
    """SELECT (SELECT origin FROM f_funnel JOIN dim_channel USING (mql_channel_sk) GROUP BY 1 ORDER BY count(*) DESC, origin LIMIT 1)
                AS best_channel, count(*) AS total_deals,
              count(*)::DOUBLE / (SELECT count(*) FROM dim_channel) AS lead_conversion_rate FROM f_funnel""",
)
add(
    "sdr_measures",
    "sdr_id_bk:s origin:s total_deals:i deals_per_sdr:i revenue_per_sdr:n",
    figures("total_deals deals_per_sdr revenue_per_sdr", by=["sdr_id_bk", "origin"], where={"lead_type": ["Online Big", "Industry"]}),
    """SELECT * FROM (SELECT f.sdr_id_bk, origin, count(*) AS total_deals FROM f_funnel f JOIN dim_channel c USING (mql_channel_sk)
              WHERE lead_type IN ('Online Big', 'Industry') GROUP BY 1, 2) a
       JOIN (SELECT coalesce(sdr_id_bk, '?') AS k, count(*) AS deals_per_sdr, sum(declared_monthly_revenue) AS revenue_per_sdr
             FROM f_funnel GROUP BY 1) b ON coalesce(a.sdr_id_bk, '?') = b.k""",
)

add(
    "funnel_by_profile",
    "business_type:s lead_behaviour_profile:s sr_id_bk:s total_deals:i",
    figures("total_deals", by=["business_type", "lead_behaviour_profile", "sr_id_bk"]),
    """SELECT business_type, lead_behaviour_profile, f.sr_id_bk, count(*) AS total_deals
       FROM f_funnel f LEFT JOIN dim_channel c USING (mql_channel_sk) GROUP BY 1, 2, 3""",
)
_NAMED_DAY = """
    SELECT f.*, dd.month_name, dd.day_of_week_name, dd.week_of_year FROM f_items f
    JOIN dim_date dd ON dd.date_key = f.purchase_date_key AND dd.date_key NOT IN (19000101, 99991231)
"""
add(
    "revenue_by_month_name",
    "month_name:s total_revenue:n total_orders:i",
    figures("total_revenue total_orders", by=["month_name"]),
    "SELECT month_name, sum(line_total) AS total_revenue, count(DISTINCT order_id_bk) AS total_orders FROM named_day GROUP BY 1",
    named_day=_NAMED_DAY,
)
add(
    "weekday_revenue_in_weeks",
    "day_of_week_name:s total_revenue:n",
    figures("total_revenue", by=["day_of_week_name"], where={"week_of_year": [1, 2, 30]}),
    "SELECT day_of_week_name, sum(line_total) AS total_revenue FROM named_day WHERE week_of_year IN (1, 2, 30) GROUP BY 1",
    named_day=_NAMED_DAY,
)
add(
    "channel_measures",
    "sdr_id_bk:s active_channels:i leads:i has_company_pct:r",
    figures("active_channels leads has_company_pct", by=["sdr_id_bk"], where={"lead_type": ["Online Big", "Industry", "Offline"]}),
    """SELECT sdr_id_bk, count(DISTINCT origin) AS active_channels, count(*) AS leads,
              nullif(count(*) FILTER (has_company = 1), 0) / count(*) AS has_company_pct
       FROM f_funnel JOIN dim_channel USING (mql_channel_sk) WHERE lead_type IN ('Online Big', 'Industry', 'Offline') GROUP BY 1""",
)

# --- time -------------------------------------------------------------------

ANCHOR = "SELECT max(day) AS a FROM f_items"
FIXED = "SELECT DATE '2001-07-20' AS a"
WIN = """
    SELECT 'month' AS grain, 'curr' AS w, date_trunc('month', a)::DATE AS lo, a AS hi FROM anchor
    UNION ALL SELECT 'month', 'prior', (date_trunc('month', a) - INTERVAL 1 MONTH)::DATE, (a - INTERVAL 1 MONTH)::DATE FROM anchor
    UNION ALL SELECT 'quarter', 'curr', date_trunc('quarter', a)::DATE, a FROM anchor
    UNION ALL SELECT 'quarter', 'prior', (date_trunc('quarter', a) - INTERVAL 3 MONTH)::DATE, (a - INTERVAL 3 MONTH)::DATE FROM anchor
    UNION ALL SELECT 'year', 'curr', date_trunc('year', a)::DATE, a FROM anchor
    UNION ALL SELECT 'year', 'prior', (date_trunc('year', a) - INTERVAL 1 YEAR)::DATE, (a - INTERVAL 1 YEAR)::DATE FROM anchor
"""
WI = """
    SELECT grain, w, sum(line_total) AS total_revenue, count(DISTINCT order_id_bk) AS total_orders,
           count(DISTINCT customer_sk) AS total_customers, count(DISTINCT seller_sk) AS active_sellers,
           sum(line_total)::DOUBLE / count(DISTINCT order_id_bk) AS aov,
           sum(line_total)::DOUBLE / count(DISTINCT customer_sk) AS revenue_per_customer,
           sum(line_total)::DOUBLE / count(DISTINCT seller_sk) AS revenue_per_seller,
           count(DISTINCT order_id_bk)::DOUBLE / count(DISTINCT customer_sk) AS avg_orders_per_customer,
           sum(line_total) FILTER (customer_state = 'SP')::DOUBLE / sum(line_total)::DOUBLE AS sp_revenue_share,
           nullif(count(DISTINCT order_id_bk) FILTER (is_weekend), 0) / count(DISTINCT order_id_bk) AS weekend_order_share,
           -1.0 AS holiday_lift_pct
    FROM mi JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2
"""
WC = """
    SELECT grain, w, nullif(count(*) FILTER (n > 1), 0) / count(*) AS repeat_rate,
           avg(CASE WHEN n >= 2 THEN date_diff('day', first, last) END) AS reactivation_window
    FROM (SELECT grain, w, customer_sk, count(DISTINCT order_id_bk) AS n, min(day) AS first, max(day) AS last
          FROM mi JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2, 3) GROUP BY 1, 2
"""
WS = """
    SELECT grain, w, max(v) AS top_seller_revenue
    FROM (SELECT grain, w, seller_sk, sum(line_total) AS v FROM mi JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2, 3) GROUP BY 1, 2
"""
WK = """
    SELECT grain, w, max(v) AS top_category_revenue, max(v)::DOUBLE / sum(v)::DOUBLE AS top_category_share,
           nullif(count(*) FILTER (v::DOUBLE / t > 0.05), 0) AS categories_above_5pct_gmv
    FROM (SELECT *, (sum(v) OVER (PARTITION BY grain, w))::DOUBLE AS t FROM
          (SELECT grain, w, product_category_name, sum(line_total) AS v FROM mi JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2, 3))
    GROUP BY 1, 2
"""
WM = """
    SELECT grain, w, max(v) AS peak_month_revenue, min(v) AS weakest_month_revenue
    FROM (SELECT grain, w, year_month, sum(line_total) AS v FROM mi JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2, 3) GROUP BY 1, 2
"""
WP = """
    SELECT grain, w, avg(days_purchase_to_delivery) AS avg_delivery_days, avg(days_to_ship) AS avg_days_to_ship,
           avg(days_to_deliver) AS avg_days_carrier_to_delivery, avg(days_to_approve) AS avg_days_to_approve,
           avg(days_purchase_to_delivery) FILTER (customer_state IN ('AM','PA','AC','RO','RR','AP','TO')) AS north_region_delivery
    FROM ml JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2
"""
WA = """
    SELECT grain, w, nullif(count(*) FILTER (order_status = 'delivered'), 0) AS delivered_orders,
           nullif(count(*) FILTER (order_status = 'canceled'), 0) AS cancelled_orders,
           nullif(count(*) FILTER (order_status = 'unavailable'), 0) AS unavailable_orders,
           nullif(count(*) FILTER (coalesce(days_delivery_variance, 0) <= 0), 0) / count(*) AS on_time_delivery_pct,
           avg(days_purchase_to_delivery) AS approval_delivery_days
    FROM ml JOIN win ON approval_day BETWEEN lo AND hi GROUP BY 1, 2
"""
WR = "SELECT grain, w, avg(review_score) AS avg_review_score FROM f_reviews JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2"
WG = """
    SELECT grain, w, avg(review_score) AS category_avg_score FROM f_reviews r JOIN win ON r.day BETWEEN lo AND hi
    WHERE r.order_id_bk IN (SELECT order_id_bk FROM f_items i WHERE i.day BETWEEN lo AND hi) GROUP BY 1, 2
"""
WY = """
    SELECT grain, w, sum(payment_value) AS total_payment_value, count(*) AS payment_transactions,
           sum(payment_value)::DOUBLE / count(*) AS avg_payment_value,
           nullif(count(*) FILTER (payment_type = 'Credit Card'), 0) / count(*) AS credit_card_pct,
           nullif(count(*) FILTER (payment_type = 'Boleto'), 0) / count(*) AS boleto_pct,
           avg(payment_installments) AS avg_installments, max(payment_installments) AS max_installments_used,
           nullif(count(DISTINCT order_id_bk) FILTER (payment_installments > 1), 0) / count(DISTINCT order_id_bk)
             AS orders_using_installments_pct
    FROM mp JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2
"""
WF = """
    SELECT grain, w, count(*) AS total_mqls, count(*) AS total_deals, 1.0 AS mql_conversion_rate,
           avg(days_to_close) AS avg_days_to_close, sum(declared_monthly_revenue)::DOUBLE / count(*) AS avg_declared_monthly_revenue,
           count(DISTINCT origin) AS active_channels
    FROM f_funnel LEFT JOIN dim_channel USING (mql_channel_sk) JOIN win ON day BETWEEN lo AND hi GROUP BY 1, 2
"""
# figures with a date range of their own, counted back from the end of each window
WE = """
    SELECT grain, w, lo, hi,
           (SELECT sum(line_total) FROM f_items WHERE day BETWEEN date_trunc('month', hi) AND hi) AS mtd,
           (SELECT sum(line_total) FROM f_items WHERE day BETWEEN date_trunc('month', hi) - INTERVAL 1 MONTH
              AND hi - INTERVAL 1 MONTH) AS pm,
           (SELECT sum(line_total) FROM f_items WHERE day BETWEEN date_trunc('year', hi) AND hi) AS ytd_revenue,
           (SELECT sum(line_total) FROM f_items WHERE day BETWEEN date_trunc('year', hi) - INTERVAL 1 YEAR
              AND hi - INTERVAL 1 YEAR) AS py FROM win
"""
CAGR = """
    SELECT pow(sum(line_total) FILTER (year(day) = 2001)::DOUBLE / sum(line_total) FILTER (year(day) = 1995)::DOUBLE, 1 / 6.0) - 1
           AS revenue_cagr FROM f_items
"""
ALL_BASES = """
    SELECT e.grain, e.w, wi.*, wc.*, ws.*, wk.*, wm.*, wp.*, wa.*, wr.*, wg.*, wy.*, wf.*,
           wi.total_orders AS o, ytd_revenue, mtd, pm, py,
           delivered_orders::DOUBLE / wi.total_orders AS fulfillment_rate,
           cancelled_orders::DOUBLE / wi.total_orders AS cancellation_rate,
           (SELECT count(DISTINCT customer_state) FROM dim_customer) AS states_active,
           (SELECT revenue_cagr FROM cagr) AS revenue_cagr,
           CASE WHEN pm = 0 THEN 0 WHEN pm IS NOT NULL THEN coalesce(mtd, 0) END AS base_forecast,
           (coalesce(wi.total_revenue, 0) - py)::DOUBLE / py::DOUBLE AS category_growth_rate_yoy,
           (coalesce(approval_delivery_days, 0) > 15)::INT + (coalesce(avg_review_score, 0) < 3.8)::INT
             + (coalesce(cancelled_orders::DOUBLE / wi.total_orders, 0) > 0.05)::INT
             + (coalesce((coalesce(mtd, 0) - pm)::DOUBLE / nullif(pm, 0)::DOUBLE, 0) < -0.05)::INT AS active_anomalies
    FROM we e
""" + " ".join(f"LEFT JOIN {b} USING (grain, w)" for b in "wi wc ws wk wm wp wa wr wg wy wf".split())
ALL_BASES = ALL_BASES.replace(
    "wi.*, wc.*, ws.*, wk.*, wm.*, wp.*, wa.*, wr.*, wg.*, wy.*, wf.*",
    ", ".join(f"{b}.* EXCLUDE (grain, w)" for b in "wi wc ws wk wm wp wa wr wg wy wf".split()),
)
TIME = dict(
    BLK, anchor=ANCHOR, win=WIN, wi=WI, wc=WC, ws=WS, wk=WK, wm=WM, wp=WP, wa=WA, wr=WR, wg=WG, wy=WY, wf=WF, we=WE,
    cagr=CAGR, bases=ALL_BASES,
)


def _pct(base: str) -> str:
    return f"CASE WHEN p.{base} <> 0 THEN (coalesce(c.{base}, 0)::DOUBLE - p.{base}::DOUBLE) / p.{base}::DOUBLE END"


def _compare_sql(bases: list[str], grain: str) -> str:
    shown = ", ".join(
        f"c.{b} AS {b}__curr, p.{b} AS {b}__prior, {_pct(b)} AS {b}__pct" for b in bases
    )
    return f"""SELECT {shown} FROM (SELECT * FROM bases WHERE grain = '{grain}' AND w = 'curr') c,
               (SELECT * FROM bases WHERE grain = '{grain}' AND w = 'prior') p"""


HEADLINE = ["total_revenue", "total_orders", "total_customers", "avg_review_score", "avg_delivery_days", "aov"]


def _headline(grain: str, anchor: dt.date | None):
    from tradewind.plans.evaluate import change, to_date_compare

    def plan(spark, folder):
        ctx = Context(roles={"lifecycle": "purchase"}, anchor=anchor)
        both = to_date_compare(Star(loaded(spark, folder)), {grain: HEADLINE}, ctx)
        both = both.withColumnsRenamed({f"{b}__{grain}__{w}": f"{b}__{w}" for b in HEADLINE for w in ("curr", "prior")})
        return both.select("*", *[change(F.col(f"{b}__curr"), F.col(f"{b}__prior")).alias(f"{b}__pct") for b in HEADLINE])

    return plan


_HEADLINE_SPEC = " ".join(f"{b}__curr:r {b}__prior:r {b}__pct:r" for b in HEADLINE).replace(
    "total_revenue__curr:r total_revenue__prior:r", "total_revenue__curr:n total_revenue__prior:n"
)
for _name, _grain in [("mtd_compare", "month"), ("qtd_compare", "quarter"), ("ytd_compare", "year")]:
    add(_name, _HEADLINE_SPEC, _headline(_grain, None), _compare_sql(HEADLINE, _grain), **TIME)
    add(
        f"{_name}_at_day",
        _HEADLINE_SPEC,
        _headline(_grain, DAY),
        _compare_sql(HEADLINE, _grain),
        **{**TIME, "anchor": FIXED},
    )

PERIODS = [n for n, m in M.MEASURES.items() if isinstance(m, M.Period)]


def _periods_sql() -> str:
    rows = [
        f"""SELECT '{n}' AS measure, {_value(n)} AS value FROM curr_rows c JOIN prior_rows p ON c.grain = p.grain
            WHERE c.grain = '{M.MEASURES[n].grain}'"""
        for n in PERIODS
    ]
    return " UNION ALL ".join(rows)


def _value(n: str) -> str:
    m = M.MEASURES[n]
    if m.part == "prior":
        return f"p.{m.base}::DOUBLE"
    if m.part == "delta":
        return f"coalesce(c.{m.base}, 0)::DOUBLE - coalesce(p.{m.base}, 0)::DOUBLE"
    return _pct(m.base)


PAIRED = dict(
    TIME,
    anchor=FIXED,
    curr_rows="SELECT * FROM bases WHERE w = 'curr'",
    prior_rows="SELECT * FROM bases WHERE w = 'prior'",
)
add(
    "period_comparisons",
    "measure:s value:r",
    lambda s, f: as_rows(evaluate(Star(loaded(s, f)), PERIODS, anchor=DAY), PERIODS),
    _periods_sql(),
    **PAIRED,
)

# --- whole-period shifts, trends, anchored and composite figures ----------------


def _shift(names: str, grain: str, number: str):
    def plan(spark, folder):
        found = names.split()
        out = shift_compare(Star(loaded(spark, folder)), found, grain)
        for n in found:
            out = out.withColumnsRenamed({n: f"v_{n}", f"{n}__prior": f"p_{n}", f"{n}__pct": f"c_{n}"})
        return out

    return plan


def _shift_sql(values: str, number: str, names: str, top: int) -> str:
    found = names.split()
    shown = ", ".join(
        f"a.{n} AS v_{n}, b.{n} AS p_{n}, (coalesce(a.{n}, 0)::DOUBLE - b.{n}::DOUBLE) / nullif(b.{n}::DOUBLE, 0) AS c_{n}"
        for n in found
    )
    return f"""SELECT coalesce(a.{number}, b.{number} + 1) AS {number}, {shown} FROM ({values}) a
               FULL JOIN ({values}) b ON a.{number} = b.{number} + 1 WHERE coalesce(a.{number}, b.{number} + 1) <= {top}"""


_STARS = """
    SELECT year(day) * 12 + month(day) AS month_index,
           nullif(count(*) FILTER (review_score = 1), 0) / count(*) AS "1_star_rate",
           nullif(count(*) FILTER (review_score = 5), 0) / count(*) AS "5_star_rate",
           nullif(count(message), 0) / count(*) AS reviews_with_comments
    FROM f_reviews WHERE year(day) BETWEEN 1995 AND 2001 GROUP BY 1
"""
add(
    "month_shift_compare",
    "month_index:i v_1_star_rate:r p_1_star_rate:r c_1_star_rate:r v_5_star_rate:r p_5_star_rate:r c_5_star_rate:r "
    "v_reviews_with_comments:r p_reviews_with_comments:r c_reviews_with_comments:r",
    _shift("1_star_rate 5_star_rate reviews_with_comments", "month", "month_index"),
    _shift_sql(_STARS, "month_index", "one_star five_star reviews_with_comments", 2001 * 12 + 12)
    .replace('"1_star_rate"', "one_star")
    .replace('"5_star_rate"', "five_star")
    .replace("v_one_star", "v_1_star_rate")
    .replace("p_one_star", "p_1_star_rate")
    .replace("c_one_star", "c_1_star_rate")
    .replace("v_five_star", "v_5_star_rate")
    .replace("p_five_star", "p_5_star_rate")
    .replace("c_five_star", "c_5_star_rate"),
)
_REPEAT_Q = """
    SELECT qi AS quarter_index, nullif(count(*) FILTER (n > 1), 0) AS repeat_customers
    FROM (SELECT year(day) * 4 + quarter(day) AS qi, customer_sk, count(DISTINCT order_id_bk) AS n FROM mi
          WHERE year IS NOT NULL GROUP BY 1, 2) GROUP BY 1
"""
add(
    "quarter_shift_compare",
    "quarter_index:i v_repeat_customers:n p_repeat_customers:n c_repeat_customers:r",
    _shift("repeat_customers", "quarter", "quarter_index"),
    _shift_sql(_REPEAT_Q, "quarter_index", "repeat_customers", 2001 * 4 + 4),
    **BLK,
)
_REPEAT_Y = "SELECT year, sum(v) FILTER (ever > 1) AS repeat_customer_revenue FROM buyer WHERE year IS NOT NULL GROUP BY 1"
add(
    "year_shift_compare",
    "year:i v_repeat_customer_revenue:n p_repeat_customer_revenue:n c_repeat_customer_revenue:r",
    _shift("repeat_customer_revenue", "year", "year"),
    _shift_sql(_REPEAT_Y, "year", "repeat_customer_revenue", 2001),
    **BLK,
    buyer=_BUYERS,
)

SHIFTS = [n for n, m in M.MEASURES.items() if isinstance(m, M.Shift)]
TRENDS = [n for n, m in M.MEASURES.items() if isinstance(m, M.Trend)]
_SHIFT_SQL = {
    "1_star_rate": ("one_star", "month_index", 2001 * 12 + 7, _STARS.replace('"1_star_rate"', "one_star").replace('"5_star_rate"', "five_star")),
    "5_star_rate": ("five_star", "month_index", 2001 * 12 + 7, _STARS.replace('"1_star_rate"', "one_star").replace('"5_star_rate"', "five_star")),
    "reviews_with_comments": ("reviews_with_comments", "month_index", 2001 * 12 + 7, _STARS.replace('"1_star_rate"', "one_star").replace('"5_star_rate"', "five_star")),
    "repeat_customers": ("repeat_customers", "quarter_index", 2001 * 4 + 3, _REPEAT_Q),
    "repeat_customer_revenue": ("repeat_customer_revenue", "year", 2001, _REPEAT_Y),
}


def _shift_value(n: str) -> str:
    """SQL for one shift figure at the anchor's period."""
    m = M.MEASURES[n]
    column, number, at, values = _SHIFT_SQL[m.base]
    now = f"(SELECT {column}::DOUBLE FROM ({values}) WHERE {number} = {at})"
    then = f"(SELECT {column}::DOUBLE FROM ({values}) WHERE {number} = {at} - 1)"
    return then if m.part == "prior" else f"(coalesce({now}, 0) - {then}) / nullif({then}, 0)"


add(
    "shift_comparisons",
    "measure:s value:r",
    lambda s, f: as_rows(evaluate(Star(loaded(s, f)), SHIFTS, anchor=DAY), SHIFTS),
    " UNION ALL ".join(f"SELECT '{n}' AS measure, {_shift_value(n)} AS value" for n in SHIFTS),
    **BLK,
    buyer=_BUYERS,
)


# fixed values: marks whose figure is good when it falls, stated apart from the registry
FALL_IS_GOOD = {
    "delivery_trend_arrow", "delivery_trend_color", "1_star_rate_trend_color", "reactivation_window_trend_color",
    "delivery_days_mom_trend_color", "avg_days_to_ship_trend_color", "avg_days_carrier_to_delivery_trend_color",
    "north_region_delivery_trend_color", "cancellation_rate_trend_color", "cancelled_orders_trend_color",
    "unavailable_orders_trend_color", "avg_days_to_approve_trend_color", "avg_days_to_close_trend_color",
    "active_anomalies_trend_color",
}


def _trend_sql() -> str:
    rows = []
    for n in TRENDS:
        m = M.MEASURES[n]
        source = m.base
        while isinstance(M.MEASURES[source], M.Calc):
            source = M.MEASURES[source].deps[0]
        value = (
            f"(SELECT value FROM changes WHERE measure = '{source}')"
            if isinstance(M.MEASURES[source], M.Period)
            else _shift_value(source)
        )
        up, down = ("good", "bad") if m.kind == "color" else ("up", "down")
        flat = "neutral" if m.kind == "color" else "flat"
        sign = "-" if n in FALL_IS_GOOD else ""
        rows.append(
            f"SELECT '{n}' AS measure, CASE WHEN {sign}v > 0 THEN '{up}' WHEN {sign}v < 0 THEN '{down}' ELSE '{flat}' END AS mark "
            f"FROM (SELECT {value} AS v)"
        )
    return " UNION ALL ".join(rows)


def _trend_rows(spark, folder):
    frame = evaluate(Star(loaded(spark, folder)), TRENDS, anchor=DAY)
    pairs = [F.struct(F.lit(n).alias("measure"), F.col(n).alias("mark")) for n in TRENDS]
    return frame.select(F.inline(F.array(*pairs)))


add("trend_flags", "measure:s mark:s", _trend_rows, _trend_sql(), **PAIRED, buyer=_BUYERS, changes=_periods_sql())
add(
    "revenue_delta",
    "customer_state:s revenue_mom_delta:n revenue_pm:n revenue_mom_pct:r",
    figures("revenue_mom_delta revenue_pm revenue_mom_pct", by=["customer_state"], anchor=DAY),
    """SELECT customer_state, coalesce(c, 0)::DOUBLE - coalesce(p, 0)::DOUBLE AS revenue_mom_delta, p AS revenue_pm,
              (coalesce(c, 0)::DOUBLE - p::DOUBLE) / nullif(p::DOUBLE, 0) AS revenue_mom_pct
       FROM (SELECT customer_state, sum(line_total) FILTER (day BETWEEN DATE '2001-07-01' AND DATE '2001-07-20') AS c,
                    sum(line_total) FILTER (day BETWEEN DATE '2001-06-01' AND DATE '2001-06-20') AS p FROM mi GROUP BY 1)
       WHERE c IS NOT NULL OR p IS NOT NULL""",
    **BLK,
)
add(
    "rank_change_yoy",
    "product_category_name:s category_rank_change_yoy:n",
    figures(
        "category_rank_change_yoy",
        by=["product_category_name"],
        windows={"half": (dt.date(2000, 1, 1), dt.date(2000, 6, 30))},
    ),
    """SELECT product_category_name, b.r - a.r AS category_rank_change_yoy
       FROM (SELECT product_category_name, dense_rank() OVER (ORDER BY sum(line_total) DESC) AS r FROM mi
             WHERE day BETWEEN DATE '2000-01-01' AND DATE '2000-06-30' GROUP BY 1) a
       FULL JOIN (SELECT product_category_name, dense_rank() OVER (ORDER BY sum(line_total) DESC) AS r FROM mi
             WHERE day BETWEEN DATE '1999-01-01' AND DATE '1999-06-30' GROUP BY 1) b USING (product_category_name)""",
    **BLK,
)
add(
    "rolling_3m",
    "product_category_name:s rolling_3m_avg_revenue:r",
    figures("rolling_3m_avg_revenue", by=["product_category_name"]),
    """SELECT product_category_name, avg(v::DOUBLE) AS rolling_3m_avg_revenue
       FROM (SELECT product_category_name, day, sum(line_total) AS v FROM mi, anchor
             WHERE day > a - INTERVAL 3 MONTH AND day <= a GROUP BY 1, 2) GROUP BY 1""",
    **TIME,
)
add(
    "cagr",
    "customer_state:s first_year_revenue:n last_year_revenue:n revenue_cagr:r",
    figures("first_year_revenue last_year_revenue revenue_cagr", by=["customer_state"]),
    """SELECT customer_state, f AS first_year_revenue, l AS last_year_revenue,
              pow(coalesce(l::DOUBLE / f::DOUBLE, 0), 1 / 6.0) - 1 AS revenue_cagr
       FROM (SELECT customer_state, sum(line_total) FILTER (year = 1995) AS f, sum(line_total) FILTER (year = 2001) AS l
             FROM mi GROUP BY 1)""",
    **BLK,
)
add(
    "forecast_scenarios",
    "base_forecast:r optimistic_forecast:r pessimistic_forecast:r forecast_periods:i ytd_revenue:n revenue_growth_rate:r "
    "category_growth_rate_yoy:r",
    figures(
        "base_forecast optimistic_forecast pessimistic_forecast forecast_periods ytd_revenue revenue_growth_rate "
        "category_growth_rate_yoy",
        anchor=DAY,
    ),
    """SELECT mtd AS base_forecast, mtd::DOUBLE * 1.15 AS optimistic_forecast, mtd::DOUBLE * 0.9 AS pessimistic_forecast,
              3 AS forecast_periods, ytd_revenue, (mtd - pm)::DOUBLE / pm::DOUBLE AS revenue_growth_rate,
              ((SELECT sum(line_total) FROM f_items) - py)::DOUBLE / py::DOUBLE AS category_growth_rate_yoy
       FROM we WHERE grain = 'month' AND w = 'curr'""",
    **{**TIME, "anchor": FIXED},
)
_NOW = """
    SELECT (SELECT count(DISTINCT order_id_bk) FROM f_items) AS n, sum(line_total)::DOUBLE AS rev,
           (SELECT avg(days_purchase_to_delivery) FROM f_life) AS d,
           (SELECT avg((coalesce(days_delivery_variance, 0) <= 0)::INT) FROM f_life) AS ot,
           (SELECT count(*) FROM f_life WHERE order_status = 'canceled') AS c,
           (SELECT count(*) FROM f_life WHERE order_status = 'delivered') AS dl,
           (SELECT avg(review_score) FROM f_reviews) AS s,
           (SELECT count(DISTINCT order_id_bk) FROM f_payments) AS p FROM f_items
"""
add(
    "health_score",
    "operational_health_score:r",
    figures("operational_health_score"),
    "SELECT (dl / n::DOUBLE + ot + s / 5 + p / n::DOUBLE + 1) / 5 AS operational_health_score FROM now_",
    now_=_NOW,
)
add(
    "risk_score",
    "composite_risk_score:r",
    figures("composite_risk_score"),
    """SELECT round(least((d - 12) / 12 * 100, 100) * 0.4 + greatest((4 - s) / 4 * 100, 0) * 0.35
                    + least(c / n::DOUBLE / 0.05 * 100, 100) * 0.25, 1) AS composite_risk_score FROM now_""",
    now_=_NOW,
)
add(
    "anomaly_count",
    "active_anomalies:i",
    figures("active_anomalies", anchor=DAY),
    """SELECT (d > 15)::INT + (s < 3.8)::INT + (c / n::DOUBLE > 0.05)::INT
              + (SELECT ((mtd - pm)::DOUBLE / pm::DOUBLE < -0.05)::INT FROM we WHERE grain = 'month' AND w = 'curr')
              AS active_anomalies FROM now_""",
    now_=_NOW,
    **{**TIME, "anchor": FIXED},
)
add(
    "insight_text",
    "ai_insight_revenue:s ai_insight_operations:s ai_insight_customer:s",
    figures("ai_insight_revenue ai_insight_operations ai_insight_customer", anchor=DAY),
    f"""SELECT 'Revenue is ' || CASE WHEN y >= 0 THEN 'up' ELSE 'down' END || ' ' || printf('%.1f', abs(y) * 100)
              || '% YoY. Total GMV: ' || format('{{:,}}', round(rev)::BIGINT) || '. '
              || CASE WHEN y > 0.1 THEN '{M.STRONG}' WHEN y < -0.05 THEN '{M.DECLINE}' ELSE '{M.STABLE}' END AS ai_insight_revenue,
              'Avg delivery: ' || printf('%.1f', d) || ' days (' || printf('%.0f', ot * 100) || '% on-time). Review score: '
              || printf('%.2f', s) || '/5. '
              || CASE WHEN d > 15 THEN '{M.SLOW}' WHEN s < 3.8 THEN '{M.UNHAPPY}' ELSE '{M.FINE}' END AS ai_insight_operations,
              format('{{:,}}', k) || ' unique buyers (' || printf('%+.1f', ky * 100) || '% YoY). Repeat rate: '
              || printf('%.1f', r * 100) || '%. '
              || CASE WHEN r < 0.05 THEN '{M.LEAVING}' WHEN r > 0.15 THEN '{M.LOYAL}' ELSE '{M.MODERATE}' END AS ai_insight_customer
       FROM now_, (SELECT count(DISTINCT customer_sk) AS k FROM f_items),
            (SELECT count(*) FILTER (n > 1)::DOUBLE / count(*) AS r
             FROM (SELECT count(DISTINCT order_id_bk) AS n FROM f_items GROUP BY customer_sk)),
            (SELECT (c.total_revenue - p.total_revenue)::DOUBLE / p.total_revenue::DOUBLE AS y,
                    (c.total_customers - p.total_customers)::DOUBLE / p.total_customers AS ky
             FROM (SELECT * FROM wi WHERE grain = 'year' AND w = 'curr') c, (SELECT * FROM wi WHERE grain = 'year' AND w = 'prior') p)""",
    now_=_NOW,
    **{**TIME, "anchor": FIXED},
)
