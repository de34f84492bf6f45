"""Named SQL blocks: the raw roles, the cleaned tables, the star and the flat order table.

Plain SQL over the given tables, written apart from the Spark code.  `sql()`
puts the blocks a query needs in front of it.
"""

from __future__ import annotations

import re

# fixed values: state codes, by nation number
_STATES = (
    "'sp','rj','mg','pr','sc','rs','ba','go','df','es','pe','ce','pa','mt','ms','am','ma','pb','rn','al',"
    "'pi','se','ro','to','ac','ap','rr'"
)


def _title(expr: str) -> str:
    return (
        f"nullif(array_to_string(list_transform(list_filter(string_split(lower(replace({expr}, '_', ' ')), ' '), "
        "lambda w: trim(w) <> ''), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' '), '')"
    )


BLOCKS: dict[str, str] = {}

# --- raw roles --------------------------------------------------------------

BLOCKS["geo"] = f"""
    SELECT n_nationkey, lower(n_name) AS city, ([{_STATES}])[n_nationkey + 1] AS state FROM nation
"""
BLOCKS["raw_customers"] = """
    SELECT CASE WHEN c_custkey % 10 = 0 THEN ' ' || c_custkey || ' ' ELSE c_custkey::VARCHAR END AS customer_id,
           'P' || (c_custkey // 2) || CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE '' END AS customer_unique_id,
           CASE WHEN c_custkey % 97 <> 0 THEN c_custkey * 37 % 100000 END AS customer_zip_code_prefix,
           city AS customer_city, state || ' ' AS customer_state,
           DATE '2024-01-01' + (c_custkey % 3)::INT AS _ingested_at
    FROM customer JOIN geo ON c_nationkey = n_nationkey
"""
BLOCKS["raw_sellers"] = """
    SELECT s_suppkey::VARCHAR AS seller_id, s_suppkey * 53 % 100000 AS seller_zip_code_prefix,
           CASE WHEN s_suppkey % 11 <> 5 THEN city END AS seller_city,
           CASE WHEN s_suppkey % 13 <> 7 THEN state END AS seller_state
    FROM supplier JOIN geo ON s_nationkey = n_nationkey
"""
BLOCKS["raw_places"] = """
    SELECT DISTINCT z, c, s FROM (
      SELECT customer_zip_code_prefix AS z, customer_city AS c, trim(customer_state) AS s FROM raw_customers
      UNION ALL SELECT seller_zip_code_prefix, seller_city, seller_state FROM raw_sellers) WHERE z IS NOT NULL
"""
BLOCKS["raw_orders"] = """
    SELECT o_orderkey AS k, o_custkey, o_orderdate::DATE AS d,
           CASE WHEN o_orderstatus = 'O' THEN
                  CASE o_orderkey % 10 WHEN 0 THEN ' CANCELED ' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'created'
                       WHEN 3 THEN 'Shipped' ELSE 'delivered' END
                WHEN o_orderstatus = 'P' THEN
                  CASE o_orderkey % 8 WHEN 0 THEN 'shipped' WHEN 1 THEN 'approved' WHEN 2 THEN 'invoiced'
                       WHEN 3 THEN 'processing' WHEN 4 THEN 'canceled' ELSE 'delivered' END
                ELSE 'delivered' END AS raw_status
    FROM orders
"""
BLOCKS["raw_items"] = """
    SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS order_item_id,
           CASE WHEN l_partkey % 101 <> 3 THEN l_partkey::VARCHAR END AS product_id,
           CASE WHEN l_orderkey % 97 <> 1 THEN l_suppkey || ' ' END AS seller_id,
           CASE WHEN l_orderkey % 89 = 2 THEN 'soon' ELSE (l_shipdate::DATE)::VARCHAR END AS shipping_limit_date,
           l_extendedprice AS price, CASE WHEN l_quantity <> 50 THEN l_quantity * 0.25 END AS freight_value,
           l_shipdate AS _ingested_at
    FROM lineitem
"""
BLOCKS["raw_payments"] = """
    SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS payment_sequential,
           (['credit_card',' BOLETO ','voucher','debit_card','not_defined',NULL,'pix'])[(l_orderkey + l_linenumber) % 7 + 1]
             AS payment_type,
           l_quantity % 11 + 0.5 AS payment_installments, l_extendedprice + l_quantity * 0.25 AS payment_value,
           l_shipdate AS _ingested_at
    FROM lineitem
"""
BLOCKS["raw_reviews"] = """
    SELECT l_orderkey || '-' || l_linenumber AS review_id, l_orderkey::VARCHAR AS order_id,
           1 + (l_partkey + l_linenumber) % 5 AS review_score,
           CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN ' no title' ELSE 'Rated ' || l_returnflag END AS title,
           CASE WHEN l_quantity < 25 THEN NULL WHEN l_quantity < 30 THEN 'No message'
                ELSE 'Bought ' || l_quantity::INT || ' pieces ' END AS message,
           l_shipdate::DATE AS created,
           CASE l_quantity::INT % 10 WHEN 3 THEN NULL WHEN 4 THEN 'pending'
                ELSE (l_shipdate::DATE + (l_suppkey % 7)::INT)::VARCHAR || ' 21:46:59' END AS answered,
           l_shipdate AS _ingested_at
    FROM lineitem
"""
BLOCKS["moved_events"] = """
    SELECT event_id, user_id, event_type, value, ts,
           (ts::DATE - to_months((269 + user_id % 3)::INT))::DATE AS day,
           'm' || user_id || '-' || ((day(ts) - 1) // 7) AS mql_id,
           json_extract_string(props, '$.k')::INT AS k
    FROM events
"""
BLOCKS["raw_leads"] = """
    SELECT mql_id, CASE WHEN event_id % 83 <> 1 THEN day::VARCHAR END AS first_contact_date,
           CASE WHEN event_id % 17 <> 3 THEN 'page ' || event_type END AS landing_page_id,
           (['organic_search','paid_search','Social ','email','referral','display','direct_traffic',
             'other_publicities',NULL])[k % 9 + 1] AS origin,
           ts AS _ingested_at
    FROM moved_events WHERE event_type IN ('signup', 'view', 'click', 'error')
"""
BLOCKS["raw_deals"] = """
    SELECT mql_id, user_id::VARCHAR AS seller_id,
           CASE WHEN event_id % 29 <> 2 THEN 'sdr' || (event_id % 7) END AS sdr_id,
           CASE WHEN event_id % 31 <> 2 THEN 'sr' || (event_id % 5) END AS sr_id,
           CASE WHEN event_id % 37 = 4 THEN 'later' ELSE (day + k % 20)::VARCHAR || ' 09:00:00' END AS won_date,
           (['home_decor','health_beauty','audio_video__electronics','',NULL])[k % 5 + 1] AS business_segment,
           (['online_big','online_medium','Online_Small','industry','offline',NULL])[k % 6 + 1] AS lead_type,
           (['cat','eagle',' wolf','shark','cat, wolf'])[k % 5 + 1] AS lead_behaviour_profile,
           ([1,0,NULL])[k % 3 + 1] AS has_company, ([0,1,NULL,1])[k % 4 + 1] AS has_gtin,
           CASE WHEN k % 4 <> 1 THEN '5-20 ' END AS average_stock,
           (['reseller','manufacturer','others',NULL])[k % 4 + 1] AS business_type,
           CASE WHEN k % 6 <> 5 THEN value END AS declared_product_catalog_size,
           value * 100 AS declared_monthly_revenue, ts AS _ingested_at
    FROM moved_events WHERE event_type = 'purchase'
"""

# --- cleaned tables ---------------------------------------------------------

BLOCKS["s_customers"] = """
    SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
           right('00000' || customer_zip_code_prefix::VARCHAR, 5) AS customer_zip_code_prefix,
           upper(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state, _ingested_at
    FROM raw_customers
    QUALIFY row_number() OVER (PARTITION BY trim(customer_id) ORDER BY _ingested_at DESC) = 1
"""
BLOCKS["s_sellers"] = """
    SELECT trim(seller_id) AS seller_id, right('00000' || seller_zip_code_prefix::VARCHAR, 5) AS seller_zip_code_prefix,
           coalesce(upper(trim(seller_city)), 'Not Specified') AS seller_city,
           coalesce(upper(trim(seller_state)), 'Not Specified') AS seller_state
    FROM raw_sellers
"""
BLOCKS["s_products"] = f"""
    SELECT p_partkey::VARCHAR AS product_id,
           coalesce({_title('''CASE WHEN p_partkey % 50 = 1 THEN '' WHEN p_partkey % 50 = 0 THEN ''
              WHEN p_name LIKE 'blue%' THEN replace(lower(p_name), ' ', '_')
              ELSE replace(lower(p_name), ' ', '_') || '__goods' END''')}, 'Not Specified') AS product_category_name,
           CASE WHEN p_partkey % 20 = 3 THEN 0 ELSE length(p_name) END AS product_name_length,
           length(p_name) * 10 AS product_description_length,
           CASE WHEN p_partkey % 30 = 4 THEN 0 ELSE p_size % 6 END AS product_photos_qty,
           trunc(p_retailprice)::BIGINT AS product_weight_g, p_size AS product_length_cm,
           p_size // 2 AS product_height_cm, 0 AS product_width_cm
    FROM part
"""
BLOCKS["s_orders"] = """
    SELECT k::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id, status AS order_status,
           CASE WHEN k % 211 = 5 THEN DATE '1900-01-01' ELSE d END AS purchase,
           CASE WHEN k % 41 = 7 THEN DATE '1900-01-01' ELSE d + (k % 3)::INT END AS approved,
           CASE WHEN status IN ('delivered', 'shipped') AND k % 53 <> 9 THEN d + (k % 3 + k % 5)::INT ELSE gap END AS carrier,
           CASE WHEN status = 'delivered' AND k % 59 <> 11 THEN d + (k % 3 + k % 5 + 1 + k * 7 % 17)::INT ELSE gap END
             AS delivered,
           CASE WHEN k % 61 = 13 THEN DATE '1900-01-01' ELSE d + (12 + k % 9)::INT END AS estimated
    FROM (SELECT *, lower(trim(raw_status)) AS status,
                 CASE WHEN lower(trim(raw_status)) IN ('canceled', 'unavailable') THEN DATE '1900-01-01'
                      ELSE DATE '9999-12-31' END AS gap
          FROM raw_orders)
"""
BLOCKS["s_items"] = """
    SELECT * FROM (
      SELECT order_id, order_item_id, coalesce(trim(product_id), 'UNKNOWN') AS product_id,
             coalesce(trim(seller_id), 'UNKNOWN') AS seller_id,
             coalesce(try_cast(shipping_limit_date AS DATE), DATE '1900-01-01') AS shipping_limit_date,
             price::DECIMAL(10,2) AS unit_price, coalesce(freight_value, 0)::DECIMAL(10,2) AS unit_freight_value,
             _ingested_at
      FROM raw_items)
    QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY _ingested_at DESC, product_id, seller_id,
                               shipping_limit_date, unit_price, unit_freight_value) = 1
"""
BLOCKS["s_payments"] = """
    SELECT * FROM (
      SELECT order_id, payment_sequential,
             CASE lower(trim(payment_type)) WHEN 'credit_card' THEN 'Credit Card' WHEN 'debit_card' THEN 'Debit Card'
                  WHEN 'boleto' THEN 'Boleto' WHEN 'voucher' THEN 'Voucher' ELSE 'Not Specified' END AS payment_type,
             trunc(payment_installments)::INT AS payment_installments, payment_value::DECIMAL(10,2) AS payment_value,
             _ingested_at
      FROM raw_payments)
    QUALIFY row_number() OVER (PARTITION BY order_id, payment_sequential
                               ORDER BY _ingested_at DESC, payment_type, payment_installments, payment_value) = 1
"""
BLOCKS["s_reviews"] = """
    SELECT * FROM (
      SELECT review_id, order_id, review_score, coalesce(trim(title), 'No Title') AS review_comment_title,
             coalesce(trim(message), 'No Message') AS review_comment_message, created,
             coalesce(try_cast(answered AS TIMESTAMP)::DATE, DATE '1900-01-01') AS answered, _ingested_at
      FROM raw_reviews)
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY answered DESC, _ingested_at DESC, review_id, review_score,
                               review_comment_title, review_comment_message) = 1
"""
BLOCKS["s_leads"] = """
    SELECT * FROM (
      SELECT mql_id, coalesce(try_cast(first_contact_date AS DATE), DATE '1900-01-01') AS first_contact_date,
             coalesce(trim(landing_page_id), 'UNKNOWN') AS landing_page_id,
             CASE lower(trim(origin)) WHEN 'organic_search' THEN 'Organic Search' WHEN 'paid_search' THEN 'Paid Search'
                  WHEN 'social' THEN 'Social' WHEN 'email' THEN 'Email' WHEN 'referral' THEN 'Referral'
                  WHEN 'display' THEN 'Display' WHEN 'direct_traffic' THEN 'Direct Traffic' ELSE 'Other' END AS origin,
             _ingested_at
      FROM raw_leads)
    QUALIFY row_number() OVER (PARTITION BY mql_id
                               ORDER BY _ingested_at DESC, first_contact_date, landing_page_id, origin) = 1
"""
BLOCKS["s_deals"] = f"""
    SELECT mql_id, seller_id, coalesce(sdr_id, 'UNKNOWN') AS sdr_id, coalesce(sr_id, 'UNKNOWN') AS sr_id,
           coalesce(try_cast(won_date AS TIMESTAMP)::DATE, DATE '1900-01-01') AS won_date,
           coalesce({_title("coalesce(trim(business_segment), '')")}, 'Not Specified') AS business_segment,
           CASE lower(trim(lead_type)) WHEN 'online_big' THEN 'Online Big' WHEN 'online_medium' THEN 'Online Medium'
                WHEN 'online_small' THEN 'Online Small' WHEN 'industry' THEN 'Industry' WHEN 'offline' THEN 'Offline'
                ELSE 'Not Specified' END AS lead_type,
           CASE lower(trim(lead_behaviour_profile)) WHEN 'cat' THEN 'Cat' WHEN 'eagle' THEN 'Eagle' WHEN 'wolf' THEN 'Wolf'
                WHEN 'shark' THEN 'Shark' ELSE 'Not Specified' END AS lead_behaviour_profile,
           coalesce(has_company, 0) AS has_company, coalesce(has_gtin, 0) AS has_gtin,
           coalesce(trim(average_stock), 'Not Specified') AS average_stock,
           CASE lower(trim(business_type)) WHEN 'reseller' THEN 'Reseller' WHEN 'manufacturer' THEN 'Manufacturer'
                WHEN 'others' THEN 'Other' ELSE 'Not Specified' END AS business_type,
           coalesce(declared_product_catalog_size, 0)::DECIMAL(10,2) AS declared_product_catalog_size,
           declared_monthly_revenue::DECIMAL(10,2) AS declared_monthly_revenue
    FROM raw_deals
    QUALIFY row_number() OVER (PARTITION BY mql_id ORDER BY _ingested_at DESC, seller_id, sdr_id, sr_id) = 1
"""

# --- star -------------------------------------------------------------------

BLOCKS["dim_date"] = """
    SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, d AS full_date, isodow(d) AS day_of_week_num,
           dayname(d) AS day_of_week_name, left(dayname(d), 3) AS day_of_week_name_short, day(d) AS day_of_month,
           dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year, month(d) AS month_num, monthname(d) AS month_name,
           left(monthname(d), 3) AS month_name_short, quarter(d) AS quarter_num, 'Q' || quarter(d) AS quarter_name,
           year(d) AS year, strftime(d, '%Y-%m') AS year_month, isodow(d) >= 6 AS is_weekend, FALSE AS is_holiday
    FROM (SELECT unnest(generate_series(date_trunc('year', lo), make_date(year(hi), 12, 31), INTERVAL 1 DAY))::DATE AS d
          FROM (SELECT min(purchase) AS lo, max(purchase) AS hi FROM s_orders WHERE year(purchase) NOT IN (1900, 9999)))
    UNION ALL
    SELECT 19000101, DATE '1900-01-01', 1, 'Unknown', 'Unk', 1, 1, 1, 1, 'Unknown', 'Unk', 1, 'Q1', 1900, '1900-01', FALSE, FALSE
    UNION ALL
    SELECT 99991231, DATE '9999-12-31', 1, 'Unknown', 'Unk', 31, 365, 52, 12, 'Unknown', 'Unk', 4, 'Q4', 9999, '9999-12', FALSE, FALSE
"""


def _keyed(source: str, bk: str, sk: str, cols: str) -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY substr(md5({bk}), 1, 3), {bk}) AS {sk}, {bk} AS {bk}_bk, {cols} FROM ({source})
    """


BLOCKS["dim_customer"] = (
    _keyed(
        """SELECT * FROM s_customers QUALIFY row_number() OVER (PARTITION BY customer_unique_id
           ORDER BY _ingested_at DESC, customer_id) = 1""",
        "customer_unique_id",
        "customer_sk",
        "customer_zip_code_prefix, customer_city, customer_state",
    )
    + " UNION ALL SELECT -1, 'UNKNOWN', '00000', 'UNKNOWN', 'UN'"
)
BLOCKS["dim_product"] = (
    _keyed(
        "SELECT * FROM s_products",
        "product_id",
        "product_sk",
        """product_category_name, product_name_length, product_description_length, product_photos_qty, product_weight_g,
           product_length_cm, product_height_cm, product_width_cm""",
    )
    + " UNION ALL SELECT -1, 'UNKNOWN', 'Not Specified', NULL, NULL, NULL, NULL, NULL, NULL, NULL"
)
BLOCKS["dim_seller"] = (
    _keyed("SELECT * FROM s_sellers", "seller_id", "seller_sk", "seller_zip_code_prefix, seller_city, seller_state")
    + " UNION ALL SELECT -1, 'UNKNOWN', '00000', 'UNKNOWN', 'UN'"
)
BLOCKS["dim_channel"] = _keyed(
    """SELECT l.mql_id, l.origin, l.landing_page_id, d.business_segment, d.lead_type, d.lead_behaviour_profile,
              d.business_type, d.average_stock, coalesce(d.has_company, 0) AS has_company, coalesce(d.has_gtin, 0) AS has_gtin
       FROM s_leads l LEFT JOIN s_deals d USING (mql_id)""",
    "mql_id",
    "mql_channel_sk",
    """origin, landing_page_id, business_segment, lead_type, lead_behaviour_profile, business_type, average_stock,
       has_company, has_gtin""",
)
BLOCKS["order_cust"] = """
    SELECT o.order_id, o.purchase, coalesce(dc.customer_sk, -1) AS customer_sk
    FROM s_orders o JOIN s_customers c USING (customer_id)
    LEFT JOIN dim_customer dc ON dc.customer_unique_id_bk = c.customer_unique_id
"""


def _key(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))::INT"


BLOCKS["f_items"] = f"""
    SELECT {_key('oc.purchase')} AS purchase_date_key, {_key('i.shipping_limit_date')} AS shipping_limit_date_key,
           oc.purchase AS day, oc.customer_sk, coalesce(p.product_sk, -1) AS product_sk, coalesce(s.seller_sk, -1) AS seller_sk,
           i.order_id AS order_id_bk, i.order_item_id AS order_item_id_bk, i.unit_price, i.unit_freight_value,
           i.unit_price + i.unit_freight_value AS line_total
    FROM s_items i JOIN order_cust oc USING (order_id)
    LEFT JOIN dim_product p ON p.product_id_bk = i.product_id LEFT JOIN dim_seller s ON s.seller_id_bk = i.seller_id
"""
BLOCKS["dim_pay"] = """
    SELECT * FROM (VALUES (1, 'Credit Card'), (2, 'Debit Card'), (3, 'Boleto'), (4, 'Voucher'), (5, 'Not Specified'))
      t(payment_type_sk, payment_type)
"""
BLOCKS["dim_status"] = """
    SELECT * FROM (VALUES (1, 'created'), (2, 'approved'), (3, 'invoiced'), (4, 'processing'), (5, 'shipped'),
      (6, 'delivered'), (7, 'canceled'), (8, 'unavailable')) t(order_status_sk, order_status)
"""
BLOCKS["f_payments"] = f"""
    SELECT {_key('oc.purchase')} AS purchase_date_key, oc.purchase AS day, oc.customer_sk,
           coalesce(t.payment_type_sk, 5) AS payment_type_sk, p.order_id AS order_id_bk,
           p.payment_sequential AS payment_sequential_bk, p.payment_value, p.payment_installments
    FROM s_payments p JOIN order_cust oc USING (order_id) LEFT JOIN dim_pay t USING (payment_type)
"""
BLOCKS["f_reviews"] = f"""
    SELECT row_number() OVER (ORDER BY substr(md5(r.order_id), 1, 3), r.order_id) AS review_sk,
           {_key('r.created')} AS review_creation_date_key,
           CASE WHEN r.answered = DATE '1900-01-01' THEN 99991231 ELSE {_key('r.answered')} END AS review_answer_date_key,
           CASE WHEN r.answered = DATE '1900-01-01' THEN DATE '9999-12-31' ELSE r.answered END AS day,
           oc.customer_sk, r.review_id AS review_id_bk, r.order_id AS order_id_bk, r.review_score,
           CASE WHEN lower(r.review_comment_title) <> 'no title' THEN r.review_comment_title END AS title,
           CASE WHEN lower(r.review_comment_message) <> 'no message' THEN r.review_comment_message END AS message
    FROM s_reviews r JOIN order_cust oc USING (order_id)
"""


def _days(a: str, b: str) -> str:
    ends = "(DATE '1900-01-01', DATE '9999-12-31')"
    return f"CASE WHEN {a} NOT IN {ends} AND {b} NOT IN {ends} THEN date_diff('day', {a}, {b}) END"


BLOCKS["f_life"] = f"""
    SELECT {_key('o.purchase')} AS purchase_date_key, {_key('o.approved')} AS approval_date_key,
           {_key('o.carrier')} AS carrier_date_key, {_key('o.delivered')} AS delivery_date_key,
           {_key('o.estimated')} AS estimated_delivery_date_key, o.purchase AS day, o.approved AS approval_day,
           oc.customer_sk, coalesce(st.order_status_sk, 1) AS order_status_sk, coalesce(st.order_status, 'created') AS order_status,
           o.order_id AS order_id_bk,
           {_days('o.purchase', 'o.approved')} AS days_to_approve, {_days('o.approved', 'o.carrier')} AS days_to_ship,
           {_days('o.carrier', 'o.delivered')} AS days_to_deliver,
           {_days('o.purchase', 'o.delivered')} AS days_purchase_to_delivery,
           {_days('o.estimated', 'o.delivered')} AS days_delivery_variance,
           {_days('o.estimated', 'o.delivered')} <= 0 AS is_delivered_on_time,
           coalesce(i.total_items, 0) AS total_items, coalesce(i.products, 0) AS total_distinct_products,
           coalesce(i.sellers, 0) AS total_distinct_sellers, coalesce(i.order_value, 0) AS total_order_value,
           coalesce(i.freight, 0) AS total_freight_value, coalesce(p.paid, 0) AS total_payment_value
    FROM s_orders o JOIN order_cust oc USING (order_id) LEFT JOIN dim_status st USING (order_status)
    LEFT JOIN (SELECT order_id, count(*) AS total_items, count(DISTINCT product_id) AS products,
                      count(DISTINCT seller_id) AS sellers, sum(unit_price) AS order_value, sum(unit_freight_value) AS freight
               FROM s_items GROUP BY 1) i USING (order_id)
    LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM s_payments GROUP BY 1) p USING (order_id)
"""
BLOCKS["f_funnel"] = f"""
    SELECT row_number() OVER (ORDER BY substr(md5(d.mql_id), 1, 3), d.mql_id) AS closed_deal_sk,
           {_key('l.first_contact_date')} AS first_contact_date_key, {_key('d.won_date')} AS won_date_key,
           l.first_contact_date AS day, coalesce(s.seller_sk, -1) AS seller_sk, coalesce(c.mql_channel_sk, -1) AS mql_channel_sk,
           d.mql_id AS mql_id_bk, nullif(d.sdr_id, 'UNKNOWN') AS sdr_id_bk, nullif(d.sr_id, 'UNKNOWN') AS sr_id_bk,
           {_days('l.first_contact_date', 'd.won_date')} AS days_to_close, d.declared_monthly_revenue,
           d.declared_product_catalog_size
    FROM s_deals d JOIN s_leads l USING (mql_id) LEFT JOIN dim_seller s ON s.seller_id_bk = d.seller_id
    LEFT JOIN dim_channel c ON c.mql_id_bk = d.mql_id
"""
BLOCKS["main_pay"] = """
    SELECT order_id_bk, payment_type_sk, max(payment_installments) AS payment_installments
    FROM f_payments GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY order_id_bk ORDER BY sum(payment_value) DESC, payment_type_sk) = 1
"""
BLOCKS["first_line"] = """
    SELECT order_id_bk, product_sk, seller_sk FROM f_items
    QUALIFY row_number() OVER (PARTITION BY order_id_bk ORDER BY order_item_id_bk) = 1
"""
BLOCKS["last_deal"] = """
    SELECT seller_sk, mql_channel_sk, days_to_close FROM f_funnel WHERE seller_sk <> -1
    QUALIFY row_number() OVER (PARTITION BY seller_sk ORDER BY won_date_key DESC, mql_id_bk) = 1
"""
BLOCKS["flat"] = """
    SELECT o.order_id_bk AS order_id, dd.full_date AS purchase_date, dd.year AS purchase_year, dd.month_num AS purchase_month,
           dd.month_name AS purchase_month_name, dd.day_of_week_name AS purchase_day_of_week,
           dd.is_weekend AS is_weekend_purchase, st.order_status, dc.customer_unique_id_bk AS customer_unique_id,
           dc.customer_state, dc.customer_city, o.days_to_approve, o.days_to_ship, o.days_to_deliver,
           o.days_purchase_to_delivery, o.days_delivery_variance, o.is_delivered_on_time, o.total_items,
           o.total_distinct_products, o.total_distinct_sellers, o.total_order_value, o.total_freight_value,
           o.total_payment_value, pt.payment_type, mp.payment_installments, dp.product_category_name,
           ds.seller_id_bk AS seller_id, ds.seller_state, ds.seller_city, fr.review_score, ch.origin AS marketing_origin,
           ld.days_to_close, ch.business_segment, ch.lead_type, ch.business_type
    FROM f_life o LEFT JOIN dim_date dd ON dd.date_key = o.purchase_date_key
    LEFT JOIN dim_customer dc USING (customer_sk) LEFT JOIN dim_status st ON st.order_status_sk = o.order_status_sk
    LEFT JOIN f_reviews fr USING (order_id_bk) LEFT JOIN main_pay mp USING (order_id_bk)
    LEFT JOIN dim_pay pt ON pt.payment_type_sk = mp.payment_type_sk LEFT JOIN first_line fl USING (order_id_bk)
    LEFT JOIN dim_product dp ON dp.product_sk = fl.product_sk LEFT JOIN dim_seller ds ON ds.seller_sk = fl.seller_sk
    LEFT JOIN last_deal ld ON ld.seller_sk = ds.seller_sk LEFT JOIN dim_channel ch ON ch.mql_channel_sk = ld.mql_channel_sk
"""
BLOCKS["done"] = "SELECT * FROM flat WHERE order_status = 'delivered'"



def sql(query: str, **extra: str) -> str:
    """The query with every block it names, directly or through another block."""
    blocks = {**BLOCKS, **extra}
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z0-9_]+", text):
            if word in blocks and word not in wanted:
                wanted.add(word)
                visit(blocks[word])

    visit(query)
    order = [b for b in blocks if b in wanted]
    if not order:
        return query.strip()
    ctes = ",\n".join(f"{b} AS ({blocks[b].strip()})" for b in order)
    return f"WITH {ctes}\n{query.strip()}"
