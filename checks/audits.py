"""Audits of the cleaned tables and the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import add
from checks.tables import _raw_frames, loaded
from tradewind.plans import cleaning, quality
from tradewind.plans.warehouse import DIMENSIONS, FACTS

# table name, raw block, cleaned block
_PAIRS = [
    ("customers", "raw_customers", "s_customers"),
    ("orders", "raw_orders", "s_orders"),
    ("order_items", "raw_items", "s_items"),
    ("order_payments", "raw_payments", "s_payments"),
    ("order_reviews", "raw_reviews", "s_reviews"),
    ("sellers", "raw_sellers", "s_sellers"),
    ("products", "part", "s_products"),
    ("marketing_qualified_leads", "raw_leads", "s_leads"),
    ("closed_deals", "raw_deals", "s_deals"),
]


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


add(
    "raw_against_clean",
    "table_name:s raw_rows:i clean_rows:i dupes_removed:i",
    lambda s, f: quality.raw_against_clean(_raw_frames(s, f), loaded(s, f), list(cleaning.JOBS)),
    _union(
        f"""SELECT '{n}' AS table_name, (SELECT count(*) FROM {r}) AS raw_rows, (SELECT count(*) FROM {c}) AS clean_rows,
            (SELECT count(*) FROM {r}) - (SELECT count(*) FROM {c}) AS dupes_removed"""
        for n, r, c in _PAIRS
    ),
)
add(
    "raw_counts",
    "table_name:s row_count:i",
    lambda s, f: quality.table_counts(_raw_frames(s, f), list(_raw_frames(s, f))),
    _union(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {r}" for n, r, _ in _PAIRS)
    + " UNION ALL SELECT 'product_category_name_translation', count(*) FROM part WHERE p_name NOT LIKE 'blue%'"
    + " UNION ALL SELECT 'geolocation', count(*) FROM raw_places",
)
add(
    "table_counts",
    "table_name:s row_count:i",
    lambda s, f: quality.table_counts(loaded(s, f), DIMENSIONS + FACTS),
    _union(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {b}"
        for n, b in [
            ("dim_date", "dim_date"),
            ("dim_customer", "dim_customer"),
            ("dim_product", "dim_product"),
            ("dim_seller", "dim_seller"),
            ("dim_marketing_channel", "dim_channel"),
            ("dim_payment_type", "dim_pay"),
            ("dim_order_status", "dim_status"),
            ("fact_order_items", "f_items"),
            ("fact_payments", "f_payments"),
            ("fact_reviews", "f_reviews"),
            ("review_comments", "f_reviews"),
            ("fact_order_life_cycle", "f_life"),
            ("fact_marketing_funnel", "f_funnel"),
        ]
    ),
)
_BLOCK = {n: c for n, _, c in _PAIRS}
_COLUMN = {
    "order_purchase_date": "purchase",
    "order_delivered_carrier_date": "carrier",
    "order_delivered_customer_date": "delivered",
    "review_creation_date": "created",
    "review_answer_date": "answered",
}


def _c(column: str) -> str:
    return _COLUMN.get(column, column)


add(
    "null_audit",
    "check_name:s cnt:i",
    lambda s, f: quality.null_audit(loaded(s, f)),
    _union(
        f"SELECT '{t}.{c} NULL' AS check_name, count(*) AS cnt FROM {_BLOCK[t]} WHERE {_c(c)} IS NULL"
        for t, cols in quality.NULL_CHECKS.items()
        for c in cols
    ),
)
add(
    "sentinel_audit",
    "check_name:s cnt:i",
    lambda s, f: quality.sentinel_audit(loaded(s, f)),
    _union(
        f"SELECT '{t}: {c} = {d}' AS check_name, count(*) AS cnt FROM {_BLOCK[t]} WHERE {_c(c)} = DATE '{d}'"
        for t, c, d in quality.SENTINELS
    ),
)
add(
    "category_distributions",
    "attribute:s value:s cnt:i",
    lambda s, f: quality.distributions(loaded(s, f)),
    _union(
        f"SELECT '{t}.{c}' AS attribute, {c} AS value, count(*) AS cnt FROM {_BLOCK[t]} GROUP BY 2"
        for t, c in quality.DISTRIBUTIONS
    ),
)
add(
    "unspecified_categories",
    "check_name:s cnt:i",
    lambda s, f: quality.unspecified_categories(loaded(s, f)["products"]),
    """SELECT 'products with No Category' AS check_name, count(*) AS cnt FROM s_products
       WHERE product_category_name = 'Not Specified'""",
)
add(
    "title_case_audit",
    "product_category_name:s cnt:i",
    # the raw spelling is audited here, because the cleaned one has no violation to show
    lambda s, f: quality.title_case_audit(_raw_frames(s, f)["products"]),
    """SELECT product_category_name, count(*) AS cnt
       FROM (SELECT CASE WHEN p_partkey % 50 = 1 THEN '' WHEN p_partkey % 50 <> 0 THEN replace(lower(p_name), ' ', '_') END
                    AS product_category_name FROM part)
       WHERE product_category_name LIKE '%\\_%' ESCAPE '\\' OR product_category_name = lower(product_category_name) GROUP BY 1""",
)
add(
    "zip_length_audit",
    "tbl:s checked:i wrong:i",
    lambda s, f: _zip_summary(loaded(s, f)),
    """SELECT 'customers' AS tbl, count(customer_zip_code_prefix) AS checked,
              count(*) FILTER (length(customer_zip_code_prefix) <> 5) AS wrong FROM s_customers
       UNION ALL SELECT 'sellers', count(seller_zip_code_prefix), count(*) FILTER (length(seller_zip_code_prefix) <> 5)
       FROM s_sellers""",
)


def _zip_summary(w):
    wrong = quality.zip_audit(w).groupBy("tbl").agg(F.count("*").alias("wrong"))
    checked = w["customers"].agg(F.lit("customers").alias("tbl"), F.count("customer_zip_code_prefix").alias("checked"))
    checked = checked.unionByName(
        w["sellers"].agg(F.lit("sellers").alias("tbl"), F.count("seller_zip_code_prefix").alias("checked"))
    )
    return checked.join(wrong, "tbl", "left").withColumn("wrong", F.coalesce("wrong", F.lit(0)))


_KEYS = {**{k: v for k, v in quality.PRIMARY_KEYS.items()}}
add(
    "pk_audit",
    "tbl:s dup_pk_rows:i",
    lambda s, f: quality.key_audit(loaded(s, f)),
    _union(
        f"SELECT '{t}' AS tbl, count(*) - count(DISTINCT ({', '.join(k)})) AS dup_pk_rows FROM {_BLOCK[t]}"
        for t, k in _KEYS.items()
    ),
)
add(
    "raw_pk_audit",
    "tbl:s dup_pk_rows:i",
    lambda s, f: quality.key_audit(
        _raw_frames(s, f),
        {
            "order_items": ["order_id", "order_item_id"],
            "order_reviews": ["order_id"],
            "marketing_qualified_leads": ["mql_id"],
            "closed_deals": ["mql_id"],
        },
    ),
    """SELECT 'order_items' AS tbl, count(*) - count(DISTINCT (order_id, order_item_id)) AS dup_pk_rows FROM raw_items
       UNION ALL SELECT 'order_reviews', count(*) - count(DISTINCT order_id) FROM raw_reviews
       UNION ALL SELECT 'marketing_qualified_leads', count(*) - count(DISTINCT mql_id) FROM raw_leads
       UNION ALL SELECT 'closed_deals', count(*) - count(DISTINCT mql_id) FROM raw_deals""",
)
add(
    "fk_audit",
    "check_name:s orphan_rows:i",
    lambda s, f: quality.reference_audit(loaded(s, f)),
    _union(
        f"""SELECT '{c}.{k} -> {p}' AS check_name, count(*) AS orphan_rows FROM {_BLOCK[c]} c
            WHERE {f"c.{k} <> '{x}' AND" if x else ""} NOT EXISTS (SELECT 1 FROM {_BLOCK[p]} p WHERE p.{pk} = c.{k})"""
        for c, k, p, pk, x in quality.REFERENCES
    ),
)
_STAR_BLOCK = {
    "dim_date": "dim_date",
    "dim_customer": "dim_customer",
    "dim_product": "dim_product",
    "dim_seller": "dim_seller",
    "dim_marketing_channel": "dim_channel",
    "dim_payment_type": "dim_pay",
    "dim_order_status": "dim_status",
    "fact_order_items": "f_items",
    "fact_payments": "f_payments",
    "fact_reviews": "f_reviews",
    "review_comments": "f_reviews",
    "fact_order_life_cycle": "f_life",
    "fact_marketing_funnel": "f_funnel",
}
add(
    "star_pk_audit",
    "tbl:s dup_pk_rows:i",
    lambda s, f: quality.key_audit(loaded(s, f), quality.STAR_KEYS),
    _union(
        f"SELECT '{t}' AS tbl, count(*) - count(DISTINCT ({', '.join(k)})) AS dup_pk_rows FROM {_STAR_BLOCK[t]}"
        for t, k in quality.STAR_KEYS.items()
    ),
)
add(
    "star_fk_audit",
    "check_name:s orphan_rows:i",
    lambda s, f: quality.reference_audit(loaded(s, f), quality.STAR_REFERENCES),
    _union(
        f"""SELECT '{c}.{k} -> {p}' AS check_name, count(*) AS orphan_rows FROM {_STAR_BLOCK[c]} c
            WHERE NOT EXISTS (SELECT 1 FROM {_STAR_BLOCK[p]} p WHERE p.{pk} = c.{k})"""
        for c, k, p, pk, _ in quality.STAR_REFERENCES
    ),
)
add(
    "date_dimension_audit",
    "total_rows:i min_date:s max_date:s sentinel_rows:i",
    lambda s, f: quality.date_dimension_audit(loaded(s, f)["dim_date"]),
    """SELECT count(*) AS total_rows, min(full_date) AS min_date, max(full_date) AS max_date,
              count(*) FILTER (date_key IN (19000101, 99991231)) AS sentinel_rows FROM dim_date""",
)
add(
    "table_preview",
    "order_id:s order_status:s order_purchase_date:s",
    lambda s, f: quality.preview(
        loaded(s, f)["orders"], 5, [F.col("order_purchase_date").desc(), F.col("order_id").asc()]
    ),
    """SELECT order_id, order_status, purchase AS order_purchase_date FROM s_orders ORDER BY purchase DESC, order_id LIMIT 5""",
)
add(
    "schema_profile",
    "table_name:s column_name:s data_type:s is_nullable:b ordinal:i row_count:i",
    lambda s, f: quality.schema_profile(loaded(s, f), DIMENSIONS + FACTS),
)
