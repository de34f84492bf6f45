"""Report pages and customer/seller features."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import add
from checks.tables import loaded
from tradewind.operators.metrics import area_under_roc, threshold_figures
from tradewind.operators.summaries import histogram
from tradewind.plans import dashboards, features, models


def done(spark, folder):
    return dashboards.delivered(loaded(spark, folder)["order_table"])


def on_done(build):
    return lambda spark, folder: build(done(spark, folder))


add(
    "global_kpis",
    "total_orders:i total_revenue:n avg_order_value:r on_time_pct:r avg_review:r total_customers:i",
    on_done(dashboards.business_kpis),
    """SELECT count(*) AS total_orders, sum(total_order_value) AS total_revenue,
              sum(total_order_value)::DOUBLE / count(total_order_value) AS avg_order_value,
              avg(is_delivered_on_time::INT) * 100 AS on_time_pct, avg(review_score) AS avg_review,
              count(DISTINCT customer_unique_id) AS total_customers FROM done""",
)
add(
    "monthly_trend",
    "purchase_year:i purchase_month:i period:s orders:i revenue:n",
    on_done(dashboards.monthly_trend),
    """SELECT purchase_year, purchase_month, make_date(purchase_year, purchase_month, 1) AS period, count(*) AS orders,
              sum(total_order_value) AS revenue FROM done GROUP BY 1, 2""",
)
for name, column, k in [
    ("revenue_by_state_top12", "customer_state", 12),
    ("top_categories", "product_category_name", 10),
]:
    add(
        name,
        f"{column}:s revenue:n",
        on_done(lambda d, column=column, k=k: dashboards.revenue_by(d, column, k)),
        f"""SELECT {column}, sum(total_order_value) AS revenue FROM done WHERE {column} IS NOT NULL GROUP BY 1
            ORDER BY revenue DESC, {column} LIMIT {k}""",
    )
for name, column, kind in [("review_distribution", "review_score", "i"), ("payment_mix", "payment_type", "s")]:
    add(
        name,
        f"{column}:{kind} n:i",
        on_done(lambda d, column=column: dashboards.value_counts(d, column)),
        f"SELECT {column}, count(*) AS n FROM done WHERE {column} IS NOT NULL GROUP BY 1",
    )
add(
    "filtered_context",
    "order_status:s customer_state:s orders:i customers:i",
    lambda spark, folder: dashboards.apply_context(
        loaded(spark, folder)["order_table"],
        {
            "purchase_year": [1997, 1998],
            "customer_state": ["SP", "RJ", "MG", "AM"],
            "order_status": ["delivered", "shipped"],
        },
    )
    .groupBy("order_status", "customer_state")
    .agg(F.count("*").alias("orders"), F.count_distinct("customer_unique_id").alias("customers")),
    """SELECT order_status, customer_state, count(*) AS orders, count(DISTINCT customer_unique_id) AS customers FROM flat
       WHERE purchase_year IN (1997, 1998) AND customer_state IN ('SP', 'RJ', 'MG', 'AM')
         AND order_status IN ('delivered', 'shipped') GROUP BY 1, 2""",
)
add(
    "latest_person",
    "customer_unique_id:s order_id:s purchase_date:s total_order_value:n",
    on_done(lambda d: dashboards.latest_order_per_customer(
        d.select("customer_unique_id", "order_id", "purchase_date", "total_order_value"))),
    """SELECT customer_unique_id, order_id, purchase_date, total_order_value FROM done
       QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY purchase_date DESC, order_id) = 1""",
)
add(
    "first_purchase_cohort",
    "month:s new_customers:i",
    on_done(lambda d: dashboards.acquisition(d, since="1995-03")),
    """SELECT coalesce(strftime(first_day, '%Y-%m'), 'unknown') AS month, count(*) AS new_customers
       FROM (SELECT customer_unique_id, min(purchase_date) FILTER (purchase_date <> DATE '1900-01-01') AS first_day
             FROM done WHERE customer_unique_id IS NOT NULL GROUP BY 1)
       GROUP BY 1 HAVING month >= '1995-03' OR month = 'unknown'""",
)
add(
    "delivery_kpis",
    "on_time_pct:r avg_deliver_days:r avg_variance:r late_orders:i",
    on_done(dashboards.delivery_kpis),
    """SELECT avg(is_delivered_on_time::INT) * 100 AS on_time_pct, avg(days_to_deliver) AS avg_deliver_days,
              avg(days_delivery_variance) AS avg_variance, count(*) FILTER (NOT is_delivered_on_time) AS late_orders FROM done""",
)
_HIST = """SELECT least(floor((x - lo) / ((hi - lo) / {n})), {n} - 1) + 1 AS bin, count(*) AS n
           FROM (SELECT x, min(x) OVER () AS lo, max(x) OVER () AS hi FROM ({src})) GROUP BY 1"""
add(
    "delivery_day_histogram",
    "bin:i n:i",
    on_done(dashboards.delivery_day_histogram),
    _HIST.format(n=40, src="SELECT days_to_deliver::DOUBLE AS x FROM done WHERE days_to_deliver BETWEEN 0 AND 60"),
)
add(
    "histogram",
    "bin:i n:i",
    on_done(lambda d: histogram(d, "total_order_value", 50)),
    _HIST.format(n=50, src="SELECT total_order_value::DOUBLE AS x FROM done"),
)
add(
    "category_on_time",
    "product_category_name:s orders:i on_time:r on_time_pct:r",
    on_done(lambda d: dashboards.category_on_time(d, least_orders=100)),
    """SELECT product_category_name, count(*) AS orders, avg(is_delivered_on_time::INT) AS on_time, on_time * 100 AS on_time_pct
       FROM done WHERE product_category_name IS NOT NULL GROUP BY 1 HAVING count(*) >= 100
       ORDER BY on_time DESC NULLS LAST, product_category_name LIMIT 12""",
)
add(
    "monthly_variance",
    "purchase_year:i purchase_month:i avg_variance:r",
    on_done(dashboards.monthly_variance),
    """SELECT purchase_year, purchase_month, avg(days_delivery_variance) AS avg_variance FROM done GROUP BY 1, 2""",
)
add(
    "fixed_sample",
    "order_id:s review_score:n days_to_deliver:n",
    on_done(
        lambda d: dashboards.fixed_sample(d.dropna(subset=["review_score", "days_to_deliver"]), "order_id", 3000)
    ),
)
_PROFILE = """
    SELECT seller_id, count(*) AS total_orders, sum(total_order_value) AS total_revenue, avg(review_score) AS avg_review,
           avg(is_delivered_on_time::INT) AS pct_on_time,
           arg_min(seller_state, (coalesce(nullif(purchase_date, DATE '1900-01-01'), DATE '9999-12-31'), order_id)) AS seller_state,
           arg_min(seller_city, (coalesce(nullif(purchase_date, DATE '1900-01-01'), DATE '9999-12-31'), order_id)) AS seller_city,
           arg_min(marketing_origin, (coalesce(nullif(purchase_date, DATE '1900-01-01'), DATE '9999-12-31'), order_id)) FILTER (marketing_origin IS NOT NULL) AS marketing_origin,
           arg_min(payment_type, (coalesce(nullif(purchase_date, DATE '1900-01-01'), DATE '9999-12-31'), order_id)) FILTER (payment_type IS NOT NULL) AS payment_type
    FROM done WHERE seller_id IS NOT NULL GROUP BY 1
"""
_PLAIN = ["seller_state", "seller_city", "marketing_origin", "payment_type"]


def profile(spark, folder):
    return dashboards.seller_profile(done(spark, folder), _PLAIN)


add(
    "seller_profile",
    "seller_id:s total_orders:i total_revenue:n avg_review:r pct_on_time:r seller_state:s seller_city:s "
    "marketing_origin:s payment_type:s",
    profile,
    "SELECT * FROM profile",
    profile=_PROFILE,
)
add(
    "sellers_by_state",
    "seller_state:s sellers:i revenue:n",
    lambda s, f: dashboards.sellers_by_state(profile(s, f)),
    """SELECT seller_state, count(*) AS sellers, sum(total_revenue) AS revenue FROM profile WHERE seller_state IS NOT NULL
       GROUP BY 1 ORDER BY revenue DESC, seller_state LIMIT 15""",
    profile=_PROFILE,
)
add(
    "seller_channels",
    "marketing_origin:s n:i",
    lambda s, f: dashboards.value_counts(profile(s, f), "marketing_origin"),
    "SELECT marketing_origin, count(*) AS n FROM profile WHERE marketing_origin IS NOT NULL GROUP BY 1",
    profile=_PROFILE,
)
add(
    "top_sellers",
    "seller:s seller_state:s total_orders:i revenue_text:s total_revenue:n",
    lambda s, f: dashboards.top_sellers(profile(s, f)),
    """SELECT left(seller_id, 12) || '...' AS seller, seller_state, total_orders, total_revenue,
              'R$' || format('{:,}', round_even(total_revenue::DOUBLE, 0)::BIGINT) AS revenue_text
       FROM profile ORDER BY total_revenue DESC, seller_id LIMIT 20""",
    profile=_PROFILE,
)

# --- features ---------------------------------------------------------------

_RFM = """
    SELECT customer_unique_id, date_diff('day', max(purchase_date) FILTER (purchase_date <> DATE '1900-01-01'), DATE '2001-08-31') AS recency_days,
           count(*) AS frequency_orders, sum(total_order_value) AS monetary_total
    FROM done WHERE customer_unique_id IS NOT NULL GROUP BY 1
"""


ANCHOR = "2001-08-31"

add(
    "rfm_features",
    "customer_unique_id:s recency_days:i frequency_orders:i monetary_total:n",
    lambda s, f: features.rfm(done(s, f), ANCHOR),
    "SELECT * FROM rfm",
    rfm=_RFM,
)
_CHURN = """
    SELECT customer_unique_id, date_diff('day', max(purchase_date) FILTER (purchase_date <> DATE '1900-01-01'), DATE '2001-08-31') AS recency_days,
           count(*) AS frequency, sum(total_order_value) AS monetary,
           sum(total_order_value)::DOUBLE / count(*) AS avg_order_value, avg(review_score) AS avg_review_score,
           avg(is_delivered_on_time::INT) AS pct_on_time, avg(days_to_deliver) AS avg_days_deliver,
           avg(days_delivery_variance) AS avg_variance,
           CASE WHEN recency_days > 180 THEN 1 WHEN recency_days <= 180 THEN 0 END AS churned
    FROM done WHERE customer_unique_id IS NOT NULL GROUP BY 1
"""
add(
    "churn_features",
    "customer_unique_id:s recency_days:i frequency:i monetary:n avg_order_value:r avg_review_score:r pct_on_time:r "
    "avg_days_deliver:r avg_variance:r churned:i",
    lambda s, f: features.churn(done(s, f), ANCHOR),
    "SELECT * FROM churn",
    churn=_CHURN,
)
add(
    "scaled_rfm",
    "customer_unique_id:s recency:r frequency:r log_value:r",
    lambda s, f: models.standardised(models.rfm_filled(done(s, f), ANCHOR), models.SEGMENT_FEATURES, "z").select(
        "customer_unique_id", *[F.col("z")[i].alias(c) for i, c in enumerate(["recency", "frequency", "log_value"])]
    ),
    """
    WITH x AS (
      SELECT customer_unique_id, coalesce(recency_days, max(recency_days) OVER (), 0)::DOUBLE AS a,
             frequency_orders::DOUBLE AS b, ln(1 + monetary_total::DOUBLE) AS c FROM rfm),
    m AS (
      SELECT avg(round(a * 1e6)) / 1e6 AS ma, stddev_samp(round(a * 1e6)) / 1e6 AS sa,
             avg(round(b * 1e6)) / 1e6 AS mb, stddev_samp(round(b * 1e6)) / 1e6 AS sb,
             avg(round(c * 1e6)) / 1e6 AS mc, stddev_samp(round(c * 1e6)) / 1e6 AS sc FROM x)
    SELECT customer_unique_id, CASE WHEN sa > 0 THEN (a - ma) / sa ELSE 0 END AS recency,
           CASE WHEN sb > 0 THEN (b - mb) / sb ELSE 0 END AS frequency,
           CASE WHEN sc > 0 THEN (c - mc) / sc ELSE 0 END AS log_value
    FROM x, m
    """,
    rfm=_RFM,
)
add(
    "churn_oversampling",
    "churned:i kept:i made:i",
    lambda s, f: models.oversampled_churn(done(s, f), ANCHOR)
    .groupBy("churned")
    .agg(F.count_if(~F.col("made")).alias("kept"), F.count_if("made").alias("made")),
    """
    WITH classes AS (SELECT churned, count(*) AS kept FROM churn WHERE churned IS NOT NULL GROUP BY churned)
    SELECT churned, kept, (SELECT max(kept) FROM classes) - kept AS made FROM classes
    """,
    churn=_CHURN,
)
add(
    "churn_rate",
    "customers:i churn_rate:r",
    lambda s, f: features.churn(done(s, f), ANCHOR).agg(
        F.count("*").alias("customers"), F.avg("churned").alias("churn_rate")
    ),
    "SELECT count(*) AS customers, avg(churned) AS churn_rate FROM churn",
    churn=_CHURN,
)
_TIERS = """
    SELECT customer_unique_id, monetary_total,
           CASE WHEN above < 0.1 THEN 'Platinum' WHEN above < 0.3 THEN 'Gold' WHEN above < 0.6 THEN 'Silver' ELSE 'Bronze' END
             AS ltv_tier
    FROM (SELECT *, (rank() OVER (ORDER BY monetary_total DESC) - 1)::DOUBLE / count(*) OVER () AS above FROM rfm)
"""
add(
    "ltv_tiers",
    "customer_unique_id:s monetary_total:n ltv_tier:s",
    lambda s, f: features.ltv_tiers(features.rfm(done(s, f), ANCHOR)),
    "SELECT * FROM tiers",
    rfm=_RFM,
    tiers=_TIERS,
)


def tiered(spark, folder):
    orders = done(spark, folder)
    return orders.join(features.ltv_tiers(features.rfm(orders, ANCHOR)), "customer_unique_id", "left")


_TIERED = "SELECT d.*, t.ltv_tier FROM done d LEFT JOIN tiers t USING (customer_unique_id)"
add(
    "segment_stats",
    "ltv_tier:s customers:i avg_order_value:r avg_review:r",
    lambda s, f: dashboards.segment_stats(tiered(s, f), "ltv_tier"),
    """SELECT ltv_tier, count(DISTINCT customer_unique_id) AS customers,
              sum(total_order_value)::DOUBLE / count(*) AS avg_order_value, avg(review_score) AS avg_review
       FROM tiered WHERE ltv_tier IS NOT NULL GROUP BY 1""",
    rfm=_RFM,
    tiers=_TIERS,
    tiered=_TIERED,
)
add(
    "segment_state_matrix",
    "customer_state:s ltv_tier:s revenue:n",
    lambda s, f: dashboards.segment_state_revenue(tiered(s, f), "ltv_tier"),
    """SELECT customer_state, ltv_tier, sum(total_order_value) AS revenue FROM tiered
       WHERE ltv_tier IS NOT NULL AND customer_state IN
         (SELECT customer_state FROM tiered GROUP BY 1 ORDER BY count(*) DESC, customer_state LIMIT 8) GROUP BY 1, 2""",
    rfm=_RFM,
    tiers=_TIERS,
    tiered=_TIERED,
)
add(
    "customer_feature_table",
    "customer_unique_id:s customer_state:s frequency_orders:i monetary_total:n recency_days:i churned:i avg_installments:r "
    "categories:i",
    lambda s, f: features.customer_table(done(s, f), ANCHOR),
    """SELECT customer_unique_id, arg_max(customer_state, (purchase_date, order_id)) AS customer_state,
              count(*) AS frequency_orders, sum(total_order_value) AS monetary_total,
              date_diff('day', max(purchase_date) FILTER (purchase_date <> DATE '1900-01-01'), DATE '2001-08-31') AS recency_days,
              CASE WHEN recency_days > 180 THEN 1 WHEN recency_days <= 180 THEN 0 END AS churned, avg(payment_installments) AS avg_installments,
              count(DISTINCT product_category_name) AS categories
       FROM done WHERE customer_unique_id IS NOT NULL GROUP BY 1""",
)
_KPI = """
    SELECT seller_id, count(*) AS total_orders, avg(review_score) AS avg_review_score,
           avg(is_delivered_on_time::INT) AS pct_on_time, sum(total_order_value) AS total_revenue
    FROM done WHERE seller_id IS NOT NULL GROUP BY 1
"""


def _scaled(c: str) -> str:
    return (
        f"coalesce((coalesce({c}, min({c}) OVER ()) - min({c}) OVER ())::DOUBLE / "
        f"nullif((max({c}) OVER () - min({c}) OVER ())::DOUBLE, 0), 0)"
    )


add(
    "seller_score",
    "seller_id:s total_orders:i avg_review_score:r pct_on_time:r total_revenue:n seller_performance_score:r",
    lambda s, f: features.seller_scores(done(s, f)),
    f"""SELECT *, ({_scaled('avg_review_score')} * 0.35 + {_scaled('pct_on_time')} * 0.30 + {_scaled('total_revenue')} * 0.20
              + {_scaled('total_orders')} * 0.15) * 100 AS seller_performance_score FROM kpi""",
    kpi=_KPI,
)
add(
    "seller_feature_table",
    "seller_id:s total_orders:i total_revenue:n seller_state:s marketing_origin:s days_to_close:n",
    lambda s, f: features.seller_table(done(s, f)),
    """SELECT seller_id, count(*) AS total_orders, sum(total_order_value) AS total_revenue,
              arg_min(seller_state, (coalesce(nullif(purchase_date, DATE '1900-01-01'), DATE '9999-12-31'), order_id)) AS seller_state,
              arg_min(marketing_origin, (coalesce(nullif(purchase_date, DATE '1900-01-01'), DATE '9999-12-31'), order_id)) FILTER (marketing_origin IS NOT NULL) AS marketing_origin,
              arg_min(days_to_close, (coalesce(nullif(purchase_date, DATE '1900-01-01'), DATE '9999-12-31'), order_id)) FILTER (days_to_close IS NOT NULL) AS days_to_close
       FROM done WHERE seller_id IS NOT NULL GROUP BY 1""",
)
add(
    "order_feature_table",
    "order_id:s is_late:i total_items:i payment_installments:n purchase_day_of_week:s product_category_name:s "
    "seller_state:s customer_state:s days_to_approve:n days_to_ship:n",
    lambda s, f: features.delay(done(s, f)),
    """SELECT order_id, 1 - is_delivered_on_time::INT AS is_late, total_items,
              coalesce(payment_installments, 0) AS payment_installments, purchase_day_of_week,
              coalesce(product_category_name, 'Unknown') AS product_category_name,
              coalesce(seller_state, 'Unknown') AS seller_state, coalesce(customer_state, 'Unknown') AS customer_state,
              coalesce(days_to_approve, 0) AS days_to_approve, coalesce(days_to_ship, 0) AS days_to_ship
       FROM done WHERE is_delivered_on_time IS NOT NULL""",
)


def _score_metrics(orders):
    """How well the days on the way tell a bad review, over all thresholds and at some."""
    told = orders.select(F.col("days_purchase_to_delivery").alias("score"), (F.col("review_score") <= 2).cast("int").alias("bad"))
    figures = threshold_figures(told, "score", "bad", [5, 10, 15, 20, 25])
    area = area_under_roc(told, "score", "bad").select("area").scalar()
    return figures.withColumn("area", area)


add(
    "score_metrics",
    "threshold:n hits:i false_alarms:i misses:i precision:r recall:r f1:r area:r",
    on_done(_score_metrics),
    """WITH told AS (
         SELECT days_purchase_to_delivery AS score, (review_score <= 2)::INT AS bad FROM done
         WHERE days_purchase_to_delivery IS NOT NULL AND review_score IS NOT NULL),
       ranks AS (
         SELECT bad, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM told),
       area AS (
         SELECT (sum(r) FILTER (bad = 1) - sum(bad) * (sum(bad) + 1) / 2.0) / (sum(bad) * sum(1 - bad)) AS area FROM ranks),
       cells AS (
         SELECT t AS threshold, count(*) FILTER (score >= t AND bad = 1) AS hits, count(*) FILTER (score >= t AND bad = 0) AS false_alarms,
                count(*) FILTER (score < t AND bad = 1) AS misses
         FROM told, (VALUES (5), (10), (15), (20), (25)) v(t) GROUP BY t)
       SELECT threshold, hits, false_alarms, misses, hits::DOUBLE / nullif(hits + false_alarms, 0) AS precision,
              hits::DOUBLE / nullif(hits + misses, 0) AS recall,
              2.0 * hits / nullif(2 * hits + false_alarms + misses, 0) AS f1, area
       FROM cells, area""",
)
