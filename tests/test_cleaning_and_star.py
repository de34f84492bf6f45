import datetime as dt
import time
from decimal import Decimal

from pyspark.sql import functions as F

from tradewind.plans import calendar, cleaning, order_table, star
from tradewind.plans.warehouse import Warehouse

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def frame(spark, rows, schema):
    return spark.createDataFrame([(*r, "src") for r in rows], schema + ", _ingested_at timestamp, _source string")


def test_duplicate_keys_that_differ_by_blanks_are_one_customer(spark):
    raw = frame(
        spark,
        [(" c1", "u1", 1151, "sao paulo", "sp", T1), ("c1 ", "u1", 9790, " rio ", "rj", T2), ("c2", "u2", None, None, None, T1)],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix long, customer_city string, customer_state string",
    )
    out = {r.customer_id: r for r in cleaning.clean_customers(raw).collect()}
    assert set(out) == {"c1", "c2"}
    assert (out["c1"].customer_zip_code_prefix, out["c1"].customer_city, out["c1"].customer_state) == ("09790", "RIO", "RJ")
    assert out["c2"].customer_zip_code_prefix is None and out["c2"].customer_city is None


def test_sellers_get_defaults(spark):
    raw = frame(spark, [("s", 5, None, None, T1)], "seller_id string, seller_zip_code_prefix long, seller_city string, seller_state string")
    row = cleaning.clean_sellers(raw).first()
    assert (row.seller_zip_code_prefix, row.seller_city, row.seller_state) == ("00005", "Not Specified", "Not Specified")


def test_product_category_chain(spark):
    measures = ", ".join(
        f"{c} double"
        for c in (
            "product_name_lenght product_description_lenght product_photos_qty product_weight_g product_length_cm "
            "product_height_cm product_width_cm"
        ).split()
    )
    rest = (40.9, None, 1.0, 2.0, 3.0, 4.0, 5.0)
    raw = frame(
        spark,
        [("p1", "cama_mesa", *rest, T1), ("p2", "sem_par", *rest, T1), ("p3", "", *rest, T1), ("p4", None, *rest, T1)],
        f"product_id string, product_category_name string, {measures}",
    )
    names = frame(
        spark,
        [(" cama_mesa", "old_name", T1), ("cama_mesa", "bed__bath_table ", T2)],
        "product_category_name string, product_category_name_english string",
    )
    out = {r.product_id: r for r in cleaning.clean_products(raw, names).collect()}
    assert {k: r.product_category_name for k, r in out.items()} == {
        "p1": "Bed Bath Table",
        "p2": "Sem Par",
        "p3": "Not Specified",
        "p4": "Not Specified",
    }
    assert (out["p1"].product_name_length, out["p1"].product_description_length) == (40, 0)


def orders(spark):
    raw = frame(
        spark,
        [
            ("o1", "c1", " Delivered ", "2018-01-01 10:00:00", "2018-01-02", "2018-01-03", "2018-01-10 09:00:00", "2018-01-10", T1),
            ("o2", "c1", "canceled", None, None, None, None, "2018-02-01", T1),
            ("o3", "c2", "shipped", "2018-01-05", "bad", "2018-01-07", None, "2018-01-20", T1),
            ("o4", "c2", "delivered", "2018-01-05", "2018-01-05", "2018-01-06", "2018-01-25", "2018-01-20", T1),
            ("o5", "cX", "weird", "2018-01-05", "2018-01-05", None, None, None, T1),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string",
    )
    return cleaning.clean_orders(raw)


def items(spark):
    raw = frame(
        spark,
        [
            ("o1", 2, "p2", "s1", "2018-01-04", 10.0, 1.0, T1),
            ("o1", 1, "p1", "s1", "2018-01-04", 20.0, 2.0, T1),
            ("o1", 1, "p1", "s1", "2018-01-04", 25.0, 2.0, T2),
            ("o4", 1, None, None, "nope", None, None, T1),
        ],
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price double, "
        "freight_value double",
    )
    return cleaning.clean_order_items(raw)


def payments(spark):
    raw = frame(
        spark,
        [("o1", 1, "voucher", 1.0, 19.0, T1), ("o1", 2, "credit_card", 3.0, 19.0, T1), ("o4", 1, "pix", None, None, T1)],
        "order_id string, payment_sequential int, payment_type string, payment_installments double, payment_value double",
    )
    return cleaning.clean_order_payments(raw)


def reviews(spark):
    raw = frame(
        spark,
        [
            ("r1", "o1", 5.0, None, "No Message ", "2018-01-11", "2018-01-12", T1),
            ("r2", "o1", 1.0, "Bad", "late", "2018-01-11", "2018-01-15", T1),
            ("r3", "o1", 2.0, "x", "y", "2018-01-11", "pending", T2),
            ("r4", "o4", 3.0, "No title", None, "2018-01-26", None, T1),
        ],
        "review_id string, order_id string, review_score double, review_comment_title string, review_comment_message string, "
        "review_creation_date string, review_answer_timestamp string",
    )
    return cleaning.clean_order_reviews(raw)


def customers(spark):
    raw = frame(
        spark,
        [("c1", "u1", 1, "a", "sp", T1), ("c2", "u2", 2, "b", "rj", T1)],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix long, customer_city string, customer_state string",
    )
    return cleaning.clean_customers(raw)


def test_order_dates_follow_status(spark):
    out = {r.order_id: r for r in orders(spark).collect()}
    assert out["o1"].order_status == "delivered"
    assert out["o2"].order_purchase_date == dt.date(1900, 1, 1)
    assert out["o2"].order_delivered_customer_date == dt.date(1900, 1, 1)
    assert out["o3"].order_delivered_customer_date == dt.date(9999, 12, 31)
    assert out["o3"].order_approved_date == dt.date(1900, 1, 1)
    assert cleaning.JOBS["orders"][1] == ["orders"]


def test_one_review_per_order_latest_answer_wins(spark):
    out = {r.order_id: r for r in reviews(spark).collect()}
    assert out["o1"].review_id == "r2" and out["o4"].review_answer_date == dt.date(1900, 1, 1)


def build(spark):
    o, i, p, r, c = orders(spark), items(spark), payments(spark), reviews(spark), customers(spark)
    dim_c = star.dim_customer(c)
    product = frame(spark, [("p1", "Toys", *[1] * 7, T1)], "product_id string, " + ", ".join(f"{a} {'string' if 'name' in a and 'len' not in a else 'int'}" for a in star.PRODUCT_ATTRS))
    seller = frame(spark, [("s1", "00001", "X", "SP", T1)], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    dim_p, dim_s = star.dim_product(product), star.dim_seller(seller)
    oc = star.order_customer(o, c, dim_c)
    keyed = star.keyed_reviews(r, oc)
    leads = spark.createDataFrame(
        [("m1", dt.date(2018, 1, 1), "l", "Email"), ("m2", dt.date(1900, 1, 1), "l", "Social"), ("m3", dt.date(2018, 1, 1), "l", "Other")],
        "mql_id string, first_contact_date date, landing_page_id string, origin string",
    )
    deals = spark.createDataFrame(
        [
            (m, s, "UNKNOWN", "sr", d, "Toys", "Online Big", "Cat", 1, 0, "5", "Reseller", Decimal("1.00"), Decimal("2.00"))
            for m, s, d in [("m1", "s1", dt.date(2018, 1, 9)), ("m2", "s1", dt.date(2018, 3, 1)), ("m9", "s1", dt.date(2018, 9, 9))]
        ],
        "mql_id string, seller_id string, sdr_id string, sr_id string, won_date date, business_segment string, lead_type string, "
        "lead_behaviour_profile string, has_company short, has_gtin short, average_stock string, business_type string, "
        "declared_product_catalog_size decimal(10,2), declared_monthly_revenue decimal(10,2)",
    )
    channels = star.dim_marketing_channel(leads, deals)
    types, statuses = star.dim_payment_type(spark), star.dim_order_status(spark)
    return {
        "dim_date": calendar.spine_for(o),
        "dim_customer": dim_c,
        "dim_product": dim_p,
        "dim_seller": dim_s,
        "dim_marketing_channel": channels,
        "dim_payment_type": types,
        "dim_order_status": statuses,
        "fact_order_items": star.fact_order_items(i, oc, dim_p, dim_s),
        "fact_payments": star.fact_payments(p, oc, types),
        "fact_reviews": star.fact_reviews(keyed),
        "review_comments": star.review_comments(keyed),
        "fact_order_life_cycle": star.fact_order_life_cycle(o, oc, i, p, statuses),
        "fact_marketing_funnel": star.fact_marketing_funnel(deals, leads, dim_s, channels),
    }


def test_facts(spark):
    w = build(spark)
    lines = {(r.order_id_bk, r.order_item_id_bk): r for r in w["fact_order_items"].collect()}
    assert lines["o1", 1].line_total == Decimal("27.00") and lines["o1", 2].product_sk == -1
    assert lines["o4", 1].seller_sk == -1 and lines["o4", 1].shipping_limit_date_key == 19000101
    life = {r.order_id_bk: r for r in w["fact_order_life_cycle"].collect()}
    assert set(life) == {"o1", "o2", "o3", "o4"}
    assert (life["o1"].is_delivered_on_time, life["o4"].is_delivered_on_time, life["o3"].is_delivered_on_time) == (True, False, None)
    assert (life["o1"].total_items, life["o1"].total_distinct_products, life["o1"].total_distinct_sellers) == (2, 2, 1)
    assert (life["o2"].total_items, life["o2"].total_order_value, life["o2"].days_to_approve) == (0, Decimal("0.00"), None)
    assert life["o1"].days_purchase_to_delivery == 9
    paid = {(r.order_id_bk, r.payment_sequential_bk): r for r in w["fact_payments"].collect()}
    assert paid["o4", 1].payment_type_sk == 5 and paid["o4", 1].payment_installments == 0
    rev = {r.order_id_bk: r for r in w["fact_reviews"].collect()}
    assert rev["o4"].review_answer_date_key == 99991231
    comments = {r.review_sk: r for r in w["review_comments"].collect()}
    assert comments[rev["o4"].review_sk].review_comment_title is None
    assert comments[rev["o1"].review_sk].review_comment_message == "late"
    deals = {r.mql_id_bk: r for r in w["fact_marketing_funnel"].collect()}
    assert set(deals) == {"m1", "m2"} and deals["m1"].days_to_close == 8 and deals["m2"].days_to_close is None
    assert deals["m1"].sdr_id_bk is None and deals["m1"].sr_id_bk == "sr"


def test_status_outside_the_dimension_falls_back_to_the_first(spark):
    o = orders(spark).where("order_id = 'o5'")
    c = customers(spark).withColumn("customer_id", F.lit("cX")).limit(1)
    oc = star.order_customer(o, c, star.dim_customer(customers(spark)))
    life = star.fact_order_life_cycle(o, oc, items(spark), payments(spark), star.dim_order_status(spark))
    assert life.first().order_status_sk == 1


def test_order_table_has_one_row_per_order_with_repeatable_ties(spark):
    flat = {r.order_id: r for r in order_table.build_order_table(build(spark)).collect()}
    assert set(flat) == {"o1", "o2", "o3", "o4"}
    # two types carry 19.00 each: the smaller key wins
    assert (flat["o1"].payment_type, flat["o1"].payment_installments) == ("Credit Card", 3)
    assert (flat["o1"].product_category_name, flat["o1"].seller_id, flat["o1"].review_score) == ("Toys", "s1", 1)
    # the seller's newest deal is that of m2
    assert (flat["o1"].marketing_origin, flat["o1"].days_to_close) == ("Social", None)
    assert flat["o2"].payment_type is None and flat["o2"].purchase_date == dt.date(1900, 1, 1)
    assert len(flat["o1"].asDict()) == 47


def test_date_spine(spark):
    days = calendar.date_spine(spark)
    assert days.count() == 1827 + 2
    assert calendar.visible_days(days).count() == 1827
    assert calendar.extend_spine(days, "2020-12-30", "2021-01-02").count() == 1827 + 2 + 2


def shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("/shuffle_" in f for f in held.mkString("\n").split("\n"))


def test_a_load_leaves_neither_shuffle_files_nor_steps(spark, tmp_path):
    house, frames = Warehouse(spark, {}, str(tmp_path)), build(spark)
    house._ready = dict(frames)
    before, steps = shuffle_files(spark), []
    table = house["order_table"]
    for _ in range(50):  # files go in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert not list((tmp_path / "_steps").iterdir())

    def seen(df, keep=False):
        steps.append(df.columns)
        return df

    whole = order_table.build_order_table(frames, with_scores=False, step=seen)
    assert len(steps) == 5 and table.columns == whole.columns
    assert sorted(map(str, table.collect())) == sorted(map(str, whole.collect()))
