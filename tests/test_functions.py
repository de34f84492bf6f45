import datetime as dt

from pyspark.sql import functions as F

from tradewind.functions import dates, numbers, text, vocab


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_zip_is_padded_and_null_stays(spark):
    got = column(spark, [1151, 9790, 14409, 123456, None], text.zip5("c"), "long")
    assert got == ["01151", "09790", "14409", "23456", None]


def test_title_case(spark):
    values = ["bed_bath_table", "home__decor", "  a  b ", "", None, "HOME-garden_x", "pc_gamer"]
    got = column(spark, values, text.title_case("c"))
    assert got == ["Bed Bath Table", "Home Decor", "A B", None, None, "Home-garden X", "Pc Gamer"]


def test_vocabulary(spark):
    values = ["credit_card", " BOLETO ", "not_defined", None, "pix"]
    got = column(spark, values, text.from_vocabulary("c", vocab.PAYMENT_LABELS, vocab.NOT_SPECIFIED))
    assert got == ["Credit Card", "Boleto", "Not Specified", "Not Specified", "Not Specified"]


def test_marker_text_becomes_null_in_any_case(spark):
    assert column(spark, ["No Message", "No message", "ok", None], text.null_if_text("c", "No Message")) == [
        None,
        None,
        "ok",
        None,
    ]


def test_state_name(spark):
    assert column(spark, ["SP", "UN", None], text.state_name("c", vocab.STATE_NAMES)) == ["São Paulo, Brazil", None, None]


def test_days_and_sentinels(spark):
    values = ["2017-10-02 10:56:33", "soon", None]
    assert column(spark, values, dates.day_or_unknown("c")) == [
        dt.date(2017, 10, 2),
        dt.date(1900, 1, 1),
        dt.date(1900, 1, 1),
    ]


def test_milestone_follows_status(spark):
    df = spark.createDataFrame(
        [(0, None, "canceled"), (1, None, "shipped"), (2, "n/a", "delivered"), (3, "n/a", "unavailable"), (4, "2018-01-05", "canceled")],
        "i int, d string, s string",
    )
    got = [r[0] for r in df.orderBy("i").select(dates.milestone_day("d", F.col("s"))).collect()]
    assert got == [
        dt.date(1900, 1, 1),
        dt.date(9999, 12, 31),
        dt.date(9999, 12, 31),
        dt.date(1900, 1, 1),
        dt.date(2018, 1, 5),
    ]


def test_day_diff_and_on_time(spark):
    rows = [
        (0, dt.date(2018, 1, 10), dt.date(2018, 1, 10)),
        (1, dt.date(2018, 1, 10), dt.date(2018, 1, 7)),
        (2, dt.date(2018, 1, 10), dt.date(2018, 1, 12)),
        (3, dt.date(2018, 1, 10), dt.date(9999, 12, 31)),
        (4, dt.date(1900, 1, 1), dt.date(2018, 1, 12)),
    ]
    df = spark.createDataFrame(rows, "i int, est date, got date").orderBy("i")
    out = df.select(dates.day_diff("est", "got"), dates.on_time("got", "est")).collect()
    assert [tuple(r) for r in out] == [(0, True), (-3, True), (2, False), (None, None), (None, None)]


def test_calendar_parts(spark):
    days = [dt.date(2016, 1, 1), dt.date(2016, 12, 31), dt.date(2017, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(*[c.alias(n) for n, c in dates.calendar_parts(F.col("d")).items()]).orderBy("full_date").collect()
    assert [r.week_of_year for r in rows] == [53, 52, 52]
    assert [r.day_of_year for r in rows] == [1, 366, 1]
    assert [r.day_of_week_num for r in rows] == [5, 6, 7]
    assert [r.is_weekend for r in rows] == [False, True, True]
    assert rows[0].date_key == 20160101 and rows[0].month_name == "January" and rows[0].quarter_name == "Q1"


def test_key_to_day_reverses_date_key(spark):
    df = spark.createDataFrame([(dt.date(2018, 3, 31),)], "d date")
    assert df.select(dates.key_to_day(dates.date_key("d"))).first()[0] == dt.date(2018, 3, 31)


def test_numbers(spark):
    assert column(spark, [2.675, None], numbers.money("c"), "double")[0].compare(__import__("decimal").Decimal("2.68")) == 0
    assert column(spark, [-3.7, 3.9, None], numbers.whole("c"), "double") == [-3, 3, 0]
    assert column(spark, [0.0, 2.0, None], numbers.ratio(F.lit(1), F.col("c")), "double") == [None, 0.5, None]


def test_predictions_are_clipped_and_rounded_to_even_halves(spark):
    got = column(spark, [0.4, 5.7, 2.25, 2.75, 3.3], numbers.rounded_prediction(F.col("c")), "double")
    assert got == [1.0, 5.0, 2.0, 3.0, 3.5]


def test_tier_bounds_are_inclusive(spark):
    values = [0.65, 0.40, 0.3999, 0.20, 0.1]
    assert column(spark, values, numbers.churn_tier(F.col("c")), "double") == ["High", "Medium", "Low", "Low", "Low"]
    assert column(spark, values, numbers.delay_tier(F.col("c")), "double") == ["High", "High", "Medium", "Medium", "Low"]
    scores = [4.5, 3.5, 2.5, 2.0]
    assert column(spark, scores, numbers.satisfaction(F.col("c")), "double") == ["Excellent", "Good", "Average", "Poor"]
    ranks = [3.5, 2.5, 1.8, 1.7]
    assert column(spark, ranks, numbers.segment_name(F.col("c")), "double") == ["Champions", "Loyal", "At Risk", "Lost/Inactive"]
