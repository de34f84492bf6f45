"""Scores of all models beside the flat order table, with few rounds."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import predictions
from tradewind.plans import features, models

FOLDER = "/root/testdata/sf0.001"


def test_scores_join_every_order(spark, monkeypatch):
    few = {
        "churn": predictions.scores("few_churn", lambda d: models.churn_risk(d, predictions.ANCHOR, trees=3)),
        "delay": predictions.scores("few_delay", lambda d: models.delay_risk(d, rounds=2)),
        "reviews": predictions.scores("few_reviews", lambda d: models.review_scores(d, rounds=2)),
    }
    for name, read in few.items():
        monkeypatch.setattr(predictions, name, read)
    got = entry.queries()["scored_orders"](spark, FOLDER).persist()
    orders = predictions.loaded(spark, FOLDER)["order_table"]
    assert got.count() == orders.count() == got.select("order_id").distinct().count()
    delivered = predictions.done(spark, FOLDER)
    # an order is scored exactly where its features are known
    for column, known in (("delay_risk_tier", features.delay(delivered)), ("predicted_review_score", features.review(delivered))):
        scored = {r.order_id for r in got.where(F.col(column).isNotNull()).collect()}
        assert scored and scored == {str(r.order_id) for r in known.select("order_id").collect()}
    assert got.where("customer_segment IS NOT NULL").count() and got.where("seller_tier IS NOT NULL").count()
    sample = entry.queries()["prediction_sample"](spark, FOLDER).collect()
    assert 0 < len(sample) <= 3000 and all(1 <= r.predicted_review_score <= 5 and r.review_score is not None for r in sample)
