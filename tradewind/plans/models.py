"""Segmentation and prediction with Spark ML.

Every job takes the delivered orders, fits on a repeatable 80 % of the keys,
reports figures on the other 20 % and scores every row.  Only cluster centres,
class counts and metrics reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import vocab
from tradewind.functions.numbers import (
    churn_tier,
    delay_tier,
    rounded_prediction,
    satisfaction,
    segment_name,
)
from tradewind.operators.boosting import Boosted, Settings, boost
from tradewind.operators.kmeans import kmeans
from tradewind.operators.metrics import area_under_roc
from tradewind.operators.oversample import oversample
from tradewind.operators.ranking import average_rank
from tradewind.operators.summaries import in_stratified_test_set, in_test_set
from tradewind.plans import features
from tradewind.plans.dashboards import known_day
from tradewind.session import shared_folder, staged

SEED = 42


@dataclass
class Fitted:
    """Scores per key, hold-out figures, the fitted model and the frame kept for it."""

    scores: DataFrame
    metrics: dict[str, float]
    model: object = field(repr=False, default=None)
    held: DataFrame | None = field(repr=False, default=None)

    def release(self) -> None:
        """Drop the kept training frame once the scores are written."""
        if self.held is not None:
            self.held.unpersist()


PARTS = 4
PART_ROWS = 50_000


def _held(df: DataFrame, key: str) -> DataFrame:
    """Keep a training frame that every pass of a learner reads; lost parts are recomputed.

    Row sampling and starts are seeded per partition, so rows go to partitions
    by a hash of their key and are sorted there, and the row count decides the number
    of partitions: the scores depend on the rows alone, not on files or cluster.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        # tree ensembles cut their lineage there every few rounds
        context.setCheckpointDir(shared_folder(df.sparkSession))
    parts = max(PARTS, -(-df.count() // PART_ROWS))
    return df.repartition(parts, key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)


# --- clustering ---------------------------------------------------------------


def _silhouette(df: DataFrame, column: str) -> float:
    """Mean silhouette; not a number where there is one cluster only."""
    if df.select("cluster_id").distinct().count() < 2:
        return float("nan")
    shown = df.select(array_to_vector(F.col(column)).alias(column), F.col("cluster_id").cast("double").alias("cluster_id"))
    return ClusteringEvaluator(featuresCol=column, predictionCol="cluster_id").evaluate(shown)


def standardised(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Add the array of the columns less their mean, in standard deviations (a constant column gives 0).

    Mean and spread come from exact sums of millionths, so they are the same however the rows are dealt.
    """
    sums = [F.count("*").alias("n")]
    for i, c in enumerate(columns):
        steps = F.round(F.col(c).cast("double") * 1e6).cast("decimal(19,0)")
        sums += [F.sum(steps).alias(f"s{i}"), F.sum((steps * steps).cast("decimal(28,0)")).alias(f"q{i}")]
    row = df.agg(*sums).first()
    scaled = []
    for i, c in enumerate(columns):
        n, s, q = row["n"], Fraction(row[f"s{i}"] or 0), Fraction(row[f"q{i}"] or 0)
        spread = float((q - s * s / n) / (n - 1)) ** 0.5 / 1e6 if n > 1 else 0.0
        mean = float(s / n) / 1e6 if n else 0.0
        scaled.append((F.col(c).cast("double") - mean) / spread if spread else F.lit(0.0))
    return df.withColumn(out, F.array(*scaled))


def segments_of(means: DataFrame) -> DataFrame:
    """Segment of every cluster from the ranks of its mean recency, frequency and value (k rows)."""
    ranks = means.select(
        "cluster_id",
        average_rank("recency_days", descending=True).alias("r"),
        average_rank("frequency_orders").alias("f"),
        average_rank("monetary_total").alias("m"),
    )
    mean_rank = (F.col("r") + F.col("f") + F.col("m")) / 3
    return ranks.select("cluster_id", segment_name(mean_rank).alias("customer_segment"))


def rfm_filled(done: DataFrame, anchor: str = vocab.ANCHOR_DATE) -> DataFrame:
    """Recency, frequency and value of every customer, with `_recency` without gaps and `_log_value`."""
    rfm = features.rfm(done, anchor)
    # a customer without a known day counts as one that has been away longest
    longest = rfm.agg(F.max("recency_days")).scalar()
    filled = rfm.withColumn("_recency", F.coalesce("recency_days", longest, F.lit(0)))
    return filled.withColumn("_log_value", F.log1p(F.col("monetary_total").cast("double")))


SEGMENT_FEATURES = ["_recency", "frequency_orders", "_log_value"]


def customer_segments(
    done: DataFrame, anchor: str = vocab.ANCHOR_DATE, k: int = 4, starts: int = 10
) -> Fitted:
    """Recency, frequency and log value, standardised and clustered."""
    filled = rfm_filled(done, anchor)
    data = _kept(filled)
    prepared = standardised(data, SEGMENT_FEATURES, "_scaled")
    model = kmeans(prepared, "_scaled", "customer_unique_id", k, starts, SEED)
    placed = model.assign(prepared, "_scaled", "cluster_id")
    columns = ["recency_days", "frequency_orders", "monetary_total"]
    means = placed.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in columns])
    # one row per cluster
    named = placed.join(F.broadcast(segments_of(means)), "cluster_id")
    metrics = {"silhouette": _silhouette(placed, "_scaled"), "cost": model.cost}
    return Fitted(named.select("customer_unique_id", *columns, "customer_segment"), metrics, model, data)


SELLER_TIERS = ["Top Seller", "Average", "Underperformer"]


def seller_tiers(done: DataFrame, starts: int = 10) -> Fitted:
    """Composite score, clustered in three; clusters are named by falling mean score."""
    data = _kept(features.seller_scores(done))
    prepared = data.withColumn("_score", F.array(F.col("seller_performance_score").cast("double")))
    model = kmeans(prepared, "_score", "seller_id", len(SELLER_TIERS), starts, SEED)
    placed = model.assign(prepared, "_score", "cluster_id")
    # centres come in ascending order
    falling = [SELLER_TIERS[len(model.centres) - 1 - i] for i in range(len(model.centres))]
    tier = F.get(F.array(*[F.lit(t) for t in falling]).cast("array<string>"), F.col("cluster_id"))
    metrics = {"silhouette": _silhouette(placed, "_score"), "cost": model.cost}
    scores = placed.select("seller_id", "seller_performance_score", tier.alias("seller_tier"))
    return Fitted(scores, metrics, model, data)


# --- supervised ------------------------------------------------------------------


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class (two rows)."""
    return {int(r[0]): int(r[1]) for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}


def balanced_weight(df: DataFrame, label: str) -> Column:
    """n / (2 · n_class), so both classes weigh the same."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, total / (2.0 * n)).otherwise(weight)
    return weight


def rare_class_weight(df: DataFrame, label: str) -> Column:
    """(1 - rate) / rate for the positive class, 1 for the other."""
    counts = class_counts(df, label)
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    return F.when(F.col(label) == 1, negative / positive if positive else 1.0).otherwise(1.0)


def label_pipeline(df: DataFrame, numbers: Sequence[str], labels: Sequence[str]):
    """Label columns numbered in alphabetical order, then one feature vector."""
    stages = []
    if labels:
        stages.append(
            StringIndexer(
                inputCols=list(labels),
                outputCols=[f"{c}_enc" for c in labels],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
    stages.append(VectorAssembler(inputCols=[*numbers, *[f"{c}_enc" for c in labels]], outputCol="features"))
    model = Pipeline(stages=stages).fit(df)
    widest = max((len(a) for a in model.stages[0].labelsArray), default=0) if labels else 0
    return model, max(32, widest + 1)


def binary_report(scored: DataFrame, label: str, probability: str) -> dict[str, float]:
    """Area under ROC, and precision, recall and F1 per class at 0.5."""
    out = {"auc": area_under_roc(scored, probability, label).first()["area"]}
    guess = (F.col(probability) >= 0.5).cast("int")
    cells = {
        (int(r.y), int(r.g)): r.n
        for r in scored.groupBy(F.col(label).alias("y"), guess.alias("g")).agg(F.count("*").alias("n")).collect()
    }
    for c in (0, 1):
        hit = cells.get((c, c), 0)
        guessed = hit + cells.get((1 - c, c), 0)
        actual = hit + cells.get((c, 1 - c), 0)
        precision = hit / guessed if guessed else 0.0
        recall = hit / actual if actual else 0.0
        out[f"precision_{c}"] = precision
        out[f"recall_{c}"] = recall
        out[f"f1_{c}"] = 2 * precision * recall / (precision + recall) if hit else 0.0
    return out


def regression_report(scored: DataFrame, label: str, prediction: str) -> dict[str, float]:
    ev = RegressionEvaluator(labelCol=label, predictionCol=prediction)
    return {m: ev.evaluate(scored, {ev.metricName: m}) for m in ("rmse", "mae", "r2")}


CHURN_FEATURES = [
    "frequency",
    "monetary",
    "avg_order_value",
    "avg_review_score",
    "pct_on_time",
    "avg_days_deliver",
    "avg_variance",
]


def _positive(column: str = "probability") -> Column:
    return vector_to_array(F.col(column)).getItem(1)


def _stored(model):
    """The model as read back from the shared folder: without its training summary, which holds the session."""
    path = f"{shared_folder(SparkSession.active())}/tradewind/models/{uuid.uuid4().hex}"
    model.write().save(path)
    return type(model).load(path)


def _classified(data: DataFrame, key: str, label: str, learner, weight: Column, name: str) -> Fitted:
    """Fit on four fifths of each class, report on the rest, score all; rows without a label are only scored."""
    known = data.where(F.col(label).isNotNull())
    tested = in_stratified_test_set(known, key, label)
    train = known.where(~tested).withColumn("_weight", weight)
    model = _stored(learner.setLabelCol(label).setFeaturesCol("features").setWeightCol("_weight").fit(train))
    scored = model.transform(data).withColumn(name, _positive())
    metrics = binary_report(scored.where(F.col(label).isNotNull() & tested), label, name)
    return Fitted(scored, metrics, model, data)


def _kept(df: DataFrame) -> DataFrame:
    """Keep a frame that is cut into bins, packed and scored; nothing depends on how it is partitioned."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _boosted_classes(data: DataFrame, n_features: int, key: str, label: str, settings: Settings, name: str) -> Fitted:
    """Boosted trees on four fifths of each class, the rarer one weighted up; report on the rest, score all."""
    known = data.where(F.col(label).isNotNull())
    tested = in_stratified_test_set(known, key, label)
    train = known.where(~tested).withColumn("_weight", rare_class_weight(data, label))
    model = boost(train, F.col("features"), n_features, key, label, settings, True, "_weight")
    scored = model.score(data, F.col("features"), name)
    metrics = binary_report(scored.where(F.col(label).isNotNull() & tested), label, name)
    return Fitted(scored, metrics, model, data)


def _boosted_values(data: DataFrame, n_features: int, key: str, label: str, settings: Settings) -> tuple[Boosted, DataFrame, dict]:
    """Boosted regression on four fifths of the keys: model, all rows with `prediction`, hold-out figures."""
    model = boost(data.where(~in_test_set(key)), F.col("features"), n_features, key, label, settings, False)
    scored = model.score(data, F.col("features"), "prediction")
    return model, scored, regression_report(scored.where(in_test_set(key)), label, "prediction")


def _array(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns]).alias("features")


def churn_risk(
    done: DataFrame, anchor: str = vocab.ANCHOR_DATE, trees: int = 200, depth: int = 8
) -> Fitted:
    """Random forest on customer aggregates; recency is left out because it defines the label."""
    cust = features.churn(done, anchor)
    filled = cust.select(
        "customer_unique_id", "churned", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in CHURN_FEATURES]
    )
    data = _held(VectorAssembler(inputCols=CHURN_FEATURES, outputCol="features").transform(filled), "customer_unique_id")
    learner = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED)
    fitted = _classified(data, "customer_unique_id", "churned", learner, balanced_weight(data, "churned"), "churn_probability")
    tiered = fitted.scores.select(
        "customer_unique_id", "churn_probability", churn_tier(F.col("churn_probability")).alias("churn_risk_tier")
    )
    return Fitted(tiered, fitted.metrics, fitted.model, data)


def oversampled_churn(done: DataFrame, anchor: str = vocab.ANCHOR_DATE) -> DataFrame:
    """churned, features, made: the training table of the churn model, its rarer class filled up with
    points between neighbours until both are even. Features are measured in their standard deviations."""
    cust = features.churn(done, anchor).where(F.col("churned").isNotNull())
    filled = staged(cust.select("churned", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in CHURN_FEATURES]))
    # one row of spreads, two of counts
    spread = filled.agg(*[F.stddev(c).alias(c) for c in CHURN_FEATURES]).first()
    table = filled.select("churned", F.array(*[F.col(c) / F.lit(spread[c] or 1.0) for c in CHURN_FEATURES]).alias("features"))
    counts = class_counts(filled, "churned")
    rare = 1 if counts.get(1, 0) <= counts.get(0, 0) else 0
    return oversample(table, "churned", "features", rare=rare, seed=SEED).drop("origin", "towards")


def delay_risk(done: DataFrame, rounds: int = 300, depth: int = 6, rate: float = 0.05) -> Fitted:
    """Boosted trees on what is known at dispatch."""
    raw = features.delay(done)
    encoder = label_pipeline(raw, features.DELAY_NUMBERS, features.DELAY_LABELS)[0]
    coded = encoder.transform(raw)
    data = _kept(coded.select("order_id", "is_late", vector_to_array("features").alias("features")))
    n = len(features.DELAY_NUMBERS) + len(features.DELAY_LABELS)
    settings = Settings(rounds, depth, rate, rows=0.8, columns=0.8, seed=SEED)
    fitted = _boosted_classes(data, n, "order_id", "is_late", settings, "delay_risk_score")
    tiered = fitted.scores.select(
        "order_id", "delay_risk_score", delay_tier(F.col("delay_risk_score")).alias("delay_risk_tier")
    )
    return Fitted(tiered, fitted.metrics, fitted.model, data)


def review_scores(done: DataFrame, rounds: int = 400, depth: int = 6, rate: float = 0.04) -> Fitted:
    """Boosted regression of the score, kept within 1..5 and rounded to halves."""
    raw = features.review(done)
    encoder = label_pipeline(raw, features.REVIEW_NUMBERS, features.REVIEW_LABELS)[0]
    coded = encoder.transform(raw)
    data = _kept(coded.select("order_id", "review_score", vector_to_array("features").alias("features")))
    n = len(features.REVIEW_NUMBERS) + len(features.REVIEW_LABELS)
    settings = Settings(rounds, depth, rate, rows=0.8, columns=0.8, seed=SEED)
    model, scored, metrics = _boosted_values(data, n, "order_id", "review_score", settings)
    shown = scored.withColumn("predicted_review_score", rounded_prediction(F.col("prediction")))
    return Fitted(
        shown.select(
            "order_id",
            "predicted_review_score",
            satisfaction(F.col("predicted_review_score")).alias("predicted_satisfaction"),
        ),
        metrics,
        model,
        data,
    )


# --- documented models ---------------------------------------------------------------

LTV_FEATURES = [
    "recency_days",
    "frequency_orders",
    "avg_days_deliver",
    "avg_review_score",
    "avg_installments",
    "pct_on_time",
    "categories",
]


def lifetime_value(done: DataFrame, anchor: str = vocab.ANCHOR_DATE, rounds: int = 100) -> Fitted:
    """Boosted regression of log spend on features that do not contain the spend."""
    table = features.customer_table(done, anchor)
    filled = table.select(
        "customer_unique_id",
        F.log1p(F.col("monetary_total").cast("double")).alias("log_value"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in LTV_FEATURES],
    )
    data = _kept(filled.select("customer_unique_id", "log_value", _array(LTV_FEATURES)))
    settings = Settings(rounds, depth=5, seed=SEED)
    model, scored, metrics = _boosted_values(data, len(LTV_FEATURES), "customer_unique_id", "log_value", settings)
    return Fitted(
        scored.select("customer_unique_id", F.expm1("prediction").alias("predicted_value")), metrics, model, data
    )


SELLER_FEATURES = ["total_orders", "total_revenue", "avg_review", "pct_on_time"]


def seller_churn(
    done: DataFrame, anchor: str = vocab.ANCHOR_DATE, churn_days: int = vocab.CHURN_DAYS, rounds: int = 100
) -> Fitted:
    """Will a seller have sold nothing for more than `churn_days`?"""
    last = done.where("seller_id IS NOT NULL").groupBy("seller_id").agg(F.max(known_day()).alias("last_sale"))
    quiet = F.datediff(F.lit(anchor).cast("date"), F.col("last_sale")) > churn_days
    table = features.seller_table(done).join(last, "seller_id").withColumn("churned", quiet.cast("int"))
    filled = table.select(
        "seller_id", "churned", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in SELLER_FEATURES]
    )
    data = _kept(filled.select("seller_id", "churned", _array(SELLER_FEATURES)))
    settings = Settings(rounds, depth=4, seed=SEED)
    fitted = _boosted_classes(data, len(SELLER_FEATURES), "seller_id", "churned", settings, "churn_probability")
    return Fitted(fitted.scores.select("seller_id", "churn_probability"), fitted.metrics, fitted.model, data)


# --- all of them ------------------------------------------------------------------------

# model, key its scores are written back by
JOBS: Mapping[str, tuple[Callable[..., Fitted], str]] = {
    "customer_segments": (customer_segments, "customer_unique_id"),
    "churn_risk": (churn_risk, "customer_unique_id"),
    "delay_risk": (delay_risk, "order_id"),
    "review_scores": (review_scores, "order_id"),
    "seller_tiers": (seller_tiers, "seller_id"),
}
