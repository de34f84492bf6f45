import pytest
from pyspark.sql import functions as F

from tradewind.__main__ import run
from tradewind.operators.lookup import lookup_sk
from tradewind.plans import cleaning, dashboards, features, jobs, models, quality
from tradewind.plans.warehouse import DIMENSIONS, FACTS, Warehouse, over_given_tables
from tradewind.sources import binding

FOLDER = "/root/testdata/sf0.001"
ANCHOR = "2001-08-31"


@pytest.fixture(scope="module")
def warehouse(spark):
    return over_given_tables(spark, FOLDER)


@pytest.fixture(scope="module")
def done(warehouse):
    return dashboards.delivered(warehouse["order_table"])


def test_loads_stop_at_the_first_failure_and_models_do_not():
    ran = []

    def bad():
        raise RuntimeError("no")

    steps = {"a": lambda: ran.append("a"), "b": bad, "c": lambda: ran.append("c")}
    with pytest.raises(jobs.LoadError) as e:
        jobs.run_jobs(steps, stop_on_failure=True)
    assert ran == ["a"] and [o.ok for o in e.value.done] == [True, False]
    outcomes = jobs.run_jobs(steps, stop_on_failure=False)
    assert [o.ok for o in outcomes] == [True, False, True] and "no" in outcomes[1].error
    assert [o.ok for o in jobs.run_jobs(steps, stop_on_failure=False, at_once=2)] == [True, False, True]
    with pytest.raises(jobs.LoadError):
        jobs.run_jobs(steps, stop_on_failure=True, at_once=2)


def test_ordered_runs_over_raw_tables(spark, tmp_path):
    sources = {n: (lambda read=read: read(spark, FOLDER)) for n, read in binding.RAW.items()}
    outcomes = jobs.ingest_all(spark, sources, str(tmp_path / "raw"))
    assert all(o.ok and o.rows for o in outcomes) and len(outcomes) == 11
    steps = run(spark, str(tmp_path / "raw"), str(tmp_path / "wh"))
    assert {o.job for o in steps} == set(cleaning.JOBS) | set(DIMENSIONS + FACTS) and all(o.rows for o in steps)


def test_a_second_load_keeps_keys_and_vanished_members(spark, tmp_path):
    raw = {n: (lambda read=read: read(spark, FOLDER)) for n, read in binding.RAW.items()}
    root = str(tmp_path / "wh")
    first = Warehouse(spark, {**raw, "sellers": lambda: binding.sellers(spark, FOLDER).where("seller_id < 6")}, root)
    before = {r.seller_id_bk: r.seller_sk for r in first["dim_seller"].collect()}
    assert len(before) == 7
    second = Warehouse(spark, {**raw, "sellers": lambda: binding.sellers(spark, FOLDER).where("seller_id > 2")}, root)
    after = {r.seller_id_bk: r.seller_sk for r in second["dim_seller"].collect()}
    assert {k: after[k] for k in before} == before
    assert len(after) == 11 and sorted(after.values()) == [-1, *range(1, 11)]


def test_a_hot_key_is_split_in_a_lookup(spark, capsys):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        code = F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
        fact = spark.range(0, 120_000, 1, 8).select(code.alias("code"), F.uuid().alias("pad"))
        members = spark.range(500).select(F.concat(F.lit("k"), F.col("id")).alias("bk"), F.col("id").alias("sk"))
        members = members.unionByName(spark.sql("SELECT 'hot' AS bk, 1000L AS sk"))
        out = lookup_sk(fact, members, "code", "bk", "sk", -1)
        counts = out.groupBy("sk").agg(F.count("*").alias("n"), F.max("pad"))
        rows = counts.collect()
        counts.explain()
        assert "SortMergeJoin(skew=true)" in capsys.readouterr().out
        assert {r.sk: r.n for r in rows}[1000] == 80_000 and sum(r.n for r in rows) == 120_000
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_star_is_sound(warehouse):
    quality.require_sound(
        quality.key_audit(warehouse, quality.STAR_KEYS), quality.reference_audit(warehouse, quality.STAR_REFERENCES)
    )
    assert quality.date_type_audit(warehouse["orders"]) == []


def test_planted_faults_are_found(spark):
    tables = {
        "child": spark.createDataFrame([("a", 1), ("a", 2), ("zz", 3), ("UNKNOWN", 4)], "k string, id int"),
        "parent": spark.createDataFrame([("a",), ("a",)], "k string"),
    }
    keys = quality.key_audit(tables, {"parent": ["k"], "child": ["id"]})
    assert {r.tbl: r.dup_pk_rows for r in keys.collect()} == {"parent": 1, "child": 0}
    refs = quality.reference_audit(tables, [("child", "k", "parent", "k", "UNKNOWN")])
    assert refs.first().orphan_rows == 1
    with pytest.raises(quality.AuditError):
        quality.require_sound(keys, refs)


def test_catalog_profile(spark, warehouse):
    profile = quality.schema_profile(warehouse, ["dim_seller"])
    rows = {r.column_name: (r.data_type, r.row_count) for r in profile.collect()}
    assert rows["seller_sk"] == ("bigint", 11)


def test_profile_of_a_catalog_database(spark, warehouse, tmp_path):
    warehouse["dim_order_status"].write.option("path", str(tmp_path / "t")).saveAsTable("status_probe")
    try:
        rows = [r for r in quality.catalog_profile(spark, "default").collect() if r.table_name == "status_probe"]
        assert [(r.column_name, r.row_count) for r in rows] == [("order_status_sk", 8), ("order_status", 8)]
    finally:
        spark.sql("DROP TABLE status_probe")


def test_segments_rank_clusters(spark):
    means = spark.createDataFrame(
        [(0, 10.0, 5.0, 900.0), (1, 50.0, 3.0, 500.0), (2, 90.0, 2.0, 300.0), (3, 200.0, 1.0, 100.0)],
        "cluster_id int, recency_days double, frequency_orders double, monetary_total double",
    )
    got = {r.cluster_id: r.customer_segment for r in models.segments_of(means).collect()}
    assert got == {0: "Champions", 1: "Loyal", 2: "At Risk", 3: "Lost/Inactive"}


def test_clusterings_score_everyone(done):
    seg = models.customer_segments(done, ANCHOR, starts=3)
    assert seg.scores.count() == features.rfm(done, ANCHOR).count() and seg.metrics["silhouette"] > 0.2
    tiers = models.seller_tiers(done, starts=3)
    means = tiers.scores.groupBy("seller_tier").agg(F.avg("seller_performance_score").alias("m")).collect()
    by = {r.seller_tier: r.m for r in means}
    assert by["Top Seller"] > by["Average"] > by["Underperformer"]
    seg.release()


def test_predictions_stay_in_range(done):
    late = models.delay_risk(done, rounds=3, depth=4)
    assert late.scores.where("delay_risk_score < 0 OR delay_risk_score > 1 OR delay_risk_tier IS NULL").count() == 0
    assert late.scores.count() == features.delay(done).count() and 0.3 < late.metrics["auc"] <= 1
    stars = models.review_scores(done, rounds=3, depth=4)
    got = {r[0] for r in stars.scores.select("predicted_review_score").distinct().collect()}
    assert got and all(1 <= x <= 5 and x * 2 == int(x * 2) for x in got) and stars.metrics["rmse"] < 2
    churn = models.churn_risk(done, ANCHOR, trees=10, depth=4)
    assert {"auc", "precision_1", "recall_0", "f1_1"} <= set(churn.metrics)


def test_a_separable_label_is_learned(spark):
    df = spark.range(400).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 * 3.0).alias("x")
    )
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    fitted = models._classified(data, "key", "y", GBTClassifier(maxIter=2), models.rare_class_weight(data, "y"), "p")
    assert fitted.metrics["auc"] == 1.0 and fitted.metrics["f1_1"] == 1.0


def test_model_run_puts_scores_on_orders(warehouse, tmp_path, monkeypatch):
    small = {"seller_tiers": models.JOBS["seller_tiers"], "broken": (lambda done: 1 / 0, "order_id")}
    monkeypatch.setattr(models, "JOBS", small)
    orders = warehouse["order_table"]
    scored, outcomes = jobs.run_models(orders, str(tmp_path / "scored"), {"seller_tiers": {"starts": 2}})
    assert [o.ok for o in outcomes] == [True, False]
    assert scored.count() == orders.count() and "seller_tier" in scored.columns


def test_a_damaged_dimension_stops_the_load(spark, tmp_path):
    raw = {n: (lambda read=read: read(spark, FOLDER)) for n, read in binding.RAW.items()}
    root = tmp_path / "wh"
    (root / "dim_seller").mkdir(parents=True)
    (root / "dim_seller" / "part-0.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception) as e:
        Warehouse(spark, raw, str(root))["dim_seller"]
    assert "PATH_NOT_FOUND" not in str(e.value)
    assert (root / "dim_seller" / "part-0.parquet").read_bytes() == b"not a table"


def test_no_shared_folder_without_a_setting():
    from tradewind.session import shared_folder

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        shared_folder(Session())


def test_hold_out_takes_its_share_of_each_label(spark):
    from tradewind.operators.summaries import in_stratified_test_set

    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    marked = df.withColumn("t", in_stratified_test_set(df, "k", "y"))
    got = {(r.y, r.t): r["count"] for r in marked.groupBy("y", "t").count().collect()}
    assert sum(got.values()) == 5000 and abs(got[0, True] - 900) <= 2 and abs(got[1, True] - 100) <= 2


def test_scores_do_not_depend_on_files(spark, done):
    one = models.seller_churn(done.coalesce(1), ANCHOR, rounds=3).scores
    many = models.seller_churn(done.repartition(8), ANCHOR, rounds=3).scores
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
