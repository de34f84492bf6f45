"""Versioned tables, the refreshed life cycle, and upserts from a stream."""

import pytest
from pyspark.sql import functions as F

from tests.test_operators import dim
from tradewind.operators.upsert import upsert_scd1
from tradewind.plans import snapshot, star
from tradewind.plans.snapshot import LifeCycle
from tradewind.plans.warehouse import Warehouse
from tradewind.sources import binding, writers
from tradewind.sources.versions import ConflictError, VersionedTable
from tradewind.streaming.upsert import batch_upsert, upsert_available

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_load_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    assert table.replace(spark.range(5)).rows == 5

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            table.replace(spark.range(9))
    assert table.read().count() == 5 and table.latest().version == 1
    with pytest.raises(Exception):
        table.replace(spark.range(9).select(F.assert_true(F.lit(False)).alias("id")))
    assert table.read().count() == 5
    table.replace(spark.range(7), "seven")
    assert table.read().count() == 7 and table.has("seven") and not table.has("nine")


def test_a_dimension_keeps_its_keys_when_a_load_is_killed(spark, tmp_path, monkeypatch):
    raw = {n: (lambda read=read: read(spark, FOLDER)) for n, read in binding.RAW.items()}
    root = str(tmp_path / "wh")
    first = rows(Warehouse(spark, raw, root)["dim_seller"].select("seller_sk", "seller_id_bk"))
    more = raw | {"sellers": lambda: raw["sellers"]().where("seller_id % 3 <> 0").unionByName(raw["sellers"]().limit(1).withColumn("seller_id", F.lit("new")))}

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            Warehouse(spark, more, root)["dim_seller"]
    table = VersionedTable(spark, f"{root}/dim_seller")
    assert rows(table.read().select("seller_sk", "seller_id_bk")) == first
    after = rows(Warehouse(spark, more, root)["dim_seller"].select("seller_sk", "seller_id_bk"))
    assert set(first) < set(after) and len(after) == len(first) + 1


def test_a_table_written_in_place_before_is_taken_over(spark, tmp_path):
    root = str(tmp_path / "old")
    spark.range(4).write.parquet(root)
    table = VersionedTable(spark, root)
    assert table.read().count() == 4
    table.replace(table.read().where("id > 0"))
    assert table.read().count() == 3


def test_parts_are_replaced_alone(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "p"))
    df = spark.range(12).select("id", (F.col("id") % 3).alias("m"))
    table.replace_all_parts(df, "m")
    kept = table.latest().folders
    table.replace_parts(spark.createDataFrame([(100, 1)], "id long, m long"), "m", ["1", "2"])
    now = table.latest().folders
    assert set(now) == {"0", "1"} and now["0"] == kept["0"] and now["1"] != kept["1"]
    assert rows(table.read()) == [(0, 0), (100, 1), (3, 0), (6, 0), (9, 0)]
    assert table.read(["1", "7"]).count() == 1 and table.read([]).columns == ["id", "m"]
    table.replace_parts(df.limit(0), "m", ["0", "1"])
    assert table.read().count() == 0 and table.read().columns == ["id", "m"]


def test_of_two_loads_that_race_one_fails(spark, tmp_path, monkeypatch):
    table, other = (VersionedTable(spark, str(tmp_path / "r")) for _ in range(2))
    table.replace(spark.range(1), "0")
    last = table.latest
    calls = []

    def stale():
        # the second load had looked before the first one committed
        calls.append(1)
        return first if len(calls) == 1 else last()

    first = table.latest()
    other.replace(spark.range(2), "a")
    monkeypatch.setattr(table, "latest", stale)
    with pytest.raises(ConflictError):
        table.replace(spark.range(3), "b")
    assert other.read().count() == 2


def test_figures_come_from_the_write(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(20).select(F.when(F.col("id") % 4 > 0, F.col("id")).alias("id")).mapInPandas(passed, "id long")
    report = writers.replace_table(df, str(tmp_path / "f"), figures=writers.nulls(df))
    assert report.rows == 20 and report.figures == {"nulls_id": 5} and seen.value == 20
    assert writers.replace_table(df.limit(0), str(tmp_path / "g"), figures=writers.nulls(df)).figures == {"nulls_id": 0}


def life_inputs(spark):
    w = Warehouse(spark, {n: (lambda read=read: read(spark, FOLDER)) for n, read in binding.RAW.items()})
    return {n: w[n].cache() for n in snapshot.INPUTS}, w["dim_order_status"]


def test_only_changed_orders_are_computed_again(spark, tmp_path, monkeypatch):
    inputs, statuses = life_inputs(spark)
    life = LifeCycle(VersionedTable(spark, str(tmp_path / "life")))
    n = inputs["orders"].count()
    assert life.refresh(inputs, statuses).orders == n
    first = life.read()
    assert life.refresh(inputs, statuses) == snapshot.Refresh(0, 0, 0)

    ids = [r.order_id for r in inputs["orders"].orderBy("order_id").limit(6).collect()]
    orders, items, payments = (inputs[k] for k in ("orders", "order_items", "order_payments"))
    late, moved, gone, item, paid = ids[:5]
    orders = orders.where(F.col("order_id") != gone)
    orders = orders.withColumn("order_delivered_customer_date", F.when(F.col("order_id") == late, F.lit("2001-01-01").cast("date")).otherwise(F.col("order_delivered_customer_date")))
    orders = orders.withColumn("order_purchase_date", F.when(F.col("order_id") == moved, F.lit("1990-03-03").cast("date")).otherwise(F.col("order_purchase_date")))
    again = items.where(F.col("order_id") == item).limit(1)
    changed = inputs | {
        "orders": orders,
        "order_items": items.unionByName(again),
        "order_payments": payments.where(F.col("order_id") != paid),
    }
    asked = []
    whole = star.fact_order_life_cycle
    monkeypatch.setattr(star, "fact_order_life_cycle", lambda o, *a: asked.append(o.count()) or whole(o, *a))
    done = life.refresh(changed, statuses)
    assert asked == [4] and done.orders == 5 and done.rows < n
    monkeypatch.undo()
    full = star.fact_order_life_cycle(*[changed[k] for k in snapshot.INPUTS], statuses)
    assert rows(life.read().drop("order_fulfillment_sk").select(*full.drop("order_fulfillment_sk").columns)) == rows(full.drop("order_fulfillment_sk"))
    keys = life.read().select("order_fulfillment_sk")
    assert keys.distinct().count() == n - 1
    stay = first.where(~F.col("order_id_bk").isin(ids[:5])).select("order_id_bk", "order_fulfillment_sk")
    assert stay.exceptAll(life.read().select("order_id_bk", "order_fulfillment_sk")).count() == 0


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    source, table = str(tmp_path / "in"), VersionedTable(spark, str(tmp_path / "dim"))
    schema = "bk string, city string, zip string, at int"
    spark.createDataFrame([("a", "X", "1", 1), ("b", "Y", "2", 1), ("a", "X2", "1", 2), (None, "Q", "9", 1)], schema).write.parquet(f"{source}/1")
    handle = batch_upsert(table, "s", "bk", "sk", ["city", "zip"], ["at"], F.lit("t"))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
        upsert_available(stream, handle, str(tmp_path / "progress"))

    run()
    first = rows(table.read().select("sk", "bk", "city"))
    assert len(first) == 2 and ("a", "X2") in {r[1:] for r in first}
    spark.createDataFrame([("c", "Z", "3", 3), ("b", "Y2", "2", 3)], schema).write.parquet(f"{source}/2")
    run()
    second, version = rows(table.read().select("sk", "bk", "city")), table.latest().version
    keys = {bk: sk for sk, bk, _ in second}
    assert len(second) == 3 and all(keys[bk] == sk for sk, bk, _ in first) and ("b", "Y2") in {r[1:] for r in second}
    last = int(table.latest().token.split(":")[1])
    handle(spark.createDataFrame([("c", "other", "3", 9), ("d", "W", "4", 9)], schema), last)
    assert rows(table.read().select("sk", "bk", "city")) == second and table.latest().version == version
    run()
    assert table.latest().version == version


def test_versions_give_what_plain_upserts_give(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "d"))
    loads = [[("a", "X", None), ("b", "Y", "1")], [("b", "Y", "2"), ("c", "Z", None)]]
    plain = None
    for i, load in enumerate(loads):
        now = F.lit(f"t{i}")
        plain = upsert_scd1(plain, dim(spark, load), "bk", "sk", ["city", "zip"], now)
        table.replace(upsert_scd1(table.read(), dim(spark, load), "bk", "sk", ["city", "zip"], now))
    assert rows(table.read().select(*plain.columns)) == rows(plain)
