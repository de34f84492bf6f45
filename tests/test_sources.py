import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewind.sources import readers, writers

SCHEMA = "id int, note string, day string"


def schema(spark, text=SCHEMA):
    return spark.createDataFrame([], text).schema


def test_csv_text_may_hold_line_breaks_and_quotes(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('id,note,day\n1,"two\nlines, ""quoted"" é",2018-01-01\n2,,\n', encoding="utf-8")
    rows = readers.read_csv(spark, str(path), schema(spark)).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2]
    assert rows[0].note == 'two\nlines, "quoted" é' and rows[1].note is None


@pytest.mark.parametrize("body", ['{"error": 1}\n', "<html></html>\n", "", "id,other\n1,2\n"])
def test_payload_that_is_not_the_csv_is_an_error(spark, tmp_path, body):
    path = tmp_path / "g.csv"
    path.write_text(body)
    with pytest.raises(readers.PayloadError):
        readers.read_checked_csv(spark, str(path), schema(spark))


def test_checked_csv(spark, tmp_path):
    path = tmp_path / "g.csv"
    path.write_text("id,note,day\n1,x,2018-01-01\n")
    assert readers.read_checked_csv(spark, str(path), schema(spark)).first().note == "x"
    path.write_text("id,note,day\nnot a number,x,2018-01-01\n")
    with pytest.raises(Exception):
        readers.read_checked_csv(spark, str(path), schema(spark)).collect()


def test_audit_columns(spark):
    row = readers.with_audit(spark.range(1), "files", F.lit("now"), drive_file_id="f1").first()
    assert (row._ingested_at, row._source, row._drive_file_id) == ("now", "files", "f1")


def test_order_table_falls_back_to_the_snapshot(spark, tmp_path):
    df = spark.createDataFrame([("o1", "2018-01-01", 5.0)], "order_id string, purchase_date string, total_order_value double")
    writers.export_csv(df, str(tmp_path / "snapshot"))
    table = str(tmp_path / "table")
    got, snapshot = readers.load_order_table(spark, table, str(tmp_path / "snapshot"), df.schema)
    assert snapshot and got.first().purchase_date == dt.date(2018, 1, 1)
    writers.replace_table(df, table)
    got, snapshot = readers.load_order_table(spark, table, str(tmp_path / "snapshot"), df.schema)
    assert not snapshot and got.count() == 1


def test_replacement_reports_rows_and_skips_empty_input(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.replace_table(spark.range(10), path).rows == 10
    assert writers.replace_if_any(spark.range(0), path) is None
    assert spark.read.parquet(path).count() == 10
    assert writers.replace_table(spark.range(3), path).rows == 3


def test_only_present_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, m string")
    writers.replace_table(df, path, ["m"])
    writers.replace_partitions(spark.createDataFrame([(9, "b")], "v int, m string"), path, ["m"])
    assert sorted((r.v, r.m) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_write_back_replaces_columns_and_keeps_rows(spark):
    table = spark.createDataFrame([("a", 1, None), ("b", 2, 5.0)], "k string, v int, score double")
    scores = spark.createDataFrame([("a", 0.5)], "k string, score double")
    out = writers.write_back(table, scores, "k")
    assert out.columns == ["k", "v", "score"]
    assert sorted(map(tuple, out.collect())) == [("a", 1, 0.5), ("b", 2, None)]
