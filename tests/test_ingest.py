"""Ingestion as a command: kinds of sources, refused files, empty sources, rows and audit columns."""

import pytest

from tradewind import ingest


def _write(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text, encoding="utf-8")
    return str(path)


def test_sources_are_loaded_and_failures_told(spark, tmp_path):
    sources = {
        "deals": {"kind": "csv", "path": _write(tmp_path / "a", 'id,note\n1,"two\nlines"\n2,\n'), "schema": "id int, note string"},
        "page": {"kind": "checked_csv", "path": _write(tmp_path / "b", "<html>\nno\n"), "schema": "id int"},
        "places": {
            "kind": "checked_csv", "path": _write(tmp_path / "c", "id,city\n7,Ulm\n"), "schema": "id int, city string",
            "audit": {"drive_file_id": "x1"},
        },
        "none": {"kind": "csv", "path": _write(tmp_path / "d", "id\n"), "schema": "id int"},
    }
    target = str(tmp_path / "raw")
    outcomes = {o.job: o for o in ingest.run(spark, sources, target)}
    assert [n for n, o in outcomes.items() if not o.ok] == ["page"] and "HTML" in outcomes["page"].error
    assert (outcomes["deals"].rows, outcomes["places"].rows) == (2, 1)
    deals = spark.read.parquet(f"{target}/deals")
    assert sorted((r.id, r.note) for r in deals.collect()) == [(1, "two\nlines"), (2, None)]
    place = spark.read.parquet(f"{target}/places").first()
    assert (place.id, place.city, place._drive_file_id, place._source) == (7, "Ulm", "x1", sources["places"]["path"])
    assert place._ingested_at is not None
    # an empty source, and a repeated run with a broken file, leave earlier tables as they are
    again = {"places": {**sources["places"], "path": _write(tmp_path / "e", "id,city\n")}}
    assert all(o.ok for o in ingest.run(spark, again, target))
    assert spark.read.parquet(f"{target}/places").count() == 1


def test_unknown_kind_is_refused_first(spark, tmp_path):
    with pytest.raises(ValueError, match="places: kind 'xml'"):
        ingest.run(spark, {"places": {"kind": "xml"}}, str(tmp_path))
