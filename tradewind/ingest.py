"""Ingestion of raw sources into Parquet tables, as one ordered run that goes on after a failure.

    python -m tradewind.ingest SOURCES.json TARGET_FOLDER

SOURCES.json maps a table name to its source:

    {"orders":  {"kind": "relational", "url": "jdbc:...", "table": "orders",
                 "split_column": "id", "bounds": [1, 1000000], "partitions": 16, "properties": {}},
     "deals":   {"kind": "csv", "path": "/landing/deals", "schema": "mql_id string, won_date string"},
     "places":  {"kind": "checked_csv", "path": "/landing/places", "schema": "...", "audit": {"drive_file_id": "x"}}}

A checked source is refused when a file has another header or is no CSV. Every
table gets `_ingested_at` and `_source`. A source without rows leaves the old table as it is. Exit
code 1 tells that a source failed; the others are loaded all the same.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradewind.plans.jobs import Outcome, ingest_all
from tradewind.session import configure
from tradewind.sources.readers import read_checked_csv, read_csv, read_relational, with_audit

KINDS = ("relational", "csv", "checked_csv")


def reader(spark: SparkSession, name: str, source: Mapping) -> Callable[[], DataFrame]:
    """How a source is read; nothing is opened before the job runs."""
    kind = source.get("kind")
    if kind not in KINDS:
        raise ValueError(f"{name}: kind {kind!r} is none of {', '.join(KINDS)}")

    def read() -> DataFrame:
        if kind == "relational":
            bounds = tuple(source["bounds"]) if "bounds" in source else None
            df = read_relational(
                spark, source["url"], source["table"], source.get("split_column"), bounds,
                source.get("partitions", 1), source.get("properties"),
            )
            told = source["table"]
        else:
            schema = T.StructType.fromDDL(source["schema"])
            read_file = read_csv if kind == "csv" else read_checked_csv
            df, told = read_file(spark, source["path"], schema), source["path"]
        return with_audit(df, told, **source.get("audit", {}))

    return read


def run(spark: SparkSession, sources: Mapping[str, Mapping], target: str) -> list[Outcome]:
    """Copy every source to TARGET/<name>; unknown kinds are refused before anything is read."""
    configure(spark)
    return ingest_all(spark, {n: reader(spark, n, s) for n, s in sources.items()}, target)


def main() -> int:
    parser = argparse.ArgumentParser(prog="tradewind.ingest")
    parser.add_argument("sources")
    parser.add_argument("target")
    args = parser.parse_args()
    with open(args.sources, encoding="utf-8") as f:
        sources = json.load(f)
    outcomes = run(SparkSession.builder.appName("tradewind-ingest").getOrCreate(), sources, args.target)
    for o in outcomes:
        print(f"{'ok    ' if o.ok else 'FAILED'} {o.job} rows={o.rows} {o.seconds:.1f}s {o.error or ''}")
    return 0 if all(o.ok for o in outcomes) else 1


if __name__ == "__main__":
    raise SystemExit(main())
