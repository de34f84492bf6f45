"""Full run over a folder of raw tables.

    python -m tradewind RAW_FOLDER TARGET_FOLDER [--models] [--execute] [--csv FOLDER]

RAW_FOLDER holds one Parquet table per raw role; TARGET_FOLDER receives the
cleaned tables, the star and the order table.  A repeated run keeps surrogate
keys.  Models run only on request; without --execute their scores are not
written.  --csv exports the order table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tradewind.plans import jobs, quality
from tradewind.plans.warehouse import Warehouse
from tradewind.session import configure
from tradewind.sources.writers import export_csv

RAW_TABLES = [
    "customers",
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "sellers",
    "products",
    "product_category_name_translation",
    "marketing_qualified_leads",
    "closed_deals",
]


def run(spark: SparkSession, raw_folder: str, target: str, with_models: bool = False, execute: bool = False, csv: str | None = None):
    """Clean, load, audit, flatten and score; returns the outcome of every step."""
    raw = {n: (lambda n=n: spark.read.parquet(f"{raw_folder}/{n}")) for n in RAW_TABLES}
    warehouse = Warehouse(configure(spark), raw, target)
    outcomes = jobs.clean_all(warehouse) + jobs.load_star(warehouse)
    quality.require_sound(
        quality.key_audit(warehouse, quality.STAR_KEYS), quality.reference_audit(warehouse, quality.STAR_REFERENCES)
    )
    orders = warehouse["order_table"]
    if csv is not None:
        export_csv(orders, csv)
    if with_models:
        _, scored = jobs.run_models(orders, f"{target}/order_table_scored" if execute else None)
        outcomes += scored
    return outcomes


def main() -> None:
    parser = argparse.ArgumentParser(prog="tradewind")
    parser.add_argument("raw_folder")
    parser.add_argument("target")
    parser.add_argument("--models", action="store_true")
    parser.add_argument("--execute", action="store_true")
    parser.add_argument("--csv")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tradewind").getOrCreate()
    for o in run(spark, args.raw_folder, args.target, args.models, args.execute, args.csv):
        print(f"{'ok    ' if o.ok else 'FAILED'} {o.job} rows={o.rows} {o.seconds:.1f}s {o.error or ''}")


if __name__ == "__main__":
    main()
