"""The whole warehouse over one raw folder, each table written once and read back by its readers."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans import calendar, cleaning, order_table, star
from tradewind.session import configure, shared_folder
from tradewind.sources.versions import VersionedTable
from tradewind.sources.writers import LoadReport, Steps, one_plan, replace_table

DIMENSIONS = [
    "dim_date",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "dim_marketing_channel",
    "dim_payment_type",
    "dim_order_status",
]
FACTS = [
    "fact_order_items",
    "fact_payments",
    "fact_reviews",
    "review_comments",
    "fact_order_life_cycle",
    "fact_marketing_funnel",
]


# rows are laid out by day in the written tables, so a range of days reads few files;
# the key columns after it split a day, or an order, that holds very many rows
LAYOUT = {
    "fact_order_items": ("purchase_date_key", "order_id_bk", "order_item_id_bk"),
    "fact_payments": ("purchase_date_key", "order_id_bk", "payment_sequential_bk"),
    "fact_reviews": ("review_answer_date_key", "order_id_bk"),
    "fact_order_life_cycle": ("purchase_date_key", "order_id_bk"),
    "order_table": ("purchase_date", "order_id"),
}


# dimensions whose keys and vanished members outlive a load
UPSERTED = {"dim_customer", "dim_product", "dim_seller", "dim_marketing_channel"}


# several shuffles of all lines or orders: written in steps
STEPPED = {"fact_order_items", "fact_order_life_cycle", "order_table"}


class Warehouse(Mapping):
    """Tables by name; a table is built with what it depends on when first asked for.

    `raw` maps a raw table name to a function giving its frame.  A load into a
    root folder that holds an earlier one upserts the dimensions and replaces
    the rest.  Without a root nothing is written and every table stays a plan.
    """

    def __init__(self, spark: SparkSession, raw: Mapping[str, Callable[[], DataFrame]], root: str | None = None):
        self.spark = configure(spark)
        self.raw = raw
        self.root = root
        self.reports: dict[str, LoadReport] = {}
        self._ready: dict[str, DataFrame] = {}
        self._jobs: dict[str, Callable[[], DataFrame]] = {
            **{name: self._cleaning_job(name) for name in cleaning.JOBS},
            "dim_date": lambda: calendar.spine_for(self["orders"]),
            "dim_customer": lambda old=None: star.dim_customer(self["customers"], old),
            "dim_product": lambda old=None: star.dim_product(self["products"], old),
            "dim_seller": lambda old=None: star.dim_seller(self["sellers"], old),
            "dim_marketing_channel": lambda old=None: star.dim_marketing_channel(
                self["marketing_qualified_leads"], self["closed_deals"], old
            ),
            "dim_payment_type": lambda: star.dim_payment_type(self.spark),
            "dim_order_status": lambda: star.dim_order_status(self.spark),
            "order_customer": lambda: star.order_customer(self["orders"], self["customers"], self["dim_customer"]),
            "keyed_reviews": lambda: star.keyed_reviews(self["order_reviews"], self["order_customer"]),
            "fact_order_items": lambda step=one_plan: star.fact_order_items(
                self["order_items"], self["order_customer"], self["dim_product"], self["dim_seller"], step
            ),
            "fact_payments": lambda: star.fact_payments(
                self["order_payments"], self["order_customer"], self["dim_payment_type"]
            ),
            "fact_reviews": lambda: star.fact_reviews(self["keyed_reviews"]),
            "review_comments": lambda: star.review_comments(self["keyed_reviews"]),
            "fact_order_life_cycle": lambda step=one_plan: star.fact_order_life_cycle(
                self["orders"],
                self["order_customer"],
                self["order_items"],
                self["order_payments"],
                self["dim_order_status"],
                step,
            ),
            "fact_marketing_funnel": lambda: star.fact_marketing_funnel(
                self["closed_deals"],
                self["marketing_qualified_leads"],
                self["dim_seller"],
                self["dim_marketing_channel"],
            ),
            "order_table": lambda step=one_plan: order_table.build_order_table(self, with_scores=False, step=step),
        }
        # loads may run side by side; a table two of them need is built once
        self._locks = {name: threading.RLock() for name in self._jobs}

    def _cleaning_job(self, name: str) -> Callable[[], DataFrame]:
        job, inputs = cleaning.JOBS[name]
        return lambda: job(*[self.raw[i]() for i in inputs])

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._jobs:
            raise KeyError(name)
        with self._locks[name]:
            if name not in self._ready:
                self._ready[name] = self._built(name)
        return self._ready[name]

    def _built(self, name: str) -> DataFrame:
        if self.root is None:
            return self._jobs[name]()
        path = f"{self.root}/{name}"
        if name in UPSERTED:
            # the old keys stay readable until the new version is committed
            table = VersionedTable(self.spark, path)
            self.reports[name] = table.replace(self._jobs[name](table.read()))
            return table.read()
        steps = Steps(self.spark, f"{self.root}/_steps")
        try:
            frame = self._jobs[name](steps) if name in STEPPED else self._jobs[name]()
            if name in LAYOUT:
                # ranges are found by reading the frame once more
                frame = steps(frame).repartitionByRange(*LAYOUT[name]).sortWithinPartitions(*LAYOUT[name])
            self.reports[name] = replace_table(frame, path)
        finally:
            steps.clear()
        return self.spark.read.parquet(path)

    def __iter__(self):
        return iter(self._jobs)

    def __len__(self) -> int:
        return len(self._jobs)

    def plan(self, name: str) -> DataFrame:
        """The job of one table over its stored inputs as a first load, not written."""
        return self._jobs[name]()


def over_given_tables(spark: SparkSession, folder: str) -> Warehouse:
    """Warehouse over the given tables.

    It is shared by all queries of one application, as reports share a loaded
    warehouse, and lives in the cluster's shared folder.
    """
    from tradewind.sources import binding

    app = spark.sparkContext.applicationId
    key = (app, folder.rstrip("/"))
    if key not in _LOADED:
        raw = {name: (lambda read=read: read(spark, folder)) for name, read in binding.RAW.items()}
        tag = folder.strip("/").replace("/", "_")
        _LOADED[key] = Warehouse(spark, raw, f"{shared_folder(spark)}/tradewind/{app}/{tag}")
    return _LOADED[key]


_LOADED: dict[tuple[str, str], Warehouse] = {}
