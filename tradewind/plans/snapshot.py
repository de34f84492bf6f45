"""The order life cycle as an accumulating snapshot: only orders whose inputs changed are computed again."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.plans import star
from tradewind.session import staged
from tradewind.sources.versions import VersionedTable

MARK = "row_mark"
MONTH = "purchase_month"
INPUTS = ("orders", "order_customer", "order_items", "order_payments")

# what the fact takes from each input; load stamps do not make a row a changed one
READ = {
    "orders": [
        "order_status",
        "order_purchase_date",
        "order_approved_date",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_customer": ["customer_sk"],
    "order_items": ["product_id", "seller_id", "unit_price", "unit_freight_value"],
    "order_payments": ["payment_value"],
}


def _hash(columns: list[str]) -> Column:
    # a missing value must not hash like an absent one
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def marks(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """order_id and a mark that changes with any value the fact is made of.

    Child rows count as a multiset: sums of two hashes each, formed before the shuffle,
    so a very large order fills no task.
    """
    base = inputs["orders"].select("order_id", _hash(READ["orders"]).alias("m_order"))
    base = base.join(inputs["order_customer"].select("order_id", _hash(READ["order_customer"]).alias("m_customer")), "order_id")
    for name in ("order_items", "order_payments"):
        h = _hash(READ[name])
        # halves, so that a sum of any number of them stays in a long
        halves = [F.shiftright(h, 32).alias("a"), h.bitwiseAND(F.lit(2**32 - 1)).alias("b")]
        rows = inputs[name].select("order_id", *halves).groupBy("order_id")
        sums = rows.agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
        base = base.join(sums.select("order_id", F.struct("n", "a", "b").alias(f"m_{name}")), "order_id", "left")
    text = F.to_json(F.struct("m_order", "m_customer", "m_order_items", "m_order_payments"))
    return base.select("order_id", F.md5(text).alias(MARK))


@dataclass(frozen=True)
class Refresh:
    """What a refresh did."""

    orders: int  # computed again or removed
    months: int  # parts written again
    rows: int  # rows written


def _month(date_key: str) -> Column:
    return F.floor(F.col(date_key) / 100).cast("int")


class LifeCycle:
    """The fact under `root`, cut by purchase month; every row carries the mark of its inputs."""

    def __init__(self, table: VersionedTable):
        self.table = table

    def read(self) -> DataFrame:
        return self.table.read().drop(MARK, MONTH)

    def _facts(self, inputs: Mapping[str, DataFrame], marked: DataFrame, statuses: DataFrame) -> DataFrame:
        fact = star.fact_order_life_cycle(*[inputs[n] for n in INPUTS], statuses)
        fact = fact.join(marked.withColumnRenamed("order_id", "order_id_bk"), "order_id_bk")
        return fact.withColumn(MONTH, _month("purchase_date_key"))

    def refresh(self, inputs: Mapping[str, DataFrame], statuses: DataFrame) -> Refresh:
        """Bring the fact up to its inputs.

        Orders are compared by mark.  Changed and new ones are computed from their own
        input rows; months that hold one, before or after, are written again with the
        rows that stay, all other months keep their files.  Keys of rows that stay are
        kept, new ones are larger than all old ones.
        """
        marked = marks(inputs)
        old = self.table.read()
        if old is None:
            fact = self._facts(inputs, marked, statuses)
            report = self.table.replace_all_parts(fact, MONTH)
            return Refresh(report.rows, len(self.table.latest().folders), report.rows)
        before = old.select(F.col("order_id_bk").alias("order_id"), F.col(MARK).alias("old_mark"), F.col(MONTH).alias("old_month"))
        pair = before.join(marked, "order_id", "full_outer")
        touched = staged(pair.where(~F.col("old_mark").eqNullSafe(F.col(MARK))))
        n = touched.count()
        if not n:
            return Refresh(0, 0, 0)
        now = touched.where(F.col(MARK).isNotNull())
        own = {name: df.join(now.select("order_id"), "order_id", "left_semi") for name, df in inputs.items()}
        top = old.agg(F.max("order_fulfillment_sk")).scalar()
        fresh = self._facts(own, now.select("order_id", MARK), statuses)
        fresh = staged(fresh.withColumn("order_fulfillment_sk", F.coalesce(top, F.lit(-1)) + 1 + F.col("order_fulfillment_sk")))
        # months of the calendar
        months = touched.select("old_month").union(fresh.select(MONTH)).distinct().where("old_month IS NOT NULL")
        months = sorted(str(r[0]) for r in months.collect())
        left = self.table.read(months).join(touched.select(F.col("order_id").alias("order_id_bk")), "order_id_bk", "left_anti")
        report = self.table.replace_parts(left.select(*old.columns).unionByName(fresh), MONTH, months)
        return Refresh(n, len(months), report.rows)
