"""Audits of the cleaned tables and the star: counts, gaps, keys, references, sentinels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import vocab

Tables = Mapping[str, DataFrame]

NULL_CHECKS = {
    "customers": ["customer_zip_code_prefix", "customer_city"],
    "orders": ["order_purchase_date", "order_status"],
    "order_items": ["product_id", "seller_id", "unit_price"],
    "order_payments": ["payment_type", "payment_value"],
    "order_reviews": ["review_score"],
    "sellers": ["seller_city"],
    "products": ["product_category_name"],
    "marketing_qualified_leads": ["first_contact_date", "origin"],
    "closed_deals": ["won_date", "business_segment"],
}

PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "marketing_qualified_leads": ["mql_id"],
    "closed_deals": ["mql_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["order_id"],
}

# child, column, parent, column, value that needs no parent
REFERENCES = [
    ("orders", "customer_id", "customers", "customer_id", None),
    ("order_items", "order_id", "orders", "order_id", None),
    ("order_items", "product_id", "products", "product_id", vocab.UNKNOWN),
    ("order_items", "seller_id", "sellers", "seller_id", vocab.UNKNOWN),
    ("order_payments", "order_id", "orders", "order_id", None),
    ("order_reviews", "order_id", "orders", "order_id", None),
    ("closed_deals", "mql_id", "marketing_qualified_leads", "mql_id", None),
    ("closed_deals", "seller_id", "sellers", "seller_id", None),
]

SENTINELS = [
    ("orders", "order_purchase_date", vocab.UNKNOWN_DATE),
    ("orders", "order_delivered_carrier_date", vocab.OPEN_DATE),
    ("orders", "order_delivered_customer_date", vocab.OPEN_DATE),
    ("orders", "order_delivered_carrier_date", vocab.UNKNOWN_DATE),
    ("order_reviews", "review_creation_date", vocab.UNKNOWN_DATE),
    ("order_reviews", "review_answer_date", vocab.UNKNOWN_DATE),
    ("closed_deals", "won_date", vocab.UNKNOWN_DATE),
]

DISTRIBUTIONS = [
    ("orders", "order_status"),
    ("order_payments", "payment_type"),
    ("marketing_qualified_leads", "origin"),
    ("closed_deals", "lead_type"),
    ("closed_deals", "business_type"),
    ("closed_deals", "lead_behaviour_profile"),
]

STAR_KEYS = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_sk"],
    "dim_product": ["product_sk"],
    "dim_seller": ["seller_sk"],
    "dim_marketing_channel": ["mql_channel_sk"],
    "fact_order_items": ["order_id_bk", "order_item_id_bk"],
    "fact_payments": ["order_id_bk", "payment_sequential_bk"],
    "fact_reviews": ["review_sk"],
    "review_comments": ["review_sk"],
    "fact_order_life_cycle": ["order_id_bk"],
    "fact_marketing_funnel": ["closed_deal_sk"],
}

STAR_REFERENCES = [
    ("fact_order_items", "purchase_date_key", "dim_date", "date_key", None),
    ("fact_order_items", "customer_sk", "dim_customer", "customer_sk", None),
    ("fact_order_items", "product_sk", "dim_product", "product_sk", None),
    ("fact_order_items", "seller_sk", "dim_seller", "seller_sk", None),
    ("fact_payments", "purchase_date_key", "dim_date", "date_key", None),
    ("fact_payments", "customer_sk", "dim_customer", "customer_sk", None),
    ("fact_payments", "payment_type_sk", "dim_payment_type", "payment_type_sk", None),
    ("fact_reviews", "review_answer_date_key", "dim_date", "date_key", None),
    ("fact_reviews", "customer_sk", "dim_customer", "customer_sk", None),
    ("review_comments", "review_sk", "fact_reviews", "review_sk", None),
    ("fact_order_life_cycle", "approval_date_key", "dim_date", "date_key", None),
    ("fact_order_life_cycle", "purchase_date_key", "dim_date", "date_key", None),
    ("fact_order_life_cycle", "delivery_date_key", "dim_date", "date_key", None),
    ("fact_order_life_cycle", "customer_sk", "dim_customer", "customer_sk", None),
    ("fact_order_life_cycle", "order_status_sk", "dim_order_status", "order_status_sk", None),
    ("fact_marketing_funnel", "first_contact_date_key", "dim_date", "date_key", None),
    ("fact_marketing_funnel", "seller_sk", "dim_seller", "seller_sk", None),
    ("fact_marketing_funnel", "mql_channel_sk", "dim_marketing_channel", "mql_channel_sk", None),
]


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _as_rows(table: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Many checks of one table in a single pass, one output row per check."""
    one = table.agg(*[c.alias(f"_{i}") for i, c in enumerate(checks.values())])
    pairs = [F.struct(F.lit(n).alias("check_name"), F.col(f"_{i}").alias("cnt")) for i, n in enumerate(checks)]
    return one.select(F.inline(F.array(*pairs)))


def table_counts(tables: Tables, names: Sequence[str]) -> DataFrame:
    return _stack(
        [tables[n].agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in names]
    )


def raw_against_clean(raw: Tables, clean: Tables, names: Sequence[str]) -> DataFrame:
    both = table_counts(raw, names).withColumnRenamed("row_count", "raw_rows")
    counts = both.join(table_counts(clean, names).withColumnRenamed("row_count", "clean_rows"), "table_name")
    return counts.withColumn("dupes_removed", F.col("raw_rows") - F.col("clean_rows"))


def null_audit(tables: Tables, checks: Mapping[str, Sequence[str]] = NULL_CHECKS) -> DataFrame:
    frames = []
    for name, columns in checks.items():
        bad = {
            f"{name}.{c} NULL": F.count_if(
                F.col(c).isNull() | (F.col(c) == "") if c == "order_status" else F.col(c).isNull()
            )
            for c in columns
        }
        frames.append(_as_rows(tables[name], bad))
    return _stack(frames)


def zip_audit(tables: Tables) -> DataFrame:
    """Postcodes that do not have five characters."""

    def bad(name: str, column: str) -> DataFrame:
        zip_len = F.length(column)
        return tables[name].where(zip_len != 5).select(
            F.lit(name).alias("tbl"), F.col(column).alias("zip"), zip_len.alias("zip_len")
        )

    return bad("customers", "customer_zip_code_prefix").unionByName(bad("sellers", "seller_zip_code_prefix"))


def date_type_audit(table: DataFrame) -> list[str]:
    """Date-named columns that are not of date type."""
    return [f.name for f in table.schema.fields if "date" in f.name and not isinstance(f.dataType, T.DateType)]


def sentinel_audit(tables: Tables, checks: Sequence[tuple[str, str, str]] = SENTINELS) -> DataFrame:
    frames = []
    for name in dict.fromkeys(t for t, _, _ in checks):
        found = {
            f"{t}: {c} = {day}": F.count_if(F.col(c) == F.lit(day).cast("date")) for t, c, day in checks if t == name
        }
        frames.append(_as_rows(tables[name], found))
    return _stack(frames)


def distributions(tables: Tables, columns: Sequence[tuple[str, str]] = DISTRIBUTIONS) -> DataFrame:
    return _stack(
        [
            tables[t]
            .groupBy(F.lit(f"{t}.{c}").alias("attribute"), F.col(c).alias("value"))
            .agg(F.count("*").alias("cnt"))
            for t, c in columns
        ]
    )


def title_case_audit(products: DataFrame) -> DataFrame:
    """Categories with an underscore left or all in lower case."""
    name = F.col("product_category_name")
    wrong = name.contains("_") | (name == F.lower(name))
    return products.where(wrong).groupBy("product_category_name").agg(F.count("*").alias("cnt"))


def unspecified_categories(products: DataFrame) -> DataFrame:
    missing = F.count_if(F.col("product_category_name") == vocab.NOT_SPECIFIED)
    return _as_rows(products, {"products with No Category": missing})


def key_audit(tables: Tables, keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS) -> DataFrame:
    """Surplus rows per key; repeated keys are counted where they are first combined."""
    frames = []
    for name, columns in keys.items():
        per_key = tables[name].groupBy(*columns).agg(F.count("*").alias("n"))
        surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long")
        frames.append(per_key.agg(F.lit(name).alias("tbl"), surplus.alias("dup_pk_rows")))
    return _stack(frames)


def reference_audit(tables: Tables, references: Sequence[tuple] = tuple(REFERENCES)) -> DataFrame:
    """Child rows without a parent; children are counted per value before the anti join."""
    frames = []
    for child, column, parent, parent_column, exempt in references:
        values = tables[child]
        if exempt is not None:
            values = values.where(F.col(column) != exempt)
        values = values.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
        known = tables[parent].select(F.col(parent_column).alias("v"))
        orphans = values.join(known, "v", "left_anti")
        name = f"{child}.{column} -> {parent}"
        frames.append(
            orphans.agg(F.lit(name).alias("check_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))
        )
    return _stack(frames)


def date_dimension_audit(dim_date: DataFrame) -> DataFrame:
    return dim_date.agg(
        F.count("*").alias("total_rows"),
        F.min("full_date").alias("min_date"),
        F.max("full_date").alias("max_date"),
        F.count_if(F.col("date_key").isin(vocab.UNKNOWN_DATE_KEY, vocab.OPEN_DATE_KEY)).alias("sentinel_rows"),
    )


def preview(table: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return table.orderBy(*order).limit(n)


def schema_profile(tables: Tables, names: Sequence[str]) -> DataFrame:
    """Columns, types and nullability with the row count of their table."""
    counts = table_counts(tables, names)
    frames = []
    for n in names:
        fields = tables[n].schema.fields
        rows = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("is_nullable"),
                F.lit(i).alias("ordinal"),
            )
            for i, f in enumerate(fields, start=1)
        ]
        here = counts.where(F.col("table_name") == n)
        frames.append(here.select("table_name", "row_count", F.inline(F.array(*rows))))
    return _stack(frames)


def catalog_profile(spark: SparkSession, database: str) -> DataFrame:
    """The same for the tables registered in a catalog database."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return schema_profile({n: spark.table(f"{database}.{n}") for n in names}, names)


class AuditError(RuntimeError):
    """A key or reference rule of the star is broken."""


def require_sound(keys: DataFrame, references: DataFrame) -> None:
    """Fail when any key repeats or any reference dangles (a handful of counter rows)."""
    broken = [r.tbl for r in keys.where("dup_pk_rows > 0").collect()]
    broken += [r.check_name for r in references.where("orphan_rows > 0").collect()]
    if broken:
        raise AuditError(", ".join(broken))
