"""Test tables in the roles of the retail store's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import surrogate_key
from strata.operators import scd1, scd2
from strata.operators.scd import END_AT, START_AT
from strata.plans import Dimension
from strata.session import scratch_path, written
from strata.sources import Bucketed, store_bucketed

EVENT_KEYS, EVENT_SEQUENCE, EVENT_DELETE = ["user_id"], "ts", "event_type = 'error'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of sale details; (transaction, line) repeats, the last by ship date counts."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS transaction_id",
        "l_linenumber AS line_item_id",
        "l_partkey AS product_id",
        "l_suppkey",
        "l_quantity AS quantity",
        "l_extendedprice AS unit_price",
        "l_discount AS discount_pct",
        "l_extendedprice AS line_total",
        "CAST(l_shipdate AS DATE) AS modified_date",
    )


LINE_KEYS = ["transaction_id", "line_item_id"]
LINE_TIES = ["product_id", "l_suppkey"]


def current_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(sale_lines(spark, sf_dir), LINE_KEYS, "modified_date", LINE_TIES, dealt_by=["transaction_id"])


def sale_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sales: the clerk is a number made from the order key, the location is the customer's nation."""
    places = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS location_id")
    return (
        table(spark, sf_dir, "orders")
        .join(places, "o_custkey")
        .selectExpr(
            "o_orderkey AS transaction_id",
            "pmod(o_orderkey, 97) AS employee_id",
            "o_custkey AS customer_id",
            "location_id",
            "CAST(o_orderdate AS DATE) AS transaction_date",
            "o_totalprice AS total_amount",
            "o_orderpriority AS payment_type",
            "CAST(o_orderdate AS DATE) AS created_date",
            "CAST(o_orderdate AS DATE) AS modified_date",
        )
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer changes on the day of an order; of several orders on a day the highest priority text counts."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS modified_date",
        "o_orderpriority AS priority",
    )


def store_history(changes: DataFrame, keys: list[str], fold: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The history that ``fold`` makes of changes, stored; ``keys`` are those of its members."""
    return written(fold(changes), name)


def bucketed(df: DataFrame, name: str, keys: list[str], **how) -> Bucketed:
    spark = df.sparkSession
    spark.sql("CREATE SCHEMA IF NOT EXISTS strata_bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return store_bucketed(df, f"strata_bucketed.{name}", scratch_path(spark, f"bucketed-{name}"), keys, buckets, **how)


def bucketed_history(changes: DataFrame, keys: list[str], fold: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """:func:`store_history` in buckets of the members, so that versions are shuffled once, before they have keys."""
    return bucketed(changes, name, keys, step=fold).rows()


def customer_history(spark: SparkSession, sf_dir: str, store=store_history) -> DataFrame:
    """Stored, as dimensions are: facts are joined to tables, not to the queries behind them."""
    history = store(customer_changes(spark, sf_dir), ["customer_id"], _customer_versions, "dim_customer")
    return _keyed(history, "customer_id", "dim_customer_key")


def _customer_versions(changes: DataFrame) -> DataFrame:
    history = scd2(changes, ["customer_id"], "modified_date", ["priority"])
    return history.select(*changes.columns, START_AT, END_AT)


def _keyed(history: DataFrame, member: str, name: str) -> DataFrame:
    """A history with the key of its versions, which is made when they are read: it is twice as long as the rest."""
    columns = [c for c in history.columns if c not in (START_AT, END_AT)]
    return history.select(*columns, surrogate_key(member, "modified_date").alias(name), START_AT, END_AT)


def _periodic(df: DataFrame, key: str, period: str, date: str, effective, name: str, store) -> DataFrame:
    """Stored history with one version per key and calendar period, so no key can have many."""
    changes = (
        df.groupBy(key, F.date_trunc(period, date).alias("period"))
        .agg(effective.cast("date").alias("modified_date"))
        .select(key, "modified_date")
    )

    def versions(df: DataFrame) -> DataFrame:
        history = scd2(df, [key], "modified_date", rows_per_slice=None)
        return history.select(key, "modified_date", START_AT, END_AT)

    return _keyed(store(changes, [key], versions, f"dim_{key}"), key, name)


def dimensions(spark: SparkSession, sf_dir: str, store=bucketed_history) -> list[Dimension]:
    """Employees from their first sale of a year, locations from their last sale of a year, products by quarter."""
    sales = sale_headers(spark, sf_dir)
    employees = _periodic(
        sales, "employee_id", "year", "transaction_date", F.min("transaction_date"), "dim_employee_key", store_history
    )
    location = _periodic(
        sales, "location_id", "year", "transaction_date", F.max("transaction_date"), "dim_location_key", store_history
    )
    products = _periodic(
        sale_lines(spark, sf_dir), "product_id", "quarter", "modified_date", F.min("modified_date"), "dim_product_key", store
    )
    customers = customer_history(spark, sf_dir, store)
    parts = [
        (employees, "employee_id", "dim_employee_key", "-1", True),
        (customers, "customer_id", "dim_customer_key", "-1", False),
        (location, "location_id", "dim_location_key", "-1", True),
        (products, "product_id", "dim_product_key", None, False),
    ]
    # A version begins with the date its key is made of.
    return [Dimension(h, {k: k}, {c: c}, unknown, small, {c: (k, START_AT)}) for h, k, c, unknown, small in parts]
