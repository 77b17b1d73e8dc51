"""Derives the star schema from the TPC-H-like parquet tables.

The value rules (signup dates, test groups, statuses, discounts) are fixed by
the project's fixture description; tests and oracles rely on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.operators.calendar import calendar_covering
from loomcart.operators.lookup import lookup
from loomcart.sources.star import Star

TEST_START = "1998-01-01"
TEST_END = "1998-03-31"


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    # Grouped, so that the optimizer knows the key to be unique and leaves the join out where no report asks for the name.
    nations = spark.read.parquet(f"{folder}/nation.parquet").groupBy(F.col("n_nationkey").alias("c_nationkey")).agg(F.first("n_name").alias("n_name"))
    key = F.col("c_custkey")
    return (
        spark.read.parquet(f"{folder}/customer.parquet")
        .join(nations, "c_nationkey", "left")
        .select(
            key.alias("customer_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), ((key * 7919) % 1800).cast("int")).alias("signup_date"),
            F.col("n_name").alias("country"),
            F.when(key % 25 == 0, "Other").when(key % 2 == 0, "M").otherwise("F").alias("gender"),
            (18 + (key * 31) % 47).cast("int").alias("age"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            _group(key).alias("ab_test_group"),
        )
    )


def _group(customer_key: Column) -> Column:
    return F.when((customer_key * 7) % 10 < 4, "control").otherwise("treatment")


def _products(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return spark.read.parquet(f"{folder}/part.parquet").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.round(price * F.lit("0.60").cast("decimal(3,2)"), 2).cast("decimal(10,2)").alias("unit_cost"),
        price.alias("unit_price"),
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.read.parquet(f"{folder}/orders.parquet")
    # Compared as timestamps, not as dates, so that the range reaches the scan.
    placed = F.col("o_orderdate")
    kind = raw.schema["o_orderdate"].dataType
    in_test = (placed >= F.lit(TEST_START).cast(kind)) & (
        placed < F.date_add(F.lit(TEST_END).cast("date"), 1).cast(kind)
    )
    group = _group(F.col("o_custkey"))
    return raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        placed.cast("date").alias("order_date"),
        # Nested, so that a filter on Completed folds to the first condition and reaches the scan.
        F.when(F.col("o_orderstatus").isin("F", "O"), "Completed")
        .otherwise(F.when(F.col("o_orderpriority") < "3", "Cancelled").otherwise("Returned"))
        .alias("order_status"),
        F.when(F.col("o_orderkey") % 20 < 11, "Web").otherwise("Mobile App").alias("channel"),
        group.alias("ab_test_group"),
        in_test.alias("in_ab_test"),
        F.when(in_test & (group == "treatment"), F.lit("0.15").cast("decimal(5,2)"))
        .otherwise(F.lit("0.00").cast("decimal(5,2)"))
        .alias("discount_pct"),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    net = F.col("l_extendedprice").cast("decimal(15,2)") * (1 - F.col("l_discount").cast("decimal(5,2)"))
    return spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        net.cast("decimal(15,2)").alias("line_total"),  # rounds halves up
    )


def _items(lines: DataFrame, products: DataFrame) -> DataFrame:
    # Every line is kept, priced or not, so that the foreign-key check can see orphans.
    prices = products.select("product_id", "unit_price")
    return lookup(lines, prices, "product_id", spread="order_id").select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"
    )


def _days(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return calendar_covering(customers.select(F.col("signup_date").alias("date")).union(orders.select("order_date")))


def read_star(spark: SparkSession, folder: str) -> Star:
    star = Star(
        customers=lambda: _customers(spark, folder),
        products=lambda: _products(spark, folder),
        dates=lambda: _days(star.customers, star.orders),
        orders=lambda: _orders(spark, folder),
        order_items=lambda: _items(star.lines, star.products),
        lines=lambda: _lines(spark, folder),
    )
    return star
