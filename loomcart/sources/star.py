"""The star schema as one value, and the ways to load and register it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.sources.schemas import SCHEMAS


Source = Callable[[], DataFrame]


class Star:
    """Five tables, each given as a function and read on first use: a report touches only what it needs.

    ``lines`` are the order items without the list price. A source that has to
    look the price up gives them separately, so that net-revenue reports never
    pay for that join.
    """

    def __init__(
        self,
        customers: Source,
        products: Source,
        dates: Source,
        orders: Source,
        order_items: Source,
        lines: Source | None = None,
    ) -> None:
        self._sources = {
            "customers": customers,
            "products": products,
            "dates": dates,
            "orders": orders,
            "order_items": order_items,
            "lines": lines,
        }

    def with_tables(self, **tables: Source) -> Star:
        return Star(**{**self._sources, **tables})

    @cached_property
    def customers(self) -> DataFrame:
        return self._sources["customers"]()

    @cached_property
    def products(self) -> DataFrame:
        return self._sources["products"]()

    @cached_property
    def dates(self) -> DataFrame:
        return self._sources["dates"]()

    @cached_property
    def orders(self) -> DataFrame:
        return self._sources["orders"]()

    @cached_property
    def order_items(self) -> DataFrame:
        return self._sources["order_items"]()

    @cached_property
    def lines(self) -> DataFrame:
        given = self._sources["lines"]
        return given() if given else self.order_items.drop("unit_price")

    def bare(self, table: str) -> DataFrame:
        """One table by its schema name, for counts and keys: order items come without the price that is looked up."""
        names = {
            "dim_customers": "customers",
            "dim_products": "products",
            "dim_date": "dates",
            "fact_orders": "orders",
            "fact_order_items": "lines",
        }
        return getattr(self, names[table])

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_customers": self.customers,
            "dim_products": self.products,
            "dim_date": self.dates,
            "fact_orders": self.orders,
            "fact_order_items": self.order_items,
        }


def star_of(read: Callable[[str], DataFrame]) -> Star:
    """A star from a function that reads a table by its schema name."""
    return Star(
        customers=lambda: read("dim_customers"),
        products=lambda: read("dim_products"),
        dates=lambda: read("dim_date"),
        orders=lambda: read("fact_orders"),
        order_items=lambda: read("fact_order_items"),
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the declared columns; a missing column is an error."""
    fields = SCHEMAS[table].fields
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks columns: {', '.join(missing)}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Typed CSV scan; a file whose header or values do not fit the types fails."""
    return (
        spark.read.schema(SCHEMAS[table])
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_csv_star(spark: SparkSession, folder: str) -> Star:
    return star_of(lambda t: read_csv_table(spark, f"{folder}/{t}.csv", t))


def read_parquet_star(spark: SparkSession, folder: str) -> Star:
    return star_of(lambda t: conform(spark.read.parquet(f"{folder}/{t}"), t))


def write_parquet_star(star: Star, folder: str) -> None:
    for table, df in star.tables().items():
        df.write.mode("overwrite").parquet(f"{folder}/{table}")


def register(star: Star) -> None:
    """Create or replace one temporary view per table, for use from SQL."""
    for table, df in star.tables().items():
        df.createOrReplaceTempView(table)


#: Tables that are bucketed and sorted by a key that others meet them by.
BUCKETED = {"dim_customers": "customer_id", "fact_orders": "order_id", "fact_order_items": "order_id"}


def store_star(star: Star, folder: str, prefix: str = "", buckets: int = 8) -> None:
    """Catalog tables ``<prefix>dim_customers`` and so on with their files under ``folder``; existing ones are replaced.

    Orders and items are bucketed and sorted by order, so that reports which sum items per order and join the orders read
    both without a shuffle. Give a multiple of the cores, and enough that a bucket fits a task.
    """
    for table, df in star.tables().items():
        key = BUCKETED.get(table)
        writer = (df.repartition(buckets, key) if key else df).write.mode("overwrite").option("path", f"{folder}/{table}")
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.format("parquet").saveAsTable(f"{prefix}{table}")


def stored_star(spark: SparkSession, prefix: str = "") -> Star:
    """The tables that ``store_star`` made, by name."""
    return star_of(lambda t: spark.table(f"{prefix}{t}"))


def drop_star(spark: SparkSession, prefix: str = "") -> None:
    """Forgets the tables' names; their files stay."""
    for table in SCHEMAS:
        spark.sql(f"DROP TABLE IF EXISTS `{prefix}{table}`")


def load_report(star: Star) -> DataFrame:
    """Rows per table."""
    counts = [
        star.bare(table).agg(F.count(F.lit(1)).alias("loaded_rows")).select(F.lit(table).alias("table_name"), "loaded_rows")
        for table in SCHEMAS
    ]
    return reduce(DataFrame.unionByName, counts)
