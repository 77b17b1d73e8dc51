"""Column types, primary keys and references of the five tables."""

from pyspark.sql import types as T


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


MONEY = T.DecimalType(10, 2)
LINE_MONEY = T.DecimalType(15, 2)
RATE = T.DecimalType(5, 2)

SCHEMAS: dict[str, T.StructType] = {
    "dim_customers": _struct(
        ("customer_id", T.LongType()),
        ("signup_date", T.DateType()),
        ("country", T.StringType()),
        ("gender", T.StringType()),
        ("age", T.IntegerType()),
        ("acquisition_channel", T.StringType()),
        ("ab_test_group", T.StringType()),
    ),
    "dim_products": _struct(
        ("product_id", T.LongType()),
        ("product_name", T.StringType()),
        ("category", T.StringType()),
        ("sub_category", T.StringType()),
        ("unit_cost", MONEY),
        ("unit_price", MONEY),
    ),
    "dim_date": _struct(
        ("date", T.DateType()),
        ("day", T.IntegerType()),
        ("month", T.IntegerType()),
        ("month_name", T.StringType()),
        ("quarter", T.IntegerType()),
        ("year", T.IntegerType()),
        ("day_of_week", T.StringType()),
        ("is_weekend", T.BooleanType()),
    ),
    "fact_orders": _struct(
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("order_date", T.DateType()),
        ("order_status", T.StringType()),
        ("channel", T.StringType()),
        ("ab_test_group", T.StringType()),
        ("in_ab_test", T.BooleanType()),
        ("discount_pct", RATE),
    ),
    "fact_order_items": _struct(
        ("order_item_id", T.LongType()),
        ("order_id", T.LongType()),
        ("product_id", T.LongType()),
        ("quantity", T.IntegerType()),
        ("unit_price", MONEY),
        ("line_total", LINE_MONEY),
    ),
}

PRIMARY_KEYS: dict[str, str] = {
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_date": "date",
    "fact_orders": "order_id",
    "fact_order_items": "order_item_id",
}

# (fact table, column, dimension table, column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_orders", "order_date", "dim_date", "date"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
]
