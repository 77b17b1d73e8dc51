"""Hand-made stars of a few rows."""

from __future__ import annotations

import datetime
from decimal import Decimal

from loomcart.operators.calendar import calendar_covering
from loomcart.sources.schemas import SCHEMAS
from loomcart.sources.star import Star

D = datetime.date


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table])


def make_star(spark, customers=(), orders=(), items=(), products=()) -> Star:
    """customers: (id, signup, group); orders: (id, customer, day, status[, in_test[, group]]); items: (order, product, qty, price, total)."""
    c = frame(spark, "dim_customers", [(i, s, "X", "F", 30, "Web", g) for i, s, g in customers])
    o = frame(
        spark,
        "fact_orders",
        [
            (r[0], r[1], r[2], r[3], "Web", r[5] if len(r) > 5 else "control", r[4] if len(r) > 4 else False, Decimal("0"))
            for r in orders
        ],
    )
    i = frame(
        spark,
        "fact_order_items",
        [(n, r[0], r[1], r[2], Decimal(str(r[3])), Decimal(str(r[4]))) for n, r in enumerate(items)],
    )
    p = frame(
        spark,
        "dim_products",
        [(k, f"p{k}", cat, "s", Decimal(str(cost)), Decimal(str(price))) for k, cat, cost, price in products],
    )
    return Star(
        customers=lambda: c,
        products=lambda: p,
        dates=lambda: calendar_covering(o.selectExpr("order_date AS date")),
        orders=lambda: o,
        order_items=lambda: i,
    )
