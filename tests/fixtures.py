"""Hand-built micro-fixtures over the logical schema (keys are bigint, as
produced by the adapter)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from ledgerlens.sources.adapter import Tables

D = Decimal

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.DateType()), T.StructField("status", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("order_total", T.DecimalType(18, 2)),
    T.StructField("coupon_used", T.ShortType()), T.StructField("delivery_date", T.DateType()),
])
ITEMS = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("unit_price", T.DoubleType()),
    T.StructField("discount_pct", T.DecimalType(5, 4)),
    T.StructField("line_total", T.DecimalType(18, 6)),
])
PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()), T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("brand", T.StringType()),
    T.StructField("selling_price", T.DecimalType(18, 2)),
    T.StructField("cost_price", T.DecimalType(18, 3)),
    T.StructField("stock_quantity", T.IntegerType()), T.StructField("rating", T.DecimalType(3, 1)),
    T.StructField("is_active", T.ShortType()),
])
CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("acquisition_channel", T.StringType()),
    T.StructField("age_group", T.StringType()), T.StructField("gender", T.StringType()),
])
RETURNS = T.StructType([
    T.StructField("return_id", T.StringType()), T.StructField("order_id", T.LongType()),
    T.StructField("return_date", T.DateType()), T.StructField("reason", T.StringType()),
    T.StructField("refund_amount", T.DecimalType(18, 6)),
    T.StructField("return_status", T.StringType()),
])


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def order(oid, cid, date, status="Delivered", total="100.00", pay="card", coupon=0, delivered=None):
    return (oid, cid, day(date), status, pay, D(total), coupon,
            day(delivered) if delivered else None)


def item(oid, pid, qty=1, price=100.0, disc="0", total=None):
    lt = D(total) if total is not None else D(str(price)) * qty * (1 - D(disc))
    return (oid, pid, qty, price, D(disc), lt)


def product(pid, cat="A", price="100.00", cost="60.000", stock=100, rating="4.0", active=1,
            name=None):
    return (pid, name or f"p{pid}", cat, "b", D(price), D(cost), stock, D(rating), active)


def customer(cid, email=None, city="c", country="X", channel="web"):
    return (cid, f"f{cid}", f"l{cid}", email if email is not None else f"e{cid}@x", city, city,
            country, "0", channel, "0")


def make_tables(spark, orders=(), items=(), products=(), customers=(), returns=()) -> Tables:
    c = spark.createDataFrame(list(customers), CUSTOMERS)
    return Tables(
        customers=c,
        products=spark.createDataFrame(list(products), PRODUCTS),
        orders=spark.createDataFrame(list(orders), ORDERS),
        order_items=spark.createDataFrame(list(items), ITEMS),
        returns=spark.createDataFrame(list(returns), RETURNS),
        customer_geo=c.selectExpr("customer_id", "age_group AS channel", "country"),
    )
