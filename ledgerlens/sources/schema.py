"""Logical table schemas (the documented retail star schema).

Keys stay ``bigint`` when the data comes from the test tables; the CSV
schemas below keep the documented string keys.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("registration_date", T.DateType()),
    T.StructField("acquisition_channel", T.StringType()),
    T.StructField("age_group", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("selling_price", MONEY),
    T.StructField("cost_price", MONEY),
    T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("rating", T.DecimalType(3, 1)),
    T.StructField("is_active", T.ShortType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("delivery_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("order_total", MONEY),
    T.StructField("shipping_fee", MONEY),
    T.StructField("coupon_used", T.ShortType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
    T.StructField("discount_pct", T.DecimalType(5, 4)),
    T.StructField("line_total", T.DecimalType(18, 6)),
])

RETURNS = T.StructType([
    T.StructField("return_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("return_date", T.DateType()),
    T.StructField("reason", T.StringType()),
    T.StructField("refund_amount", MONEY),
    T.StructField("return_status", T.StringType()),
])

TABLE_SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "returns": RETURNS,
}

# Churn-model metrics document (one JSON object with a nested matrix).
CHURN_METRICS = T.StructType([
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("churn_rate", T.DoubleType()),
    T.StructField("confusion_matrix", T.StructType([
        T.StructField("TP", T.LongType()),
        T.StructField("TN", T.LongType()),
        T.StructField("FP", T.LongType()),
        T.StructField("FN", T.LongType()),
    ])),
])
